"""Trees cut at several depths."""

import numpy as np
from pyspark.sql import functions as F

from cohortwise.models import search, zoo
from cohortwise.models.frame import FOLD, model_frame


def test_deep_trees_are_cut_at_every_depth(spark):
    rng = np.random.default_rng(3)
    rows = [(i, float(a), float(b), int(c)) for i, (a, b, c) in enumerate(zip(rng.random(600), rng.random(600), rng.integers(0, 2, 600)))]
    df = spark.createDataFrame(rows, "id int, a double, b double, y int").withColumn(FOLD, F.col("id") % 3)
    frame = model_frame(df, ["a", "b"], "y", keep=["id", FOLD])
    spec = zoo.ModelSpec("DecisionTree", "tree", {"maxDepth": 14})
    model, depths = zoo.fit(spec, frame), [0, 2, 5, 14]
    assert model.model.numNodes > 200
    got = frame.select("id", zoo.depth_votes(spark, model.model, depths).alias("v"), *[zoo.tree_vote(model.model, d).alias(f"d{d}") for d in depths[:3]])
    whole = {r["id"]: r["prediction"] for r in model.model.transform(frame).collect()}
    for r in got.collect():
        assert r["v"][:3] == [r["d0"], r["d2"], r["d5"]] and r["v"][3] == whole[r["id"]]
    options = [{"maxDepth": d} for d in (2, 14)]
    assert search._shares(model, options, frame) == [search.accuracy(zoo.fit(spec.with_params(**o), frame).score(frame)) for o in options]
