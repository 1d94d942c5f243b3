"""The neighbour join is dealt to more cells and tasks where there is more to compare."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from cohortwise.models import neighbours as N


def test_cells_and_tasks_grow_with_the_pairs(spark, monkeypatch):
    rng = np.random.default_rng(5)
    x, q = rng.random((900, 2)), rng.random((60, 2))
    points = spark.createDataFrame([(p.tolist(), 1.0, float(i % 2)) for i, p in enumerate(x)], "values array<double>, n double, y double")
    probes = spark.createDataFrame([(p.tolist(),) for p in q], "values array<double>")
    assert len(N.choose_pivots(points)) == N.PIVOTS
    monkeypatch.setattr(N, "CELL_POINTS", 3)
    assert len(N.choose_pivots(points)) == 300
    assert N._rows(np.zeros((2 * N.PIVOTS, 2))) == N.BLOCK // 2
    monkeypatch.setattr(N, "TASK_PAIRS", 500)
    placed, asked = (df.withColumn("cell", F.lit(0)) for df in (points, probes))
    met = N._meet(placed, asked, {0: 900}, 3, 2)
    assert met.rdd.getNumPartitions() == 900 * 60 // 500
    for found in (met, N.neighbours(points, probes, 3)):
        got = {tuple(r["values"]): [n["d2"] for n in r["near"]] for r in found.collect()}
        want = {tuple(p): sorted(((x - p) ** 2).sum(1))[:3] for p in q.tolist()}
        assert got.keys() == want.keys() and all(got[p] == pytest.approx(want[p], abs=1e-9) for p in want)
