"""Forests on binned cells against plain versions."""

import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from cohortwise.models import forest, stumps, zoo
from cohortwise.models.frame import FEATURES, LABEL


def _frame(spark, rows=400, seed=3):
    rng = np.random.default_rng(seed)
    x = np.column_stack([rng.integers(0, 3, rows), rng.integers(0, 6, rows), rng.integers(0, 20, rows) / 4]).astype(float)
    y = (x[:, 0] + x[:, 2] + rng.normal(scale=1.0, size=rows) > 4).astype(int)
    table = spark.createDataFrame([(i, v.tolist(), int(l)) for i, (v, l) in enumerate(zip(x, y))], f"id int, values array<double>, {LABEL} int")
    return table.withColumn(FEATURES, array_to_vector("values"))


def _probs(model, frame):
    return [r["prob"] for r in model.score(frame).orderBy("id").select("prob").collect()]


def test_trees_do_not_depend_on_the_order_or_partitions_of_rows(spark):
    frame, spec = _frame(spark), zoo.ModelSpec("forest", "random_forest", {"numTrees": 7, "maxDepth": 4})
    first, second = zoo.fit(spec, frame.coalesce(1)), zoo.fit(spec, frame.orderBy(F.desc("id")).repartition(5, "id"))
    assert _probs(first, frame) == _probs(second, frame)
    assert first.model.featureImportances.toArray() == pytest.approx(second.model.featureImportances.toArray())


def test_the_work_goes_by_the_distinct_cells(spark):
    frame = _frame(spark)
    edges = stumps.bin_edges(frame)
    once, often = (forest.cells_of(f, edges) for f in (frame, frame.unionByName(frame).unionByName(frame)))
    assert often.count() == once.count() < 400 and often.agg(F.sum("n")).first()[0] == 1200


@pytest.mark.parametrize("kind", ["gini", "entropy"])
@pytest.mark.parametrize("strategy, least", [("all", 1), ("sqrt", 9)])
def test_a_forest_equals_trees_grown_row_by_row(spark, kind, strategy, least):
    frame = _frame(spark)
    trees, depth, take = 4, 4, 3 if strategy == "all" else 2
    params = {"numTrees": trees, "maxDepth": depth, "featureSubsetStrategy": strategy, "impurity": kind, "minInstancesPerNode": least}
    model = zoo.fit(zoo.ModelSpec("forest", "random_forest", params), frame)
    edges = stumps.bin_edges(frame)
    cells = forest.cells_of(frame, edges).collect()
    n, key = np.array([c["n"] for c in cells]), np.array([c["key"] for c in cells])
    bins = np.array([list(c["bins"]) for c in cells])
    copies = forest.Copies(n, key, zoo.SEED)

    def impurity(zero, one):
        p = np.array([zero, one]) / (zero + one)
        return 1 - (p**2).sum() if kind == "gini" else -sum(s * np.log2(s) for s in p if s)

    def chosen(t, number):
        order = np.argsort(forest.draw(zoo.SEED + 1, np.int64(t), np.int64(number), np.arange(3)), kind="stable")
        return sorted(order[:take])

    label = np.array([c["label"] for c in cells])
    where = {}
    x = {r["id"]: r["values"] for r in frame.collect()}
    for t in range(trees):
        weight = copies.of(t, np.arange(len(cells)))
        nodes, splits, open_ = [np.arange(len(cells))], {}, [(0, 0)]
        while open_:
            number, level = open_.pop(0)
            at = nodes[number]
            zero, one = (int(weight[at[label[at] == v]].sum()) for v in (0, 1))
            if level == depth or not zero or not one:
                continue
            best = (0.0, None)
            for f in chosen(t, number):
                for b in range(len(edges[f])):
                    low = bins[at, f] <= b
                    lz, lo = (int(weight[at[low & (label[at] == v)]].sum()) for v in (0, 1))
                    if min(lz + lo, zero + one - lz - lo) < least:
                        continue
                    gain = impurity(zero, one) - ((lz + lo) * impurity(lz, lo) + (zero + one - lz - lo) * impurity(zero - lz, one - lo)) / (zero + one)
                    if gain > best[0] + 1e-12:
                        best = (gain, (f, b))
            if best[1]:
                f, b = best[1]
                splits[number] = (f, b, len(nodes))
                nodes += [at[bins[at, f] <= b], at[bins[at, f] > b]]
                open_ += [(len(nodes) - 2, level + 1), (len(nodes) - 1, level + 1)]
        votes = [int(weight[a[label[a] == 1]].sum() > weight[a[label[a] == 0]].sum()) for a in nodes]
        for number in sorted(splits, reverse=True):
            left = splits[number][2]
            if left not in splits and left + 1 not in splits and votes[left] == votes[left + 1]:
                del splits[number]
        for i, values in x.items():
            number = 0
            while number in splits:
                f, b, left = splits[number]
                number = left + (values[f] > edges[f][b])
            at = nodes[number]
            where.setdefault(i, []).append(weight[at[label[at] == 1]].sum() / weight[at].sum())
    assert _probs(model, frame) == pytest.approx([np.mean(where[i]) for i in sorted(where)])


def test_copies_of_a_cell_follow_the_poisson_law():
    n = np.repeat([1, 6, 1000], 20_000)
    drawn = forest.Copies(n, np.arange(len(n)), 5).of(3, np.arange(len(n))).reshape(3, -1)
    assert drawn.mean(axis=1) == pytest.approx([1, 6, 1000], rel=0.02) and drawn.var(axis=1) == pytest.approx([1, 6, 1000], rel=0.05)
    assert (drawn[0] == 0).mean() == pytest.approx(np.exp(-1), abs=0.01)


def test_other_parameters_and_one_label(spark):
    frame = _frame(spark, 60)
    model = zoo.fit(zoo.ModelSpec("forest", "random_forest", {"numTrees": 3, "subsamplingRate": 0.5}), frame)
    assert model.model.getSubsamplingRate() == 0.5 and len(model.model.trees) == 3
    same = zoo.fit(zoo.ModelSpec("forest", "random_forest", {"numTrees": 3}), frame.withColumn(LABEL, F.lit(1)))
    assert set(_probs(same, frame)) == {1.0}


def test_edges_of_long_features_are_exact_and_not_sorted_whole(spark, monkeypatch):
    rng = np.random.default_rng(8)
    rows = [[float(a), float(b), float(c), 1.0] for a, b, c in zip(rng.exponential(size=50_000), rng.integers(0, 90, 50_000), np.where(rng.random(50_000) < 0.6, 7.0, rng.normal(size=50_000)))]
    rows[5][0] = float("nan")
    frame = spark.createDataFrame([(r,) for r in rows], "values array<double>").repartition(3)
    whole = stumps.bin_edges(frame)
    monkeypatch.setattr(stumps, "grouped_quantiles", None)
    for got, want in zip(stumps.bin_edges(frame, direct_rows=40_000), whole, strict=True):
        assert got == pytest.approx(want)


def test_boosting_of_cells_equals_boosting_of_rows(spark, monkeypatch):
    frame, spec = _frame(spark), zoo.ModelSpec("gbt", "boosted_trees", {"maxIter": 6, "maxDepth": 3})
    frame = frame.unionByName(frame.filter("id % 3 = 0"))
    plain = zoo.NativeFitted(spec, zoo.native_estimator(spec).fit(frame))
    seen, real = [], forest.cells_of
    monkeypatch.setattr(forest, "cells_of", lambda *a: seen.append(real(*a)) or seen[-1])
    model = zoo.fit(spec, frame)
    assert seen[0].count() < frame.count()
    assert _probs(model, frame) == pytest.approx(_probs(plain, frame))
    assert model.model.featureImportances.toArray() == pytest.approx(plain.model.featureImportances.toArray())
