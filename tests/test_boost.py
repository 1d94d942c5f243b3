"""Boosting that draws rows, and both ways of growing trees."""

import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from cohortwise.models import boost, forest, search, zoo
from cohortwise.models.frame import FEATURES, FOLD, LABEL


def _frame(spark, rows=600, seed=4):
    rng = np.random.default_rng(seed)
    x = np.column_stack([rng.integers(0, 3, rows), rng.integers(0, 2, rows), rng.integers(0, 25, rows) / 4, rng.integers(0, 20, rows)]).astype(float)
    y = (x[:, 0] + x[:, 2] + rng.normal(scale=1.0, size=rows) > 4).astype(int)
    lines = [(i, int(rng.integers(0, 3)), v.tolist(), int(l)) for i, (v, l) in enumerate(zip(x, y))]
    table = spark.createDataFrame(lines, f"id int, {FOLD} int, values array<double>, {LABEL} int")
    return table.withColumn(FEATURES, array_to_vector("values"))


def _probs(model, frame):
    return [r["prob"] for r in model.score(frame).orderBy("id").select("prob").collect()]


SPEC = zoo.ModelSpec("gbt", "boosted_trees", {"maxIter": 30, "stepSize": 0.2, "maxDepth": 4, "subsamplingRate": 0.8})


def test_folds_are_boosted_in_one_run_and_see_a_share_of_the_rows(spark, monkeypatch):
    frame, calls, real = _frame(spark), [], boost.fit_runs
    monkeypatch.setattr(boost, "fit_runs", lambda *a: calls.append(a) or real(*a))
    models = search.fit_folds([SPEC], frame, [0, 1, 2, None])
    assert len(calls) == 1 and [run.held_out for run in calls[0][2]] == [0, 1, 2, None]
    kept = frame.filter(F.col(FOLD) != 1)
    rows = [t.counts[0, 0] / kept.count() for t in calls[0][2][1].trees]
    assert len(set(rows)) > 5 and np.mean(rows) == pytest.approx(0.8, abs=0.02)
    plain = zoo.NativeFitted(SPEC, zoo.native_estimator(SPEC).fit(kept))
    held_out = frame.filter(F.col(FOLD) == 1)
    assert search.accuracy(models["gbt", 1].score(held_out)) >= search.accuracy(plain.score(held_out)) - 0.04
    assert np.mean(np.abs(np.subtract(_probs(models["gbt", 1], kept), _probs(plain, kept)))) < 0.06


def test_rows_without_a_fold_are_seen_by_runs_over_all_rows_only(spark, monkeypatch):
    frame, seen, real = _frame(spark, 200), [], boost.fit_runs
    monkeypatch.setattr(boost, "fit_runs", lambda *a: real(*a) or seen.append(a[2]))
    frame, spec = frame.withColumn(FOLD, F.when(F.col("id") >= 50, F.col(FOLD))), SPEC.with_params(maxIter=1, subsamplingRate=1.0)
    for limit in (boost.LOCAL, 0):
        monkeypatch.setattr(boost, "LOCAL", limit)
        search.fit_folds([spec], frame, [0, None])
    kept = frame.filter(F.col(FOLD) != 0).count()
    assert [[run.trees[0].counts[0, 0] for run in runs] for runs in seen] == [[kept, 200], [kept, 200]]


def test_boosting_with_all_rows_equals_spark(spark):
    frame = _frame(spark)
    frame = frame.unionByName(frame.filter("id % 3 = 0"))
    spec = SPEC.with_params(maxIter=8, subsamplingRate=1.0)
    plain, model = zoo.NativeFitted(spec, zoo.native_estimator(spec).fit(frame)), zoo.fit(spec, frame)
    assert _probs(model, frame) == pytest.approx(_probs(plain, frame), abs=1e-4)
    assert model.model.featureImportances.toArray() == pytest.approx(plain.model.featureImportances.toArray(), abs=1e-3)


def test_boosted_trees_do_not_depend_on_tasks_partitions_or_order(spark, monkeypatch):
    frame = _frame(spark)
    frame = frame.unionByName(frame.filter("id % 4 = 0"))
    first = search.fit_folds([SPEC], frame, [0, None])
    monkeypatch.setattr(boost, "LOCAL", 0)
    monkeypatch.setattr(boost, "CELLS", 100)
    # Written three times on the way.
    monkeypatch.setattr(boost, "ROUNDS", 10)
    second = search.fit_folds([SPEC], frame.orderBy(F.desc("id")).repartition(5, "id"), [0, None])
    for fold in (0, None):
        assert _probs(first["gbt", fold], frame) == _probs(second["gbt", fold], frame)


@pytest.mark.parametrize("strategy", ["all", "sqrt"])
def test_forests_are_the_same_where_trees_or_rows_are_dealt(spark, monkeypatch, strategy):
    frame = _frame(spark)
    spec = zoo.ModelSpec("forest", "random_forest", {"numTrees": 9, "maxDepth": 6, "featureSubsetStrategy": strategy})
    first, levels, real = zoo.fit(spec, frame), [], forest._level
    monkeypatch.setattr(forest, "LOCAL", 0)
    monkeypatch.setattr(forest, "_level", lambda *a: levels.append(a[2]) or real(*a))
    second = zoo.fit(spec, frame)
    assert levels == [0, 1, 2, 3, 4, 5]
    assert _probs(first, frame) == _probs(second, frame)
    assert list(first.model.featureImportances.toArray()) == list(second.model.featureImportances.toArray())


def test_a_bounded_table_takes_no_job_for_each_level(spark, monkeypatch):
    frame = _frame(spark)
    monkeypatch.setattr(forest, "_level", lambda *a: pytest.fail("dealt"))
    monkeypatch.setattr(boost, "_fit_dealt", lambda *a: pytest.fail("dealt"))
    zoo.fit(zoo.ModelSpec("forest", "random_forest", {"numTrees": 3}), frame)
    zoo.fit(SPEC, frame)


def test_counts_of_combined_features_fall_back_to_the_features():
    rng, sizes = np.random.default_rng(2), [30, 2, 2, 31, 6, 2, 32, 1]
    x = np.column_stack([rng.integers(0, n, 500) for n in sizes]).astype(np.uint8)
    slot, copies, pull = rng.integers(0, 4, 500), rng.integers(1, 3, 500).astype(float), rng.integers(-9, 9, 500).astype(float)
    layout = boost.Layout(sizes)
    assert max(layout.joint) <= boost.JOINT and len(layout.groups) < len(sizes)
    sums, start = layout.sums(layout.codes(x), slot, 3, copies, pull), 0
    for f, n in enumerate(sizes):
        for kind, weight in enumerate((copies, pull)):
            plain = [[weight[(slot == s) & (x[:, f] == b)].sum() for b in range(n)] for s in range(3)]
            assert sums[:, start : start + n, kind].tolist() == plain
        start += n


@pytest.mark.parametrize("n", [1, 7, 70_000])
def test_drawn_rows_of_a_cell_follow_the_binomial_law(n):
    plan = boost.Plan((2,), 1, 1, 0.1, 0.8, 5)
    drawn = boost._Drawn(np.full(4000, n), np.arange(4000), plan).of(3)
    assert drawn.max() <= n and drawn.mean() == pytest.approx(0.8 * n, rel=0.03) and drawn.var() == pytest.approx(0.16 * n, rel=0.1)


def test_draws_are_those_of_the_plain_lookup():
    n, key = np.array([1, 2, 3, 900, 5] * 400), np.arange(2000)
    copies, at = forest.Copies(n, key, 7), np.arange(2000)
    plain = np.zeros(2000, np.int64)
    for bit in range(10):
        some = np.flatnonzero(n >> bit & 1)
        plain[some] += np.searchsorted(_poisson(float(1 << bit)), forest.draw(7, key[some], np.int64(4), np.int64(bit)), side="right")
    assert copies.of(4, at).tolist() == plain.tolist()


def _poisson(mean):
    import math

    k = np.arange(int(mean + 12 * math.sqrt(mean) + 20))
    return np.cumsum(np.exp(k * math.log(mean) - mean - np.array([math.lgamma(i + 1.0) for i in k])))


def test_stored_boosted_trees_score_the_same(spark, tmp_path):
    frame = _frame(spark, 200)
    model = zoo.fit(SPEC.with_params(maxIter=4), frame)
    model.save(spark, str(tmp_path / "m"))
    assert _probs(zoo.load(spark, str(tmp_path / "m")), frame) == _probs(model, frame)
    assert len(model.first(2).model.trees) == 2


def test_boosting_without_a_share_of_rows_takes_cells_too(spark, monkeypatch):
    frame = _frame(spark)
    spec = zoo.ModelSpec("gbt", "boosted_trees", {"maxIter": 8, "stepSize": 0.2, "maxDepth": 4})
    plain = zoo.NativeFitted(spec, zoo.native_estimator(spec).fit(frame))
    calls, real = [], boost.fit_runs
    monkeypatch.setattr(boost, "fit_runs", lambda *a: calls.append(a) or real(*a))
    model = zoo.fit(spec, frame)
    assert len(calls) == 1 and _probs(model, frame) == pytest.approx(_probs(plain, frame), abs=1e-4)
