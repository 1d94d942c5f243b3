"""Metrics on twelve rows counted by hand, ROC, ranking, ensembles, charts."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from cohortwise.operators import ensemble as N
from cohortwise.operators import metrics as M

# Seven of class 1, five right and two missed; five of class 0, one of them taken for class 1.
TRUE = [1, 1, 1, 1, 1, 1, 1, 0, 0, 0, 0, 0]
PRED = [1, 1, 1, 1, 1, 0, 0, 0, 0, 0, 0, 1]
PROB = [0.95, 0.85, 0.85, 0.75, 0.55, 0.45, 0.25, 0.05, 0.15, 0.35, 0.45, 0.65]


@pytest.fixture(scope="module")
def twelve(spark):
    return spark.createDataFrame(list(zip(TRUE, PRED, PROB)), "y int, p int, prob double")


def test_metrics(twelve):
    row = M.binary_metrics(twelve, "y", "p").first()
    assert [row[c] for c in ("accuracy", "precision", "recall", "f1_score")] == pytest.approx([9 / 12, 5 / 6, 5 / 7, 10 / 13])
    cells = {(r["actual"], r["predicted"]): r["n"] for r in M.confusion_matrix(twelve, "y", "p").collect()}
    assert cells == {(0, 0): 4, (0, 1): 1, (1, 0): 2, (1, 1): 5}
    right = M.binary_metrics(twelve, "y", "y").first()
    assert right["accuracy"] == 1.0 and right["f1_score"] == 1.0
    none = M.binary_metrics(twelve.withColumn("z", F.lit(0)), "y", "z").first()
    assert none["precision"] == 0.0 and none["recall"] == 0.0 and none["f1_score"] == 0.0


def test_report(twelve):
    rows = {r["class"]: r for r in M.classification_report(twelve, "y", "p").collect()}
    assert rows["1"]["support"] == 7 and rows["accuracy"]["precision"] == 0.75 and rows["weighted avg"]["recall"] == pytest.approx(0.75)


def test_check_binary(twelve, spark):
    M.check_binary(twelve, "y", "p")
    with pytest.raises(ValueError):
        M.check_binary(spark.createDataFrame([(2,)], "y int"), "y")


def brute_auc(y, s):
    pos, neg = [v for t, v in zip(y, s) if t], [v for t, v in zip(y, s) if not t]
    return sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg))


def test_roc(twelve, spark):
    assert M.roc_auc(twelve, "y", "prob").first()["auc"] == pytest.approx(brute_auc(TRUE, PROB))
    points = M.roc_points(twelve, "y", "prob").orderBy("fpr", "tpr").collect()
    x, y = [r["fpr"] for r in points], [r["tpr"] for r in points]
    assert np.trapezoid(y, x) == pytest.approx(brute_auc(TRUE, PROB)) and (x[0], y[0], x[-1], y[-1]) == (0, 0, 1, 1)
    rng = np.random.default_rng(1)
    rows = [(m, int(rng.integers(0, 2)), float(np.round(rng.random(), 2))) for m in "ab" for _ in range(300)]
    df = spark.createDataFrame(rows, "m string, y int, s double")
    for r in M.roc_auc(df, "y", "s", ["m"]).collect():
        part = [x for x in rows if x[0] == r["m"]]
        assert r["auc"] == pytest.approx(brute_auc([x[1] for x in part], [x[2] for x in part]))


def test_ranking_selection_history(spark):
    results = spark.createDataFrame([("b", 0.8, 0.5), ("a", 0.8, 0.7), ("c", 0.6, 0.9)], "model string, accuracy double, f1_score double")
    assert [r["model"] for r in M.ranked_models(results).collect()] == ["a", "b", "c"]
    best = M.select_best(results, 0.8).first()
    assert (best["model"], best["meets_threshold"]) == ("a", 1)
    assert M.select_best(results, 0.9).first()["meets_threshold"] == 0
    assert M.metrics_long(results).count() == 6
    summary = M.metrics_history_summary(results, "model").first()
    assert (summary["evaluations"], summary["accuracy"]) == (3, 0.6)


def test_blend(spark):
    results = spark.createDataFrame([("a", 0.8), ("b", 0.6), ("c", 0.2)], "model string, cv_mean double")
    weights = {r["model"]: r["weight"] for r in N.model_weights(results, top_k=2).collect()}
    assert weights == pytest.approx({"a": 0.8 / 1.4, "b": 0.6 / 1.4})
    scores = spark.createDataFrame([(1, "a", 1.0), (1, "b", 0.0), (1, "c", 0.0)], "id int, model string, prob double")
    assert N.blend(scores, N.model_weights(results, top_k=2), "id").first()["prob"] == pytest.approx(0.8 / 1.4)
    uniform = N.blend(scores, N.model_weights(results, uniform=True), "id").first()
    assert uniform["prob"] == pytest.approx(1 / 3) and uniform["n_models"] == 3


def test_histogram_and_density(spark):
    rng = np.random.default_rng(2)
    values = np.round(rng.normal(50, 10, 400), 2)
    df = spark.createDataFrame([(float(v),) for v in values] + [(None,)], "v double")
    h = M.histogram(df, "v", 30).orderBy("bin").toPandas()
    counts, edges = np.histogram(values, bins=30)
    assert h["n"].tolist() == counts.tolist()
    np.testing.assert_allclose(h["density"], np.histogram(values, bins=30, density=True)[0])
    kde = M.kde_curve(df, "v").orderBy("i").toPandas()
    bandwidth = values.std(ddof=1) * len(values) ** -0.2
    exact = [np.mean(np.exp(-0.5 * ((x - values) / bandwidth) ** 2)) / (bandwidth * np.sqrt(2 * np.pi)) for x in kde["x"]]
    np.testing.assert_allclose(kde["density"], exact, atol=2e-4)
