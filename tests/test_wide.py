"""Correlations by blocks, mutual information by neighbours, splits by histogram, output files."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from cohortwise.operators import metrics as M
from cohortwise.operators import validate as V
from cohortwise.operators import wide
from cohortwise.operators.information import digamma, neighbour_information
from cohortwise.operators.profile import correlation_matrix
from cohortwise.operators.split import hash_rank, stratified_split
from cohortwise.sources.tables import write_predictions


def table_of(spark, columns):
    names = list(columns)
    return spark.createDataFrame(list(zip(*columns.values())), ", ".join(f"`{n}` double" for n in names))


def test_blocks_equal_single_aggregates(spark, monkeypatch):
    rng = np.random.default_rng(3)
    columns = {f"c{i}": rng.normal(1e4, 2, 90).tolist() for i in range(9)}
    columns["c3"] = [None if i % 7 == 0 else v for i, v in enumerate(columns["c3"])]
    columns["c5"] = [float("nan") if i % 5 == 0 else v for i, v in enumerate(columns["c1"])]
    columns["flat"], columns["none"] = [4.2] * 90, [None] * 90
    df = table_of(spark, columns).repartition(5)
    plain = {(r["a"], r["b"]): r["corr"] for r in correlation_matrix(df).collect()}
    monkeypatch.setattr(wide, "BLOCK", 4)
    monkeypatch.setattr(wide, "TASK_BYTES", 2000)
    blocked = {(r["a"], r["b"]): r["corr"] for r in wide.blocked_correlation(df, df.columns).collect()}
    assert blocked.keys() == plain.keys()
    for pair, r in plain.items():
        if r is None or math.isnan(r):
            assert blocked[pair] is None, pair
        else:
            assert blocked[pair] == pytest.approx(r, abs=1e-9), pair


def test_a_thousand_columns(spark):
    base = spark.range(50).select(*[((F.col("id") * (i % 13 + 1) + F.hash("id") % (i % 7 + 2)) % 101).cast("double").alias(f"c{i}") for i in range(1000)])
    df = spark.createDataFrame(base.toPandas())
    got = correlation_matrix(df)
    assert got.count() == 1000 * 999 // 2
    x = base.toPandas()
    for r in got.filter("a = 'c999' and b in ('c0', 'c1', 'c500')").collect():
        assert r["corr"] == pytest.approx(np.corrcoef(x[r["a"]], x[r["b"]])[0, 1])


def brute_information(x, y, k):
    psi = lambda n: -0.5772156649015329 + sum(1 / i for i in range(1, n))
    kept = [i for i in range(len(x)) if y.count(y[i]) > 1]
    terms = []
    for i in kept:
        own = sorted(abs(x[i] - x[j]) for j in kept if j != i and y[j] == y[i])
        want = min(k, len(own))
        r = own[want - 1]
        m = sum(abs(x[i] - x[j]) < r or x[i] == x[j] for j in kept)
        terms.append(psi(want) - psi(len(own) + 1) - psi(m))
    return max(0.0, psi(len(kept)) + sum(terms) / len(terms))


@pytest.mark.parametrize("size", [5, 4096])
def test_neighbour_information_equals_brute_force(spark, size):
    rng = np.random.default_rng(1)
    y = rng.integers(0, 3, 120).tolist() + [7]
    near = [v * 1.5 + e for v, e in zip(y, rng.normal(size=121).tolist())]
    ties = [float(v) for v in rng.integers(0, 4, 121)]
    df = spark.createDataFrame(list(zip(near, ties, rng.normal(size=121).tolist(), y)), "near double, ties double, noise double, y int")
    df = df.unionByName(spark.createDataFrame([(None, float("nan"), None, 1), (1.0, 2.0, 3.0, None)], df.schema))
    got = {r["feature"]: r["mutual_info"] for r in neighbour_information(df, ["near", "ties", "noise"], "y", 3, size).collect()}
    rows = [r for r in df.collect() if r["y"] is not None]
    for name in ("near", "ties", "noise"):
        pairs = [(r[name], r["y"]) for r in rows if r[name] is not None and not math.isnan(r[name])]
        assert got[name] == pytest.approx(brute_information([a for a, _ in pairs], [b for _, b in pairs], 3), abs=1e-8), name
    assert got["near"] > 0.3 > got["noise"]


def test_digamma(spark):
    for n, v in ((1, -0.5772156649015329), (2, 0.42278433509846713), (10, 2.251752589066721), (1000, 6.907255195648812)):
        assert spark.range(1).select(digamma(F.lit(n))).first()[0] == pytest.approx(v, abs=1e-9)


def test_split_marks_the_first_rows_by_hash(spark):
    df = spark.range(3000).select("id", (F.col("id") % 3).alias("y"))
    df = df.withColumn("y", F.when(F.col("y") < 2, F.col("y")))
    for label in ("y", None):
        marked = stratified_split(df, "id", label, 0.13)
        ranked = hash_rank(df, "id", [label] if label else [])
        sizes = {r[0]: r["count"] for r in df.withColumn("all", F.lit(0)).groupBy(label or "all").count().collect()}
        want = {r["id"] for r in ranked.collect() if r["__rank"] <= round(sizes[r[label] if label else 0] * 0.13)}
        assert {r["id"] for r in marked.filter("part = 'test'").collect()} == want
    plan = stratified_split(df, "id", "y", 0.2)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning" not in plan and "Exchange rangepartitioning" not in plan


def test_split_shares_of_none_and_all(spark):
    df = spark.range(20).withColumn("y", F.lit(1))
    assert stratified_split(df, "id", "y", 0.0).filter("part = 'test'").count() == 0
    assert stratified_split(df, "id", "y", 1.0).filter("part = 'test'").count() == 20
    assert stratified_split(df.limit(0), "id", "y", 0.5).count() == 0 and stratified_split(df.limit(0), "id", None, 0.5).count() == 0


def test_output_files(spark, tmp_path, caplog):
    good = spark.createDataFrame([(i, i % 2) for i in range(10)], "id int, p int")
    with pytest.raises(ValueError):
        V.validate_output(good, "id", "p", 12)
    with caplog.at_level("WARNING"):
        report = V.validate_output(good, "id", "p", 12, strict_rows=False)
    assert report.filter("NOT passed").count() == 0 and "2 rows" in caplog.text
    with pytest.raises(ValueError):
        V.validate_output(good.unionByName(good), "id", "p", 12, strict_rows=False)
    with pytest.raises(ValueError):
        V.validate_output(good.limit(0), "id", "p", 12, strict_rows=False)
    named, other = write_predictions(good, str(tmp_path / "a.csv")), write_predictions(good, str(tmp_path / "b"))
    assert V.file_checks(spark, named, "id", "p", 10).filter("NOT passed").count() == 0
    assert {r["check"] for r in V.file_checks(spark, other, "id", "p", 10).filter("NOT passed").collect()} == {"csv_format", "compliant"}
    with pytest.raises(FileNotFoundError):
        V.file_checks(spark, str(tmp_path / "none.csv"), "id", "p")


def test_history(spark, tmp_path):
    root = str(tmp_path / "h")
    with pytest.raises(FileNotFoundError):
        M.metrics_history(spark, root)
    row = spark.createDataFrame([("a", 0.5)], "model string, accuracy double")
    M.append_metrics(row, root, "1", spark.createDataFrame([("x", 0.1), ("z", 0.9)], "feature string, importance double"))
    M.append_metrics(row.withColumn("accuracy", F.lit(0.7)), root, "2")
    assert M.metrics_history(spark, root).count() == 2
    assert [r["feature"] for r in M.latest_importances(spark, root).collect()] == ["z", "x"]
    assert M.metrics_history_summary(M.metrics_history(spark, root).drop("model"), "evaluated_at").first()["accuracy"] == 0.7
