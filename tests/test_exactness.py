"""Exact quantiles, two-level totals and skew-safe joins against brute force."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from cohortwise.operators import joins
from cohortwise.operators.prefix import running_totals
from cohortwise.operators.quantiles import column_quantiles, grouped_quantiles
from cohortwise.operators.split import assign_folds, stratified_split


@pytest.fixture(scope="module")
def skewed(spark):
    rng = np.random.default_rng(3)
    n = 6000
    key = np.where(rng.random(n) < 0.4, 0, rng.integers(1, 300, n))
    value = np.where(rng.random(n) < 0.3, 7.0, np.round(rng.lognormal(3, 2, n), 3))
    value[rng.random(n) < 0.05] = np.nan
    pdf = pd.DataFrame({"id": np.arange(n), "k": key, "v": value, "y": rng.integers(0, 2, n)})
    return pdf, spark.createDataFrame(pdf).repartition(7)


PROBS = {"q10": 0.1, "q25": 0.25, "q50": 0.5, "q90": 0.9}


@pytest.mark.parametrize("direct,accuracy,one_task", [(10**9, 0, 0), (0, 10000, 10**9), (0, 20, 10**9), (0, 20, 0), (100, 200, 100)])
def test_grouped_quantiles_match_pandas(skewed, direct, accuracy, one_task):
    pdf, df = skewed
    got = grouped_quantiles(df, ["k"], "v", PROBS, direct_rows=direct, accuracy=accuracy, one_task_rows=one_task)
    got = got.toPandas().set_index("k").sort_index()
    want = pdf.dropna().groupby("k")["v"]
    assert (got["n"] == want.count()).all()
    for name, p in PROBS.items():
        np.testing.assert_allclose(got[name], want.quantile(p), rtol=1e-12)


@pytest.mark.parametrize("direct,accuracy,one_task", [(10**9, 0, 0), (0, 10000, 10**9), (0, 50, 0)])
def test_global_quantiles_match_pandas(skewed, direct, accuracy, one_task):
    pdf, df = skewed
    row = grouped_quantiles(df, [], "v", PROBS, direct_rows=direct, accuracy=accuracy, one_task_rows=one_task).first()
    for name, p in PROBS.items():
        assert row[name] == pytest.approx(pdf["v"].quantile(p), rel=1e-12)


def test_quantiles_of_small_and_empty_columns(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (4.0,), (10.0,), (None,)], "v double")
    assert column_quantiles(df, "v", [0.0, 0.25, 0.5, 1.0]) == [1.0, 1.75, 3.0, 10.0]
    assert column_quantiles(df.filter("v is null"), "v", [0.5]) == [None]


def test_running_totals_match_cumsum(skewed):
    pdf, df = skewed
    out = running_totals(df, ["k"], [F.col("id")], {"total": F.col("y")}).toPandas().sort_values("id")
    np.testing.assert_array_equal(out["total"].to_numpy(), pdf.groupby("k")["y"].cumsum().to_numpy())
    out = running_totals(df, [], [F.col("id").desc()], {"total": F.lit(1)}, None).toPandas().sort_values("id")
    np.testing.assert_array_equal(out["total"].to_numpy(), len(pdf) - pdf["id"].to_numpy())


@pytest.mark.parametrize("with_rows", [True, False])
def test_shuffle_join_with_hot_key_equals_broadcast_join(skewed, with_rows, monkeypatch):
    pdf, df = skewed
    table = df.filter("k % 3 = 0").groupBy("k").agg(F.count("*").alias("n"), F.sum("y").alias("s"))
    small = joins.attach(df, table, ["k"], rows="n").toPandas().sort_values("id").reset_index(drop=True)
    monkeypatch.setattr(joins, "BROADCAST_ROWS", 0)
    monkeypatch.setattr(joins, "HOT_PARTS", 10)
    source = table if with_rows else table.drop("n")
    big = joins.attach(df, source, ["k"], rows="n" if with_rows else None).toPandas()
    big = big.sort_values("id").reset_index(drop=True)
    pd.testing.assert_frame_equal(small, big[small.columns])


def test_shuffle_join_spreads_only_hot_keys(skewed, monkeypatch):
    _, df = skewed
    monkeypatch.setattr(joins, "BROADCAST_ROWS", 0)
    monkeypatch.setattr(joins, "HOT_PARTS", 10)
    table = df.groupBy("k").agg(F.count("*").alias("n"))
    joined = joins.attach(df, table, ["k"], rows="n")
    plan = joined._jdf.queryExecution().optimizedPlan().toString()
    assert "__salt" in plan


def test_null_keys_match_only_when_asked(spark):
    df = spark.createDataFrame([(1, "a"), (2, None)], "id int, k string")
    table = spark.createDataFrame([("a", 1.0), (None, 9.0)], "k string, m double")
    plain = {r["id"]: r["m"] for r in joins.attach(df, table, ["k"]).collect()}
    safe = {r["id"]: r["m"] for r in joins.attach(df, table, ["k"], null_safe=True).collect()}
    assert plain == {1: 1.0, 2: None} and safe == {1: 1.0, 2: 9.0}


def test_semi_join_and_membership(spark):
    df = spark.createDataFrame([(1,), (1,), (2,), (None,)], "k int")
    members = spark.createDataFrame([(1,), (1,), (3,)], "k int")
    assert [r["k"] for r in joins.keep_members(df, members, ["k"]).collect()] == [1, 1]
    flags = joins.mark_members(df, members.distinct(), ["k"], "m").orderBy("k").collect()
    assert [r["m"] for r in flags] == [0, 1, 1, 0]


def test_split_is_exact_stratified_and_independent_of_layout(skewed):
    _, df = skewed
    a = stratified_split(df, "id", "y", 0.2).toPandas().set_index("id").sort_index()
    b = stratified_split(df.repartition(3, "v").coalesce(1), "id", "y", 0.2).toPandas().set_index("id").sort_index()
    assert (a["part"] == b["part"]).all()
    for _, g in a.groupby("y"):
        assert (g["part"] == "test").sum() == int(len(g) * 0.2 + 0.5)
    other = stratified_split(df, "id", "y", 0.2, seed=7).toPandas().set_index("id").sort_index()
    assert (a["part"] != other["part"]).any()


def test_approximate_split_needs_no_shuffle(skewed):
    _, df = skewed
    out = stratified_split(df.coalesce(1), "id", exact=False)
    share = out.filter("part = 'test'").count() / df.count()
    assert abs(share - 0.2) < 0.03


def test_folds_are_even_within_label(skewed):
    _, df = skewed
    sizes = assign_folds(df, "id", "y", 5).groupBy("y", "fold").count().toPandas()
    for _, g in sizes.groupby("y"):
        assert len(g) == 5 and g["count"].max() - g["count"].min() <= 1


def test_split_keeps_rows_without_label(spark):
    df = spark.createDataFrame([(i, None if i % 3 == 0 else i % 2) for i in range(90)], "id int, y int")
    assert stratified_split(df, "id", "y", 0.2).filter("part = 'test'").count() == 18
    folds = assign_folds(df, "id", "y", 5).groupBy("fold").count().collect()
    assert sorted(r["count"] for r in folds) == [18] * 5


def test_offsets_join_by_shuffle_gives_the_same(skewed, monkeypatch):
    pdf, df = skewed
    monkeypatch.setattr(joins, "BROADCAST_ROWS", 0)
    out = running_totals(df, ["k"], [F.col("id")], {"total": F.col("y")}).toPandas().sort_values("id")
    np.testing.assert_array_equal(out["total"].to_numpy(), pdf.groupby("k")["y"].cumsum().to_numpy())


def test_scratch_folder_comes_from_the_session(spark, tmp_path, monkeypatch):
    from types import SimpleNamespace

    from cohortwise import session

    def stub(folder, master):
        context = SimpleNamespace(master=master, getCheckpointDir=lambda: None)
        return SimpleNamespace(conf=SimpleNamespace(get=lambda key, default: folder), sparkContext=context)

    assert session.checkpoint_root(stub("hdfs:///shared", "yarn")) == "hdfs:///shared"
    with pytest.raises(RuntimeError):
        session.checkpoint_root(stub(None, "yarn"))

    monkeypatch.setattr(session, "checkpoint_root", lambda _: str(tmp_path))
    monkeypatch.setattr(session, "_written", [])
    assert session.materialize(spark.range(5).toDF("id")).count() == 5
    assert len(list(tmp_path.iterdir())) == 1
    assert session.release(spark) == 1 and not list(tmp_path.iterdir())


def _largest_task(df):
    return df.withColumn("__p", F.spark_partition_id()).groupBy("__p").count().agg(F.max("count")).first()[0]


@pytest.fixture
def shuffled_joins(spark):
    before = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled", "spark.sql.shuffle.partitions")}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def test_null_keys_are_spread(spark, shuffled_joins):
    df = spark.range(20_000).selectExpr("id", "CASE WHEN id % 10 = 0 THEN id END AS k")
    table = spark.range(0, 20_000, 20).selectExpr("id AS k", "id * 2 AS v")
    joined = joins.attach(df, table, ["k"])
    assert joined.count() == 20_000 and joined.filter("v IS NOT NULL").count() == 1000
    assert _largest_task(joined) < 20_000 / 8 * 1.5


def test_keys_hot_only_in_the_joined_table_are_spread(spark, shuffled_joins):
    df = spark.range(20_000).selectExpr("id", "CASE WHEN id % 3 > 0 THEN -1 ELSE id END AS k")
    table = spark.range(-1, 20_000).selectExpr("id AS k", "1L AS n", "id AS v")
    joined = joins.attach(df, table, ["k"], rows="n")
    assert joined.filter("k = v").count() == 20_000 and _largest_task(joined) < 20_000 / 8 * 2


def test_stream_joins_without_broadcast(spark, shuffled_joins, tmp_path):
    rows = spark.range(1000).selectExpr("id", "CASE WHEN id % 2 = 0 THEN id % 7 END AS k")
    rows.write.parquet(str(tmp_path / "in"))
    table = spark.createDataFrame([(k, k * 10) for k in range(5)], "k long, v long")
    stream = spark.readStream.schema(rows.schema).parquet(str(tmp_path / "in"))
    out = joins.attach(stream, table, ["k"]).writeStream.format("parquet").option("checkpointLocation", str(tmp_path / "cp"))
    out.trigger(availableNow=True).start(str(tmp_path / "out")).awaitTermination()
    got = spark.read.parquet(str(tmp_path / "out"))
    assert got.count() == 1000 and got.filter("v = k * 10").count() == rows.filter("k < 5").count()


def test_members_are_a_semi_join(spark, shuffled_joins):
    df = spark.createDataFrame([(1, "a"), (2, None), (3, "b"), (4, "a")], "id int, k string")
    kept = joins.keep_members(df, spark.createDataFrame([("a",), ("a",), (None,)], "k string"), ["k"])
    assert sorted(r["id"] for r in kept.collect()) == [1, 4]
    assert "LeftSemi" in kept._jdf.queryExecution().executedPlan().toString()


def test_onehot_of_a_large_vocabulary(spark):
    from cohortwise.operators.encode import OneHot

    rows = spark.range(20_000).selectExpr("CASE WHEN id % 2 = 0 THEN 'common' WHEN id % 4 = 1 THEN concat('v', id DIV 4) END AS c")
    coder = OneHot(["c"]).fit(rows)
    assert coder.names == ["c_common", "c_Rare"]
    sums = coder.transform(rows.unionByName(spark.createDataFrame([("new",)], "c string"))).agg(F.sum("c_common"), F.sum("c_Rare"), F.count(F.lit(1))).first()
    assert tuple(sums) == (10_000, 5_000, 20_001)
