"""Every query with SQL against DuckDB, and what the physical plans may hold."""

import os
import re

import pytest
from pyspark.sql import functions as F

from cohortwise.queries.catalog import ORACLES, QUERIES
from oracle import compare, duck

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="needs the given tables")


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, con, name):
    assert compare(QUERIES[name](spark, SF), con, ORACLES[name]) == ""


LAYOUT = ["split_stratified", "roc_multi", "target_encode_oof", "impute_all", "label_encode", "rules_conservative"]


@pytest.mark.parametrize("parts", ["1", "200"])
@pytest.mark.parametrize("name", LAYOUT)
def test_result_does_not_depend_on_partitions(spark, con, name, parts):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    try:
        assert compare(QUERIES[name](spark, SF), con, ORACLES[name]) == ""
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


# Bounded by construction: totals per slice and bins of a histogram.
SINGLE_WINDOW = {"hist_density"}


# The support vector machine's random features are an Arrow-batched function.
ARROW = {"model_roundtrip"}


@pytest.mark.parametrize("name", sorted(set(ORACLES) - ARROW))
def test_plan_stays_in_the_jvm_and_has_no_cross_join(spark, name):
    plan = plan_of(QUERIES[name](spark, SF))
    for bad in ("BatchEvalPython", "ArrowEvalPython", "CartesianProduct", "FlatMapGroupsInPandas"):
        assert bad not in plan, bad
    if name not in SINGLE_WINDOW:
        assert not re.search(r"Window .*\], \[\]", plan) and "SinglePartition, ENSURE_REQUIREMENTS" not in _windows(plan)


def _windows(plan):
    """The part of a plan below its window operators."""
    at = plan.find("Window ")
    return plan[at:] if at >= 0 else ""


def test_filters_and_columns_reach_the_scan(spark):
    df = spark.read.parquet(f"{SF}/lineitem.parquet")
    plan = plan_of(df.filter("l_quantity > 45").groupBy("l_returnflag").agg(F.count("*")))
    assert "PushedFilters: [IsNotNull(l_quantity), GreaterThan(l_quantity,45.0)]" in plan
    assert "ReadSchema: struct<l_quantity:double,l_returnflag:string>" in plan
    profile = plan_of(QUERIES["metrics_binary"](spark, SF))
    assert "l_extendedprice" not in profile and "l_shipdate" not in profile
