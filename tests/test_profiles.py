"""Profiles, missing values, cohorts."""

import pytest
from pyspark.sql import functions as F

from cohortwise.operators import cohort as C
from cohortwise.operators import profile as P

SCHEMA = "id int, Survived int, Sex string, Age double, Fare double, Cabin string"
ROWS = [
    (1, 0, "male", 22.0, 7.25, None),
    (2, 1, "female", 38.0, 71.28, "C85"),
    (3, 1, "female", 26.0, 7.92, None),
    (4, 1, "female", 35.0, None, "C123"),
    (5, 0, "male", None, 8.05, None),
]


@pytest.fixture(scope="module")
def df(spark):
    return spark.createDataFrame(ROWS, SCHEMA)


def test_numeric_profile(df):
    row = P.profile_numeric(df).filter("column = 'Age'").first()
    assert (row["count"], row["min"], row["max"], row["median"], row["missing_count"]) == (4, 22.0, 38.0, 30.5, 1)
    assert row["mean"] == 30.25 and row["q25"] == 25.0 and row["q75"] == 35.75 and row["missing_pct"] == 20.0


def test_categorical_profile_breaks_ties_by_value(df):
    rows = {r["column"]: r for r in P.profile_categorical(df).collect()}
    assert rows["Sex"]["most_frequent"] == "female" and rows["Sex"]["most_frequent_count"] == 3
    assert rows["Cabin"]["most_frequent"] == "C123" and rows["Cabin"]["unique_values"] == 2 and rows["Cabin"]["missing_count"] == 3


def test_missing_values(df):
    counts = {r["column"]: r["missing_count"] for r in P.missing_by_column(df).collect()}
    assert counts == {"id": 0, "Survived": 0, "Sex": 0, "Age": 1, "Fare": 1, "Cabin": 3}
    patterns = {r["pattern"]: r["n"] for r in P.missing_patterns(df).collect()}
    assert patterns == {
        "Age:False_Fare:False_Cabin:True": 2, "Age:False_Fare:False_Cabin:False": 1,
        "Age:False_Fare:True_Cabin:False": 1, "Age:True_Fare:False_Cabin:True": 1,
    }
    s = P.missing_summary(df).first()
    assert (s["total_missing"], s["total_cells"], s["columns_with_missing"], s["rows_with_any_missing"]) == (5, 30, 3, 4)
    assert (s["most_missing_column"], s["most_missing_count"]) == ("Cabin", 3)


def test_all_missing_and_nothing_missing(spark):
    gone = spark.createDataFrame([(None, None)] * 3, "a double, b string")
    s = P.missing_summary(gone).first()
    assert s["total_missing"] == 6 and s["missing_pct"] == 100.0 and s["most_missing_column"] == "a"
    full = spark.createDataFrame([(1.0, "x")], "a double, b string")
    assert P.missing_patterns(full).count() == 0 and P.missing_summary(full).first()["most_missing_column"] is None


def test_empty_table(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert P.dataset_info(empty).first()["rows"] == 0
    assert P.missing_summary(empty).first()["total_missing"] == 0
    assert P.profile_numeric(empty).count() in (0, 4)


def test_cohort_rates(df):
    rows = {r["value"]: r for r in C.cohort_rates(df, ["Sex"], "Survived").collect()}
    assert (rows["male"]["total"], rows["male"]["positives"]) == (2, 0)
    assert (rows["female"]["total"], rows["female"]["positives"], rows["female"]["rate_pct"]) == (3, 3, 100.0)
    assert rows["female"]["share_pct"] == 60.0
    assert C.cohort_rates(df, ["Cabin"], "Survived").first()["missing"] == 3
    assert C.cohort_overall(df, "Survived").first()["rate_pct"] == 60.0
    with pytest.raises(ValueError):
        C.cohort_overall(df.drop("Survived"), "Survived")


def test_fixed_bins_are_left_closed(spark):
    ages = spark.createDataFrame([(a, 1) for a in (0.0, 11.9, 12.0, 18.0, 60.0, 100.0)], "Age double, y int")
    rows = {r["value"]: r["total"] for r in C.cohort_by_bins(ages, "Age", "y", C.AGE_EDGES, C.AGE_LABELS).collect()}
    assert rows == {"Child (0-12)": 2, "Teen (13-18)": 1, "Young Adult (19-35)": 1, "Senior (60+)": 1}


def test_quartile_and_size_cohorts(spark):
    df = spark.createDataFrame([(float(i), i % 2, i % 4, i % 5) for i in range(1, 9)], "v double, y int, a int, b int")
    q = {r["value"]: r["total"] for r in C.cohort_by_quartiles(df, "v", "y").collect()}
    assert list(q.values()) == [2, 2, 2, 2]
    sizes = {r["value"]: r["total"] for r in C.cohort_by_size(df, "a", "b", "y").collect()}
    assert sum(sizes.values()) == 8 and "Large Family (7+)" in sizes


def test_report_and_correlation(df):
    report = C.exploration_report(df, "Survived", ["Sex"], bins="Age", quartiles="Fare")
    assert {"numeric", "missing_summary", "overall", "cohorts", "cohorts_by_bins", "cohorts_by_quartiles"} <= set(report)
    assert "overall" not in C.exploration_report(df.drop("Survived"), "Survived")
    pairs = {(r["a"], r["b"]): r["corr"] for r in P.correlation_matrix(df, ["id", "Survived", "Age"]).collect()}
    assert set(pairs) == {("Survived", "id"), ("Age", "id"), ("Age", "Survived")}
    with pytest.raises(ValueError):
        P.correlation_matrix(df.select("Sex"))


def test_high_cardinality_cohort_has_no_window(df):
    plan = C.cohort_rates(df, ["id", "Sex"], "Survived")._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan
