"""Reading, validating and writing."""

import pytest
from pyspark.sql import functions as F

from cohortwise.operators import validate as V
from cohortwise.sources import tables as S

RULES = V.TableRules(
    "PassengerId", S.PASSENGER_SCHEMA.names, V.PASSENGER_DOMAINS, V.PASSENGER_NUMERIC, expected_rows=891
)
ROWS = [
    (1, 0, 3, "Braund, Mr. Owen Harris", "male", 22.0, 1, 0, "A/5 21171", 7.25, None, "S"),
    (2, 1, 1, "Cumings, Mrs. John", "female", 38.0, 1, 0, "PC 17599", 71.2833, "C85", "C"),
    (3, 1, 3, "Heikkinen, Miss. Laina", "female", None, 0, 0, "STON/O2. 3101282", 7.925, None, None),
]


@pytest.fixture(scope="module")
def good(spark):
    return spark.createDataFrame(ROWS, S.PASSENGER_SCHEMA)


def failing(df):
    return {r["check"] for r in V.validation_report(df, RULES).collect() if r["violations"]} - {"row_count"}


def test_good_table_passes_and_reports_row_count(good):
    report = {r["check"]: r["violations"] for r in V.validate(good, RULES).collect()}
    assert report["row_count"] == 888 and sum(v for k, v in report.items() if k != "row_count") == 0


@pytest.mark.parametrize(
    "change,check",
    [
        (lambda d: d.withColumn("Survived", F.lit(2)), "domain:Survived"),
        (lambda d: d.withColumn("Pclass", F.lit(4)), "domain:Pclass"),
        (lambda d: d.withColumn("Sex", F.lit("other")), "domain:Sex"),
        (lambda d: d.withColumn("PassengerId", F.lit(7)), "duplicate_keys"),
        (lambda d: d.withColumn("Age", F.lit("old")), "numeric:Age"),
        (lambda d: d.filter("1 = 0"), "empty"),
    ],
)
def test_each_broken_table_fails_its_check(good, change, check):
    bad = change(good)
    assert failing(bad) == {check}
    with pytest.raises(ValueError, match=check):
        V.validate(bad, RULES)


def test_missing_extra_and_untyped_columns(good):
    assert V.column_difference(good.drop("Age").withColumn("x", F.lit(1)), RULES.required) == (["Age"], ["x"])
    with pytest.raises(ValueError, match="missing columns"):
        V.validate(good.drop("Age"), RULES)
    with pytest.raises(ValueError, match="PassengerId must be numeric"):
        V.validate(good.withColumn("PassengerId", F.concat(F.lit("p"), F.col("PassengerId"))), RULES)


def test_nulls_pass_domain_checks(good):
    assert failing(good.withColumn("Survived", F.lit(None).cast("int"))) == set()


def test_csv_round_trip_with_doubled_quotes(spark, tmp_path):
    path = tmp_path / "in.csv"
    path.write_text('PassengerId,Name,Age\n911,"Assaf Khalil, Mrs. Mariana (Miriam"")""",45\n912,"X, Mr. Y",\n')
    schema = S.without_fields(S.PASSENGER_SCHEMA, [c for c in S.PASSENGER_SCHEMA.names if c not in ("PassengerId", "Name", "Age")])
    rows = S.read_csv(spark, str(path), schema).orderBy("PassengerId").collect()
    assert rows[0]["Name"] == 'Assaf Khalil, Mrs. Mariana (Miriam")"' and rows[1]["Age"] is None


def test_csv_errors(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        S.read_csv(spark, str(tmp_path / "none.csv"), S.PASSENGER_SCHEMA)
    with pytest.raises(FileNotFoundError):
        S.read_parquet(spark, str(tmp_path / "none.parquet"))
    empty = tmp_path / "empty.csv"
    empty.write_text(",".join(S.PASSENGER_SCHEMA.names) + "\n")
    with pytest.raises(ValueError):
        S.read_csv(spark, str(empty), S.PASSENGER_SCHEMA)
    wrong = tmp_path / "wrong.csv"
    wrong.write_text(",".join(S.PASSENGER_SCHEMA.names) + "\n1,x,y\n")
    with pytest.raises(Exception):
        S.read_csv(spark, str(wrong), S.PASSENGER_SCHEMA).collect()


def test_nan_becomes_null(spark):
    df = spark.createDataFrame([(1, float("nan")), (2, 1.0)], "id int, v double")
    assert S.nan_to_null(df).filter("v is null").count() == 1


def checks(df, rows=None):
    return {r["check"]: r["passed"] for r in V.output_checks(df, "PassengerId", "Survived", rows).collect()}


def test_output_checks(spark, tmp_path):
    good = spark.createDataFrame([(1, 0), (2, 1)], "PassengerId int, Survived int")
    path = S.write_predictions(good, str(tmp_path / "out"))
    written = S.read_predictions(spark, path)
    assert all(checks(written, 2).values())
    assert not checks(written, 418)["row_count"]
    V.validate_output(written, "PassengerId", "Survived", 2)
    bad = {
        "binary_predictions": [(1, 0), (2, 2)],
        "no_missing_values": [(1, 0), (2, None)],
        "unique_keys": [(1, 0), (1, 1)],
    }
    for check, rows in bad.items():
        df = spark.createDataFrame(rows, "PassengerId int, Survived int")
        result = checks(df)
        assert not result[check] and not result["compliant"]
        with pytest.raises(ValueError, match=check):
            V.validate_output(df, "PassengerId", "Survived")
        assert V.output_offenders(df, "PassengerId", "Survived").filter(F.col("check") == check).count() == 1
    assert checks(good.withColumnRenamed("Survived", "x")) == {"columns": False, "compliant": False}
    with pytest.raises(FileNotFoundError):
        S.read_predictions(spark, str(tmp_path / "none"))


def test_prediction_summary_and_vector_checks(spark):
    df = spark.createDataFrame([(1.0,), (0.0,), (0.0,), (float("nan"),), (None,), (2.0,)], "p double")
    row = V.prediction_checks(df, "p", 6).first()
    assert (row["missing"], row["not_binary"], row["row_gap"]) == (2, 1, 0)
    s = V.prediction_summary(df.filter("p in (0, 1)"), "p").first()
    assert (s["total"], s["positives"], s["negatives"], round(s["positive_rate"], 4)) == (3, 1, 2, 0.3333)
    assert V.table_info(df)["columns"] == ["p"]
