"""Table checks: presence, keys, domains, types, and output compliance."""

from __future__ import annotations

import logging
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortwise.session import plan_bytes, small_table
from cohortwise.sources.tables import read_predictions

log = logging.getLogger(__name__)


@dataclass
class TableRules:
    """What a table must look like."""

    key: str
    required: Sequence[str] = ()
    domains: dict[str, Sequence] = field(default_factory=dict)
    numeric: Sequence[str] = ()
    expected_rows: int | None = None


# Domains and numeric columns of the passenger table.
PASSENGER_DOMAINS = {"Survived": [0, 1], "Pclass": [1, 2, 3], "Sex": ["male", "female"]}
PASSENGER_NUMERIC = ["Age", "SibSp", "Parch", "Fare"]


def is_numeric(df: DataFrame, column: str) -> bool:
    return isinstance(df.schema[column].dataType, T.NumericType)


def count_if(condition: Column) -> Column:
    """How many rows meet a condition (null counts as not met)."""
    return F.coalesce(F.sum(F.when(condition, F.lit(1)).otherwise(F.lit(0))), F.lit(0)).cast("bigint")


def out_of_domain(column: str, values: Sequence) -> Column:
    return F.col(column).isNotNull() & ~F.col(column).isin(*values)


def not_a_number(column: str) -> Column:
    return F.col(column).isNotNull() & F.expr(f"try_cast(`{column}` AS double)").isNull()


def column_difference(df: DataFrame, required: Sequence[str]) -> tuple[list[str], list[str]]:
    """Missing and unexpected column names; needs no job."""
    missing = [c for c in required if c not in df.columns]
    extra = [c for c in df.columns if c not in required]
    return missing, extra


def duplicate_keys(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their count."""
    return df.groupBy(*key).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)


def domain_violations(df: DataFrame, domains: dict[str, Sequence]) -> DataFrame:
    """Rows per column whose value lies outside its domain; nulls pass."""
    return _long_counts(df, {c: count_if(out_of_domain(c, v)) for c, v in domains.items()}, "violations")


def coercion_failures(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows per column holding text that is not a number."""
    return _long_counts(df, {c: count_if(not_a_number(c)) for c in columns}, "violations")


def null_counts(df: DataFrame) -> DataFrame:
    """Nulls per column in one pass."""
    return _long_counts(df, {c: count_if(F.col(c).isNull()) for c in df.columns}, "nulls")


def _long_counts(df: DataFrame, aggregates: dict[str, Column], name: str) -> DataFrame:
    wide = df.agg(*[a.alias(c) for c, a in aggregates.items()])
    return wide.unpivot([], list(aggregates), "column", name)


def validation_report(df: DataFrame, rules: TableRules) -> DataFrame:
    """All checks as rows ``(check, violations)``: one pass plus one key count."""
    missing, _ = column_difference(df, rules.required)
    present = [c for c in rules.numeric if c in df.columns]
    aggregates = {"rows": F.count(F.lit(1)).cast("bigint")}
    aggregates |= {f"domain:{c}": count_if(out_of_domain(c, v)) for c, v in rules.domains.items() if c in df.columns}
    aggregates |= {f"numeric:{c}": count_if(not_a_number(c)) for c in present}
    wide = df.agg(*[a.alias(n) for n, a in aggregates.items()])
    counts = {n: F.col(f"`{n}`") for n in aggregates if n != "rows"}
    counts["empty"] = F.when(F.col("rows") == 0, 1).otherwise(0).cast("bigint")
    counts["missing_columns"] = F.lit(len(missing)).cast("bigint")
    if rules.expected_rows is not None:
        counts["row_count"] = F.abs(F.col("rows") - F.lit(rules.expected_rows)).cast("bigint")
    report = wide.select(*[c.alias(n) for n, c in counts.items()]).unpivot([], list(counts), "check", "violations")
    if rules.key in df.columns:
        keys = duplicate_keys(df, [rules.key]).agg(
            F.lit("duplicate_keys").alias("check"), F.count(F.lit(1)).cast("bigint").alias("violations")
        )
        report = report.unionByName(keys)
    return report


def validate(df: DataFrame, rules: TableRules) -> DataFrame:
    """Raise ValueError on the first broken check; return the report otherwise.

    A row count that differs from the expected one and unexpected columns are
    reported, not raised.
    """
    missing, _ = column_difference(df, rules.required)
    if missing:
        raise ValueError(f"missing columns: {missing}")
    typed = [rules.key] + [c for c, values in rules.domains.items() if not isinstance(values[0], str)]
    for column in typed:
        if column in df.columns and not is_numeric(df, column):
            raise ValueError(f"{column} must be numeric")
    report = validation_report(df, rules)
    for row in report.collect():  # one row per declared check
        if row["violations"] and row["check"] != "row_count":
            raise ValueError(f"check failed: {row['check']} ({row['violations']})")
    return report


def table_info(df: DataFrame) -> dict:
    """Columns, types and the optimizer's size estimate; needs no job."""
    return {"columns": df.columns, "dtypes": dict(df.dtypes), "estimated_bytes": plan_bytes(df)}


def _int_like(column: str) -> Column:
    return F.expr(f"try_cast(`{column}` AS bigint)")


def output_checks(df: DataFrame, key: str, label: str, expected_rows: int | None) -> DataFrame:
    """Checks of a prediction table as rows ``(check, passed, detail)``.

    ``detail`` counts offending rows. The closing row ``compliant`` is the AND
    of all others.
    """
    right_columns = df.columns == [key, label]
    if not right_columns:
        names = [("columns", False, len(df.columns)), ("compliant", False, len(df.columns))]
        return small_table(df.sparkSession, names, "check string, passed boolean, detail bigint")
    bad_label = F.col(label).isNull() | F.coalesce(~_int_like(label).isin(0, 1), F.lit(True))
    facts = df.agg(
        F.count(F.lit(1)).cast("bigint").alias("rows"),
        count_if(F.col(key).isNotNull() & _int_like(key).isNull()).alias("key_numeric"),
        count_if(F.col(key).isNull() | F.col(label).isNull()).alias("no_missing_values"),
        count_if(bad_label).alias("binary_predictions"),
    )
    repeated = duplicate_keys(df, [key]).agg(F.count(F.lit(1)).cast("bigint").alias("unique_keys"))
    both = facts.withColumn("__one", F.lit(1)).join(repeated.withColumn("__one", F.lit(1)), "__one")
    off = F.lit(0) if expected_rows is None else F.abs(F.col("rows") - F.lit(expected_rows))
    checks = {
        "columns": F.lit(0).cast("bigint"),
        "row_count": F.when(F.col("rows") == 0, 1).otherwise(off).cast("bigint"),
        "key_numeric": F.col("key_numeric"),
        "unique_keys": F.col("unique_keys"),
        "no_missing_values": F.col("no_missing_values"),
        "binary_predictions": F.col("binary_predictions"),
    }
    checks["compliant"] = sum(list(checks.values())[1:], list(checks.values())[0])
    long = both.select(*[c.alias(n) for n, c in checks.items()]).unpivot([], list(checks), "check", "detail")
    return long.select("check", (F.col("detail") == 0).alias("passed"), "detail")


def validate_output(df: DataFrame, key: str, label: str, expected_rows: int | None = None, strict_rows: bool = True) -> DataFrame:
    """Raise ValueError when a prediction table breaks a check.

    Without ``strict_rows`` another number of rows than expected is only a warning; a table without rows fails all the same.
    """
    report = output_checks(df, key, label, expected_rows)
    rows = {r["check"]: r for r in report.collect()}
    failed = [n for n, r in rows.items() if not r["passed"] and n != "compliant"]
    if not strict_rows and failed == ["row_count"] and not df.isEmpty():
        log.warning("%d rows more or less than the expected %d", rows["row_count"]["detail"], expected_rows)
        return output_checks(df, key, label, None)
    if failed:
        raise ValueError(f"output checks failed: {failed}")
    return report


def file_checks(spark: SparkSession, path: str, key: str, label: str, expected_rows: int | None = None) -> DataFrame:
    """Checks of a written prediction file as rows ``(check, passed, detail)``: first the file, then its table.

    ``file_exists`` raises FileNotFoundError if it fails; ``csv_format`` wants the name to end in .csv;
    ``readable`` wants a header and at least one row. The closing row ``compliant`` is the AND of all.
    """
    df = read_predictions(spark, path)
    named, filled = path.rstrip("/").lower().endswith(".csv"), bool(df.columns) and not df.isEmpty()
    own = [("file_exists", True, 0), ("csv_format", named, int(not named)), ("readable", filled, int(not filled))]
    checks = output_checks(df, key, label, expected_rows)
    first = small_table(spark, own, "check string, passed boolean, detail bigint")
    every = first.unionByName(checks.filter("check <> 'compliant'"))
    closing = every.agg(F.lit("compliant").alias("check"), F.min("passed").alias("passed"), F.sum("detail").alias("detail"))
    return every.unionByName(closing)


def compliance_details(df: DataFrame, key: str, label: str) -> DataFrame:
    """What stands behind :func:`output_checks`, as rows ``(part, item, value)``: missing values by column, invalid
    predictions by value, repeated keys with their rows, and, if all predictions are 0 or 1, their summary."""
    valid = F.coalesce(_int_like(label).isin(0, 1), F.lit(False))
    row = lambda part, item, value: F.struct(F.lit(part).alias("part"), F.lit(item).alias("item"), value.cast("double").alias("value"))
    one = F.when(valid, _int_like(label))
    sums = df.agg(
        count_if(F.col(key).isNull()).alias("k"), count_if(F.col(label).isNull()).alias("l"), F.count(F.lit(1)).alias("n"),
        F.coalesce(F.sum(one), F.lit(0)).alias("ones"), count_if(~valid).alias("bad"),
    )
    summary = F.array(row("summary", "total", F.col("n")), row("summary", "positives", F.col("ones")), row("summary", "negatives", F.col("n") - F.col("ones")), row("summary", "positive_rate", F.try_divide("ones", "n")))
    missing = F.array(row("missing", key, F.col("k")), row("missing", label, F.col("l")))
    every = sums.select(F.explode(F.concat(F.filter(missing, lambda r: r["value"] > 0), F.when(F.col("bad") == 0, summary).otherwise(F.array().cast(_DETAIL)))).alias("r")).select("r.*")
    invalid = df.filter(F.col(label).isNotNull() & ~valid).groupBy(F.col(label).cast("string").alias("item")).count()
    repeated = df.filter(F.col(key).isNotNull()).groupBy(F.col(key).cast("string").alias("item")).count().filter("count > 1")
    return every.unionByName(invalid.select(F.lit("invalid").alias("part"), "item", F.col("count").cast("double").alias("value"))).unionByName(
        repeated.select(F.lit("repeated").alias("part"), "item", F.col("count").cast("double").alias("value"))
    )


_DETAIL = "array<struct<part: string, item: string, value: double>>"


def output_offenders(df: DataFrame, key: str, label: str) -> DataFrame:
    """The offending rows behind :func:`output_checks`, with the broken check."""
    bad = df.select(
        F.col(key).cast("string").alias("key"),
        F.when(F.col(key).isNull() | F.col(label).isNull(), "no_missing_values")
        .when(F.coalesce(~_int_like(label).isin(0, 1), F.lit(True)), "binary_predictions")
        .alias("check"),
    ).filter(F.col("check").isNotNull())
    repeated = duplicate_keys(df, [key]).select(F.col(key).cast("string").alias("key"), F.lit("unique_keys").alias("check"))
    return bad.unionByName(repeated)


def prediction_checks(df: DataFrame, prediction: str, expected_rows: int | None = None) -> DataFrame:
    """Rows whose prediction is missing, NaN, or not 0/1, and the row count gap."""
    value = F.col(prediction).cast("double")
    missing = value.isNull() | F.isnan(value)
    gap = F.lit(0) if expected_rows is None else F.abs(F.count(F.lit(1)) - F.lit(expected_rows))
    return df.agg(
        count_if(missing).alias("missing"),
        count_if(~missing & ~value.isin(0.0, 1.0)).alias("not_binary"),
        gap.cast("bigint").alias("row_gap"),
    )


def prediction_summary(df: DataFrame, prediction: str) -> DataFrame:
    """Total, positives, negatives and positive rate."""
    p = F.col(prediction)
    return df.agg(
        F.count(F.lit(1)).cast("bigint").alias("total"),
        count_if(p == 1).alias("positives"),
        count_if(p == 0).alias("negatives"),
        F.try_divide(count_if(p == 1), F.count(F.lit(1))).alias("positive_rate"),
    )
