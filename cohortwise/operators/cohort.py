"""Label rates by cohort."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortwise.functions.bins import cut, quantile_edges
from cohortwise.functions.numeric import group_size
from cohortwise.operators.profile import (
    dataset_info, missing_by_column, missing_patterns, missing_summary, percent, profile_categorical, profile_numeric,
    value_counts,
)


def cohort_overall(df: DataFrame, label: str) -> DataFrame:
    """Rows, positives, negatives and positive rate in percent."""
    if label not in df.columns:
        raise ValueError(f"no label column {label}")
    total, positives = F.count(F.lit(1)), F.sum(F.col(label)).cast("bigint")
    return df.agg(
        total.alias("total"),
        positives.alias("positives"),
        (total - positives).alias("negatives"),
        (F.avg(label) * 100).alias("rate_pct"),
    )


def cohort_rates(df: DataFrame, features: dict[str, Column] | Sequence[str], label: str) -> DataFrame:
    """Per feature value: total, positives, negatives, rate and share of rows with a value.

    All features share one scan and one aggregate. Rows without a value are
    counted in ``missing`` of their feature. Cohort values are compared as text.
    """
    if not isinstance(features, dict):
        features = {f: F.col(f) for f in features}
    names = list(features)
    long = df.select(
        F.col(label).cast("int").alias("__y"), *[c.cast("string").alias(n) for n, c in features.items()]
    ).unpivot(["__y"], names, "feature", "value")
    per_value = long.groupBy("feature", "value").agg(
        F.count(F.lit(1)).alias("total"), F.coalesce(F.sum("__y"), F.lit(0)).cast("bigint").alias("positives")
    )
    real = F.col("value").isNotNull()
    # One row per listed feature, so broadcasting it is safe.
    totals = per_value.groupBy("feature").agg(
        F.sum(F.when(real, F.col("total")).otherwise(0)).alias("__with"),
        F.sum(F.when(~real, F.col("total")).otherwise(0)).alias("missing"),
    )
    return (
        per_value.filter(real)
        .join(F.broadcast(totals), "feature")
        .select(
            "feature",
            "value",
            "total",
            "positives",
            (F.col("total") - F.col("positives")).alias("negatives"),
            percent(F.col("positives"), F.col("total")).alias("rate_pct"),
            percent(F.col("total"), F.col("__with")).alias("share_pct"),
            "missing",
        )
    )


# Age cohorts, fare cohorts and family size classes.
AGE_EDGES = [0, 12, 18, 35, 60, 100]
AGE_LABELS = ["Child (0-12)", "Teen (13-18)", "Young Adult (19-35)", "Adult (36-60)", "Senior (60+)"]
QUARTILE_LABELS = ["Low Fare (Q1)", "Medium-Low Fare (Q2)", "Medium-High Fare (Q3)", "High Fare (Q4)"]


def size_class_label(size: Column) -> Column:
    return (
        F.when(size == 1, "Alone")
        .when(size <= 3, "Small Family (2-3)")
        .when(size <= 6, "Medium Family (4-6)")
        .when(size.isNotNull(), "Large Family (7+)")
    )


def cohort_by_bins(df: DataFrame, column: str, label: str, edges: Sequence[float], labels: Sequence[str]) -> DataFrame:
    """Cohorts of fixed left-closed bins; values outside all bins count as missing."""
    return cohort_rates(df, {column: cut(F.col(column), edges, labels, right=False)}, label)


def cohort_by_quartiles(df: DataFrame, column: str, label: str, labels: Sequence[str] = QUARTILE_LABELS) -> DataFrame:
    """Cohorts of the column's own quartiles, right-closed, minimum included."""
    edges, kept = quantile_edges(df, column, [0.0, 0.25, 0.5, 0.75, 1.0], labels)
    return cohort_rates(df, {column: cut(F.col(column), edges, kept, right=True, include_lowest=True)}, label)


def cohort_by_size(df: DataFrame, a: str, b: str, label: str, name: str = "size_class") -> DataFrame:
    """Cohorts of group size ``a + b + 1`` in four classes."""
    return cohort_rates(df, {name: size_class_label(group_size(F.col(a), F.col(b)))}, label)


def cohort_chart_data(df: DataFrame, feature: str, label: str) -> DataFrame:
    """Count, sum and mean of the label by feature."""
    return (
        df.filter(F.col(feature).isNotNull())
        .groupBy(feature)
        .agg(F.count(label).alias("count"), F.sum(label).cast("bigint").alias("sum"), F.avg(label).alias("mean"))
    )


def exploration_report(
    df: DataFrame,
    label: str | None = None,
    categories: Sequence[str] = (),
    bins: str | None = None,
    quartiles: str | None = None,
    sizes: tuple[str, str] | None = None,
) -> dict[str, DataFrame]:
    """All profiles of a table as named DataFrames; label cohorts if it has the label."""
    report = {
        "info": dataset_info(df),
        "numeric": profile_numeric(df),
        "categorical": profile_categorical(df),
        "value_counts": value_counts(df),
        "missing_by_column": missing_by_column(df),
        "missing_patterns": missing_patterns(df),
        "missing_summary": missing_summary(df),
    }
    if label and label in df.columns:
        report["overall"] = cohort_overall(df, label)
        if categories:
            report["cohorts"] = cohort_rates(df, list(categories), label)
        if bins:
            report["cohorts_by_bins"] = cohort_by_bins(df, bins, label, AGE_EDGES, AGE_LABELS)
        if quartiles:
            report["cohorts_by_quartiles"] = cohort_by_quartiles(df, quartiles, label)
        if sizes:
            report["cohorts_by_size"] = cohort_by_size(df, *sizes, label)
    return report
