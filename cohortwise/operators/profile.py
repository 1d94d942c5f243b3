"""Column profiles and missing-value patterns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortwise.operators.quantiles import grouped_quantiles, no_nan
from cohortwise.operators.validate import count_if
from cohortwise.operators.wide import blocked_correlation


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]


def text_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]


def percent(part: Column, whole: Column) -> Column:
    return F.try_divide(part, whole) * 100


def profile_numeric(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Count, mean, sample std, min, quartiles, max and missing share per column."""
    columns = list(columns or numeric_columns(df))
    long = df.select(*[no_nan(F.col(c)).alias(c) for c in columns]).unpivot([], columns, "column", "value")
    moments = long.groupBy("column").agg(
        F.count("value").alias("count"),
        F.avg("value").alias("mean"),
        F.stddev_samp("value").alias("std"),
        F.min("value").alias("min"),
        F.max("value").alias("max"),
        count_if(F.col("value").isNull()).alias("missing_count"),
        F.count(F.lit(1)).alias("total"),
    )
    quartiles = grouped_quantiles(long, ["column"], "value", {"q25": 0.25, "median": 0.5, "q75": 0.75}, rows="__n")
    return moments.join(quartiles, "column", "left").select(
        "column", "count", "mean", "std", "min", "q25", "median", "q75", "max", "missing_count",
        percent(F.col("missing_count"), F.col("total")).alias("missing_pct"),
    )


def value_counts(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Rows per (column, value); null values are left out."""
    columns = list(columns or text_columns(df))
    long = df.select(*[F.col(c).cast("string").alias(c) for c in columns]).unpivot([], columns, "column", "value")
    return long.filter(F.col("value").isNotNull()).groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))


def profile_categorical(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Count, distinct values, most frequent value (smallest on ties) and missing share."""
    columns = list(columns or text_columns(df))
    long = df.select(*[F.col(c).cast("string").alias(c) for c in columns]).unpivot([], columns, "column", "value")
    per_value = long.groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))
    real = F.col("value").isNotNull()
    top = F.min(F.when(real, F.struct((-F.col("n")).alias("neg"), F.col("value").alias("value"))))
    return per_value.groupBy("column").agg(
        F.coalesce(F.sum(F.when(real, F.col("n"))), F.lit(0)).alias("count"),
        count_if(real).alias("unique_values"),
        top["value"].alias("most_frequent"),
        F.coalesce(-top["neg"], F.lit(0)).alias("most_frequent_count"),
        F.coalesce(F.sum(F.when(~real, F.col("n"))), F.lit(0)).alias("missing_count"),
        percent(F.coalesce(F.sum(F.when(~real, F.col("n"))), F.lit(0)), F.sum("n")).alias("missing_pct"),
    )


def dataset_info(df: DataFrame) -> DataFrame:
    """Row and column count."""
    return df.agg(F.count(F.lit(1)).alias("rows"), F.lit(len(df.columns)).cast("bigint").alias("columns"))


def missing_by_column(df: DataFrame) -> DataFrame:
    """Missing and present count and share per column."""
    wide = df.agg(F.count(F.lit(1)).alias("__total"), *[count_if(F.col(c).isNull()).alias(c) for c in df.columns])
    long = wide.unpivot(["__total"], list(df.columns), "column", "missing_count")
    present = F.col("__total") - F.col("missing_count")
    return long.select(
        "column",
        "missing_count",
        percent(F.col("missing_count"), F.col("__total")).alias("missing_pct"),
        present.alias("present_count"),
        percent(present, F.col("__total")).alias("present_pct"),
    )


def _null_vectors(df: DataFrame) -> DataFrame:
    """Rows per null vector: at most one row per distinct combination leaves
    the map side, and every missing-value summary follows from it."""
    return (
        df.select(F.array(*[F.col(c).isNull() for c in df.columns]).alias("nulls"))
        .groupBy("nulls")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def missing_patterns(df: DataFrame) -> DataFrame:
    """Rows per combination of missing columns, over columns that miss anything."""
    vectors = _null_vectors(df)
    anywhere = vectors.agg(
        F.array(*[F.max(F.col("nulls")[i]) for i in range(len(df.columns))]).alias("anywhere"),
        F.sum("n").alias("total"),
        F.lit(1).alias("__one"),
    )
    names = F.array(*[F.lit(c) for c in df.columns])
    parts = F.transform(
        F.filter(F.arrays_zip(names.alias("name"), F.col("nulls"), F.col("anywhere")), lambda z: z["anywhere"]),
        lambda z: F.concat(z["name"], F.lit(":"), F.when(z["nulls"], "True").otherwise("False")),
    )
    return (
        vectors.withColumn("__one", F.lit(1))
        .join(anywhere, "__one")
        .select(F.concat_ws("_", parts).alias("pattern"), "n", percent(F.col("n"), F.col("total")).alias("pct"))
        .filter(F.col("pattern") != "")
    )


def missing_summary(df: DataFrame) -> DataFrame:
    """Totals over the table; ties for the most-missing column go to the first."""
    columns = list(df.columns)
    per_column = [count_if(F.col(c).isNull()).alias(f"m{i}") for i, c in enumerate(columns)]
    any_null = F.lit(False)
    for c in columns:
        any_null = any_null | F.col(c).isNull()
    wide = df.agg(F.count(F.lit(1)).alias("rows"), count_if(any_null).alias("with_any"), *per_column)
    counts = [F.col(f"m{i}") for i in range(len(columns))]
    worst = F.array_max(F.array(*counts))
    which = F.array_position(F.array(*counts), worst)
    with_missing = sum([F.when(c > 0, 1).otherwise(0) for c in counts], F.lit(0)).cast("bigint")
    total = sum(counts, F.lit(0).cast("bigint"))
    cells = F.col("rows") * len(columns)
    return wide.select(
        total.alias("total_missing"),
        cells.alias("total_cells"),
        percent(total, cells).alias("missing_pct"),
        with_missing.alias("columns_with_missing"),
        (F.lit(len(columns)).cast("bigint") - with_missing).alias("columns_without_missing"),
        F.col("with_any").alias("rows_with_any_missing"),
        (F.col("rows") - F.col("with_any")).alias("rows_without_missing"),
        F.when(worst > 0, F.element_at(F.array(*[F.lit(c) for c in columns]), which.cast("int"))).alias(
            "most_missing_column"
        ),
        worst.alias("most_missing_count"),
    )


# Up to so many columns have one aggregate for each pair.
WIDE_COLUMNS = 24


def correlation_matrix(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Pearson correlation of every pair of numeric columns, lower triangle, long form.

    Pairwise complete: a pair skips rows where either value is missing. More than ``WIDE_COLUMNS``
    columns, whose pairs no generated code could hold, are multiplied in blocks.
    """
    columns = list(columns or numeric_columns(df))
    if not columns:
        raise ValueError("no numeric columns")
    if len(columns) > WIDE_COLUMNS:
        return blocked_correlation(df, columns)
    pairs = [(a, b) for i, a in enumerate(columns) for b in columns[:i]]
    clean = df.select(*[no_nan(F.col(c)).alias(c) for c in columns])
    both = lambda a, b: F.stddev_pop(F.when(F.col(b).isNotNull(), F.col(a)))
    # Null where one of the two is constant.
    wide = clean.agg(*[F.try_divide(F.covar_pop(a, b), both(a, b) * both(b, a)).alias(f"c{i}") for i, (a, b) in enumerate(pairs)])
    rows = F.array(
        *[F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), F.col(f"c{i}").alias("r")) for i, (a, b) in enumerate(pairs)]
    )
    return wide.select(F.explode(rows).alias("p")).select("p.a", "p.b", F.col("p.r").alias("corr"))
