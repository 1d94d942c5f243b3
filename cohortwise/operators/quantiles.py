"""Exact grouped quantiles that never hold a large group in one task.

Groups of bounded size (counted first) use Spark's own ``percentile``. If any
group is larger, two passes follow. The first builds a bounded sketch per group
and takes from it, for every wanted quantile, a narrow bracket of values that
must contain it. The second counts rows exactly, but keeps single values apart
only inside the brackets; everything between them collapses to one counter in
the map-side combine. A running count over what is left gives the exact order
statistics.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortwise.operators.joins import all_present, attach
from cohortwise.operators.prefix import running_totals
from cohortwise.session import materialize

# Groups up to this size are sorted by Spark's percentile inside one task.
DIRECT_ROWS = 200_000
ACCURACY = 10000
SLICES = 256
# Up to this many rows per group, the brackets' rows are summed in one task.
ONE_TASK_ROWS = 50_000_000


def no_nan(column: Column) -> Column:
    """NaN counts as missing."""
    value = column.cast("double")
    return F.when(~F.isnan(value), value)


def grouped_quantiles(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    probs: dict[str, float],
    keep_null_keys: bool = False,
    rows: str = "n",
    direct_rows: int = DIRECT_ROWS,
    accuracy: int = ACCURACY,
    one_task_rows: int = ONE_TASK_ROWS,
) -> DataFrame:
    """One row per key with the non-null count and linearly interpolated quantiles.

    ``probs`` maps output names to ascending probabilities. Groups without any
    value do not appear. Rows with a null key are skipped unless
    ``keep_null_keys``.
    """
    keys = list(keys)
    values = df.select(*keys, no_nan(F.col(value)).alias("__v")).filter(F.col("__v").isNotNull())
    if not keep_null_keys:
        values = values.filter(all_present(keys))
    group = keys or ["__all"]
    if not keys:
        values = values.withColumn("__all", F.lit(1))

    sizes = values.groupBy(*group).agg(F.count(F.lit(1)).alias("__n"))
    size = sizes.agg(F.count(F.lit(1)).alias("groups"), F.max("__n").alias("largest")).first()
    if (size["largest"] or 0) <= direct_rows:
        quantiles = F.percentile("__v", [float(p) for p in probs.values()])
        direct = values.groupBy(*group).agg(F.count(F.lit(1)).alias(rows), quantiles.alias("__q"))
        return direct.select(*keys, rows, *[F.col("__q")[i].alias(name) for i, name in enumerate(probs)])

    slack = 2.0 / accuracy
    points = [q for p in probs.values() for q in (max(p - slack, 0.0), min(p + slack, 1.0))]
    sketch = materialize(
        values.groupBy(*group).agg(
            F.count(F.lit(1)).alias("__n"),
            F.percentile_approx("__v", points, accuracy).alias("__points"),
        ),
        "brackets",
    ).withColumn("__rows", F.col("__n"))
    banded = attach(values, sketch, group, rows="__rows", null_safe=keep_null_keys, count=size["groups"])
    counted, in_slices = _bracketed(banded, group, len(probs), accuracy), size["largest"] > one_task_rows
    running = _running_counts(counted, group, in_slices, len(probs), accuracy, keep_null_keys)
    return _order_statistics(running, keys, group, probs, rows)


def _bracket(i: int) -> tuple[Column, Column]:
    return F.col("__points")[2 * i], F.col("__points")[2 * i + 1]


def _small(accuracy: int) -> Column:
    """A group of a few sketch widths is kept whole: the sketch's rank slack
    is below one row there."""
    return F.col("__n") <= 4 * accuracy


def _bracketed(banded: DataFrame, group: Sequence[str], brackets: int, accuracy: int) -> DataFrame:
    """Rows per (group, value) inside the brackets, and per gap between them.

    A gap carries the upper end of the bracket below it.
    """
    inside = _small(accuracy)
    ends_below = [F.lit(None).cast("double"), F.lit(None).cast("double")]
    for i in range(brackets):
        low, high = _bracket(i)
        inside = inside | F.col("__v").between(low, high)
        ends_below.append(F.when(high < F.col("__v"), high))
    at = F.when(F.col("__gap"), F.greatest(*ends_below)).otherwise(F.col("__v"))
    return (
        banded.withColumn("__gap", ~inside)
        .withColumn("__at", at)
        .groupBy(*group, "__n", "__points", "__at", "__gap")
        .agg(F.count(F.lit(1)).alias("__c"))
    )


def _running_counts(
    counted: DataFrame, group: Sequence[str], in_slices: bool, brackets: int, accuracy: int, null_safe: bool
) -> DataFrame:
    order = [F.col("__at").asc_nulls_first(), F.col("__gap")]
    if not in_slices:
        window = Window.partitionBy(*group).orderBy(*order)
        upto = window.rowsBetween(Window.unboundedPreceding, Window.currentRow)
        return counted.withColumn("__cum", F.sum("__c").over(upto))
    # A slice number grows with the value: the last bracket reached and, within
    # it, one of SLICES equal steps.
    number = F.lit(-1)
    for i in range(brackets):
        low, high = _bracket(i)
        step = F.coalesce(F.floor(F.try_divide(F.col("__at") - low, high - low) * (SLICES - 1)), F.lit(0))
        within = F.least(F.greatest(step, F.lit(0)), F.lit(SLICES - 1))
        number = F.when(F.col("__at") >= low, within + i * SLICES).otherwise(number)
    number = F.when(_small(accuracy), F.lit(0)).otherwise(number).cast("int")
    kept = materialize(counted.withColumn("__part", number).drop("__points"), "candidates")
    return running_totals(kept, group, order, {"__cum": F.col("__c")}, F.col("__part"), null_safe)


def _order_statistics(
    running: DataFrame, keys: Sequence[str], group: Sequence[str], probs: dict[str, float], rows: str
) -> DataFrame:
    """Pick the values at the two ranks around each quantile and interpolate."""
    entry = F.struct("__at", "__gap")
    picks = []
    for i, p in enumerate(probs.values()):
        position = F.lit(float(p)) * (F.col("__n") - 1)
        picks.append(F.min(F.when(F.col("__cum") > F.floor(position), entry)).alias(f"__lo{i}"))
        picks.append(F.min(F.when(F.col("__cum") > F.ceil(position), entry)).alias(f"__hi{i}"))
    picked = running.groupBy(*group, "__n").agg(*picks)
    outputs = []
    for i, (name, p) in enumerate(probs.items()):
        low, high = F.col(f"__lo{i}"), F.col(f"__hi{i}")
        position = F.lit(float(p)) * (F.col("__n") - 1)
        share = position - F.floor(position)
        between = (1 - share) * low["__at"] + share * high["__at"]
        result = F.when(low["__at"] == high["__at"], low["__at"]).otherwise(between)
        outside = F.raise_error(F.lit("quantile outside its bracket")).cast("double")
        outputs.append(F.when(low["__gap"] | high["__gap"], outside).otherwise(result).alias(name))
    return picked.select(*keys, F.col("__n").alias(rows), *outputs)


def grouped_median(df: DataFrame, keys: Sequence[str], value: str, name: str = "median", **kwargs) -> DataFrame:
    """Median of ``value`` per key."""
    return grouped_quantiles(df, keys, value, {name: 0.5}, **kwargs)


def column_quantiles(df: DataFrame, value: str, probs: Sequence[float]) -> list[float | None]:
    """Quantiles of one whole column, as a short driver-side list."""
    names = {f"q{i}": p for i, p in enumerate(probs)}
    row = grouped_quantiles(df, [], value, names).first()
    return [row[name] for name in names] if row else [None] * len(probs)
