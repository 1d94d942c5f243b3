"""Running totals over a global or skewed order, in two levels.

A window over the whole order would run in one task. Here rows are cut into
ordered slices; totals per slice are few and are summed first, then each slice
is summed on its own and shifted by what came before.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortwise.operators.joins import fits_broadcast
from cohortwise.session import materialize


def running_totals(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column],
    sums: dict[str, Column],
    slice_by: Column | None = None,
    null_safe: bool = False,
) -> DataFrame:
    """Add inclusive running totals ``sums`` per ``keys`` along ``order``.

    ``slice_by`` is a deterministic integer that grows with ``order`` (such as
    the top bits of a hash). Without it, rows are range-partitioned by
    ``keys, order`` and written once, so that every later read sees the same
    slices. ``keys`` + ``order`` must be unique for the result to be fixed.
    """
    keys = list(keys)
    if slice_by is None:
        parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        ranged = df.repartitionByRange(parts, *[F.col(k) for k in keys], *order)
        sliced = materialize(ranged.withColumn("__slice", F.spark_partition_id()), "slices")
    else:
        sliced = df.withColumn("__slice", slice_by)
    group = [*keys, "__slice"]
    totals = sliced.groupBy(*group).agg(*[F.sum(c).alias(f"__t_{n}") for n, c in sums.items()])
    earlier = Window.partitionBy(*keys).orderBy("__slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = materialize(
        totals.select(*group, *[F.coalesce(F.sum(f"__t_{n}").over(earlier), F.lit(0)).alias(f"__o_{n}") for n in sums]),
        "offsets",
    )
    within = Window.partitionBy(*group).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    local = sliced.withColumns({f"__l_{n}": F.sum(c).over(within) for n, c in sums.items()})
    joined = _join_offsets(local, offsets, group, null_safe)
    return joined.withColumns({n: F.col(f"__l_{n}") + F.col(f"__o_{n}") for n in sums}).drop(
        "__slice", *[f"__l_{n}" for n in sums], *[f"__o_{n}" for n in sums]
    )


def _join_offsets(local: DataFrame, offsets: DataFrame, group: Sequence[str], null_safe: bool) -> DataFrame:
    """Slices are even, so a plain join does; rows already lie by slice after
    the window, so only the offsets move when they are too many to broadcast."""
    renamed = offsets.select(*[F.col(k).alias(f"__k_{k}") if k in group else F.col(k) for k in offsets.columns])
    renamed = F.broadcast(renamed) if fits_broadcast(offsets) else renamed
    on = [F.col(k).eqNullSafe(F.col(f"__k_{k}")) if null_safe else F.col(k) == F.col(f"__k_{k}") for k in group]
    return local.join(renamed, on).drop(*[f"__k_{k}" for k in group])
