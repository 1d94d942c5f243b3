"""Joining fitted stat tables onto rows, safe for hot keys."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortwise.session import broadcast_limit, materialize, plan_bytes

# A key is hot when it holds more than 1/HOT_PARTS of the counted rows, so
# there are fewer than HOT_PARTS hot keys whatever the table size.
HOT_PARTS = 1000
SALTS = 64
STREAM_SALTS = 8
# Rows with a null key match nothing, so they may go anywhere.
NULL_SALTS = 1 << 20
# Most rows a broadcast table may have, next to the session's byte limit.
BROADCAST_ROWS = 200_000
# The optimizer's stand-in for an unknown size, and what is accepted then.
UNKNOWN_BYTES = 1 << 60
UNSIZED_ROWS = 10_000


def _equal(left: str, right: str, null_safe: bool) -> Column:
    return F.col(left).eqNullSafe(F.col(right)) if null_safe else F.col(left) == F.col(right)


def fits_broadcast(table: DataFrame, count: int | None = None) -> bool:
    """Whether a table may be broadcast.

    The optimizer's size estimate must be below the session's limit, and the
    counted rows below ``BROADCAST_ROWS``. Where the optimizer has no estimate,
    only ``UNSIZED_ROWS`` rows pass.
    """
    limit = broadcast_limit(table.sparkSession)
    size = plan_bytes(table)
    unsized = size >= UNKNOWN_BYTES
    if limit <= 0 or (size > limit and not unsized):
        return False
    most = min(UNSIZED_ROWS, BROADCAST_ROWS) if unsized else BROADCAST_ROWS
    if count is None:
        count = table.limit(most + 1).count()
    return count <= most


def attach(
    df: DataFrame,
    table: DataFrame,
    keys: Sequence[str],
    rows: str | None = None,
    null_safe: bool = False,
    count: int | None = None,
) -> DataFrame:
    """Left-join a table with unique ``keys`` onto ``df``.

    A table small enough is broadcast. A larger one is joined by shuffle: rows
    with a null key, which can't match, are spread evenly, and the hot keys of
    ``df``, found by one map-side combined count of its keys, over ``SALTS``
    partitions. A stream can't be counted beforehand, so there every key is
    spread over ``STREAM_SALTS``. ``rows`` names a count column of the table
    that is dropped from the result.
    """
    carried = [c for c in table.columns if c not in keys and c != rows]
    if fits_broadcast(table, count):
        renamed = table.select(*[F.col(k).alias(f"__{k}") for k in keys], *carried)
        on = [_equal(k, f"__{k}", null_safe) for k in keys]
        return df.join(F.broadcast(renamed), on, "left").drop(*[f"__{k}" for k in keys])
    deal = F.xxhash64(*[F.col(f"`{c}`") for c in df.columns])
    zero = F.lit(0).cast("bigint")
    if df.isStreaming:
        salt, copies = F.pmod(deal, F.lit(STREAM_SALTS)), F.sequence(zero, F.lit(STREAM_SALTS - 1).cast("bigint"))
        flagged, marked = df, table
    else:
        hot = _hot_keys(df, keys, null_safe)
        to_hot = [_equal(k, f"__h_{k}", null_safe) for k in keys]
        flagged = df.join(F.broadcast(hot), to_hot, "left")
        marked = table.join(F.broadcast(hot), to_hot, "left")
        salt = F.when(F.col("__hot"), F.pmod(deal, F.lit(SALTS))).otherwise(zero)
        copies = F.when(F.col("__hot"), F.sequence(zero, F.lit(SALTS - 1).cast("bigint"))).otherwise(F.array(zero))
    if not null_safe:
        salt = F.when(all_present(keys), salt).otherwise(F.pmod(deal, F.lit(NULL_SALTS)))
    flagged = flagged.withColumn("__salt", salt).drop("__hot", *[f"__h_{k}" for k in keys])
    spread = marked.select(*[F.col(k).alias(f"__{k}") for k in keys], *carried, F.explode(copies).alias("__copy"))
    on = [_equal(k, f"__{k}", null_safe) for k in keys] + [F.col("__salt") == F.col("__copy")]
    return flagged.join(spread, on, "left").drop("__salt", "__copy", *[f"__{k}" for k in keys])


def _hot_keys(df: DataFrame, keys: Sequence[str], null_safe: bool) -> DataFrame:
    """The fewer than ``HOT_PARTS`` keys with more than their part of the rows, from one pass over the key columns."""
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("__rows"))
    counts = materialize(counts if null_safe else counts.filter(all_present(keys)), "key-counts")
    total = counts.agg(F.sum("__rows")).first()[0] or 0
    hot = counts.filter(F.col("__rows") * HOT_PARTS > F.lit(total))
    return hot.select(*[F.col(k).alias(f"__h_{k}") for k in keys], F.lit(True).alias("__hot"))


def join_with_default(
    df: DataFrame, table: DataFrame, keys: Sequence[str], column: str, default, rows: str | None = None
) -> DataFrame:
    """Left-join one column of a stat table; keys without a match get ``default``."""
    joined = attach(df, table.select(*keys, column, *([rows] if rows else [])), keys, rows)
    return joined.withColumn(column, F.coalesce(F.col(column), F.lit(default)))


def mark_members(df: DataFrame, members: DataFrame, keys: Sequence[str], flag: str) -> DataFrame:
    """Add a 0/1 column: does the row's key occur in ``members`` (unique keys)?"""
    table = members.select(*keys).withColumn(flag, F.lit(1))
    return attach(df, table, keys).withColumn(flag, F.coalesce(F.col(flag), F.lit(0)))


def keep_members(df: DataFrame, members: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose key occurs in ``members`` (semi-join)."""
    own = members.select(*[F.col(k).alias(f"__{k}") for k in keys]).distinct()
    return df.join(own, [F.col(k) == F.col(f"__{k}") for k in keys], "left_semi")


def all_present(columns: Sequence[str]) -> Column:
    """True when none of the columns is null."""
    return reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in columns], F.lit(True))
