"""Reproducible splits from a hash of the row key.

The same key and seed always land in the same place, whatever the number of
partitions or the order of rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortwise.operators.joins import attach
from cohortwise.operators.prefix import running_totals
from cohortwise.session import materialize

HASH_RANGE = 1 << 32


def key_hash(key: Column, seed: int = 42) -> Column:
    """A 32-bit integer from the key and the seed."""
    digest = F.md5(F.concat(key.cast("string"), F.lit(f"|{seed}")).cast("binary"))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint")


def hash_rank(df: DataFrame, key: str, strata: Sequence[str] = (), seed: int = 42, slices: int | None = None) -> DataFrame:
    """Add ``__rank``: position (from 1) by hash within the stratum.

    Ties on the hash are ordered by key. Hash values are uniform, so slices of
    the hash range are even and no stratum has to fit in one task. The number
    of slices grows with the session's shuffle partitions. Rows without a
    stratum value form a stratum of their own.
    """
    if slices is None:
        slices = max(4096, 8 * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    hashed = df.withColumn("__hash", key_hash(F.col(key), seed))
    step = HASH_RANGE // slices
    ranked = running_totals(
        hashed, list(strata), [F.col("__hash"), F.col(key)], {"__rank": F.lit(1)}, F.floor(F.col("__hash") / step), True
    )
    return ranked.drop("__hash")


# Top bits of the hash that are counted to find where a split cuts.
BUCKET_BITS = 16


def hash_cuts(df: DataFrame, key: str, strata: Sequence[str], share: float, seed: int = 42) -> DataFrame:
    """Per stratum the last ``(hash, key)`` of its first ``round(share * size)`` rows by hash: columns ``__h``, ``__k``.

    A histogram of the hash's top bits, one map-side combined count, tells in which bucket the cut
    lies; only that bucket's rows, one in 65,536, are ranked. A stratum whose share is no row has no line.
    """
    group = list(strata) or ["__all"]
    hashed = df.select(*strata, F.coalesce(key_hash(F.col(key), seed), F.lit(-1)).alias("__h"), F.col(key).alias("__k"))
    hashed = hashed.withColumn("__bucket", F.shiftright("__h", 32 - BUCKET_BITS)) if strata else hashed.withColumns(
        {"__bucket": F.shiftright("__h", 32 - BUCKET_BITS), "__all": F.lit(0)}
    )
    counts = hashed.groupBy(*group, "__bucket").agg(F.count(F.lit(1)).alias("__n"))
    whole = Window.partitionBy(*group)
    upto = whole.orderBy("__bucket").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = counts.withColumns({"__size": F.sum("__n").over(whole), "__cum": F.sum("__n").over(upto)})
    wanted = F.round(F.col("__size") * share)
    need = (wanted - (F.col("__cum") - F.col("__n"))).cast("long")
    cut = placed.filter((need >= 1) & (need <= F.col("__n"))).select(*group, "__bucket", need.alias("__need"))
    inside = attach(hashed, materialize(cut, "cuts"), [*group, "__bucket"], null_safe=True).filter(F.col("__need").isNotNull())
    ranked = inside.withColumn("__rank", F.row_number().over(Window.partitionBy(*group).orderBy("__h", "__k")))
    return materialize(ranked.filter("__rank = __need").select(*strata, "__h", "__k"), "last")


def stratified_split(
    df: DataFrame,
    key: str,
    label: str | None = None,
    test_share: float = 0.2,
    seed: int = 42,
    name: str = "part",
    exact: bool = True,
) -> DataFrame:
    """Mark rows 'test' or 'train'.

    ``exact`` gives each stratum ``round(share * size)`` test rows, the first by
    hash (keys must be unique): the cut of each stratum comes from :func:`hash_cuts`, and
    rows are compared with it where they lie. Otherwise the hash is compared with the share,
    which meets the sizes approximately.
    """
    if not exact:
        low = key_hash(F.col(key), seed) < F.lit(int(test_share * HASH_RANGE))
        return df.withColumn(name, F.when(low, "test").otherwise("train"))
    cuts = hash_cuts(df, key, [label] if label else [], test_share, seed)
    if label:
        marked = attach(df, cuts, [label], null_safe=True)
    else:
        last = cuts.first()
        kind = df.schema[key].dataType
        marked = df.withColumns({"__h": F.lit(last["__h"] if last else None).cast("long"), "__k": F.lit(last["__k"] if last else None).cast(kind)})
    own = F.coalesce(key_hash(F.col(key), seed), F.lit(-1))
    test = (own < F.col("__h")) | ((own == F.col("__h")) & (F.col(key) <= F.col("__k")))
    return marked.withColumn(name, F.when(test, "test").otherwise("train")).drop("__h", "__k")


def assign_folds(
    df: DataFrame, key: str, label: str | None = None, k: int = 5, seed: int = 42, name: str = "fold"
) -> DataFrame:
    """Fold number 0..k-1, spread evenly within each label."""
    ranked = hash_rank(df, key, [label] if label else [], seed)
    return ranked.withColumn(name, F.pmod(F.col("__rank") - 1, F.lit(k)).cast("int")).drop("__rank")
