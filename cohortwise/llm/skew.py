"""Left join on a key of which one value may hold a large share of the rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortwise.session import small_table

# A key is hot above this share of all rows, so there are fewer than 1 / HOT_SHARE hot keys.
HOT_SHARE = 1 / 500
HOT_FLOOR = 1000


def hot_keys(df: DataFrame, key: str) -> list:
    """The values of ``key`` that hold more than ``HOT_SHARE`` of the rows (fewer than ``1 / HOT_SHARE``), from a map-side combined count."""
    counts = df.groupBy(key).count().filter((F.col("count") > HOT_FLOOR) & F.col(key).isNotNull())
    most = counts.orderBy(F.desc("count")).limit(int(1 / HOT_SHARE)).collect()
    bound = df.count() * HOT_SHARE if most else 0
    return [r[0] for r in most if r["count"] > bound]


def left_join_hot(df: DataFrame, table: DataFrame, key: str) -> DataFrame:
    """``df`` left join ``table`` (unique on ``key``).

    Rows of hot keys meet their few table rows by a broadcast of bounded size;
    all others, null keys among them, take a shuffled join. ``df`` and ``table``
    are read more than once, so pass written tables.
    """
    found = hot_keys(df, key)
    if not found:
        return df.join(table, key, "left")
    hot = F.broadcast(small_table(df.sparkSession, [(k,) for k in found], f"{key} {df.schema[key].dataType.simpleString()}"))
    few = F.broadcast(table.join(hot, key, "left_semi"))
    wide = df.join(hot, key, "left_semi").join(few, key, "left")
    return df.join(hot, key, "left_anti").join(table, key, "left").unionByName(wide)
