"""Exact duplicates by sorting content (DataFrame functions only)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortwise.session import materialize

# Bytes of content that the splitters of the range partitioning hold; ties go on by hash.
SPLITTER_BYTES = 16
# A text with more than this share of the rows is dealt over CHUNKS sorted groups; fewer than 1 / HOT_SHARE texts can be hot.
HOT_SHARE = 1 / 1000
HOT_FLOOR = 64
CHUNKS = 512


def mark_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "smallest", normalise=None) -> DataFrame:
    """Decide for every row whether it stays among the rows of equal text.

    Returns ``row`` (a struct of all input columns), ``keep_id``, ``group_size``,
    ``kept`` and ``text_sha256``. Content bytes are range-partitioned by sampled
    splitters and sorted, which puts equal texts next to each other; windows
    over the full bytes then compare neighbours and number the copies. Splitters
    hold a short prefix and a hash of the bytes, both functions of the content,
    so equal texts never part. A text with very many copies is sorted in
    ``CHUNKS`` pieces; its size and the identifier to keep come from one
    map-side combined count, checked to be of one text only.

    ``normalise`` maps the text column before comparison (default: no change).
    Null text counts as empty. Among rows of equal text the ``keep``
    ("smallest" or "largest") identifier stays; null identifiers come last, and
    of rows with the same identifier exactly one stays. Empty tables give empty
    results. Column names of ``docs`` cannot clash, they stay inside ``row``.
    """


    def content(text: Column) -> Column:
        text = F.coalesce(text, F.lit(""))
        return (normalise(text) if normalise else text).cast("binary")

    rows = docs.select(F.struct("*").alias("row"), F.col(id_col).alias("id"), content(F.col(text_col)).alias("content"))
    rows = rows.withColumns({"mark": F.xxhash64("content"), "head": F.substring("content", 1, SPLITTER_BYTES)})
    best = F.max if keep == "largest" else F.min
    hot = _hot_texts(rows, best)
    rows = rows.join(F.broadcast(hot), "mark", "left")
    rows = rows.withColumn("chunk", F.when(F.col("hot_size").isNotNull(), F.pmod(F.xxhash64("id"), F.lit(CHUNKS))).otherwise(F.lit(0)))
    splitter: list[str | Column] = [F.col("head"), F.col("mark"), F.col("chunk")]
    # The shuffled row holds its text once; the bytes to compare are taken from it afterwards.
    ranged = rows.drop("content").repartitionByRange(*splitter).withColumn("content", content(F.col("row")[text_col]))
    group = Window.partitionBy("head", "mark", "chunk", "content")
    order = F.col("id").desc_nulls_last() if keep == "largest" else F.col("id").asc_nulls_last()
    whole = group.orderBy(order).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    marked = ranged.withColumns(
        {
            "place": F.row_number().over(group.orderBy(order)),
            "first_id": F.first("id").over(whole),
            "copies": F.count(F.lit(1)).over(whole),
        }
    )
    is_hot = F.col("hot_size").isNotNull()
    keep_id = F.when(is_hot, F.col("hot_id")).otherwise(F.col("first_id"))
    return marked.select(
        "row",
        keep_id.alias("keep_id"),
        F.when(is_hot, F.col("hot_size")).otherwise(F.col("copies")).alias("group_size"),
        ((F.col("place") == 1) & F.col("id").eqNullSafe(keep_id)).alias("kept"),
        F.sha2("content", 256).alias("text_sha256"),
    )


def _hot_texts(rows: DataFrame, best) -> DataFrame:
    """Hash, copies and kept identifier of the texts with very many copies, as a written table of fewer than 1 / HOT_SHARE rows.

    A hash that stands for two different texts is left out; its rows are sorted like all others.
    """
    total = rows.select("id").count()
    many = rows.groupBy("mark").count().filter(F.col("count") > max(HOT_FLOOR, total * HOT_SHARE)).select("mark")
    copies = rows.join(F.broadcast(materialize(many, "hot")), "mark", "left_semi")
    sizes = copies.groupBy("mark", "content").agg(F.count(F.lit(1)).alias("hot_size"), best("id").alias("hot_id"))
    one_text = sizes.groupBy("mark").agg(F.count(F.lit(1)).alias("texts"), F.first("hot_size").alias("hot_size"), F.first("hot_id").alias("hot_id"))
    return materialize(one_text.filter("texts = 1").drop("texts"), "hot")


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "smallest", normalise=None) -> DataFrame:
    """``docs`` with one row of each text, all columns as given."""
    return mark_copies(docs, id_col, text_col, keep, normalise).filter("kept").select("row.*")
