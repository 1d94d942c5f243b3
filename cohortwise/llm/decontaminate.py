"""Benchmark passages in documents, found by spaced seeds (DataFrame functions only)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortwise.session import materialize

# A passage counts from this many aligned words with at most SUBSTITUTIONS words replaced.
WINDOW = 13
SUBSTITUTIONS = 2
# Word places that a seed compares. Together these two hit every window of 13 words, wherever two of them are replaced.
MASKS = ((0, 1, 2, 3, 5, 6), (0, 1, 2, 4, 7, 8))
# Benchmarks of up to this many words are broadcast (16 MB of seeds); larger ones are joined by shuffle.
BROADCAST_WORDS = 200_000


def word_hashes(text: Column) -> Column:
    """64-bit hashes of the lower-cased runs of letters and digits."""
    return F.transform(F.array_remove(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+"), ""), lambda w: F.xxhash64(w))


def _seed(words: Column, at: Column, mask: int) -> Column:
    """Hash of the words that a mask selects from place ``at`` on; null where they don't all exist."""
    inside = (at >= 0) & (at + MASKS[mask][-1] < F.size(words))
    return F.when(inside, F.xxhash64(F.lit(mask), *[F.get(words, at + o) for o in MASKS[mask]]))


def seeds(items: DataFrame) -> DataFrame:
    """(key, mask, item_no, item_at, key_before) of every mask at every place of (item_no, item_words)."""
    at = items.filter(F.size("item_words") >= WINDOW).select("*", F.explode(F.sequence(F.lit(0), F.size("item_words") - 1)).alias("item_at"))
    each = [
        at.select(
            _seed(F.col("item_words"), F.col("item_at"), m).alias("key"),
            F.lit(m).alias("mask"),
            "item_no",
            "item_at",
            _seed(F.col("item_words"), F.col("item_at") - 1, m).alias("key_before"),
        )
        for m in range(len(MASKS))
    ]
    return each[0].unionByName(each[1]).filter("key IS NOT NULL")


def _passages(hits: DataFrame) -> DataFrame:
    """Compare words along the diagonal of each hit (doc_id, words, item_id, item_words, shift) and keep those with a close enough window."""
    low = F.greatest(-F.col("shift"), F.lit(0))
    high = F.least(F.size("item_words"), F.size("words") - F.col("shift"))
    hits = hits.withColumns({"low": low, "span": high - low}).filter(F.col("span") >= WINDOW)
    differ = F.zip_with(
        F.slice("item_words", F.col("low") + 1, F.col("span")),
        F.slice("words", F.col("low") + F.col("shift") + 1, F.col("span")),
        lambda a, b: (a != b).cast("int"),
    )
    hits = hits.withColumn("differ", differ)
    close = F.filter(
        F.sequence(F.lit(0), F.col("span") - WINDOW),
        lambda i: F.aggregate(F.slice("differ", i + 1, WINDOW), F.lit(0), lambda s, x: s + x) <= SUBSTITUTIONS,
    )
    found = hits.withColumn("close", close).filter(F.size("close") > 0)
    start, end = F.array_min("close") + F.col("low"), F.array_max("close") + F.col("low") + WINDOW
    return found.select(
        "doc_id",
        "item_id",
        (start + F.col("shift")).alias("doc_start"),
        (end + F.col("shift")).alias("doc_end"),
        start.alias("item_start"),
        end.alias("item_end"),
        F.aggregate(F.slice("differ", start - F.col("low") + 1, end - start), F.lit(0), lambda s, x: s + x).alias("substituted"),
    ).distinct()


def overlaps(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text") -> DataFrame:
    """Benchmark passages in documents: doc_id, item_id, doc_start, doc_end, item_start, item_end (in words, ends exclusive), substituted.

    A passage is a stretch of an item and of a document, word under word, made
    of windows of ``WINDOW`` words of which at most ``SUBSTITUTIONS`` differ;
    one row for every item, document and alignment. Words are lower-cased runs
    of letters and digits. Items and documents of fewer words hold none.

    Every place of every text is hashed once per mask. Seeds of documents are
    looked up in those of the benchmark, and only the first hit of a chain along
    one alignment is compared word by word. Benchmarks of up to
    ``BROADCAST_WORDS`` words go to all tasks and documents don't move; larger
    ones are joined by hash, and documents with hits are joined back.
    Null texts have no words; rows with a null id are compared like all others;
    repeated rows give the same rows, which are returned once.
    """
    own = benchmark.select(F.col(item_col).alias("item_id"), word_hashes(F.col(item_text)).alias("item_words")).distinct()
    # Numbers of their own, as identifiers may be null or stand for several texts; fixed once written.
    items = materialize(own.withColumn("item_no", F.monotonically_increasing_id()), "items")
    size = items.agg(F.sum(F.size("item_words"))).first()[0] or 0
    index = materialize(seeds(items), "seeds")
    texts = docs.select(F.col(id_col).alias("doc_id"), word_hashes(F.col(text_col)).alias("words")).filter(F.size("words") >= WINDOW)
    at = texts.select("doc_id", "words", F.explode(F.sequence(F.lit(0), F.size("words") - 1)).alias("doc_at"))
    keys = F.array(*[_seed(F.col("words"), F.col("doc_at"), m) for m in range(len(MASKS))])
    shift = (F.col("doc_at") - F.col("item_at")).alias("shift")
    if size <= BROADCAST_WORDS:
        probes = at.select("doc_id", "words", "doc_at", F.explode(keys).alias("key"))
        hits = probes.join(F.broadcast(index), "key")
        before = F.when(F.col("mask") == 0, _seed(F.col("words"), F.col("doc_at") - 1, 0)).otherwise(_seed(F.col("words"), F.col("doc_at") - 1, 1))
        heads = hits.filter(~F.coalesce(F.col("key_before") == before, F.lit(False)))
        return _passages(heads.select("doc_id", "words", "item_no", shift).join(F.broadcast(items), "item_no"))
    probes = at.select("doc_id", "doc_at", F.explode(keys).alias("key")).filter("key IS NOT NULL")
    met = probes.join(index, "key").select("doc_id", "item_no", shift).distinct()
    found = materialize(met, "hits")
    return _passages(found.join(texts.distinct(), found["doc_id"].eqNullSafe(texts["doc_id"])).drop(texts["doc_id"]).join(items, "item_no"))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_text: str = "text") -> DataFrame:
    """``docs`` without the rows whose id has a benchmark passage, all columns as given; rows with a null id are kept."""
    found = materialize(overlaps(docs, benchmark, id_col, text_col, item_text=item_text).select(F.col("doc_id").alias(id_col)).distinct(), "leaks")
    return docs.join(found, id_col, "left_anti")
