"""Resampling of documents by importance weights towards a target text distribution."""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortwise.llm.arrow import pieces
from cohortwise.session import materialize, small_table

BUCKETS = 10_000
NGRAMS = 2
MIN_WORDS = 20
SHARE = (25, 100)
SEED = 7

# Lower case for A-Z; every byte that is no digit, no letter and below 128 separates words.
_FOLD = bytes(32 if b < 0x30 or 0x3A <= b <= 0x40 or 0x5B <= b <= 0x60 or 0x7B <= b <= 0x7F else b + 32 if 0x41 <= b <= 0x5A else b for b in range(256))
_SPACES = regex.compile(rb" +")


def collapse(text: bytes) -> bytes:
    """Words in lower case with single spaces between them, none at the ends."""
    return _SPACES.sub(b" ", text.translate(_FOLD)).strip(b" ")


def gram_pattern(n: int) -> regex.Pattern:
    """Runs of ``n`` words of a collapsed text, from word border to word border."""
    return regex.compile(rb"(?<![^ ])[^ ]++(?: [^ ]++){%d}(?![^ ])" % (n - 1))


def features(text: bytes, patterns: list[regex.Pattern], buckets: int) -> tuple[int, np.ndarray]:
    """Number of words, and the bucket of every run of words, runs of one word first."""
    flat = collapse(text)
    found = [np.fromiter((zlib.crc32(m[0]) for m in p.finditer(flat, overlapped=True)), np.uint32) for p in patterns]
    return flat.count(b" ") + 1 if flat else 0, np.concatenate(found) % np.uint32(buckets)


def _bucket_type(buckets: int) -> str:
    return "<u2" if buckets <= 1 << 16 else "<u4"


def scan(table: DataFrame, id_col: str, text_col: str, buckets: int = BUCKETS, ngrams: int = NGRAMS) -> DataFrame:
    """(id, n_words, n_features, buckets) for every row; ``buckets`` is a packed array with one number for each feature."""
    kind = table.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        patterns = [gram_pattern(n) for n in range(1, ngrams + 1)]
        for batch, texts in pieces(batches):
            found = [features(t, patterns, buckets) for t in texts]
            columns = [pa.array([w for w, _ in found], pa.int64()), pa.array([len(b) for _, b in found], pa.int64()), pa.array([b.astype(_bucket_type(buckets)).tobytes() for _, b in found], pa.binary())]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], ["id", "n_words", "n_features", "buckets"])

    rows = table.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, f"id {kind}, n_words bigint, n_features bigint, buckets binary")


def bucket_counts(scanned: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """How many features lie in each bucket. Every task adds up its own, so at most ``buckets`` numbers leave a task and reach the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for packed in batch.column(0).to_pylist():
                total += np.bincount(np.frombuffer(packed, _bucket_type(buckets)), minlength=buckets)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(total[at])], ["bucket", "n"])

    sums = scanned.select("buckets").mapInArrow(run, "bucket int, n bigint").groupBy("bucket").agg(F.sum("n").alias("n"))
    out = np.zeros(buckets, np.int64)
    for r in sums.collect():
        out[r["bucket"]] = r["n"]
    return out


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """A thousand times the log ratio of the target's share of a bucket to the corpus' share, each with one more in every bucket, rounded down."""
    n = len(corpus)
    all_s, all_t = float(int(corpus.sum()) + n), float(int(target.sum()) + n)
    return np.array([math.floor(1000 * math.log(float(t + 1) * all_s / (float(s + 1) * all_t))) for s, t in zip(corpus.tolist(), target.tolist())], np.int64)


def noise(id_col: str, seed: int = SEED) -> Column:
    """Gumbel noise, a thousandfold and rounded down, from a hash of the seed and the id (null: empty)."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit(""))), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint")
    return F.floor(-1000 * F.log(-F.log((h + F.lit(0.5)) / F.lit(4294967296.0))))


def ranked(rows: DataFrame, order: list[Column]) -> DataFrame:
    """``rows`` (a written table) with ``place``, 1, 2, 3... along ``order`` over the whole table.

    Rows are range-partitioned and sorted; the sizes of the partitions, one number each, say how far each is shifted.
    """
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    laid = rows.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    laid = materialize(laid.withColumn("at", F.monotonically_increasing_id()), "ranked")
    part = F.shiftright("at", 33)
    sizes = sorted((r["part"], r["n"]) for r in laid.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("n")).collect())
    shifts, before = [], 0
    for number, n in sizes:
        shifts.append((number, before + 1))
        before += n
    table = small_table(rows.sparkSession, shifts, "part bigint, shift bigint")
    placed = laid.withColumn("part", part).join(F.broadcast(table), "part")
    return placed.withColumn("place", F.col("at").bitwiseAND(F.lit((1 << 33) - 1)) + F.col("shift")).drop("part", "at", "shift")


def resample(
    docs: DataFrame,
    target: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    target_id: str = "item_id",
    target_text: str = "text",
    share: tuple[int, int] = SHARE,
    min_words: int = MIN_WORDS,
    buckets: int = BUCKETS,
    ngrams: int = NGRAMS,
    seed: int = SEED,
) -> DataFrame:
    """(id, n_words, n_features, weight, score, rank) for every row of ``docs``.

    Each text's separators collapse to single spaces and overlapped scans emit
    the spans of all runs of 1 to ``ngrams`` words, which are counted by the CRC of
    their bytes. Documents are scanned once; their bucket numbers are written, and
    counted and weighed from there. ``weight`` is the floored mean of the buckets' gains towards
    ``target`` over the document's features, ``score`` adds Gumbel noise of the id, and
    the ``share`` (numerator, denominator) of the documents with ``min_words`` that score highest are drawn
    without replacement: ``rank`` 1, 2, 3... (ties: smaller id, null ids last), null for the others.

    Null text has no words; without features the weight is 0. Null ids have the noise of an empty
    id. Repeated rows count and rank one by one. Empty tables give no rows, an empty target only smoothing.
    """
    spark = docs.sparkSession
    scanned = materialize(scan(docs, id_col, text_col, buckets, ngrams), "features")
    gain = gains(bucket_counts(scanned, buckets), bucket_counts(scan(target, target_id, target_text, buckets, ngrams), buckets))
    shared = spark.sparkContext.broadcast(gain)
    kind = docs.schema[id_col].dataType.simpleString()

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = shared.value
        for batch in batches:
            weights = []
            for packed in batch.column(3).to_pylist():
                at = np.frombuffer(packed, _bucket_type(buckets))
                weights.append(int(table[at].sum()) // len(at) if len(at) else 0)
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(weights, pa.int64())], ["id", "n_words", "n_features", "weight"])

    weighed = scanned.mapInArrow(weigh, f"id {kind}, n_words bigint, n_features bigint, weight bigint")
    scored = weighed.withColumn("score", F.col("weight") + noise("id", seed)).withColumn("no", F.monotonically_increasing_id())
    scored = materialize(scored, "scored")
    eligible = scored.filter(F.col("n_words") >= min_words)
    # Equal rows are told apart by their number, so that they need not lie in one partition.
    order = [F.desc("score"), F.asc_nulls_last("id"), F.asc("no")]
    drawn = eligible.count() * share[0] // share[1]
    placed = ranked(eligible, order).withColumn("rank", F.when(F.col("place") <= drawn, F.col("place")))
    rest = scored.filter(F.col("n_words") < min_words).withColumn("rank", F.lit(None).cast("bigint"))
    columns = ["id", "n_words", "n_features", "weight", "score", "rank"]
    return placed.select(*columns).unionByName(rest.select(*columns))
