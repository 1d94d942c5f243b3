"""Packing token sequences into as few fixed-length sequences as possible."""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cohortwise.llm.arrow import pieces
from cohortwise.session import materialize, small_table

CAPACITY = 2048
END_ID = 0
# More runs than this are not broadcast (a run is 40 bytes).
BROADCAST_RUNS = 200_000


@lru_cache(maxsize=4)
def _encoder(json_path: str | None, ranks_path: str | None):
    """text -> uint32 array of ids, the same ids as ``tokenizers`` gives with ``add_special_tokens=False``.

    The rank file of the same vocabulary is several times faster. Texts that
    hold the special token's string, or that it fails on, go to ``tokenizers``.
    """
    import public_tokenizers
    from tokenizers import Tokenizer

    slow = Tokenizer.from_file(json_path or public_tokenizers.path("byte_bpe_50k.json"))
    special = [t.content for t in slow.get_added_tokens_decoder().values()]

    def plain(text: str) -> np.ndarray:
        return np.array(slow.encode(text, add_special_tokens=False).ids, np.uint32)

    if json_path and not ranks_path:
        return plain
    import base64

    import tiktoken

    with open(ranks_path or public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    fast = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})

    def encode(text: str) -> np.ndarray:
        if any(s in text for s in special):
            return plain(text)
        try:
            return fast.encode_to_numpy(text)
        except Exception:  # the pattern engine gives up on some very long runs of one kind
            return plain(text)

    return encode


def token_pieces(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    capacity: int = CAPACITY,
    json_path: str | None = None,
    ranks_path: str | None = None,
    ids: bool = False,
) -> DataFrame:
    """Token ids of every document with ``END_ID`` behind them, cut into pieces of at most ``capacity``.

    Only longer documents are cut; the first piece takes the rest, all others
    are full. Columns: id, piece, start, length, ids_crc32 and with ``ids`` the
    ids themselves. Null text counts as empty (one piece with ``END_ID``).
    """
    kind = docs.schema[id_col].dataType.simpleString()
    schema = f"id {kind}, piece int, start long, length long, ids_crc32 long" + (", ids array<int>" if ids else "")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = _encoder(json_path, ranks_path)
        for batch, texts in pieces(batches):
            rows: list[tuple] = []
            owner = []
            seen: dict[bytes, list[tuple]] = {}
            for k, text in enumerate(texts):
                cut = seen.get(text)
                if cut is None:
                    own = np.append(encode(text.decode()), np.uint32(END_ID)).astype("<u4")
                    stops = list(range(len(own), 0, -capacity))[::-1]
                    spans = list(zip([0, *stops[:-1]], stops))
                    cut = seen[text] = [(n, a, b - a, zlib.crc32(own[a:b].tobytes()), own[a:b].astype(np.int32) if ids else None) for n, (a, b) in enumerate(spans)]
                rows += cut
                owner += [k] * len(cut)
            columns = list(zip(*rows))
            arrays = [batch.column(0).take(pa.array(owner)), pa.array(columns[0], pa.int32()), *(pa.array(c, pa.int64()) for c in columns[1:4])]
            arrays += [pa.array(columns[4], pa.list_(pa.int32()))] if ids else []
            yield pa.RecordBatch.from_arrays(arrays, ["id", "piece", "start", "length", "ids_crc32", "ids"][: len(arrays)])

    return docs.select(F.col(id_col), F.col(text_col).cast("string")).mapInArrow(run, schema)


def plan_bins(histogram: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, int, int, int, int, int]]:
    """Bins for all pieces from how many there are of each length.

    Lengths over a third of the capacity: from the longest on, each is paired
    with the longest other one that still fits, so at most two share a bin.
    Shorter ones, from the longest on, go to the bin with the smallest gap that
    fits (best fit), or to a new one. Pieces of one length are alike, so whole
    runs of them are placed at a time: work and result depend on the number of
    different lengths, not on the number of pieces.

    Returns runs (length, rank, pieces, each, bin, offset): pieces of ``length``
    numbered from ``rank`` on lie ``each`` to a bin, in bins from ``bin`` on, the
    first at ``offset`` and the others behind it.
    """
    left = {n: c for n, c in histogram.items() if c}
    used = dict.fromkeys(left, 0)
    placed: list[tuple[int, int, int, int, int, int]] = []
    gaps: dict[int, list[tuple[int, int]]] = {}
    order: list[int] = []  # the gaps in use, ascending
    bins = 0

    def put(length: int, pieces_: int, each: int, at: int, offset: int) -> None:
        placed.append((length, used[length], pieces_, each, at, offset))
        used[length] += pieces_
        left[length] -= pieces_

    def open_gap(gap: int, at: int, n: int) -> None:
        if gap and n:
            if gap not in gaps:
                gaps[gap] = []
                insort(order, gap)
            gaps[gap].append((at, n))

    large = sorted(n for n in left if n * 3 > capacity)
    for a in reversed(large):
        while left[a]:
            k = bisect_left(large, capacity - a + 1) - 1
            while k >= 0 and (large[k] > a or left[large[k]] < 1 + (large[k] == a)):
                k -= 1
            b = large[k] if k >= 0 else 0
            n = left[a] if not b else left[a] // 2 if a == b else min(left[a], left[b])
            put(a, n, 1, bins, 0)
            if b:
                put(b, n, 1, bins, a)
            open_gap(capacity - a - b, bins, n)
            bins += n
    for s in sorted((n for n in left if n * 3 <= capacity), reverse=True):
        while left[s]:
            k = bisect_left(order, s)
            if k == len(order):
                fit = capacity // s
                open_gap(capacity, bins, -(-left[s] // fit))
                bins += -(-left[s] // fit)
                continue
            gap = order[k]
            at, n = gaps[gap].pop()
            if not gaps[gap]:
                del gaps[gap], order[k]
            fit = gap // s
            full = min(n, left[s] // fit)
            if full:
                put(s, full * fit, fit, at, capacity - gap)
                open_gap(gap - fit * s, at, full)
            rest = left[s] if full < n else 0
            if rest:
                put(s, rest, rest, at + full, capacity - gap)
                open_gap(gap - rest * s, at + full, 1)
            open_gap(gap, at + full + bool(rest), n - full - bool(rest))
    return placed


def pack(pieces_: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to written pieces (id, piece, length, ...).

    The driver sees one count per length (at most ``capacity``) and plans the
    bins from these. Pieces are then numbered within their length in two
    levels, counts per hashed group and numbers within it, so that a length
    with many pieces spreads over all tasks, and look their place up. Offsets
    in each sequence run gapless from 0. No pieces give no rows.
    """
    spark = pieces_.sparkSession
    histogram = {r["length"]: r["count"] for r in pieces_.groupBy("length").count().collect()}
    runs = [(n, rank, rank + count, each, at, offset) for n, rank, count, each, at, offset in plan_bins(histogram, capacity)]
    table = small_table(spark, runs, "length long, rank_from long, rank_to long, each long, bin long, offset_from long")
    groups = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = pieces_.withColumn("deal", F.pmod(F.xxhash64("id", "piece"), F.lit(groups)))
    sizes = dealt.groupBy("length", "deal").count()
    before = Window.partitionBy("length").orderBy("deal").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("length", "deal", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("rank_before"))
    within = Window.partitionBy("length", "deal").orderBy("id", "piece")
    ranked = dealt.withColumn("place", F.row_number().over(within) - 1).join(offsets, ["length", "deal"])
    ranked = ranked.withColumn("rank", F.col("place") + F.col("rank_before")).drop("place", "rank_before", "deal")
    table = F.broadcast(table) if len(runs) <= BROADCAST_RUNS else table
    hit = (ranked["length"] == table["length"]) & (F.col("rank") >= F.col("rank_from")) & (F.col("rank") < F.col("rank_to"))
    nth = F.col("rank") - F.col("rank_from")
    return ranked.join(table, hit).select(
        *[ranked[c] for c in pieces_.columns],
        (F.col("bin") + F.floor(nth / F.col("each"))).alias("sequence_id"),
        (F.col("offset_from") + F.pmod(nth, F.col("each")) * ranked["length"]).alias("offset"),
    )


def pack_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY, **tokenizer) -> DataFrame:
    """Cut, tokenise and pack ``docs``: id, piece, start, length, ids_crc32, sequence_id, offset (and ids, if asked for).

    Rows count one by one: repeated rows and repeated or null identifiers are
    packed like all others. Other columns are not read.
    """
    return pack(materialize(token_pieces(docs, id_col, text_col, capacity, **tokenizer), "pieces"), capacity)


def sequences(packed: DataFrame) -> DataFrame:
    """(sequence_id, ids) from pieces packed with their ids; a sequence holds at most the capacity."""
    inside = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    return packed.groupBy("sequence_id").agg(F.flatten(F.transform(inside, lambda p: p["ids"])).alias("ids"))
