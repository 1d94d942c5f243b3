"""Removal of word passages that repeat across documents, found by fixed-block anchors."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortwise.llm.arrow import pieces, runs
from cohortwise.session import materialize

# A window of this many words that also starts in a document with a smaller id is a repeat.
WINDOW = 13
# Characters of text for each group of hashes that one task handles at once, at most.
GROUP_CHARS = 12 << 20
# Bytes of text hashed at once (hashing takes some forty times that in memory).
HASH_BYTES = 1 << 20
# Bytes of text whose hashes are combined before they are dealt out.
COMBINE_BYTES = 8 << 20

_LOW32 = np.uint64(0xFFFFFFFF)
# Odd multipliers of the rolling hashes.
_BYTE_STEP = 0x9E3779B97F4A7C15
_WORD_STEP = 0xD6E8FEB86659FD93
_MASK = (1 << 64) - 1


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


def _powers(step: int, n: int) -> np.ndarray:
    out = np.full(n, step, np.uint64)
    if n:
        out[0] = 1
    return np.multiply.accumulate(out)


def _word_hashes(words: list[bytes]) -> np.ndarray:
    """Differences of running sums of byte * step ** place, brought back to place 0 by the inverse step."""
    if not words:
        return np.zeros(0, np.uint64)
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    joined = np.frombuffer(b"".join(words), np.uint8).astype(np.uint64) + np.uint64(1)
    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(joined * _powers(_BYTE_STEP, len(joined)))))
    ends = np.cumsum(sizes)
    back = _powers(pow(_BYTE_STEP, -1, 1 << 64), len(joined))[ends - sizes]
    return _mix((sums[ends] - sums[ends - sizes]) * back + sizes.astype(np.uint64))


class Words:
    """The words of some texts, all in one row, with a 64-bit hash of each."""

    def __init__(self, texts: list[bytes]):
        self.words = [t.split() for t in texts]
        self.counts = np.fromiter(map(len, self.words), np.int64, len(texts))
        self.firsts = np.cumsum(self.counts) - self.counts
        found, some, size = [np.zeros(0, np.uint64)], [], 0
        for words, text in zip(self.words, texts):
            some += words
            size += len(text)
            if size >= HASH_BYTES:
                found.append(_word_hashes(some))
                some, size = [], 0
        self.hashes = np.concatenate((*found, _word_hashes(some)))

    def rolling(self, n: int, salt: int = 0) -> np.ndarray:
        """Hash of the ``n`` words from each word on; only meaningful where they end in the same text."""
        out = np.zeros(max(0, len(self.hashes) - n + 1), np.uint64)
        step = (_WORD_STEP + 2 * salt) & _MASK
        for i in range(n):
            out += self.hashes[i : i + len(out)] * np.uint64(pow(step, i + 1, 1 << 64))
        return np.append(_mix(out), np.zeros(len(self.hashes) - len(out), np.uint64))

    def starts(self, n: int) -> np.ndarray:
        """Places of all windows of ``n`` words, and below the text each belongs to."""
        fits = np.maximum(self.counts - n + 1, 0)
        owner = np.repeat(np.arange(len(fits)), fits)
        return np.stack((np.arange(len(owner)) - np.repeat(np.cumsum(fits) - fits, fits) + self.firsts[owner], owner))


# Entries of one batch for one group of hashes: the smallest id and the steps from id to id (of so many bytes each), hashes, flags.
_DEALT = "part int, first long, step int, ids binary, hashes binary, indexed binary, wide boolean, settled boolean"
_NAMES = [c.split()[0] for c in _DEALT.split(", ")]
_MARKED = "doc_id long, key long"


def _flags(keys: np.ndarray, ids: np.ndarray, indexed: np.ndarray, both: bool) -> tuple[np.ndarray, np.ndarray]:
    """Which entries have an equal indexed one in a document with a smaller id (with ``both``: also indexed ones with an equal entry in a larger one);
    and which entries must be told to others: the smallest indexed id, and the largest id, of each key."""
    order = np.argsort(keys, kind="stable")
    starts = runs(keys[order])
    sizes = np.diff(np.append(starts, len(keys)))
    if not len(starts):
        return np.zeros(0, bool), np.zeros(0, bool)
    far = np.iinfo(np.int64).max
    own, known = ids[order], indexed[order]
    least = np.repeat(np.minimum.reduceat(np.where(known, own, far), starts), sizes)
    most = np.repeat(np.maximum.reduceat(own, starts), sizes)
    flagged = least < own
    if both:
        flagged |= known & (own < most)
    ends = (known & (own == least)) | (own == most)
    result, tell = np.empty(len(keys), bool), np.empty(len(keys), bool)
    result[order], tell[order] = flagged, ends
    return result, tell


def _deal(keys: np.ndarray, part: np.ndarray, ids: np.ndarray, indexed: np.ndarray, wide: bool, settled: bool) -> Iterator[dict]:
    """Rows of ``_DEALT``; entries of a part lie by id, so that ids travel as small steps."""
    order = np.lexsort((ids, part))
    keys, ids, indexed, part = keys[order], ids[order], indexed[order], part[order]
    starts = runs(part)
    for a, b in zip(starts.tolist(), [*starts[1:].tolist(), len(part)]):
        steps = np.diff(ids[a:b])
        size = next(n for n in (1, 2, 4, 8) if n == 8 or not len(steps) or int(steps.max()) < 1 << 8 * n)
        hashes = keys[a:b] if wide else (keys[a:b] & _LOW32).astype(np.uint32)
        yield {
            "part": int(part[a]),
            "first": int(ids[a]),
            "step": size,
            "ids": steps.astype(f"u{size}").tobytes(),
            "hashes": hashes.tobytes(),
            "indexed": np.packbits(indexed[a:b]).tobytes(),
            "wide": wide,
            "settled": settled,
        }


def _ids(row: dict) -> np.ndarray:
    steps = np.frombuffer(row["ids"], f"u{row['step']}").astype(np.int64)
    return np.concatenate((np.array([row["first"]]), steps)).cumsum()


def _parts(keys: np.ndarray, parts: int) -> np.ndarray:
    return ((keys >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)).astype(np.int32)


Entries = Callable[[Words, list], tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]


def _combine(texts: DataFrame, entries: Entries, parts: int, wide: bool, both: bool) -> DataFrame:
    """(doc_id, key) of entries with an equal indexed entry in a document with a smaller id.

    Hashes of ``COMBINE_BYTES`` of text are compared where they arise. What that
    settles goes on as it is; of equal ones only those still open, the smallest
    indexed one and the largest one are sent. So a passage in a third of all
    documents sends a few entries per batch instead of one per document. Hashes
    are dealt by their leading bits over ``parts`` groups of bounded size and
    travel packed, four (or, ``wide``, eight) bytes each.
    """

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        turn = 0
        for batch, raw in pieces(batches, limit=COMBINE_BYTES):
            keys, deal, ids, indexed = entries(Words(raw), batch)
            if not len(keys):
                continue
            part = _parts(deal, parts)
            mark = keys if wide else (part.astype(np.uint64) << np.uint64(32)) | (keys & _LOW32)
            flagged, tell = _flags(mark, ids, indexed, both)
            rows = list(_deal(keys[~flagged | tell], part[~flagged | tell], ids[~flagged | tell], indexed[~flagged | tell], wide, False))
            if flagged.any():
                turn += 1
                here = np.full(int(flagged.sum()), (int(ids[0]) * 7919 + turn) % parts, np.int32)
                rows += list(_deal(mark[flagged], here, ids[flagged], indexed[flagged], True, True))
            yield pa.RecordBatch.from_pylist(rows, _arrow_schema())

    def meet(table: pa.Table) -> pa.Table:
        found_ids, found_keys = [], []
        keys, ids, indexed = [], [], []
        for r in table.to_pylist():
            own = _ids(r)
            if r["settled"]:
                found_ids.append(own)
                found_keys.append(np.frombuffer(r["hashes"], np.uint64))
                continue
            low = np.frombuffer(r["hashes"], np.uint64 if wide else np.uint32).astype(np.uint64)
            keys.append(low if wide else (np.uint64(r["part"]) << np.uint64(32)) | low)
            ids.append(own)
            indexed.append(np.unpackbits(np.frombuffer(r["indexed"], np.uint8), count=len(own)).astype(bool))
        if keys:
            every, owners = np.concatenate(keys), np.concatenate(ids)
            flagged, _ = _flags(every, owners, np.concatenate(indexed), both)
            found_ids.append(owners[flagged])
            found_keys.append(every[flagged])
        owner = np.concatenate([*found_ids, np.zeros(0, np.int64)])
        mark = np.concatenate([*found_keys, np.zeros(0, np.uint64)])
        order = np.lexsort((mark, owner))
        owner, mark = owner[order], mark[order]
        new = np.append(True, (owner[1:] != owner[:-1]) | (mark[1:] != mark[:-1]))[: len(owner)]
        return pa.table({"doc_id": owner[new], "key": mark[new].view(np.int64)})

    dealt = texts.mapInArrow(send, _DEALT)
    return _written(dealt.groupBy("part").applyInArrow(meet, _MARKED))


# Lets Spark delete a query's shuffle files when it ends instead of when its plan is collected as garbage.
_TIDY = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def _written(df: DataFrame) -> DataFrame:
    """``df`` written to the shared folder; the packed hashes it was made from need not stay on disk."""
    conf = df.sparkSession.conf
    before = conf.get(_TIDY, "false")
    conf.set(_TIDY, "true")
    try:
        return materialize(df, "marked")
    finally:
        conf.set(_TIDY, before)


def _arrow_schema() -> pa.Schema:
    kinds = [pa.int32(), pa.int64(), pa.int32(), pa.binary(), pa.binary(), pa.binary(), pa.bool_(), pa.bool_()]
    return pa.schema(list(zip(_NAMES, kinds)))


def _grouped(marked: DataFrame) -> DataFrame:
    """One row per document; its keys are bounded by its own windows."""
    return marked.groupBy("doc_id").agg(F.collect_list("key").alias("keys")).withColumnRenamed("doc_id", "marked_id")


def _known(batch: pa.RecordBatch, column: int) -> list[np.ndarray]:
    lists = batch.column(column)
    values, ends = lists.values.to_numpy(zero_copy_only=False).view(np.uint64), lists.offsets.to_numpy()
    return [values[a:b] for a, b in zip(ends[:-1].tolist(), ends[1:].tolist())]


def _found(values: np.ndarray, place: np.ndarray, owner: np.ndarray, known: list[np.ndarray]) -> np.ndarray:
    """Is each window's value among the known ones of its own text?"""
    out = np.zeros(len(values), bool)
    edges = np.searchsorted(owner, np.arange(len(known) + 1))
    for k, some in enumerate(known):
        if len(some):
            out[edges[k] : edges[k + 1]] = np.isin(values[edges[k] : edges[k + 1]], some)
    return out


def _covered(flags: np.ndarray, places: np.ndarray, n: int, total: int) -> np.ndarray:
    """Places covered by a flagged window of ``n``."""
    change = np.zeros(total + n + 1, np.int64)
    np.add.at(change, places[flags], 1)
    np.add.at(change, places[flags] + n, -1)
    return np.cumsum(change)[:total] > 0


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW) -> DataFrame:
    """Remove the words covered by windows that also start in a document with a smaller id.

    Columns: doc_id, n_words, n_removed, kept_sha256, kept_text (words joined by
    one space). Words are runs of bytes other than ASCII white space, unchanged.

    Anchors: every document is cut into blocks of ``(window + 1) // 2`` words;
    whatever is as long as a window holds a whole block of its first document.
    All blocks are indexed by hash and probed with every rolling run of that
    many words of all documents. Around the hits, runs are extended to windows,
    and only windows that hold a hit are compared with each other, by a hash of
    all their words (64 bits, and further bits that pick the group). What
    adjoining windows cover together are the maximal repeats. Windows are judged
    on the input. Ids must be integers; rows with a null id neither lose words
    nor cause a loss, rows of the same id don't repeat each other, and null
    text has no words. Every row gets a row; other columns are not read.
    """
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    named = texts.filter(F.col("doc_id").isNotNull())
    chars = named.agg(F.sum(F.length("text"))).first()[0] or 0
    parts = max(3 * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-chars // GROUP_CHARS))
    block = (window + 1) // 2

    def anchors(words: Words, batch) -> tuple:
        place, owner = words.starts(block)
        long = words.counts[owner] >= window
        place, owner = place[long], owner[long]
        keys = words.rolling(block)[place]
        return keys, keys, batch.column(0).to_numpy()[owner], (place - words.firsts[owner]) % block == 0

    hits = _grouped(_combine(named, anchors, parts, wide=False, both=True))

    def key32(keys: np.ndarray) -> np.ndarray:
        return (_parts(keys, parts).astype(np.uint64) << np.uint64(32)) | (keys & _LOW32)

    def candidates(words: Words, batch) -> tuple:
        place, owner = words.starts(block)
        hit = np.zeros(len(words.hashes) + 1, np.int64)
        hit[place[_found(key32(words.rolling(block)[place]), place, owner, _known(batch, 2))]] = 1
        before = np.concatenate(([0], np.cumsum(hit)))
        place, owner = words.starts(window)
        near = before[place + window - block + 1] > before[place]
        place, owner = place[near], owner[near]
        return words.rolling(window)[place], words.rolling(window, salt=1)[place], batch.column(0).to_numpy()[owner], np.ones(len(place), bool)

    some = named.join(hits, F.col("doc_id") == F.col("marked_id")).select("doc_id", "text", "keys")
    repeats = _grouped(_combine(some, candidates, parts, wide=True, both=False))

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, raw in pieces(batches):
            words = Words(raw)
            place, owner = words.starts(window)
            flags = _found(words.rolling(window)[place], place, owner, _known(batch, 2))
            gone = _covered(flags, place, window, len(words.hashes))
            kept = []
            for parts_, first, n in zip(words.words, words.firsts.tolist(), words.counts.tolist()):
                drop = gone[first : first + n]
                kept.append(b" ".join([w for w, d in zip(parts_, drop.tolist()) if not d] if drop.any() else parts_))
            removed = np.add.reduceat(np.append(gone, False), words.firsts) * (words.counts > 0) if len(raw) else []
            digests = [hashlib.sha256(k).hexdigest() for k in kept]
            arrays = [batch.column(0), pa.array(words.counts), pa.array(np.asarray(removed, np.int64)), pa.array(digests), pa.array([k.decode() for k in kept], pa.string())]
            yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "n_words", "n_removed", "kept_sha256", "kept_text"])

    marked = texts.join(repeats, F.col("doc_id") == F.col("marked_id"), "left").select("doc_id", "text", "keys")
    return marked.mapInArrow(finish, "doc_id long, n_words long, n_removed long, kept_sha256 string, kept_text string")
