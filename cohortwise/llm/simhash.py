"""Near duplicates by SimHash fingerprints, linked by meeting in the middle."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortwise.llm.arrow import pieces, runs
from cohortwise.llm.components import components
from cohortwise.llm.skew import left_join_hot
from cohortwise.session import materialize

SHINGLE_WORDS = 4
SEED = 42
RADIUS = 4
# Bits of the fingerprint are cut into this many blocks, see link().
BLOCKS = 3
# A bucket of more fingerprints is not compared pairwise but goes on as whole balls.
DENSE = 256
_LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))
_COUNT_AT_ONCE = 1 << 16


def fingerprint(text: bytes, words: int = SHINGLE_WORDS, seed: int = SEED) -> int:
    """SimHash of UTF-8 bytes: XXH64 of every shingle; a bit is set when more than half of them have it."""
    parts = text.translate(_LOWER).split()
    if not parts:
        return 0
    joined = memoryview(b" ".join(parts))
    ends = np.cumsum(np.fromiter(map(len, parts), np.int64, len(parts)) + 1) - 1
    n = max(1, len(parts) - words + 1)
    starts = np.concatenate(([0], ends[: n - 1] + 1))
    ends = ends[-n:]
    ones = np.zeros(64, np.int64)
    for at in range(0, n, _COUNT_AT_ONCE):
        spans = zip(starts[at : at + _COUNT_AT_ONCE].tolist(), ends[at : at + _COUNT_AT_ONCE].tolist())
        marks = np.array([xxhash.xxh64_intdigest(joined[a:b], seed) for a, b in spans], "<u8")
        ones += np.unpackbits(marks.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(ones * 2 > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = SHINGLE_WORDS) -> DataFrame:
    """(id, fp long) for every row; null text counts as empty."""
    schema = f"id {docs.schema[id_col].dataType.simpleString()}, fp long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in pieces(batches):
            marks = np.array([fingerprint(t, words) for t in texts], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(marks)], ["id", "fp"])

    return docs.select(F.col(id_col), F.col(text_col).cast("string")).mapInArrow(run, schema)


def _signed(x: int) -> int:
    return x - (1 << 64) if x >= 1 << 63 else x


def ball(radius: int, bits: list[int]) -> list[int]:
    """Masks with at most ``radius`` of ``bits`` set."""
    return [sum(1 << b for b in some) for k in range(radius + 1) for some in combinations(bits, k)]


def _variants(nodes: DataFrame, masks: list[tuple[int, int]]) -> DataFrame:
    """(key, fp) for every fingerprint and every (kept bits, flipped bits); the literal array explodes inside one code-generated stage."""
    rows = F.array(*[F.struct(F.lit(_signed(keep)).alias("keep"), F.lit(_signed(flip)).alias("flip")) for keep, flip in masks])
    out = nodes.select("fp", F.explode(rows).alias("m"))
    return out.select(F.col("fp").bitwiseAND(F.col("m.keep")).bitwiseXOR(F.col("m.flip")).alias("key"), "fp")


def link(nodes: DataFrame, radius: int = RADIUS, blocks: int = BLOCKS, dense: int = DENSE) -> DataFrame:
    """Edges (a, b) that connect the distinct fingerprints ``nodes`` (fp) within ``radius`` bits of each other, each pair directly or over others linked to both.

    Two fingerprints within the radius meet at a variant half-way between them.
    With ``blocks = 1`` each emits its whole ball of half the radius (2081
    variants for radius 4) and whatever meets is linked, no check needed.
    With more blocks, leaving out the block with the most differing bits leaves
    at most ``radius - ceil(radius / blocks)`` of them in the rest; so each
    fingerprint emits, once for every block left out, the ball of half that
    radius over the other bits (132 variants for three blocks and radius 4).
    Those that meet are compared in full. A variant shared by more than
    ``dense`` fingerprints is not compared pairwise: its members emit whole
    balls as with one block. Work follows the number of fingerprints and of
    variants, never the square of a group.
    """
    ball_of_all = [((1 << 64) - 1, m) for m in ball((radius + 1) // 2, list(range(64)))]
    if blocks <= 1:
        return _meet(_variants(nodes, ball_of_all)).distinct()
    cuts = [64 * k // blocks for k in range(blocks + 1)]
    left = radius - -(-radius // blocks)
    masks = []
    for low, high in zip(cuts, cuts[1:]):
        others = [b for b in range(64) if not low <= b < high]
        keep = sum(1 << b for b in others)
        masks += [(keep, m) for m in ball((left + 1) // 2, others)]
    dealt = _variants(nodes, masks).repartition("key").sortWithinPartitions("key", "fp")
    found = materialize(dealt.mapInArrow(lambda it: _compare(it, radius, dense), "a long, b long").distinct(), "links")
    crowded = found.filter("b IS NULL").select(F.col("a").alias("fp"))
    return found.filter("b IS NOT NULL").union(_meet(_variants(crowded, ball_of_all)).distinct())


def _meet(variants: DataFrame) -> DataFrame:
    """A star over all fingerprints that share a variant; the task remembers one of them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last_key = last_head = None
        for batch in batches:
            keys, marks = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
            if not len(keys):
                continue
            starts = runs(keys)
            heads = marks[starts]
            if keys[0] == last_key:
                heads[0] = last_head
            head = np.repeat(heads, np.diff(np.append(starts, len(keys))))
            last_key, last_head = keys[-1], head[-1]
            other = head != marks
            edges = np.unique(np.stack((head[other], marks[other]), 1), axis=0)
            yield pa.RecordBatch.from_arrays([pa.array(edges[:, 0]), pa.array(edges[:, 1])], ["a", "b"])

    return variants.repartition("key").sortWithinPartitions("key").mapInArrow(run, "a long, b long")


def _compare(batches: Iterator[pa.RecordBatch], radius: int, dense: int) -> Iterator[pa.RecordBatch]:
    """Edges between fingerprints of one key within the radius, from rows sorted by key; (fp, null) for members of crowded keys.

    A key that goes on in the next batch is carried over, up to ``dense`` rows.
    """
    keys, marks = np.zeros(0, np.int64), np.zeros(0, np.int64)
    crowded = None
    for batch in batches:
        keys = np.concatenate((keys, batch.column(0).to_numpy(zero_copy_only=False)))
        marks = np.concatenate((marks, batch.column(1).to_numpy(zero_copy_only=False)))
        starts = runs(keys)
        if not len(starts):
            continue
        more = len(keys) - starts[-1]
        full = starts[-1] if more <= dense and keys[-1] != crowded else len(keys)
        yield _edges(keys[:full], marks[:full], crowded, radius, dense)
        if full == len(keys):
            crowded = keys[-1]
        keys, marks = keys[full:], marks[full:]
    yield _edges(keys, marks, crowded, radius, dense)


def _edges(keys: np.ndarray, marks: np.ndarray, crowded, radius: int, dense: int) -> pa.RecordBatch:
    starts = runs(keys)
    sizes = np.diff(np.append(starts, len(keys)))
    too_many = sizes > dense
    if crowded is not None and len(keys):
        too_many |= keys[starts] == crowded
    ones, others = [], []
    for n in np.unique(sizes[~too_many & (sizes > 1)]).tolist():
        at = starts[~too_many & (sizes == n)]
        step = max(1, (1 << 20) // (n * n))
        for k in range(0, len(at), step):
            group = marks[at[k : k + step, None] + np.arange(n)]
            bits = group.view(np.uint64)
            near = np.bitwise_count(bits[:, :, None] ^ bits[:, None, :]) <= radius
            label = np.broadcast_to(np.arange(n), group.shape)
            while True:  # spread the smallest place among all that are near
                new = np.where(near, label[:, None, :], n).min(2)
                if (new == label).all():
                    break
                label = new
            root = np.take_along_axis(group, label, 1)
            apart = root != group
            ones.append(root[apart])
            others.append(group[apart])
    heads = np.concatenate([*ones, np.zeros(0, np.int64)]) if ones else np.zeros(0, np.int64)
    tails = np.concatenate(others) if others else np.zeros(0, np.int64)
    lone = np.unique(marks[np.repeat(too_many, sizes)])
    a = pa.array(np.concatenate((heads, lone)).astype(np.int64))
    b = pa.array(np.concatenate((tails, lone)).astype(np.int64), mask=np.arange(len(a)) >= len(heads))
    return pa.RecordBatch.from_arrays([a, b], ["a", "b"])


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", radius: int = RADIUS, words: int = SHINGLE_WORDS, blocks: int = BLOCKS) -> DataFrame:
    """(id, fp, component_id) for every row; component_id is the smallest identifier reachable over links.

    Rows of equal fingerprint are one node. Null text counts as empty and has
    fingerprint zero. Null identifiers take part but never name a component
    unless all its rows have none. Repeated rows each get a row. Only ``id_col``
    and ``text_col`` are read, so other columns cannot clash.
    """
    marks = materialize(fingerprints(docs, id_col, text_col, words), "fingerprints")
    nodes = materialize(marks.groupBy("fp").agg(F.min("id").alias("first_id")), "nodes")
    roots = materialize(components(link(nodes.select("fp"), radius, blocks)).withColumnRenamed("node", "fp"), "roots")
    owned = nodes.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    firsts = owned.groupBy("root").agg(F.min("first_id").alias("component_id"))
    named = materialize(left_join_hot(materialize(owned.select("fp", "root"), "owned"), firsts, "root").select("fp", "component_id"), "named")
    return left_join_hot(marks, named, "fp").select("id", "fp", "component_id")


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``docs`` with one row of each component, all columns as given: the row whose identifier names it.

    Rows with a null identifier stay, for nothing tells them apart; of repeated
    rows of the naming identifier one stays.
    """
    found = near_duplicates(docs, id_col, text_col, **options)
    first = found.filter(F.col("id") == F.col("component_id")).select(F.col("id").alias(id_col)).distinct()
    rows = docs.join(first, id_col, "left_semi")
    twice = found.filter("id IS NOT NULL").groupBy("id").count().filter("count > 1")
    repeated = materialize(twice.select(F.col("id").alias(id_col)), "repeated")
    if not repeated.isEmpty():
        rows = rows.join(repeated, id_col, "left_anti").unionByName(rows.join(repeated, id_col, "left_semi").dropDuplicates([id_col]))
    return rows.unionByName(docs.filter(F.col(id_col).isNull()))
