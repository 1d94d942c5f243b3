"""The trie of conversation prefixes and what sharing them saves."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortwise.llm.contraction import subtree_totals
from cohortwise.llm.skew import left_join_hot
from cohortwise.operators.prefix import running_totals
from cohortwise.session import materialize

# Turns of one conversation that are summed by one task at a time.
SLICE = 1024
# Bytes of joined ids in one row on the way to a digest.
SLAB = 1 << 20
PARTS = ("p0", "p1", "p2", "p3")
NOTHING = hashlib.sha256(b"").hexdigest()


def turns_of(conversations: DataFrame, id_col: str, turn_col: str, role_col: str, text_col: str) -> DataFrame:
    """(conv_id, pos, h0, h1, size): each turn's place from 1, two hashes of role and text, and the text's bytes.

    Turns are in the order of their number (null first), equal numbers in the
    order of role and text. Places are running counts in two levels, so one conversation may be of any length.
    """
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (role_col, text_col))
    rows = conversations.filter(F.col(id_col).isNotNull()).select(
        F.col(id_col).cast("long").alias("conv_id"), F.col(turn_col).alias("turn"), role.alias("role"), text.alias("text")
    )
    order = [F.asc_nulls_first("turn"), F.col("role"), F.col("text")]
    placed = running_totals(rows, ["conv_id"], order, {"pos": F.lit(1)})
    return placed.select(
        "conv_id", "pos", F.xxhash64("role", "text").alias("h0"), F.xxhash64(F.lit("second"), "text", "role").alias("h1"), F.octet_length("text").cast("long").alias("size")
    )


def rebuilt(turns: DataFrame, group: int = 5, longest: int = 9) -> tuple[DataFrame, DataFrame]:
    """Conversations that begin with turns of another one: (heads, rows).

    ``heads`` has (conv_id, base, head, shared, length) for every conversation:
    its first ``head`` turns are replaced by those of ``base``, of which there
    are ``shared``. ``rows`` is ``turns`` with the new places.
    """
    lengths = turns.groupBy("conv_id").agg(F.max("pos").alias("own"))
    base = F.col("conv_id") - F.pmod(F.col("conv_id"), F.lit(group))
    heads = lengths.withColumns({"base": base, "head": F.crc32(F.col("conv_id").cast("string").cast("binary")) % longest})
    known = lengths.select(F.col("conv_id").alias("base"), F.col("own").alias("base_length"))
    shared = F.least("head", F.coalesce("base_length", F.lit(0)))
    heads = heads.join(known, "base", "left").withColumn("shared", shared)
    heads = heads.select("conv_id", "base", "head", "shared", (F.col("shared") + F.greatest(F.col("own") - F.col("head"), F.lit(0))).alias("length"))
    heads = materialize(heads, "heads")
    # At most ``group`` conversations share a base, and at most ``longest`` of its turns are taken.
    first = turns.filter(F.col("pos") < longest).withColumnRenamed("conv_id", "base")
    taken = heads.filter("shared > 0").join(first, "base").filter("pos <= shared")
    rest = left_join_hot(turns, heads, "conv_id").filter("pos > head").withColumn("pos", F.col("pos") - F.col("head") + F.col("shared"))
    columns = ["conv_id", "pos", "h0", "h1", "size", "length"]
    return heads, materialize(taken.select(*columns).unionByName(rest.select(*columns)), "rebuilt")


def _salted() -> dict[str, Column]:
    """A turn at its place as four numbers of 32 bits."""
    low = F.lit((1 << 32) - 1)
    one, two = F.xxhash64("pos", "h0", "h1"), F.xxhash64("h1", "pos", "h0")
    return {"p0": one.bitwiseAND(low), "p1": F.shiftrightunsigned(one, 32), "p2": two.bitwiseAND(low), "p3": F.shiftrightunsigned(two, 32)}


def prefixes(rows: DataFrame) -> DataFrame:
    """``rows`` with ``prefix``, which names the turns up to this one, and ``before``, up to the one before.

    A prefix is the sums of its turns' salted hashes (128 bits and carries), so it comes from running totals
    in two levels and not from a fold over the conversation.
    """
    own = _salted()
    summed = running_totals(rows, ["conv_id"], [F.col("pos")], own, F.floor((F.col("pos") - 1) / SLICE))
    name = F.concat_ws(".", "pos", *PARTS)
    before = F.concat_ws(".", F.col("pos") - 1, *[F.col(p) - own[p] for p in PARTS])
    return summed.withColumns({"prefix": name, "before": F.when(F.col("pos") > 1, before)})


def ends_digest(ends: DataFrame) -> DataFrame:
    """(prefix, ends_sha256) of (prefix, conv_id): the digest of each prefix's ids in ascending order.

    Ids are range-partitioned and joined to slabs of text first, so that a prefix with a large share of
    all ids reaches its digest in few rows, which are hashed as they come in and never held together.
    """
    parts = int(ends.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    laid = ends.repartitionByRange(parts, "prefix", "conv_id").sortWithinPartitions("prefix", "conv_id")

    def slabs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, first, held, size = None, 0, [], 0

        def flush() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([now]), pa.array([first], pa.int64()), pa.array([",".join(held)])], ["prefix", "first", "ids"])

        for batch in batches:
            for prefix, conv in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if held and (prefix != now or size > SLAB):
                    yield flush()
                    held, size = [], 0
                if not held:
                    now, first = prefix, conv
                held.append(str(conv))
                size += len(held[-1])
        if held:
            yield flush()

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, state = None, None
        for batch in batches:
            done = []
            for prefix, ids in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist()):
                if prefix != now:
                    if state is not None:
                        done.append((now, state.hexdigest()))
                    now, state = prefix, hashlib.sha256(ids.encode())
                else:
                    state.update(b"," + ids.encode())
            yield pa.RecordBatch.from_pylist([{"prefix": p, "ends_sha256": d} for p, d in done], pa.schema([("prefix", pa.string()), ("ends_sha256", pa.string())]))
        if state is not None:
            yield pa.RecordBatch.from_arrays([pa.array([now]), pa.array([state.hexdigest()])], ["prefix", "ends_sha256"])

    cut = laid.mapInArrow(slabs, "prefix string, first bigint, ids string")
    return cut.repartition(parts, "prefix").sortWithinPartitions("prefix", "first").mapInArrow(digest, "prefix string, ends_sha256 string")


def prefix_trie(
    conversations: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text", group: int = 5, longest: int = 9
) -> DataFrame:
    """One row per node of the trie of all rebuilt conversations: every distinct sequence of first turns, the empty one too.

    Columns: conv_id (its smallest member), depth, parent_conv_id (null for the root), n_convs, n_children,
    n_leaves and saved_tokens over its subtree, ends_sha256. Sums over subtrees
    come from parallel tree contraction (``contraction.subtree_totals``). A
    conversation's first turns come from the one at the start of its ``group``
    (see :func:`rebuilt`). Null roles and texts are empty; rows with equal turn
    numbers are ordered by role and text, and repeated rows are turns of their own; rows
    without a conversation id belong to none and are left out. No conversations, no nodes.
    """
    turns = materialize(turns_of(conversations, id_col, turn_col, role_col, text_col), "turns")
    heads, rows = rebuilt(turns, group, longest)
    members = materialize(prefixes(rows).select("conv_id", "pos", "size", "length", "prefix", "before"), "members")
    nodes = members.groupBy("prefix").agg(
        F.min("conv_id").alias("conv_id"), F.max("pos").alias("depth"), F.count(F.lit(1)).alias("n_convs"), F.max("size").alias("size"), F.max("before").alias("before")
    )
    top = heads.agg(F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs")).filter("n_convs > 0")
    root = top.select(F.lit("root").alias("prefix"), "conv_id", F.lit(0).cast("long").alias("depth"), "n_convs", F.lit(0).cast("long").alias("size"), F.lit(None).cast("string").alias("before"))
    nodes = nodes.withColumn("before", F.coalesce("before", F.lit("root"))).unionByName(root)
    nodes = materialize(nodes.withColumn("node", F.monotonically_increasing_id()), "nodes")
    parents = nodes.select(F.col("prefix").alias("before"), F.col("node").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    linked = materialize(left_join_hot(nodes, parents, "before"), "linked")

    children = linked.filter("parent IS NOT NULL").groupBy(F.col("parent").alias("node")).agg(F.count(F.lit(1)).alias("n_children"))
    linked = linked.join(children, "node", "left").withColumn("n_children", F.coalesce("n_children", F.lit(0)))
    own = linked.withColumns({"n_leaves": (F.col("n_children") == 0).cast("long"), "saved_tokens": (F.col("n_convs") - 1) * F.col("size")})
    totals = subtree_totals(own.select("node", "parent", "n_leaves", "saved_tokens"), ["n_leaves", "saved_tokens"])

    ends = members.filter("pos = length").select("prefix", "conv_id").unionByName(heads.filter("length = 0").select(F.lit("root").alias("prefix"), "conv_id"))
    digests = ends_digest(materialize(ends, "ends"))
    out = linked.join(totals, "node").join(digests, "prefix", "left")
    return out.select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", F.coalesce("ends_sha256", F.lit(NOTHING)).alias("ends_sha256")
    )
