"""Sums over all subtrees of a forest by parallel tree contraction, in Spark rounds."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortwise.session import materialize

MAX_ROUNDS = 200


def _coin(node: Column, number: int) -> Column:
    return F.xxhash64(node, F.lit(number))


def subtree_totals(tree: DataFrame, values: Sequence[str], node: str = "node", parent: str = "parent", max_rounds: int = MAX_ROUNDS) -> DataFrame:
    """(node, one column per value) with the sum of each value over the node's subtree, itself included.

    ``tree`` has one row per node (a long, unique) with its parent (null: a root) and the values (longs,
    null counts as 0). Every round *rakes* all leaves, whose sums go to their
    parents in one grouped step, and *compresses* unary chains: of a run of nodes with one child each
    those go whose coin of the round beats both neighbours' (a third of
    them), their child moves up to their parent, and what they held stays on
    the edge. So live nodes shrink by a constant share each round, whatever the depth, and the hottest
    parent is only ever an aggregate's key. Afterwards rounds are undone last
    to first: a raked node has its sum already, a compressed one adds its own to that of the child it had.

    Rounds are written, so lineage stays short. Parents that are not in the tree, or that
    form a circle, make it fail after ``max_rounds``. An empty tree gives no rows.
    """
    edge = {v: f"edge_{v}" for v in values}
    start = tree.select(F.col(node).alias("node"), F.col(parent).alias("up"), *[F.coalesce(F.col(v), F.lit(0)).cast("long").alias(v) for v in values])
    start = materialize(start, "tree")
    below = start.filter("up IS NOT NULL").groupBy(F.col("up").alias("node")).agg(F.count(F.lit(1)).alias("kids"), F.bit_xor("node").alias("mixed"))
    first = start.join(below, "node", "left").withColumns({"kids": F.coalesce("kids", F.lit(0)), "mixed": F.coalesce("mixed", F.lit(0))})
    live = materialize(first.withColumns({e: F.lit(0).cast("long") for e in edge.values()} | {"skipped": F.lit(None).cast("long")} | {f"add_{v}": F.lit(0).cast("long") for v in values}), "live")
    rounds = []
    while not live.isEmpty():
        if len(rounds) == max_rounds:
            raise RuntimeError(f"nodes are left after {max_rounds} rounds")
        rested = _rake(live, values, edge, len(rounds))
        rounds.append(live)
        live = _compress(rested, values, edge)
    return _expand(rounds, live.schema, values, start)


def _rake(live: DataFrame, values: Sequence[str], edge: dict[str, str], number: int) -> DataFrame:
    """Nodes that are no leaves, with what their leaves held; ``out`` marks the chain nodes that go next.

    A node knows its children by their number and the exclusive-or of their names, so the last one left is known without a join.
    """
    gone = live.filter("kids = 0 AND up IS NOT NULL").groupBy(F.col("up").alias("node")).agg(
        F.count(F.lit(1)).alias("lost"), F.bit_xor("node").alias("lost_mixed"), *[F.sum(F.col(v) + F.col(e)).alias(f"lost_{v}") for v, e in edge.items()]
    )
    rest = live.filter("kids > 0").drop("skipped", *[f"add_{v}" for v in values]).join(gone, "node", "left")
    changed = {v: F.col(v) + F.coalesce(f"lost_{v}", F.lit(0)) for v in values}
    changed |= {"kids": F.col("kids") - F.coalesce("lost", F.lit(0)), "mixed": F.col("mixed").bitwiseXOR(F.coalesce("lost_mixed", F.lit(0)))}
    rest = rest.withColumns(changed).drop("lost", "lost_mixed", *[f"lost_{v}" for v in values])
    mine = _coin(F.col("node"), number)
    wins = (F.col("kids") == 1) & F.col("up").isNotNull() & (mine > _coin(F.col("up"), number)) & (mine > _coin(F.col("mixed"), number))
    return materialize(rest.withColumn("out", F.coalesce(wins, F.lit(False))), "raked")


def _compress(rested: DataFrame, values: Sequence[str], edge: dict[str, str]) -> DataFrame:
    """Marked nodes go: their child hangs on their parent, and keeps on its edge what they held."""
    out = rested.filter("out")
    over = out.select(F.col("mixed").alias("node"), F.col("node").alias("skipped"), F.col("up").alias("new_up"), *[F.col(v).alias(f"own_{v}") for v in values], *[F.col(e).alias(f"own_{e}") for e in edge.values()])
    # The parent's children change by name only: the one that goes for the one that comes.
    swaps = out.groupBy(F.col("up").alias("node")).agg(F.bit_xor(F.col("node").bitwiseXOR(F.col("mixed"))).alias("swap"))
    stays = rested.filter("NOT out").drop("out").join(over, "node", "left").join(swaps, "node", "left")
    # What a skipped node adds to the sum of its child: its own part and what was on the edge between.
    adds = {f"add_{v}": F.coalesce(F.col(f"own_{v}") + F.col(e), F.lit(0)) for v, e in edge.items()}
    stays = stays.withColumns(adds)
    moved = {e: F.col(e) + F.coalesce(F.col(f"own_{v}") + F.col(f"own_{e}"), F.lit(0)) for v, e in edge.items()}
    moved |= {"up": F.coalesce("new_up", "up"), "mixed": F.col("mixed").bitwiseXOR(F.coalesce("swap", F.lit(0)))}
    return materialize(stays.withColumns(moved).drop("new_up", "swap", *[f"own_{v}" for v in values], *[f"own_{e}" for e in edge.values()]), "live")


def _expand(rounds: list[DataFrame], schema, values: Sequence[str], start: DataFrame) -> DataFrame:
    """Totals of all nodes, from the last round to the first. ``rounds[i]`` is what round i began with: it
    has that round's leaves, and the children over which the round before skipped nodes."""
    known = start.sparkSession.createDataFrame([], schema).select("node", *values)
    for live in reversed(rounds):
        skipped = live.filter("skipped IS NOT NULL").select(F.col("node").alias("child"), F.col("skipped"), *[f"add_{v}" for v in values])
        with_leaves = known.union(live.filter("kids = 0").select("node", *values))
        found = skipped.join(with_leaves.withColumnRenamed("node", "child"), "child").select(F.col("skipped").alias("node"), *[(F.col(v) + F.col(f"add_{v}")).alias(v) for v in values])
        known = materialize(with_leaves.union(found), "totals")
    return known
