"""Connected components of a graph given as edges, in Spark rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortwise.llm.skew import left_join_hot
from cohortwise.session import materialize


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b long); root is the smallest node of its component.

    Alternating large and small stars: every round re-links neighbours to the
    smallest neighbour, until all edges point at roots. Each round is written,
    so lineage stays short; the driver sees two numbers a round. Hubs with a
    large share of the edges are joined by broadcast (``left_join_hot``).
    Null ends and loops are dropped; no edges give no rows.
    """
    pair = edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    now, before = materialize(pair.distinct(), "edges"), None
    for _ in range(max_rounds):
        state = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b") % (1 << 40))).first()
        if state == before:
            return now.select(F.col("a").alias("node"), F.col("b").alias("root")).union(now.select("b", "b")).distinct()
        before = state
        now = _small_star(_large_star(now))
    raise RuntimeError(f"no fixed point after {max_rounds} rounds")


def _large_star(edges: DataFrame) -> DataFrame:
    both = materialize(edges.union(edges.select("b", "a")), "both")
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    linked = left_join_hot(both, least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return materialize(linked.filter("a <> b").distinct(), "edges")


def _small_star(edges: DataFrame) -> DataFrame:
    # edges go from the larger to the smaller node
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    linked = left_join_hot(edges, least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    linked = linked.union(least.select("a", "m")).filter("a <> b")
    return materialize(linked.distinct(), "edges")
