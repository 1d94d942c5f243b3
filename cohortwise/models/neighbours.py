"""Exact nearest-neighbour join of two tables of value arrays, without all pairs and without a sample.

Points are dealt to the nearest of some pivots. A probe first searches the cell of
its own pivot, which bounds the distance of its k-th neighbour; then it visits only the cells that
can hold a nearer point by the triangle inequality. Large cells are cut into blocks, and
many probes of one cell into groups, so a task holds a bounded block of either.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortwise.session import materialize

PIVOTS = 256
# More points get more pivots, one for so many points, so that a probe's cells don't grow with the table.
CELL_POINTS = 2_000
MOST_PIVOTS = 4_096
# Points beyond the k nearest that are compared in full with them; where more are as near, all these are.
SPARE = 8
# Points and probes that meet in one group at most, about.
BLOCK = 20_000
# Pairs of points and probes that one task compares, about.
TASK_PAIRS = 500_000_000
# Squared distances that agree in so many decimals are ties: the smaller point, value by value, is nearer.
DECIMALS = 9

_FOUND = "values array<double>, near array<struct<d2: double, point: array<double>, n: double, y: double>>"


def choose_pivots(points: DataFrame, count: int | None = None) -> np.ndarray:
    """Pivots for the cells: the first distinct points by hash, at most ``count``, found below a threshold of the hash."""
    total, steps = points.count(), 1 << 40
    count = count or min(MOST_PIVOTS, max(PIVOTS, total // CELL_POINTS))
    few = points.filter(F.pmod(F.xxhash64("values"), F.lit(steps)) < min(steps, 4 * steps * count // max(total, 1)))
    rows = few.select("values", F.pmod(F.xxhash64("values"), F.lit(steps)).alias("h")).orderBy("h", "values").limit(count).collect()
    if not rows:
        rows = points.select("values").limit(1).collect()
    return np.array([r["values"] for r in rows], float)


def _distances(a: np.ndarray, b: np.ndarray, p: int = 2) -> np.ndarray:
    if p == 1:
        return sum(np.abs(a[:, i, None] - b[:, i]) for i in range(a.shape[1]))
    return np.sqrt(np.maximum((a**2).sum(1)[:, None] - 2 * a @ b.T + (b**2).sum(1), 0.0))


def _stacked(column: pa.ChunkedArray, width: int) -> np.ndarray:
    return np.concatenate([c.flatten().to_numpy(zero_copy_only=False) for c in column.chunks] or [np.zeros(0)]).reshape(-1, width)


def _rows(places: np.ndarray) -> int:
    """Rows whose distances to all pivots are held at once."""
    return max(1, BLOCK * PIVOTS // max(PIVOTS, len(places)))


def _placed(df: DataFrame, pivots: np.ndarray, columns: Sequence[str], schema: str, p: int = 2) -> DataFrame:
    """``columns`` with the nearest pivot's number and distance."""
    shared = df.sparkSession.sparkContext.broadcast(pivots)

    def run(batches):
        places = shared.value
        for batch in batches:
            for start in range(0, len(batch), _rows(places)):
                part = batch.slice(start, _rows(places))
                d = _distances(_stacked(pa.chunked_array([part.column(0)]), places.shape[1]), places, p)
                cell = d.argmin(1)
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array(cell.astype(np.int32)), pa.array(d[np.arange(len(d)), cell])], [*columns, "cell", "dist"]
                )

    return df.select(*columns).mapInArrow(run, f"{schema}, cell int, dist double")


def _search(k: int, width: int, p: int = 2):
    """Nearest points of each probe of one block."""

    def run(points: pa.Table, probes: pa.Table) -> pa.Table:
        x, q = _stacked(points.column("values"), width), _stacked(probes.column("values"), width)
        n, y = points.column("n").to_numpy(), points.column("y").to_numpy()
        order = np.lexsort(x.T[::-1]) if len(x) else np.zeros(0, int)
        x, n, y = x[order], n[order], y[order]
        least = min(k, len(x))
        found, squares = np.empty((len(q) if least else 0, least), np.int64), np.empty((len(q) if least else 0, least))

        def exact(probe: np.ndarray, at: np.ndarray) -> np.ndarray:
            apart = np.abs(x[at] - probe)
            return np.round((apart**2).sum(-1) if p == 2 else apart.sum(-1) ** 2, DECIMALS)

        wide = min(least + SPARE, len(x))
        for start in range(0, len(found), 256):
            block = q[start : start + 256]
            rough = _distances(block, x, p)
            pick = np.sort(np.argpartition(rough, wide - 1, axis=1)[:, :wide], axis=1)
            near = np.take_along_axis(rough, pick, 1)
            far = np.partition(near, least - 1, axis=1)[:, least - 1] + 1e-6
            d2 = np.where(near <= far[:, None], exact(block[:, None], pick), math.inf)
            take = np.argsort(d2, axis=1, kind="stable")[:, :least]
            found[start : start + 256], squares[start : start + 256] = np.take_along_axis(pick, take, 1), np.take_along_axis(d2, take, 1)
            # Where all that were picked are so near, there may be others.
            for i in np.flatnonzero(near.max(axis=1) <= far) if wide < len(x) else ():
                at = np.flatnonzero(rough[i] <= far[i])
                d2 = exact(block[i], at)
                take = np.argsort(d2, kind="stable")[:least]
                found[start + i], squares[start + i] = at[take], d2[take]
        at = found.ravel()
        lists = lambda n, size, values: pa.ListArray.from_arrays(pa.array(np.arange(n + 1) * size, pa.int32()), values)
        each = [pa.array(squares.ravel()), lists(len(at), width, pa.array(x[at].ravel())), pa.array(n[at]), pa.array(y[at])]
        values = probes.column("values").combine_chunks() if len(x) else pa.array([], pa.list_(pa.float64()))
        return pa.table([values, lists(len(found), least, pa.StructArray.from_arrays(each, ["d2", "point", "n", "y"]))], ["values", "near"])

    return run


def _meet(points: DataFrame, visits: DataFrame, sizes: dict[int, int], k: int, width: int, p: int = 2) -> DataFrame:
    """(values, near) of probes (values, cell) with all blocks of their cells; ``sizes`` has the points of each cell.

    There are as many tasks as the pairs to compare need.
    """
    spark = points.sparkSession
    blocks = {c: math.ceil(n / BLOCK) for c, n in sizes.items()}
    counts = {r["cell"]: r["count"] for r in visits.groupBy("cell").count().collect()}  # one row a pivot
    groups = {c: math.ceil(n / BLOCK) for c, n in counts.items()}
    pairs = sum(n * sizes.get(c, 0) for c, n in counts.items())
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), math.ceil(pairs / TASK_PAIRS))
    table = F.broadcast(spark.createDataFrame([(c, blocks[c], groups.get(c, 1)) for c in blocks], "cell int, blocks int, groups int"))
    sides = F.pmod(F.xxhash64("values"), F.col("blocks")).cast("int"), F.pmod(F.xxhash64("values", F.lit(1)), F.col("groups")).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    left = points.join(table, "cell").withColumn("block", sides[0]).withColumn("of", every("groups"))
    right = visits.join(table, "cell").withColumn("of", sides[1]).withColumn("block", every("blocks"))
    left, right = left.select("cell", "block", "of", "values", "n", "y"), right.select("cell", "block", "of", "values")
    left, right = left.repartition(tasks, "cell", "block", "of"), right.repartition(tasks, "cell", "block", "of")
    return left.groupBy("cell", "block", "of").cogroup(right.groupBy("cell", "block", "of")).applyInArrow(
        lambda a, b: _search(k, width, p)(a, b), _FOUND
    )


def _nearest(found: DataFrame, k: int) -> DataFrame:
    """The k nearest of what all blocks found."""
    ordered = F.slice(F.array_sort(F.flatten(F.collect_list("near"))), 1, k)
    return found.groupBy("values").agg(ordered.alias("near"))


def neighbours(points: DataFrame, probes: DataFrame, k: int, pivots: int | None = None, p: int = 2) -> DataFrame:
    """(values, near) for each distinct ``values`` of ``probes``: its ``k`` nearest points, nearest first, exactly.

    ``points`` has (values, n, y): distinct value arrays, the rows and positive labels of each; ``near``
    holds (d2, point, n, y). Distances are Euclidean, with ``p`` 1 Manhattan, and ``d2`` is their square; ties go to the smaller point. No points, no rows.
    """
    points = materialize(points.select("values", F.col("n").cast("double").alias("n"), F.col("y").cast("double").alias("y")), "points")
    places = choose_pivots(points, pivots)
    if not len(places):
        return probes.sparkSession.createDataFrame([], _FOUND)
    width = places.shape[1]
    points = materialize(_placed(points, places, ["values", "n", "y"], "values array<double>, n double, y double", p), "cells")
    stats = {r["cell"]: r for r in points.groupBy("cell").agg(F.count(F.lit(1)).alias("n"), F.min("dist").alias("low"), F.max("dist").alias("high")).collect()}
    sizes = {c: r["n"] for c, r in stats.items()}
    asked = materialize(_placed(probes.select("values").distinct(), places, ["values"], "values array<double>", p), "probes")
    # Only cells with points: a pivot is a point, so each has one at least, itself.
    first = materialize(_nearest(_meet(points, asked, sizes, k, width, p), k), "first")
    bound = F.aggregate("near", F.lit(0.0), lambda acc, x: acc + x["n"])
    reach = F.when(bound >= k, F.sqrt(F.element_at(F.transform("near", lambda x: x["d2"]), -1))).otherwise(F.lit(math.inf))
    visits = _visits(asked.join(first.select("values", reach.alias("reach")), "values"), places, stats, p)
    second = _meet(points, materialize(visits, "visits"), sizes, k, width, p)
    return _nearest(first.unionByName(second), k)


def _visits(asked: DataFrame, places: np.ndarray, stats: dict, p: int = 2) -> DataFrame:
    """(values, cell) for all other cells that may hold a point within reach."""
    low, high = (np.array([stats[c][side] if c in stats else math.inf for c in range(len(places))]) for side in ("low", "high"))
    shared = asked.sparkSession.sparkContext.broadcast((places, low, high, _distances(places, places, p)))

    def run(batches):
        places, low, high, apart = shared.value
        for batch in batches:
            for start in range(0, len(batch), _rows(places)):
                part = batch.slice(start, _rows(places))
                own, reach = part.column(1).to_numpy(), part.column(2).to_numpy(zero_copy_only=False)[:, None] + 1e-6
                d = _distances(_stacked(pa.chunked_array([part.column(0)]), places.shape[1]), places, p)
                mine, between = d[np.arange(len(d)), own][:, None], apart[own]
                # The ring of a cell around its pivot, and the plane half way between two pivots (without right angles, half the difference).
                ring = np.maximum(d - high, low - d)
                plane = (d**2 - mine**2) / np.maximum(2 * between, 1e-300) if p == 2 else (d - mine) / 2
                near = (ring <= reach) & ((plane <= reach) | (between <= 1e-12)) & np.isfinite(low)
                near[np.arange(len(d)), own] = False
                row, cell = np.nonzero(near)
                yield pa.RecordBatch.from_arrays([part.column(0).take(pa.array(row)), pa.array(cell.astype(np.int32))], ["values", "cell"])

    return asked.select("values", "cell", "reach").mapInArrow(run, "values array<double>, cell int")
