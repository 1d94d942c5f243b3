"""Correlations of tables with very many columns: cross products by blocks of columns."""

from __future__ import annotations

import itertools
import math
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortwise.operators.quantiles import no_nan

# Columns of a block; sums of a pair of blocks are six numbers for each pair of columns.
BLOCK = 64
# Bytes of sums that one task holds; more pairs of blocks take another pass over the table.
TASK_BYTES = 256 << 20
# Partial sums of a pair of blocks are added up in so many groups first.
SLOTS = 64
ROWS = 4096

_SUMS = "left int, right int, slot int, sums binary"


def _centres(df: DataFrame, columns: Sequence[str]) -> list[float]:
    """Means of all columns, so that products are of small numbers."""
    each = df.select(F.posexplode(F.array(*[no_nan(F.col(f"`{c}`")) for c in columns])).alias("i", "x"))
    means = {r["i"]: r["m"] for r in each.groupBy("i").agg(F.avg("x").alias("m")).collect()}  # one row a column
    return [means.get(i) or 0.0 for i in range(len(columns))]


def _partial(values: DataFrame, centres: list[float], pairs: list[tuple[int, int]]) -> DataFrame:
    """The sums of every pair of blocks over each task's rows."""
    shared = values.sparkSession.sparkContext.broadcast((np.array(centres), pairs))

    def run(batches):
        centres, pairs = shared.value
        sums = {p: 0.0 for p in pairs}
        for whole in batches:
            for start in range(0, len(whole), ROWS):
                part = whole.slice(start, ROWS).column(0)
                x = part.flatten().to_numpy(zero_copy_only=False).astype(float).reshape(len(part), -1) - centres
                there = (~np.isnan(x)).astype(float)
                x = np.where(there > 0, x, 0.0)
                blocks = [(x[:, k : k + BLOCK], there[:, k : k + BLOCK]) for k in range(0, x.shape[1], BLOCK)]
                for a, b in pairs:
                    (p, m), (q, n) = blocks[a], blocks[b]
                    sums[a, b] = sums[a, b] + np.stack([_padded(s) for s in (m.T @ n, p.T @ n, m.T @ q, (p * p).T @ n, m.T @ (q * q), p.T @ q)])
        slot = TaskContext.get().partitionId() % SLOTS
        for (a, b), s in sums.items():
            if not isinstance(s, float):
                yield pa.RecordBatch.from_arrays([pa.array([a], pa.int32()), pa.array([b], pa.int32()), pa.array([slot], pa.int32()), pa.array([s.tobytes()])], ["left", "right", "slot", "sums"])

    return values.mapInArrow(run, _SUMS)


def _padded(s: np.ndarray) -> np.ndarray:
    return np.pad(s, ((0, BLOCK - s.shape[0]), (0, BLOCK - s.shape[1])))


def _added(group: pa.Table) -> pa.Table:
    total = sum(np.frombuffer(s, float) for s in group.column("sums").to_pylist())
    first = group.slice(0, 1)
    return pa.table([first.column(0), first.column(1), first.column(2), pa.array([total.tobytes()])], ["left", "right", "slot", "sums"])


def blocked_correlation(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(a, b, corr) for every pair of columns, the later one first; pairwise complete, null where a column is constant or nothing is complete.

    Every task multiplies blocks of columns of its rows and sends one matrix of sums for each pair of blocks, which are
    added in two steps. The driver sees one mean for each column.
    """
    columns = list(columns)
    nan = F.lit(float("nan"))
    values = df.select(F.array(*[F.coalesce(no_nan(F.col(f"`{c}`")), nan) for c in columns]).alias("values"))
    blocks = math.ceil(len(columns) / BLOCK)
    pairs = [(a, b) for a in range(blocks) for b in range(a + 1)]
    each = max(1, TASK_BYTES // (6 * BLOCK * BLOCK * 8))
    centres, found = _centres(df, columns), None
    for start in range(0, len(pairs), each):
        part = _partial(values, centres, pairs[start : start + each])
        part = part.groupBy("left", "right", "slot").applyInArrow(_added, _SUMS).groupBy("left", "right").applyInArrow(_added, _SUMS)
        found = part if found is None else found.unionByName(part)
    names = values.sparkSession.sparkContext.broadcast(columns)

    def pairs_of(batches):
        columns = names.value
        for batch in batches:
            for a, b, packed in zip(*(batch.column(i).to_pylist() for i in (0, 1, 3))):
                n, sx, sy, sxx, syy, sxy = np.frombuffer(packed, float).reshape(6, BLOCK, BLOCK)
                with np.errstate(all="ignore"):
                    vx, vy = sxx - sx * sx / n, syy - sy * sy / n
                    r = (sxy - sx * sy / n) / np.sqrt(vx * vy)
                    # What rounding leaves of a constant column's deviations is none.
                    r[(vx <= 1e-14 * np.maximum(sxx, 1e-300)) | (vy <= 1e-14 * np.maximum(syy, 1e-300))] = np.nan
                at = [(a * BLOCK + i, b * BLOCK + j, r[i, j]) for i, j in itertools.product(range(BLOCK), range(BLOCK)) if b * BLOCK + j < a * BLOCK + i < len(columns)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([columns[i] for i, _, _ in at], pa.string()), pa.array([columns[j] for _, j, _ in at], pa.string()), pa.array([None if math.isnan(x) else float(x) for *_, x in at], pa.float64())],
                    ["a", "b", "corr"],
                )

    return found.mapInArrow(pairs_of, "a string, b string, corr double")
