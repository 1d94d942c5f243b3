"""Extremely randomised trees, grown level by level for all trees at once.

Thresholds and candidate features are drawn by hash from (seed, tree, node, feature), so trees do not depend on
partitions or the order of rows. A level takes two grouped sums over all trees: the range of every feature in
every open node, then the labels on both sides of each drawn threshold. Rows
are routed in Arrow batches from the trees grown so far, so no state of the size of rows x trees is kept.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortwise.models.frame import FOLD, LABEL

SEED = 42
ROWS = 65_536


def draw(seed: int, tree, node, feature) -> np.ndarray:
    """Numbers in [0, 1) from whole numbers, by a fixed mixing of their bits."""
    x = np.zeros(np.broadcast(tree, node, feature).shape, np.uint64) + np.uint64(seed)
    for part in (tree, node, feature):
        mix(x, part)
    return (x >> np.uint64(11)).astype(float) / float(1 << 53)


def mix(x: np.ndarray, part) -> np.ndarray:
    """One step of :func:`draw`'s mixing, in place."""
    with np.errstate(over="ignore"):
        x ^= np.asarray(part).astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15)
        x *= np.uint64(0xBF58476D1CE4E5B9)
        x ^= x >> np.uint64(27)
        x *= np.uint64(0x94D049BB133111EB)
        x ^= x >> np.uint64(31)
    return x


@dataclass
class Tree:
    """Nodes by heap number (root 1, children 2n and 2n + 1): feature (-1: a leaf), threshold, share of label 1."""

    feature: dict[int, int]
    threshold: dict[int, float]
    share: dict[int, float]

    def arrays(self, depth: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The nodes as arrays over all heap numbers down to ``depth``."""
        size = 2 << depth
        feature, threshold, share = np.full(size, -1, np.int32), np.zeros(size), np.zeros(size)
        for n, f in self.feature.items():
            feature[n], threshold[n] = f, self.threshold.get(n, 0.0)
        for n, s in self.share.items():
            share[n] = s
        return feature, threshold, share


def route(x: np.ndarray, feature: np.ndarray, threshold: np.ndarray, depth: int) -> np.ndarray:
    """The node each row reaches."""
    node, row = np.ones(len(x), np.int64), np.arange(len(x))
    for _ in range(depth):
        at = feature[node]
        inner = at >= 0
        if not inner.any():
            break
        right = x[row, np.maximum(at, 0)] > threshold[node]
        node = np.where(inner, 2 * node + right, node)
    return node


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _batches(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Values, labels and folds of about ``ROWS`` rows at a time: each block sends a line for every node it reaches, so small batches go together."""
    held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    for whole in batches:
        for start in range(0, len(whole), ROWS):
            part = whole.slice(start, ROWS)
            if len(part):
                held.append((_matrix(part.column(0)), part.column(1).to_numpy(), part.column(2).to_numpy()))
            if sum(len(y) for _, y, _ in held) >= ROWS:
                yield tuple(map(np.concatenate, zip(*held)))
                held = []
    if held:
        yield tuple(map(np.concatenate, zip(*held)))


def _grouped(node: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(node, kind="stable")
    return order, np.flatnonzero(np.diff(node[order], prepend=-1))


def grow(frame: DataFrame, trees: int, depth: int, held_out: Sequence[int | None] = (None,), min_split: int = 2, seed: int = SEED) -> list[list[Tree]]:
    """For each fold to leave out (None: none) a list of ``trees`` trees.

    A node is split while it has both labels and at least ``min_split`` rows and is not at ``depth``: of its features that are not constant the
    first ceil(sqrt(features)) by hash get one threshold each, uniform over the node's range, and the one with the largest
    Gini gain wins (the first feature among equals). The driver sees one line for each open node and candidate.
    """
    fold = F.col(FOLD) if FOLD in frame.columns else F.lit(-1)
    rows = frame.select("values", F.col(LABEL).cast("int").alias("label"), fold.cast("int").alias("fold"))
    width = len(rows.select("values").first()["values"])
    take = math.ceil(math.sqrt(width))
    left_out = [fold for fold in held_out for _ in range(trees)]
    forest = [Tree({}, {}, {}) for _ in left_out]
    opened: list[set[int]] = [{1} for _ in forest]
    spark = frame.sparkSession
    for level in range(depth + 1):
        shared = spark.sparkContext.broadcast(([t.arrays(level) for t in forest], [sorted(o) for o in opened], left_out, level))
        ranges = _ranges(rows, shared, width)
        counts: list[dict[int, tuple[int, int]]] = [{} for _ in forest]
        plans: list[dict[int, list[tuple[int, float]]]] = [{} for _ in forest]
        for tree, node, zero, one, low, high in ranges:
            forest[tree].share[node] = one / (zero + one)
            forest[tree].feature[node] = -1
            if not zero or not one or zero + one < min_split or level == depth:
                continue
            ids = np.arange(width)
            order = np.argsort(draw(seed, tree % trees, node, ids), kind="stable")
            kept = sorted([f for f in order.tolist() if low[f] < high[f]][:take])
            if kept:
                u = draw(seed + 1, tree % trees, node, np.array(kept))
                counts[tree][node] = (zero, one)
                plans[tree][node] = [(f, float(low[f] + x * (high[f] - low[f]))) for f, x in zip(kept, u)]
        if not any(plans):
            break
        opened = _split(rows, forest, plans, counts, left_out, level)
        if not any(opened):
            break
    return [forest[i * trees : (i + 1) * trees] for i in range(len(held_out))]


def _ranges(rows: DataFrame, shared, width: int) -> list[tuple]:
    """(tree, node, rows of label 0, of label 1, least values, largest values) of every open node."""

    def run(batches):
        forest, opened, left_out, level = shared.value
        for x, y, fold in _batches(batches):
            out = []
            for tree, ((feature, threshold, _), nodes, out_fold) in enumerate(zip(forest, opened, left_out)):
                if not nodes:
                    continue
                node = route(x, feature, threshold, level)
                kept = np.flatnonzero(np.isin(node, nodes) & (fold != (-2 if out_fold is None else out_fold)))
                if not len(kept):
                    continue
                order, firsts = _grouped(node[kept])
                order = kept[order]
                n, ones = np.diff(np.append(firsts, len(order))), np.add.reduceat(y[order], firsts)
                low, high = np.minimum.reduceat(x[order], firsts, axis=0), np.maximum.reduceat(x[order], firsts, axis=0)
                out += [(tree, int(a), int(b - c), int(c), d, e) for a, b, c, d, e in zip(node[order[firsts]], n, ones, low.tolist(), high.tolist())]
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(c), k) for c, k in zip(zip(*out), _RANGE)] if out else [pa.array([], k) for k in _RANGE], ["tree", "node", "zero", "one", "low", "high"]
            )

    found = rows.mapInArrow(run, "tree int, node bigint, zero bigint, one bigint, low array<double>, high array<double>")
    least, most = ([f(F.col(c)[i]).alias(f"{c}{i}") for i in range(width)] for f, c in ((F.min, "low"), (F.max, "high")))
    sums = found.groupBy("tree", "node").agg(F.sum("zero").alias("zero"), F.sum("one").alias("one"), *least, *most)
    return [(r["tree"], r["node"], r["zero"], r["one"], r[4 : 4 + width], r[4 + width :]) for r in sums.collect()]


_RANGE = [pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.float64()), pa.list_(pa.float64())]


def _split(rows: DataFrame, forest: list[Tree], plans: list[dict], counts: list[dict], left_out: list, level: int) -> list[set[int]]:
    """Count the labels left of every drawn threshold, take the best of each node, and return the new open nodes."""
    shared = rows.sparkSession.sparkContext.broadcast(([t.arrays(level) for t in forest], plans, left_out, level))

    def run(batches):
        forest, plans, left_out, level = shared.value
        drawn = [_drawn(plan) if plan else None for plan in plans]
        kinds = [pa.int32(), pa.int64(), pa.int32(), pa.int64(), pa.int64()]
        for x, y, fold in _batches(batches):
            out = []
            for tree, ((feature, threshold, _), lists, out_fold) in enumerate(zip(forest, drawn, left_out)):
                if lists is None:
                    continue
                nodes, features, cuts = lists
                node = route(x, feature, threshold, level)
                at = np.minimum(np.searchsorted(nodes, node), len(nodes) - 1)
                kept = np.flatnonzero((nodes[at] == node) & (fold != (-2 if out_fold is None else out_fold)))
                at, own, label = at[kept], x[kept], y[kept]
                for j in range(features.shape[1]):
                    f = features[at, j]
                    left = (f >= 0) & (own[np.arange(len(own)), np.maximum(f, 0)] <= cuts[at, j])
                    n, ones = np.bincount(at[left], minlength=len(nodes)), np.bincount(at[left], label[left], len(nodes)).astype(np.int64)
                    some = np.flatnonzero(n)
                    out.append((np.full(len(some), tree), nodes[some], features[some, j], (n - ones)[some], ones[some]))
            columns = [np.concatenate(c) for c in zip(*out)] if out else [[]] * 5
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["tree", "node", "feature", "zero", "one"])

    found = rows.mapInArrow(run, "tree int, node bigint, feature int, zero bigint, one bigint")
    whole = found.groupBy("tree", "node", "feature").agg(F.sum("zero").alias("zero"), F.sum("one").alias("one")).collect()
    left = {(r["tree"], r["node"], r["feature"]): (r["zero"], r["one"]) for r in whole}
    opened: list[set[int]] = [set() for _ in forest]
    for tree, plan in enumerate(plans):
        for node, drawn in plan.items():
            best = None
            for f, cut in drawn:
                gain = purity(left.get((tree, node, f), (0, 0)), counts[tree][node])
                if best is None or gain > best[0] + 1e-12:
                    best = (gain, f, cut)
            forest[tree].feature[node], forest[tree].threshold[node] = best[1:]
            opened[tree] |= {2 * node, 2 * node + 1}
    return opened


def _drawn(plan: dict[int, list[tuple[int, float]]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The drawn (feature, threshold) of every node as arrays; nodes with fewer have feature -1."""
    nodes, width = sorted(plan), max(map(len, plan.values()))
    features, cuts = np.full((len(nodes), width), -1), np.zeros((len(nodes), width))
    for i, node in enumerate(nodes):
        for j, (f, cut) in enumerate(plan[node]):
            features[i, j], cuts[i, j] = f, cut
    return np.array(nodes), features, cuts


def purity(left: tuple[int, int], whole: tuple[int, int]) -> float:
    """What a split keeps of the squared label shares: larger is purer."""
    right, total = (whole[0] - left[0], whole[1] - left[1]), sum(whole)
    return sum((side[0] ** 2 + side[1] ** 2) / sum(side) / total for side in (left, right) if sum(side))


def predict(x: np.ndarray, trees: Sequence[tuple[np.ndarray, np.ndarray, np.ndarray]], depth: int) -> np.ndarray:
    """Mean of the trees' shares of label 1."""
    return sum(share[route(x, feature, threshold, depth)] for feature, threshold, share in trees) / len(trees)
