"""Random forests grown on binned cells, level by level for all trees at once.

Features are binned once and rows equal in all bins and the label become one cell with a count. A tree's bootstrap gives
each row a Poisson(1) number of copies, so a cell of n rows has Poisson(n) of them; it is drawn by hash from (seed, tree, cell),
not from partitions or the order of rows. A bounded table of cells goes to all tasks, each growing some of the trees. Of a larger one a
level is one grouped sum: tasks route their cells in Arrow batches from the splits
found so far and count labels by (tree, node, candidate feature, bin), and the counts of a tree's nodes are added and
searched for the best split where they meet. The driver sees one line for each open node.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortwise.models.extra import draw, mix
from cohortwise.models.frame import LABEL
from cohortwise.session import materialize, sized

# Nodes whose counts meet in one group, and cells one task reads at least.
NODES = 256
CELLS = 4096
# Bytes of cells that one task may hold, as many as Spark itself would give it.
LOCAL = 64 << 20
# Equal steps of a draw whose number of copies a table knows.
_SLOTS = 4096


class Grown:
    """One tree as arrays over its nodes, the root first, children next to each other: a leaf has left child -1."""

    def __init__(self):
        self.feature, self.cut, self.left = np.zeros(1, np.int64), np.zeros(1, np.int64), np.full(1, -1)
        self.counts, self.gain, self.depth = np.zeros((1, 2)), np.full(1, -1.0), np.zeros(1, np.int64)

    def split(self, nodes: np.ndarray, feature: np.ndarray, cut: np.ndarray, gain: np.ndarray, low: np.ndarray) -> np.ndarray:
        """Give these nodes two children each, with the counts ``low`` on the left; returns the children."""
        first = len(self.left) + 2 * np.arange(len(nodes))
        self.feature[nodes], self.cut[nodes], self.gain[nodes], self.left[nodes] = feature, cut, gain, first
        new = 2 * len(nodes)
        self.counts = np.concatenate([self.counts, np.stack([low, self.counts[nodes] - low], 1).reshape(new, 2)])
        self.feature, self.cut = (np.concatenate([a, np.zeros(new, np.int64)]) for a in (self.feature, self.cut))
        self.left, self.gain = np.concatenate([self.left, np.full(new, -1)]), np.concatenate([self.gain, np.full(new, -1.0)])
        self.depth = np.concatenate([self.depth, np.repeat(self.depth[nodes] + 1, 2)])
        return np.stack([first, first + 1], 1).ravel()

    def pruned(self) -> Grown:
        """Without splits whose two leaves predict the same label, as Spark's forests are kept."""
        vote, left, kept = (self.counts[:, 1] > self.counts[:, 0]), self.left.copy(), np.zeros(len(self.left), bool)
        for level in range(int(self.depth.max()) - 1, -1, -1):
            at = np.flatnonzero((self.depth == level) & (left >= 0))
            a, b = left[at], left[at] + 1
            left[at[(left[a] < 0) & (left[b] < 0) & (vote[a] == vote[b])]] = -1
        kept[0] = True
        for level in range(int(self.depth.max())):
            at = np.flatnonzero((self.depth == level) & kept & (left >= 0))
            kept[left[at]] = kept[left[at] + 1] = True
        number, out = np.cumsum(kept) - 1, Grown()
        out.feature, out.cut, out.counts, out.depth = self.feature[kept], self.cut[kept], self.counts[kept], self.depth[kept]
        out.left = np.where(left[kept] >= 0, number[np.maximum(left[kept], 0)], -1)
        out.gain = np.where(out.left >= 0, self.gain[kept], -1.0)
        return out


def cells_of(frame: DataFrame, edges: Sequence[Sequence[float]], fold: Column | None = None) -> DataFrame:
    """(bins, label, n, key): the rows of each combination of bins, counted once, one byte a feature. Bin b holds values up to edge b.

    With ``fold`` cells are told apart by it too and have it as a column.
    """
    borders = [np.array(e, float) for e in edges]

    def run(batches):
        for batch in batches:
            x = batch.column(0).flatten().to_numpy(zero_copy_only=False).reshape(len(batch), len(borders))
            bins = np.stack([np.searchsorted(e, x[:, i]) for i, e in enumerate(borders)], 1).astype(np.uint8) if len(batch) else x
            ends = pa.array(np.arange(len(batch) + 1) * len(borders), pa.int32())
            packed = pa.Array.from_buffers(pa.binary(), len(batch), [None, ends.buffers()[1], pa.py_buffer(bins.tobytes())])
            yield pa.RecordBatch.from_arrays([packed, *batch.columns[1:]], ["bins", *by])

    by = ["label"] if fold is None else ["label", "fold"]
    own = [] if fold is None else [fold.cast("int").alias("fold")]
    rows = frame.select("values", F.col(LABEL).cast("int").alias("label"), *own).mapInArrow(run, "bins binary, " + ", ".join(f"{c} int" for c in by))
    cells = rows.groupBy("bins", *by).agg(F.count(F.lit(1)).alias("n")).withColumn("key", F.xxhash64("bins", *by))
    return sized(materialize(cells, "cells"), rows=CELLS)


def _poisson(mean: float) -> np.ndarray:
    """Distribution function of the Poisson law, from 0 to far beyond ``mean``."""
    k = np.arange(int(mean + 12 * math.sqrt(mean) + 20))
    logs = k * math.log(mean) - mean - np.array([math.lgamma(i + 1.0) for i in k])
    return np.cumsum(np.exp(logs))


class _Law:
    """Numbers by a distribution function from 0 on. A table over equal steps of the draw knows most, the others are looked up."""

    def __init__(self, steps: np.ndarray):
        self.steps = steps
        known = np.searchsorted(steps, np.arange(_SLOTS + 1) / _SLOTS, side="right")
        self.known, self.unsure = known[:-1], known[1:] != known[:-1]

    def of(self, drawn: np.ndarray) -> np.ndarray:
        slot = (drawn * _SLOTS).astype(np.int64)
        out, some = self.known[slot], np.flatnonzero(self.unsure[slot])
        out[some] = np.searchsorted(self.steps, drawn[some], side="right")
        return out


class Copies:
    """How often the bootstrap of a tree takes the rows of each cell; ``law`` is the distribution function of the copies of some rows."""

    def __init__(self, n: np.ndarray, key: np.ndarray, seed: int, law: Callable[[float], np.ndarray] = _poisson):
        self.n, self.mixed = n, mix(np.full(len(n), seed, np.uint64), key)
        bits = range(int(n.max()).bit_length()) if len(n) else ()
        # Poisson laws add up, and binomial ones, so a count is the sum of the draws for its binary digits.
        self.tables = {b: _Law(law(float(1 << b))) for b in bits if (n >> b & 1).any()}

    def of(self, tree: int, at: np.ndarray) -> np.ndarray:
        n, mixed, out = self.n[at], mix(self.mixed[at], np.int64(tree)), np.zeros(len(at), np.int64)
        for bit, law in self.tables.items():
            some = np.flatnonzero(n >> bit & 1)
            if len(some):
                out[some] += law.of((mix(mixed[some], np.int64(bit)) >> np.uint64(11)).astype(float) / float(1 << 53))
        return out


def impurities(counts: np.ndarray, kind: str) -> np.ndarray:
    """Gini impurity or entropy of label counts along the last axis; 0 where there are none."""
    total = counts.sum(axis=-1, keepdims=True)
    share = counts / np.where(total > 0, total, 1)
    if kind == "entropy":
        return -(share * np.log2(np.where(share > 0, share, 1))).sum(axis=-1)
    return np.where(total[..., 0] > 0, 1 - (share**2).sum(axis=-1), 0.0)


def best_splits(sums: np.ndarray, least: int, kind: str) -> tuple[np.ndarray, ...]:
    """(candidate, bin, gain, labels on the left, all labels) of each node's best split; gain 0 if there is none.

    ``sums`` has the counts by node, candidate, bin and label. Both sides have at least ``least`` rows; the first of equal splits wins.
    """
    left = np.cumsum(sums, axis=2)
    whole = left[:, 0, -1]
    left = left[:, :, :-1]
    right = whole[:, None, None] - left
    total, a, b = whole.sum(axis=1), left.sum(axis=3), right.sum(axis=3)
    gain = impurities(whole, kind)[:, None, None] - (a * impurities(left, kind) + b * impurities(right, kind)) / np.maximum(total, 1)[:, None, None]
    gain = np.where((a >= max(least, 1)) & (b >= max(least, 1)), gain, 0.0).reshape(len(sums), -1)
    if not gain.shape[1]:
        return np.zeros(len(sums), int), np.zeros(len(sums), int), np.zeros(len(sums)), whole, whole
    at, row = gain.argmax(axis=1), np.arange(len(sums))
    candidate, bin_ = np.divmod(at, left.shape[2])
    return candidate, bin_, gain[row, at], left[row, candidate, bin_], whole


def grow(cells: DataFrame, features: int, bins: int, trees: int, depth: int, take: int, least: int = 1, kind: str = "gini", seed: int = 42) -> list[Grown]:
    """``trees`` trees of at most ``depth`` levels; each node searches ``take`` of the features, drawn by hash.

    Cells of up to ``LOCAL`` bytes go to all tasks, which grow a share of the trees each; more stay dealt. Both ways give the same trees.
    """
    if not depth:
        raise ValueError("a forest needs at least one level")
    shape = (features, bins, depth, take, least, kind, seed)
    if cells.count() * (features + 16) <= LOCAL:
        return _grow_each(cells, trees, shape)
    forest, spark = [Grown() for _ in range(trees)], cells.sparkSession
    opened = [np.zeros(1, np.int64) for _ in forest]
    for level in range(depth):
        plan = [(t, *_steps(tree, nodes), _candidates(t, nodes, features, take, seed)) for t, (tree, nodes) in enumerate(zip(forest, opened)) if len(nodes)]
        if not plan:
            break
        found = _level(cells, spark.sparkContext.broadcast(plan), level, features, bins, take, least, kind, seed)
        for t, tree in enumerate(forest):
            nodes, lines = opened[t], [found[t, c] for c in range(-(-len(opened[t]) // NODES)) if (t, c) in found]
            opened[t] = _grown(tree, nodes, np.concatenate(lines)) if len(nodes) and lines else nodes[:0]
    return [tree.pruned() for tree in forest]


def _candidates(tree: int, nodes: np.ndarray, features: int, take: int, seed: int) -> np.ndarray:
    """The features that each of the nodes searches."""
    order = np.argsort(draw(seed + 1, np.int64(tree), nodes[:, None], np.arange(features)[None]), axis=1, kind="stable")
    return np.sort(order[:, :take], axis=1)


def _steps(tree: Grown, nodes: np.ndarray) -> tuple[np.ndarray, ...]:
    """(feature, cut, left, slot): a leaf leads to itself, so that all rows take the same steps; open nodes have a slot."""
    leaf, slot = tree.left < 0, np.full(len(tree.left), -1)
    slot[nodes] = np.arange(len(nodes))
    return np.where(leaf, 0, tree.feature), np.where(leaf, 255, tree.cut).astype(np.uint8), np.where(leaf, np.arange(len(leaf)), tree.left), slot


def _grown(tree: Grown, nodes: np.ndarray, lines: np.ndarray) -> np.ndarray:
    """Split the open nodes by their lines of :func:`_searched`; returns the nodes open next."""
    feature, cut, gain, low, whole = (a.reshape(len(nodes), -1) for a in np.split(lines, [1, 2, 3, 5], axis=1))
    if len(tree.left) == 1:
        tree.counts[:] = whole
    good = gain[:, 0] > 0
    children = tree.split(nodes[good], feature[good, 0].astype(int), cut[good, 0].astype(int), gain[good, 0], low[good])
    return children[(tree.counts[children] > 0).all(axis=1)]


def _counts(x: np.ndarray, first: np.ndarray, label: np.ndarray, taken: np.ndarray, own: np.ndarray, candidates: np.ndarray, bins: int) -> np.ndarray:
    """Labels by (node, candidate, bin) of rows that begin at ``first`` in ``x`` and lie in the slots ``own``."""
    nodes, take = candidates.shape
    sums, place = np.empty((nodes, take, bins * 2)), own * (bins * 2) + label
    for j, asked in enumerate(candidates.T):
        sums[:, j] = np.bincount(place + x[first + asked[own]].astype(np.int64) * 2, taken, nodes * bins * 2).reshape(nodes, -1)
    return sums


def _searched(sums: np.ndarray, candidates: np.ndarray, bins: int, least: int, kind: str) -> np.ndarray:
    """Feature, bin, gain, labels on the left and all labels of each node's best split."""
    candidate, bin_, gain, low, whole = best_splits(sums.reshape(*candidates.shape, bins, 2), least, kind)
    return np.column_stack([candidates[np.arange(len(candidates)), candidate], bin_, gain, low, whole])


def _grow_each(cells: DataFrame, trees: int, shape: tuple) -> list[Grown]:
    tasks = min(trees, cells.sparkSession.sparkContext.defaultParallelism)

    def some(table: pa.Table) -> pa.Table:
        task = table.column("task")[0].as_py()
        x = np.frombuffer(b"".join(table.column("bins").to_pylist()), np.uint8)
        label, n, key = (table.column(c).to_numpy() for c in ("label", "n", "key"))
        copies = Copies(n, key, shape[-1])
        mine = range(task, trees, tasks)
        lines = [np.column_stack([t.feature, t.cut, t.left, t.gain, t.depth, t.counts]).tobytes() for t in (_tree(x, label, copies, t, *shape) for t in mine)]
        return pa.table({"tree": pa.array(mine, pa.int32()), "nodes": pa.array(lines, pa.binary())})

    every = cells.select("bins", "label", "n", "key", F.explode(F.array(*map(F.lit, range(tasks)))).alias("task"))
    # Several ranges for each number, so that each has a task of its own.
    grown = every.repartitionByRange(8 * tasks, "task").groupBy("task").applyInArrow(some, "tree int, nodes binary").collect()
    out = [Grown() for _ in range(trees)]
    for r in grown:
        nodes, tree = np.frombuffer(bytes(r["nodes"])).reshape(-1, 7), out[r["tree"]]
        tree.feature, tree.cut, tree.left, tree.depth = (nodes[:, i].astype(np.int64) for i in (0, 1, 2, 4))
        tree.gain, tree.counts = nodes[:, 3], nodes[:, 5:]
    return out


def _tree(x: np.ndarray, label: np.ndarray, copies: Copies, number: int, features: int, bins: int, depth: int, take: int, least: int, kind: str, seed: int) -> Grown:
    """One whole tree."""
    taken = copies.of(number, np.arange(len(label)))
    at = np.flatnonzero(taken)
    first, label, taken, node = at * features, label[at].astype(np.int64), taken[at].astype(float), np.zeros(len(at), np.int64)
    tree, opened = Grown(), np.zeros(1, np.int64)
    for _ in range(depth if len(at) else 0):
        if not len(opened):
            break
        candidates, slot = _candidates(number, opened, features, take, seed), _steps(tree, opened)[3]
        own = slot[node]
        inside = np.flatnonzero(own >= 0)
        if len(inside) < len(own):
            first, label, taken, node, own = (a[inside] for a in (first, label, taken, node, own))
        opened = _grown(tree, opened, _searched(_counts(x, first, label, taken, own, candidates, bins), candidates, bins, least, kind))
        feature, cut, left, _ = _steps(tree, opened)
        node = left[node] + (x[first + feature[node]] > cut[node])
    return tree.pruned()


def _level(cells: DataFrame, shared, level: int, features: int, bins: int, take: int, least: int, kind: str, seed: int) -> dict[tuple[int, int], np.ndarray]:
    """By tree and group of its open nodes: the lines of :func:`_searched`."""
    group = NODES * take * bins * 2

    def count(batches):
        held = [b for b in batches if len(b)]
        if not held:
            return
        x = np.concatenate([np.frombuffer(b"".join(b.column(0).to_pylist()), np.uint8) for b in held])
        label, n, key = (np.concatenate([b.column(i).to_numpy() for b in held]) for i in (1, 2, 3))
        copies, everything = Copies(n, key, seed), np.arange(len(n))
        out = []
        for t, feature, cut, left, slot, candidates in shared.value:
            taken = copies.of(t, everything)
            at = np.flatnonzero(taken)
            node, first = np.zeros(len(at), np.int64), at * features
            for _ in range(level):
                node = left[node] + (x[first + feature[node]] > cut[node])
            own = slot[node]
            inside = np.flatnonzero(own >= 0)
            at, own, first = at[inside], own[inside], first[inside]
            sums = _counts(x, first, label[at], taken[at].astype(float), own, candidates, bins).ravel()
            filled = np.flatnonzero(sums)
            ends = np.searchsorted(filled, np.arange(0, len(sums) + group, group))
            for c, (a, b) in enumerate(zip(ends, ends[1:])):
                if a < b:
                    part = filled[a:b]
                    out.append((t, c, (part - c * group).astype(np.int32).tobytes(), sums[part].astype(np.int64).tobytes()))
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), (pa.int32(), pa.int32(), pa.binary(), pa.binary()))], ["tree", "part", "place", "sums"])

    def search(table: pa.Table) -> pa.Table:
        t, c = table.column("tree")[0].as_py(), table.column("part")[0].as_py()
        candidates = next(p[5] for p in shared.value if p[0] == t)[c * NODES : (c + 1) * NODES]
        sums = np.zeros(len(candidates) * take * bins * 2)
        for place, n in zip(table.column("place").to_pylist(), table.column("sums").to_pylist()):
            sums[np.frombuffer(place, np.int32)] += np.frombuffer(n, np.int64)
        lines = _searched(sums, candidates, bins, least, kind)
        return pa.table({"tree": pa.array([t], pa.int32()), "part": pa.array([c], pa.int32()), "best": pa.array([lines.tobytes()], pa.binary())})

    counted = cells.select("bins", "label", "n", "key").mapInArrow(count, "tree int, part int, place binary, sums binary")
    found = counted.groupBy("tree", "part").applyInArrow(search, "tree int, part int, best binary").collect()
    return {(r["tree"], r["part"]): np.frombuffer(bytes(r["best"])).reshape(-1, 7) for r in found}
