"""Boosted trees with subsampling on binned cells, as Spark boosts them, all folds side by side.

Features are binned once and rows equal in all bins, fold and label become one cell with a count. A tree sees a row with the
chance ``rate``, so a cell of n rows has Binomial(n, rate) of them, drawn by hash from (seed, cell, tree). What a tree is fitted to is kept in
whole multiples of 2^-20 (2^-24 where all rows are seen), so sums are exact and trees do not depend on partitions or the order of rows. Small features are
counted together, by the number of their combination of bins.

Cells of up to ``LOCAL`` bytes, what Spark itself would give to one task, are boosted in one task for each run. More stay dealt over
tasks: a level of all runs' trees is one job, whose tasks count their own cells by (run, node, feature, bin), and a run's counts
meet where its splits are searched. The driver sees one line for each open node. Both ways give the same trees.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortwise.models.forest import LOCAL, Copies, Grown
from cohortwise.session import checkpoint_root, note_written, sized

# Cells one task of a level reads, and the combinations of bins that are counted together.
CELLS = 65_536
JOINT = 1024
UNIT, FINE = float(1 << 20), float(1 << 24)
# Rounds after which the margins are written, which cuts their lineage.
ROUNDS = 25


@dataclass
class Run:
    """One boosting run: the fold it leaves out, then its trees, whose counts are (rows, sum of what they are fitted to), and their weights."""

    held_out: int | None = None
    trees: list[Grown] = field(default_factory=list)
    weights: list[float] = field(default_factory=list)
    unit: float = UNIT


@dataclass(frozen=True)
class Plan:
    """What all tasks need to know."""

    sizes: tuple[int, ...]  # bins by feature
    rounds: int
    depth: int
    step: float
    rate: float
    seed: int

    @property
    def unit(self) -> float:
        return UNIT if self.rate < 1 else FINE


class Layout:
    """Groups of features with at most ``JOINT`` combinations of bins, and how their counts fall back to the single features."""

    def __init__(self, sizes: Sequence[int]):
        self.sizes, self.groups, self.joint = list(sizes), [], []
        for f in sorted(range(len(sizes)), key=lambda f: -sizes[f]):
            at = next((g for g, n in enumerate(self.joint) if n * sizes[f] <= JOINT), len(self.groups))
            if at == len(self.groups):
                self.groups.append([])
                self.joint.append(1)
            self.groups[at].append(f)
            self.joint[at] *= sizes[f]
        ends = np.cumsum(sizes)
        self.width, self.most = int(ends[-1]), max(sizes)
        # Places of a feature's bins in a line of counts; past its last bin a place that is always 0.
        self.padded = np.full((len(sizes), self.most), self.width)
        for f, (end, n) in enumerate(zip(ends, sizes)):
            self.padded[f, :n] = np.arange(end - n, end)
        self.back, self.places = [], []
        for group, n in zip(self.groups, self.joint):
            number, columns = np.arange(n), []
            for f in reversed(group):
                number, bin_ = np.divmod(number, sizes[f])
                columns.insert(0, (bin_[:, None] == np.arange(sizes[f])).astype(float))
            self.back.append(np.concatenate(columns, axis=1))
            self.places.append(np.concatenate([self.padded[f, : sizes[f]] for f in group]))

    def codes(self, x: np.ndarray) -> list[np.ndarray]:
        """The combination of bins of each cell in each group."""
        out = []
        for group in self.groups:
            code = np.zeros(len(x), np.int16)
            for f in group:
                code = code * np.int16(self.sizes[f]) + x[:, f].astype(np.int16)
            out.append(code)
        return out

    def sums(self, codes: Sequence[np.ndarray], slot: np.ndarray, nodes: int, copies: np.ndarray, pull: np.ndarray) -> np.ndarray:
        """Rows and their sums by node, place and kind; cells in slot ``nodes`` are left out."""
        out = np.empty((nodes, self.width, 2))
        for code, n, back, places in zip(codes, self.joint, self.back, self.places):
            place = slot * n
            place += code
            for kind, weight in enumerate((copies, pull)):
                joint = np.bincount(place, weight, (nodes + 1) * n)[: nodes * n].reshape(nodes, n)
                out[:, places, kind] = joint @ back
        return out


def best_splits(sums: np.ndarray, layout: Layout, unit: float = UNIT) -> np.ndarray:
    """A line for each node: feature, bin, gain (0: none), rows and sum on the left, rows and sum of the node.

    The gain is the fall of the variance; the first of equal splits wins.
    """
    room = np.concatenate([sums, np.zeros((len(sums), 1, 2))], axis=1)[:, layout.padded]
    left = np.cumsum(room, axis=2)
    whole = left[:, 0, -1]
    left = left[:, :, :-1]
    right = whole[:, None, None] - left
    n, s = whole[:, 0], whole[:, 1] / unit
    if not left.shape[2]:
        return np.column_stack([np.zeros((len(sums), 5)), whole])
    a, b = left[..., 0], right[..., 0]
    gain = (left[..., 1] / unit) ** 2 / np.maximum(a, 1) + (right[..., 1] / unit) ** 2 / np.maximum(b, 1)
    level = s**2 / np.maximum(n, 1)
    # Rounding must not pass for a gain.
    gain = np.where((a > 0) & (b > 0), gain - level[:, None, None], 0.0).reshape(len(sums), -1)
    at, row = gain.argmax(axis=1), np.arange(len(sums))
    feature, bin_ = np.divmod(at, left.shape[2])
    most = gain[row, at]
    most = np.where(most > 1e-12 * level, most / np.maximum(n, 1), 0.0)
    return np.column_stack([feature, bin_, most, left[row, feature, bin_], whole])


def _grown(tree: Grown, opened: np.ndarray, lines: np.ndarray) -> np.ndarray:
    """Split the open nodes by their lines; returns the nodes open next."""
    if len(tree.left) == 1:
        tree.counts[:] = lines[:, 5:]
    good = lines[:, 2] > 0
    children = tree.split(opened[good], lines[good, 0].astype(int), lines[good, 1].astype(int), lines[good, 2], lines[good, 3:5])
    return children[tree.counts[children, 0] > 1]


def _steps(tree: Grown) -> tuple[np.ndarray, ...]:
    """(feature, cut, left) in which a leaf leads to itself, so that all cells take the same steps."""
    leaf = tree.left < 0
    return np.where(leaf, 0, tree.feature), np.where(leaf, 255, tree.cut).astype(np.uint8), np.where(leaf, np.arange(len(leaf)), tree.left)


def _down(x: np.ndarray, start: np.ndarray, node: np.ndarray, steps: tuple[np.ndarray, ...]) -> np.ndarray:
    feature, cut, left = steps
    return left[node] + (x[start + feature[node]] > cut[node])


def _values(tree: Grown, unit: float) -> np.ndarray:
    return tree.counts[:, 1] / np.maximum(tree.counts[:, 0], 1) / unit


def _slots(tree: Grown, opened: np.ndarray) -> np.ndarray:
    slot = np.full(len(tree.left), len(opened))
    slot[opened] = np.arange(len(opened))
    return slot


def _aim(label: np.ndarray, margin: np.ndarray | None, unit: float) -> np.ndarray:
    """What a tree is fitted to, in units: the signed label first, then the log loss's negative gradient."""
    sign = 2.0 * label - 1.0
    if margin is None:
        return sign * unit
    return np.rint(4.0 * sign / (1.0 + np.exp(2.0 * sign * margin)) * unit)


def _law(rate: float):
    """Distribution functions of the binomial laws with this chance, from 0 on."""

    def steps(mean: float) -> np.ndarray:
        n = int(mean)
        if rate >= 1:
            return np.concatenate([np.zeros(n), [1.0]])
        k = np.arange(n + 1)
        logs = np.array([math.lgamma(n + 1.0) - math.lgamma(i + 1.0) - math.lgamma(n - i + 1.0) for i in k])
        out = np.minimum(np.cumsum(np.exp(logs + k * math.log(rate) + (n - k) * math.log1p(-rate))), 1.0)
        out[-1] = 1.0
        return out

    return steps


class _Drawn:
    """Rows of each cell that a tree sees. Counts beyond 65,536 are drawn in pieces of that many."""

    def __init__(self, n: np.ndarray, key: np.ndarray, plan: Plan):
        self.all = n.astype(np.int64) if plan.rate >= 1 else None
        self.rest, self.pieces = Copies(n & 0xFFFF, key, plan.seed, _law(plan.rate)), n >> 16
        self.whole = Copies(np.full(len(n), 1 << 16), key, plan.seed, _law(plan.rate)) if self.pieces.any() else None

    def of(self, number: int) -> np.ndarray:
        if self.all is not None:
            return self.all
        out = self.rest.of(number, np.arange(len(self.pieces)))
        for piece in range(int(self.pieces.max()) if self.whole else 0):
            some = np.flatnonzero(self.pieces > piece)
            out[some] += self.whole.of(number + ((piece + 1) << 32), some)
        return out


def fit_runs(cells: DataFrame, edges: Sequence[Sequence[float]], runs: Sequence[Run], rounds: int, depth: int, step: float, rate: float, seed: int) -> None:
    """Boost all ``runs``; ``cells`` are those of ``forest.cells_of`` with the fold kept; rows of no fold have -1 and only runs over all rows see them."""
    plan = Plan(tuple(len(e) + 1 for e in edges), rounds, depth, step, rate, seed)
    if cells.count() * (len(edges) + 16) <= LOCAL:
        _fit_each(cells, runs, plan)
    else:
        _fit_dealt(cells, runs, plan)
    for run in runs:
        run.weights, run.unit = [1.0] + [step] * (len(run.trees) - 1), plan.unit


# --- one task for each run ------------------------------------------------------


def _fit_each(cells: DataFrame, runs: Sequence[Run], plan: Plan) -> None:
    left_out = F.array(*[F.lit(-2 if run.held_out is None else run.held_out) for run in runs])
    each = cells.select("*", F.posexplode(left_out).alias("run", "out")).filter("out = -2 OR fold >= 0 AND fold <> out").drop("out", "fold")

    def boost(table: pa.Table) -> pa.Table:
        label, n, key = (table.column(c).to_numpy() for c in ("label", "n", "key"))
        x = np.frombuffer(b"".join(table.column("bins").to_pylist()), np.uint8).reshape(len(n), -1)
        trees = _boosted(x, label, n, key, plan)
        lines = [np.column_stack([t.feature, t.cut, t.left, t.gain, t.counts]).tobytes() for t in trees]
        run = table.column("run")[0].as_py()
        return pa.table({"run": pa.array([run] * len(lines), pa.int32()), "tree": pa.array(range(len(lines)), pa.int32()), "nodes": pa.array(lines, pa.binary())})

    # Several ranges a run, so that each run has a task of its own.
    spread = each.repartitionByRange(8 * len(runs), "run")
    for r in sorted(spread.groupBy("run").applyInArrow(boost, "run int, tree int, nodes binary").collect()):
        nodes, tree = np.frombuffer(bytes(r["nodes"])).reshape(-1, 6), Grown()
        tree.feature, tree.cut, tree.left = (nodes[:, i].astype(np.int64) for i in range(3))
        tree.gain, tree.counts = nodes[:, 3], nodes[:, 4:]
        runs[r["run"]].trees.append(tree)


def _boosted(x: np.ndarray, label: np.ndarray, n: np.ndarray, key: np.ndarray, plan: Plan) -> list[Grown]:
    layout, drawn, trees = Layout(plan.sizes), _Drawn(n, key, plan), []
    codes, flat, start = layout.codes(x), np.ascontiguousarray(x).ravel(), np.arange(len(x)) * x.shape[1]
    margin = np.zeros(len(x))
    for number in range(plan.rounds):
        copies = drawn.of(number)
        at = np.flatnonzero(copies)
        taken = copies[at].astype(float)
        pull, own = taken * _aim(label, margin if number else None, plan.unit)[at], [c[at] for c in codes]
        tree, node, opened = Grown(), np.zeros(len(x), np.int64), np.zeros(1, np.int64)
        for _ in range(plan.depth):
            if not len(opened):
                break
            slot = _slots(tree, opened)[node[at]]
            opened = _grown(tree, opened, best_splits(layout.sums(own, slot, len(opened), taken, pull), layout, plan.unit))
            node = _down(flat, start, node, _steps(tree))
        margin += (plan.step if number else 1.0) * _values(tree, plan.unit)[node]
        trees.append(tree)
    return trees


# --- cells dealt over tasks -------------------------------------------------------


def _fit_dealt(cells: DataFrame, runs: Sequence[Run], plan: Plan) -> None:
    sc, width = cells.sparkSession.sparkContext, len(plan.sizes)
    checkpoint_root(cells.sparkSession)
    left_out = np.array([-2 if run.held_out is None else run.held_out for run in runs])

    def pack(batches):
        held = [b for b in batches if len(b)]
        if held:
            n = sum(map(len, held))
            columns = [np.concatenate([b.column(i).to_numpy() for b in held]).astype(k).tobytes() for i, k in ((1, np.int32), (2, np.int32), (3, np.int64), (4, np.int64))]
            yield pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip([n, b"".join(b"".join(b.column(0).to_pylist()) for b in held), *columns], [pa.int64()] + [pa.binary()] * 5)], ["n", "x", "fold", "label", "count", "key"])

    def begun(row):
        fold, label = (np.frombuffer(row[c], np.int32) for c in ("fold", "label"))
        count, key = (np.frombuffer(row[c], np.int64) for c in ("count", "key"))
        x = np.frombuffer(row["x"], np.uint8)
        part = {"x": x, "fold": fold, "label": label, "count": count, "key": key, "margin": np.zeros((len(runs), len(fold)))}
        return {**part, "codes": Layout(plan.sizes).codes(x.reshape(-1, width))}

    def aimed(number: int, trees: list):
        """The state before a round: margins moved by the round before, the rows drawn and what they are fitted to."""

        def move(part):
            margin, start = part["margin"].copy(), np.arange(len(part["label"])) * width
            for r, (steps, values) in enumerate(trees):
                node = np.zeros(len(start), np.int64)
                for _ in range(plan.depth):
                    node = _down(part["x"], start, node, steps)
                margin[r] += (plan.step if number > 1 else 1.0) * values[node]
            copies = _Drawn(part["count"], part["key"], plan).of(number)
            aim = np.stack([_aim(part["label"], m if number else None, plan.unit).astype(np.int32) for m in margin])
            return {**part, "margin": margin, "copies": copies, "aim": aim}

        return move

    def counted(level: int, trees: list):
        def count(parts):
            layout = Layout(plan.sizes)
            for part in parts:
                for r, (steps, slots, nodes) in enumerate(trees):
                    at = np.flatnonzero((part["copies"] > 0) & ((left_out[r] == -2) | (part["fold"] >= 0) & (part["fold"] != left_out[r]))) if nodes else ()
                    if not len(at):
                        continue
                    node, start = np.zeros(len(at), np.int64), at * width
                    for _ in range(level):
                        node = _down(part["x"], start, node, steps)
                    taken = part["copies"][at].astype(float)
                    yield r, layout.sums([c[at] for c in part["codes"]], slots[node], nodes, taken, taken * part["aim"][r][at]).tobytes()

        return count

    def search(found):
        layout, whole = Layout(plan.sizes), {}
        for r, sums in found:
            sums = np.frombuffer(sums)
            whole[r] = whole[r] + sums if r in whole else sums
        for r, sums in whole.items():
            yield r, best_splits(sums.reshape(-1, layout.width, 2), layout, plan.unit)

    dealt = sized(cells, rows=CELLS, size=CELLS * (width + 16))
    state = dealt.select("bins", "fold", "label", "n", "key").mapInArrow(pack, "n bigint, x binary, fold binary, label binary, count binary, key binary").rdd.map(begun)
    last, before = [], None
    for number in range(plan.rounds):
        state = state.map(aimed(number, last)).persist(StorageLevel.MEMORY_AND_DISK)
        if number % ROUNDS == ROUNDS - 1:
            state.checkpoint()
        trees, opened = [Grown() for _ in runs], [np.zeros(1, np.int64) for _ in runs]
        for level in range(plan.depth):
            if not any(map(len, opened)):
                break
            sent = [(_steps(t), _slots(t, o), len(o)) for t, o in zip(trees, opened)]
            found = dict(state.mapPartitions(counted(level, sent)).partitionBy(min(4, len(runs)), int).mapPartitions(search).collect())
            opened = [_grown(t, o, found[r]) if r in found else o[:0] for r, (t, o) in enumerate(zip(trees, opened))]
        if before is not None:
            before.unpersist()
        if state.isCheckpointed():
            note_written(state.getCheckpointFile())
        before = state
        last = [(_steps(t), _values(t, plan.unit)) for t in trees]
        for run, tree in zip(runs, trees):
            run.trees.append(tree)
    if before is not None:
        before.unpersist()
