"""Adaptive boosting of one-split trees on a binned count layout, many boosting runs side by side.

Features are binned once and equal rows become one cell with a count. Cells of up to ``LOCAL`` bytes go to all tasks, each boosting
some of the runs. Of more cells every round is one grouped sum of the cells' weights by (feature, bin) for all runs, from
which the driver picks each run's split; weights move in Arrow batches by the splits found since the
state was last written, so every round has the same plan. Runs differ in learning rate and in the fold they leave out, so a
whole search with cross-validation costs the jobs of its longest run.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortwise.models.frame import FOLD, LABEL
from cohortwise.operators.quantiles import ACCURACY, DIRECT_ROWS, grouped_quantiles
from cohortwise.session import materialize, once, sized

BINS = 32
# Splits of all runs that may be pending; then the state is written.
TERMS = 400
# Gains that agree in so many decimals are ties: the first feature and bin of them win.
DECIMALS = 9
# Bytes of cells that one task may hold, as many as Spark itself would give it.
LOCAL = 64 << 20


@dataclass
class Run:
    """One boosting run: its rate and the fold it leaves out, then its splits (feature, edge, left, right) and weights."""

    rate: float = 1.0
    held_out: int | None = None
    stumps: list[tuple[int, float, int, int]] = field(default_factory=list)
    alphas: list[float] = field(default_factory=list)
    errors: list[float] = field(default_factory=list)
    open: bool = True

    def copy(self) -> Run:
        return Run(self.rate, self.held_out, [*self.stumps], [*self.alphas], [*self.errors], self.open)

    def first(self, rounds: int) -> Run:
        """The run as it was after so many rounds."""
        return Run(self.rate, self.held_out, self.stumps[:rounds], self.alphas[:rounds], self.errors[:rounds], False)


def bin_edges(frame: DataFrame, bins: int = BINS, direct_rows: int = DIRECT_ROWS) -> list[list[float]]:
    """Per feature at most ``bins - 1`` edges: midpoints of neighbouring values if these are few, else quantiles.

    Exact over all rows; features of up to ``direct_rows`` values (four times ``ACCURACY`` at least) are sorted whole. What reaches the driver is bounded by the numbers of features and bins.
    """
    each = frame.select(F.posexplode("values").alias("feature", "x"))
    sizes = each.groupBy("feature").agg(F.approx_count_distinct("x").alias("n"), F.count(F.when(~F.isnan("x"), 1)).alias("rows")).collect()
    kinds = {r["feature"]: r["n"] for r in sizes}
    few = [f for f, n in kinds.items() if n <= 2 * bins]
    values: dict[int, list[float]] = {}
    for r in each.filter(F.col("feature").isin(few)).distinct().collect():
        values.setdefault(r["feature"], []).append(r["x"])
    small = {f: sorted(v) for f, v in values.items() if len(v) <= bins}
    edges = {f: [(a + b) / 2 for a, b in zip(v, v[1:])] for f, v in small.items()}
    wide = [f for f in kinds if f not in small]
    rows = {r["feature"]: r["rows"] for r in sizes if r["feature"] in wide}
    short, long = ([f for f in wide if (rows[f] <= direct_rows) == side] for side in (True, False))
    if short:
        shares = {f"q{i}": i / bins for i in range(1, bins)}
        for r in grouped_quantiles(each.filter(F.col("feature").isin(short)), ["feature"], "x", shares).collect():
            edges[r["feature"]] = sorted({r[q] for q in shares})
    if long:
        edges.update(_quantile_edges(frame, {f: rows[f] for f in long}, [i / bins for i in range(1, bins)]))
    return [edges[f] for f in sorted(edges)]


def edges_of(frame: DataFrame, bins: int = BINS) -> list[list[float]]:
    """:func:`bin_edges`, found once for all models that are fitted to this frame."""
    return once(frame, ("edges", bins), lambda: bin_edges(frame, bins))


def _quantile_edges(frame: DataFrame, rows: dict[int, int], shares: Sequence[float]) -> dict[int, list[float]]:
    """Exact quantiles of whole features, as ``grouped_quantiles`` gives them, from one walk over the value arrays.

    A sketch gives a bracket around each quantile. Tasks sort each batch once, count what lies below every bracket and send on
    only what lies inside, equal values as one line; each bracket's lines are put in order where they meet.
    """
    slack, features = 2.0 / ACCURACY, sorted(rows)
    points = [q for p in shares for q in (max(p - slack, 0.0), min(p + slack, 1.0))]
    sketch = [F.percentile_approx(F.when(~F.isnan(F.col("values")[f]), F.col("values")[f]), points, ACCURACY).alias(f"f{f}") for f in features]
    found = frame.agg(*sketch).first()
    brackets = {f: (np.array(found[f"f{f}"][::2]), np.array(found[f"f{f}"][1::2])) for f in features}

    def run(batches):
        for batch in batches:
            if not len(batch):
                continue
            x = batch.column(0).flatten().to_numpy(zero_copy_only=False).reshape(len(batch), -1)
            out = []
            for f, (low, high) in brackets.items():
                values = np.sort(x[~np.isnan(x[:, f]), f])
                first, last = np.searchsorted(values, low, side="left"), np.searchsorted(values, high, side="right")
                for i, (a, b) in enumerate(zip(first, last)):
                    inside, n = np.unique(values[a:b], return_counts=True)
                    out.append((np.full(len(n) + 1, f), np.full(len(n) + 1, i), np.append(inside, np.nan), np.append(n, a)))
            columns = [pa.array(np.concatenate(c), k) for c, k in zip(zip(*out), (pa.int32(), pa.int32(), pa.float64(), pa.int64()))]
            yield pa.RecordBatch.from_arrays(columns, ["feature", "bracket", "x", "n"])

    def pick(table: pa.Table) -> pa.Table:
        f, i = table.column("feature")[0].as_py(), table.column("bracket")[0].as_py()
        x, n = (table.column(c).to_numpy() for c in ("x", "n"))
        below, inside = int(n[np.isnan(x)].sum()), ~np.isnan(x)
        order = np.argsort(x[inside], kind="stable")
        upto, position = below + np.cumsum(n[inside][order]), shares[i] * (rows[f] - 1)
        ranks = [math.floor(position), math.ceil(position)]
        if ranks[0] < below or not len(upto) or ranks[1] >= upto[-1]:
            raise ValueError("quantile outside its bracket")
        least, most = x[inside][order][np.searchsorted(upto, ranks, side="right")]
        part = position - ranks[0]
        value = least if least == most else (1 - part) * least + part * most
        return pa.table({"feature": pa.array([f], pa.int32()), "edge": pa.array([value], pa.float64())})

    lines = frame.select("values").mapInArrow(run, "feature int, bracket int, x double, n bigint")
    out: dict[int, set[float]] = {}
    for r in lines.groupBy("feature", "bracket").applyInArrow(pick, "feature int, edge double").collect():
        out.setdefault(r["feature"], set()).add(r["edge"])
    return {f: sorted(v) for f, v in out.items()}


def _bin(feature: int, edges: Sequence[float]) -> Column:
    if not edges:
        return F.lit(0)
    return F.aggregate(F.lit(list(map(float, edges))), F.lit(0), lambda acc, edge: acc + (F.col("values")[feature] > edge).cast("int"))


def cells_of(frame: DataFrame, edges: Sequence[Sequence[float]]) -> DataFrame:
    """(bins, fold, label, n): the rows of each combination of bins, counted once. Bin b holds values up to edge b."""
    placed = [_bin(i, e) for i, e in enumerate(edges)]
    fold = F.col(FOLD) if FOLD in frame.columns else F.lit(-1)
    rows = frame.select(F.array(*placed).alias("bins"), fold.cast("int").alias("fold"), F.col(LABEL).cast("int").alias("label"))
    return sized(materialize(rows.groupBy("bins", "fold", "label").agg(F.count(F.lit(1)).cast("double").alias("n")), "cells"))


def _best(sums: np.ndarray, tie: int = DECIMALS) -> tuple[int, int, int, int, float]:
    """(feature, bin, left, right, error) of the split with the largest Gini gain.

    ``sums`` has the weight by feature, bin and label. Each side votes for its heavier label, 0 if equal.
    """
    total = sums[0].sum()
    left = np.cumsum(sums, axis=1)[:, :-1]
    whole = sums[0].sum(axis=0)
    right = whole - left

    def purity(side: np.ndarray) -> np.ndarray:
        weight = side.sum(axis=2)
        return np.where(weight > 0, (side**2).sum(axis=2) / np.where(weight > 0, weight, 1), 0.0)

    filled = (left.sum(axis=2) > 0) & (right.sum(axis=2) > 1e-12 * total)
    gain = np.where(filled, np.round((purity(left) + purity(right)) / total, tie), -1.0)
    feature, bin_ = (int(i) for i in np.unravel_index(int(np.argmax(gain)), gain.shape)) if gain.size else (0, 0)
    if not gain.size or gain[feature, bin_] < 0:  # nothing can be cut
        vote = int(whole[1] > whole[0])
        return 0, 0, vote, vote, float(whole[1 - vote] / total)
    sides = left[feature, bin_], right[feature, bin_]
    votes = [int(s[1] > s[0]) for s in sides]
    return feature, bin_, *votes, float(sum(s[1 - v] for s, v in zip(sides, votes)) / total)


def fit_runs(cells: DataFrame, edges: Sequence[Sequence[float]], runs: Sequence[Run], rounds: int, stages: Sequence[int] = ()) -> dict[int, list[float | None]]:
    """Boost all ``runs`` for ``rounds`` rounds; returns, for each round in ``stages``, the accuracy of each run on its held-out fold.

    Cells of up to ``LOCAL`` bytes are boosted in one job. Of more it is one grouped sum a round, one for each stage, and one write
    whenever ``TERMS`` splits have gathered; the driver sees (features x bins x 2) rows with one number for each run.
    """
    width = max(len(e) for e in edges) + 1
    if cells.count() * (4 * len(edges) + 24) <= LOCAL:
        return _fit_each(cells, edges, runs, rounds, stages, width)
    state, pending = cells.withColumn("s", F.array(*[F.lit(0.0)] * len(runs))), [[] for _ in runs]
    shifts = [0.0] * len(runs)
    every = max(5, TERMS // len(runs))
    marks: dict[int, list[float | None]] = {}
    for number in range(1, rounds + 1):
        if any(run.open for run in runs):
            _round(state, edges, runs, shifts, pending, width)
        if max(map(len, pending)) >= every:
            state = sized(materialize(_moved(state, pending), "boosted"))
            pending = [[] for _ in runs]
        if number in stages:
            marks[number] = _held_out_accuracy(_moved(state, pending), runs)
    return marks


def _fit_each(cells: DataFrame, edges: Sequence[Sequence[float]], runs: Sequence[Run], rounds: int, stages: Sequence[int], width: int) -> dict[int, list[float | None]]:
    """All rounds of a run in one task, which holds all cells; they are put in order first, so sums do not depend on where they came from."""
    tasks = min(len(runs), cells.sparkSession.sparkContext.defaultParallelism)
    features = len(edges)

    def some(table: pa.Table) -> pa.Table:
        bins = np.concatenate([c.flatten().to_numpy() for c in table.column("bins").chunks]).reshape(-1, features)
        fold, label, n = (table.column(c).to_numpy() for c in ("fold", "label", "n"))
        order = np.lexsort((fold, label, *bins.T[::-1]))
        bins, fold, label, n = bins[order], fold[order], label[order], n[order]
        at, out = [b * 2 + label for b in bins.T], []
        for number in range(table.column("task")[0].as_py(), len(runs), tasks):
            run, shifts = runs[number].copy(), [0.0]
            inside = np.zeros(len(n), bool) if run.held_out is None else fold == run.held_out
            kept, s, marks = np.where(inside, 0.0, n), np.zeros(len(n)), []
            for round_ in range(1, rounds + 1):
                if run.open:
                    weight, pending = kept * np.exp(s - shifts[0]), [[]]
                    sums = np.stack([np.bincount(a, weight, 2 * width) for a in at]).reshape(features, width, 2)
                    _grown([sums], edges, [run], shifts, pending)
                    for (feature, bin_, left, right), alpha in pending[0]:
                        s += alpha * (np.where(bins[:, feature] <= bin_, left, right) != label)
                if round_ in stages:
                    half = sum(run.alphas) / 2
                    right = np.where(label == 1, s < half, s <= half)
                    marks.append(float(n[inside & right].sum() / n[inside].sum()) if inside.any() else None)
            feature, edge, left, right = map(list, zip(*run.stumps)) if run.stumps else ([], [], [], [])
            out.append((number, feature, edge, left, right, run.alphas, run.errors, run.open, marks))
        return pa.table([pa.array(c, k) for c, k in zip(zip(*out), _RUN.values())], list(_RUN))

    every = cells.select("bins", "fold", "label", "n", F.explode(F.array(*map(F.lit, range(tasks)))).alias("task"))
    # Several ranges for each number, so that each has a task of its own.
    found = every.repartitionByRange(8 * tasks, "task").groupBy("task").applyInArrow(some, _RUNS).collect()
    marks: dict[int, list[float | None]] = {stage: [None] * len(runs) for stage in stages if stage <= rounds}
    for r in found:
        run = runs[r["run"]]
        run.stumps, run.alphas, run.errors, run.open = list(zip(r["feature"], r["edge"], r["left"], r["right"])), list(r["alphas"]), list(r["errors"]), r["open"]
        for stage, mark in zip(sorted(marks), r["marks"]):
            marks[stage][r["run"]] = mark
    return marks


_RUN = {
    "run": pa.int32(), "feature": pa.list_(pa.int32()), "edge": pa.list_(pa.float64()), "left": pa.list_(pa.int32()), "right": pa.list_(pa.int32()),
    "alphas": pa.list_(pa.float64()), "errors": pa.list_(pa.float64()), "open": pa.bool_(), "marks": pa.list_(pa.float64()),
}
_RUNS = (
    "run int, feature array<int>, edge array<double>, left array<int>, right array<int>, alphas array<double>, errors array<double>, open boolean, marks array<double>"
)


def _read(batch: pa.RecordBatch, pending: list[list]) -> tuple[np.ndarray, ...]:
    """(bins, fold, label, n, s) of a batch of the state, with the pending splits' misses added to s."""
    bins, s = (batch.column(i).flatten().to_numpy(zero_copy_only=False).reshape(len(batch), -1).copy() for i in (0, 4))
    fold, label, n = (batch.column(i).to_numpy(zero_copy_only=False) for i in (1, 2, 3))
    for c, splits in enumerate(pending):
        for (feature, bin_, left, right), alpha in splits:
            s[:, c] += alpha * (np.where(bins[:, feature] <= bin_, left, right) != label)
    return bins, fold, label, n, s


_STATE = "bins array<int>, fold int, label int, n double, s array<double>"


def _moved(state: DataFrame, pending: list[list]) -> DataFrame:
    def run(batches):
        for batch in batches:
            s = _read(batch, pending)[4]
            edges = pa.array(np.arange(0, s.size + 1, s.shape[1]), pa.int32())
            yield pa.RecordBatch.from_arrays([*batch.columns[:4], pa.ListArray.from_arrays(edges, pa.array(s.ravel()))], ["bins", "fold", "label", "n", "s"])

    return state.select("bins", "fold", "label", "n", "s").mapInArrow(run, _STATE)


def _sums(state: DataFrame, runs: Sequence[Run], shifts: list[float], pending: list[list], features: int, width: int) -> np.ndarray:
    """Weights by run, feature, bin and label. Tasks add up their own, so each sends (features x bins x 2) rows."""
    left_out = np.array([-2 if run.held_out is None else run.held_out for run in runs])

    def run(batches):
        total = np.zeros((features, width * 2, len(left_out)))
        for batch in batches:
            if not len(batch):
                continue
            bins, fold, label, n, s = _read(batch, pending)
            weight = n[:, None] * np.exp(s - np.array(shifts)) * (fold[:, None] != left_out)
            for f in range(features):
                order = np.argsort(at := bins[:, f] * 2 + label, kind="stable")
                firsts = np.flatnonzero(np.diff(at[order], prepend=-1))
                total[f, at[order[firsts]]] += np.add.reduceat(weight[order], firsts)
        f, at = np.nonzero(total.any(axis=2))
        columns = [pa.array(f.astype(np.int32)), pa.array(at.astype(np.int32)), *[pa.array(total[f, at, c]) for c in range(len(left_out))]]
        yield pa.RecordBatch.from_arrays(columns, ["feature", "at", *[f"w{c}" for c in range(len(left_out))]])

    names = [f"w{c}" for c in range(len(runs))]
    parts = state.select("bins", "fold", "label", "n", "s").mapInArrow(run, "feature int, at int, " + ", ".join(f"{n} double" for n in names))
    out = np.zeros((len(runs), features, width * 2))
    for r in parts.groupBy("feature", "at").agg(*[F.sum(n).alias(n) for n in names]).collect():
        out[:, r["feature"], r["at"]] = r[2:]
    return out.reshape(len(runs), features, width, 2)


def _round(state: DataFrame, edges, runs, shifts, pending, width) -> None:
    _grown(_sums(state, runs, shifts, pending, len(edges), width), edges, runs, shifts, pending)


def _grown(sums: Sequence[np.ndarray], edges, runs, shifts, pending) -> None:
    """Give every open run its next split, from its weights by feature, bin and label."""
    for c, run in enumerate(runs):
        if not run.open:
            continue
        total = sums[c][0].sum()
        if total <= 0:
            run.open = False
            continue
        feature, bin_, left, right, error = _best(sums[c])
        if error >= 0.5:
            run.open = False
            if run.stumps:
                continue
        alpha = 1.0 if error >= 0.5 else run.rate * math.log((1 - error) / max(error, 1e-10))
        edge = edges[feature][bin_] if bin_ < len(edges[feature]) else math.inf
        run.stumps.append((feature, float(edge), left, right))
        run.alphas.append(alpha)
        run.errors.append(error)
        run.open &= error > 0
        pending[c].append(((feature, bin_, left, right), alpha))
        # Keeps the weights near the counts: the next total is this one times (1 - error + error * e^alpha).
        shifts[c] += math.log(1 - error + error * math.exp(alpha))


def _held_out_accuracy(state: DataFrame, runs: Sequence[Run]) -> list[float | None]:
    """A row is right if less than half of the votes' weight is against it; label 0 also wins a draw."""
    parts = []
    for c, run in enumerate(runs):
        half = F.lit(sum(run.alphas) / 2)
        right = F.when(F.col("label") == 1, F.col("s")[c] < half).otherwise(F.col("s")[c] <= half)
        inside = F.col("fold") == (run.held_out if run.held_out is not None else -2)
        parts += [F.sum(F.when(inside & right, F.col("n"))), F.sum(F.when(inside, F.col("n")))]
    row = state.agg(*[p.alias(f"a{i}") for i, p in enumerate(parts)]).first()
    return [(row[2 * c] or 0.0) / row[2 * c + 1] if row[2 * c + 1] else None for c in range(len(runs))]


def margin(run: Run) -> Column:
    """The votes' weighted mean in [-1, 1] over a row's value array."""
    votes = [F.lit(a) * F.when(F.col("values")[f] <= edge, 2 * left - 1).otherwise(2 * right - 1) for (f, edge, left, right), a in zip(run.stumps, run.alphas)]
    return sum(votes[1:], votes[0]) / (sum(run.alphas) or 1.0)
