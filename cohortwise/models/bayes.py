"""Gaussian naive Bayes from moments by fold: one pass over the rows gives the models of all training folds.

Counts, means and squared deviations are kept per (fold, label, feature). The
training rows of a fold are all the other folds, so their moments are those folds'
moments merged, and no fold's own rows take part.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Sequence
from dataclasses import dataclass
from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortwise.models.frame import FOLD, LABEL

# Share of the largest variance that is added to all, so that none is 0.
SMOOTHING = 1e-9


@dataclass
class Moments:
    """Rows, means and summed squared deviations of several features."""

    n: float
    mean: np.ndarray
    square: np.ndarray

    def __add__(self, other: Moments) -> Moments:
        n = self.n + other.n
        if not n:
            return self
        step = other.mean - self.mean
        return Moments(n, self.mean + step * (other.n / n), self.square + other.square + step**2 * (self.n * other.n / n))


def fold_moments(frame: DataFrame) -> dict[tuple[int, int], Moments]:
    """Moments by (fold, label); without a fold column everything is fold -1. The driver sees (folds x 2 x features) rows."""
    fold = F.col(FOLD) if FOLD in frame.columns else F.lit(-1)
    each = frame.select(fold.cast("int").alias("fold"), F.col(LABEL).alias("label"), F.posexplode("values").alias("feature", "x"))
    rows = each.groupBy("fold", "label", "feature").agg(F.count("x").alias("n"), F.avg("x").alias("mean"), F.var_pop("x").alias("var")).collect()
    width = max((r["feature"] for r in rows), default=-1) + 1
    out: dict[tuple[int, int], Moments] = {}
    for r in rows:
        one = out.setdefault((r["fold"], r["label"]), Moments(r["n"], np.zeros(width), np.zeros(width)))
        one.mean[r["feature"]], one.square[r["feature"]] = r["mean"], r["var"] * r["n"]
    return out


def merged(parts: Iterable[Moments], width: int) -> Moments:
    return reduce(Moments.__add__, parts, Moments(0, np.zeros(width), np.zeros(width)))


@dataclass
class Gaussians:
    """Per label the rows, means and variances."""

    rows: list[float]
    means: list[list[float]]
    variances: list[list[float]]

    @classmethod
    def of(cls, moments: dict[tuple[int, int], Moments], left_out: int | None = None) -> Gaussians:
        """The model of all folds but one."""
        width = len(next(iter(moments.values())).mean)
        kept = {key: m for key, m in moments.items() if key[0] != left_out}
        labels = [merged((m for (_, label), m in sorted(kept.items()) if label == y), width) for y in (0, 1)]
        whole = labels[0] + labels[1]
        smoothing = SMOOTHING * float((whole.square / max(whole.n, 1)).max(initial=0.0))
        return cls([m.n for m in labels], [m.mean.tolist() for m in labels], [(m.square / max(m.n, 1) + smoothing).tolist() for m in labels])

    def prob(self) -> Column:
        """The probability of label 1 over a row's value array; a label without rows has none."""
        if not all(self.rows):
            return F.lit(float(bool(self.rows[1])))
        sides = []
        for y in (0, 1):
            fixed = math.log(self.rows[y] / sum(self.rows)) - 0.5 * sum(math.log(2 * math.pi * v) for v in self.variances[y])
            terms = [(F.col("values")[i] - m) * (F.col("values")[i] - m) / (2 * v) for i, (m, v) in enumerate(zip(self.means[y], self.variances[y]))]
            sides.append(F.lit(fixed) - sum(terms[1:], terms[0]))
        return 1.0 / (1.0 + F.exp(sides[0] - sides[1]))


def fit(frame: DataFrame, left_out: Sequence[int | None] = (None,)) -> list[Gaussians]:
    """One model for each fold to leave out (None: none), from one pass."""
    moments = fold_moments(frame)
    return [Gaussians.of(moments, fold) for fold in left_out]
