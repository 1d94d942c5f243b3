"""Standardisation and feature selection scores."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortwise.operators.profile import numeric_columns
from cohortwise.operators.quantiles import grouped_quantiles, no_nan
from cohortwise.session import materialize


def long_form(df: DataFrame, features: Sequence[str], label: str | None = None) -> DataFrame:
    """Rows ``(feature, x)``, with the label as ``__y`` if asked for."""
    kept = [F.col(label).alias("__y")] if label else []
    values = [no_nan(F.col(f"`{c}`")).alias(c) for c in features]
    ids = ["__y"] if label else []
    return df.select(*kept, *values).unpivot(ids, [F.col(f"`{c}`") for c in features], "feature", "x")


# More columns than this are aggregated in long form, where the generated code
# stays small.
WIDE_COLUMNS = 16


def _moments_wide(df: DataFrame, columns: Sequence[str]) -> dict[str, tuple[float, float]]:
    clean = [no_nan(F.col(f"`{c}`")) for c in columns]
    means = [F.avg(v).alias(f"m{i}") for i, v in enumerate(clean)]
    row = df.agg(*means, *[F.stddev_pop(v).alias(f"s{i}") for i, v in enumerate(clean)]).first()
    return {c: (row[f"m{i}"] or 0.0, row[f"s{i}"] or 1.0) for i, c in enumerate(columns)}


def _moments_long(df: DataFrame, columns: Sequence[str]) -> dict[str, tuple[float, float]]:
    long = long_form(df, columns).groupBy("feature").agg(F.avg("x").alias("mean"), F.stddev_pop("x").alias("std"))
    return {r["feature"]: (r["mean"] or 0.0, r["std"] or 1.0) for r in long.collect()}  # one row per column


@dataclass
class Standardizer:
    """Subtract the mean, divide by the population deviation (1 where it is 0).

    Without a column list every numeric column is scaled.
    """

    columns: Sequence[str] | None = None
    stats: dict[str, tuple[float, float]] | None = None

    def fit(self, df: DataFrame) -> Standardizer:
        columns = list(self.columns or numeric_columns(df))
        found = _moments_wide(df, columns) if len(columns) <= WIDE_COLUMNS else _moments_long(df, columns)
        self.stats = {c: found.get(c, (0.0, 1.0)) for c in columns}
        return self

    def transform(self, df: DataFrame) -> DataFrame:
        if self.stats is None:
            raise ValueError("fit the scaler first")
        return df.withColumns(
            {c: (F.col(f"`{c}`").cast("double") - m) / s for c, (m, s) in self.stats.items() if c in df.columns}
        )


def anova_f(df: DataFrame, features: Sequence[str], label: str) -> DataFrame:
    """Between-to-within variance ratio of each feature over the label classes."""
    long = long_form(df, features, label)
    per_class = (
        long.filter(F.col("x").isNotNull() & F.col("__y").isNotNull())
        .groupBy("feature", "__y")
        .agg(F.count("x").alias("n"), F.avg("x").alias("mean"), F.var_pop("x").alias("var"))
    )
    sums = per_class.groupBy("feature").agg(
        F.count(F.lit(1)).alias("k"),
        F.sum("n").alias("n"),
        F.sum(F.col("n") * F.col("mean")).alias("sx"),
        F.sum(F.col("n") * F.col("mean") * F.col("mean")).alias("sxx"),
        F.sum(F.col("n") * F.col("var")).alias("within"),
    )
    between = F.col("sxx") - F.col("sx") * F.col("sx") / F.col("n")
    f_value = F.try_divide(between / (F.col("k") - 1), F.col("within") / (F.col("n") - F.col("k")))
    return sums.filter(F.col("k") > 1).select("feature", "n", f_value.alias("f_value"))


def mutual_information(df: DataFrame, features: Sequence[str], label: str, bins: int = 10) -> DataFrame:
    """Mutual information (nats) between the label and each feature cut at its quantiles."""
    names = {f"q{i}": i / bins for i in range(1, bins)}
    long = long_form(df, features, label).filter(F.col("x").isNotNull() & F.col("__y").isNotNull())
    cuts = grouped_quantiles(long, ["feature"], "x", names)
    # One row per listed feature, so broadcasting it is safe.
    cuts = materialize(cuts.select("feature", F.array_distinct(F.array(*names)).alias("cuts")), "cuts")
    # A value's bin is the number of distinct inner cut points below it.
    below = F.size(F.filter("cuts", lambda edge: edge < F.col("x")))
    cells = (
        long.join(F.broadcast(cuts), "feature")
        .groupBy("feature", below.alias("bin"), "__y")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    cells = materialize(cells, "cells")
    # From here on the table has at most bins x classes rows per feature.
    by_bin = cells.groupBy("feature", "bin").agg(F.sum("n").alias("n_bin"))
    by_label = cells.groupBy("feature", "__y").agg(F.sum("n").alias("n_label"))
    whole = cells.groupBy("feature").agg(F.sum("n").alias("total"))
    joined = cells.join(by_bin, ["feature", "bin"]).join(by_label, ["feature", "__y"]).join(whole, "feature")
    share = F.col("n") / F.col("total")
    term = share * F.log(F.col("n") * F.col("total") / (F.col("n_bin") * F.col("n_label")))
    return joined.groupBy("feature").agg(F.sum(term).alias("mutual_info"))


@dataclass
class FeatureSelector:
    """Union of the ``k`` best features by either score, plus forced ones, in table order.

    Mutual information is estimated by ``neighbours`` nearest neighbours, or over ``bins`` quantile bins if that is None.
    """

    k: int = 50
    forced: Sequence[str] = ()
    bins: int = 10
    neighbours: int | None = 3
    selected: list[str] | None = None

    def fit(self, df: DataFrame, features: Sequence[str], label: str) -> FeatureSelector:
        best = set(self.forced)
        if len(features) <= self.k:
            best |= set(features)
        else:
            scored = anova_f(df, features, label).orderBy(F.desc_nulls_last("f_value"), "feature").limit(self.k)
            if self.neighbours:
                from cohortwise.operators.information import neighbour_information

                informed = neighbour_information(df, features, label, self.neighbours)
            else:
                informed = mutual_information(df, features, label, self.bins)
            informed = informed.orderBy(F.desc("mutual_info"), "feature").limit(self.k)
            best |= {r["feature"] for r in scored.collect()} | {r["feature"] for r in informed.collect()}
        self.selected = [c for c in features if c in best]
        return self

    def transform(self, df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
        if self.selected is None:
            return df
        return df.select(*keep, *[F.col(f"`{c}`") for c in self.selected if c in df.columns])
