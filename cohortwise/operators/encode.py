"""Turning categories into numbers."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cohortwise.operators.joins import attach
from cohortwise.operators.prefix import running_totals
from cohortwise.session import materialize

# Least share of the rows for a column of its own in one-hot encoding, and what rarer values are called.
MIN_SHARE = 1 / 1000
RARE = "Rare"
# Vocabularies up to this counted size are numbered in one task.
ONE_TASK_VALUES = 100_000


def onehot_name(column: str, value) -> str:
    return f"{column}_{value}"


def onehot_fixed(df: DataFrame, categories: dict[str, Sequence]) -> DataFrame:
    """A 0/1 column per listed category; a null value is 0 everywhere."""
    types = dict(df.dtypes)
    as_text = {c: F.col(c) if types[c] == "string" else F.col(c).cast("string") for c in categories}
    return df.withColumns(
        {
            onehot_name(c, v): F.when(as_text[c] == str(v), 1).otherwise(0)
            for c, values in categories.items()
            for v in values
        }
    )


@dataclass
class OneHot:
    """One-hot encoding with the categories learned at fit.

    A value gets a column of its own if it holds at least ``min_share`` of the
    column's non-null rows, so there are at most ``1 / min_share`` columns
    whatever the vocabulary. All rarer values known at fit share the column
    ``<column>_Rare``, if there are any. Values first seen later get 0
    everywhere, missing ones still get their column, so every table comes out
    with the same columns.
    """

    columns: Sequence[str]
    drop_first: bool = False
    min_share: float = MIN_SHARE
    categories: dict[str, list[str]] | None = None
    rare: dict[str, DataFrame] = field(default_factory=dict)

    def fit(self, df: DataFrame) -> OneHot:
        long = df.select(*[F.col(c).cast("string").alias(c) for c in self.columns]).unpivot(
            [], list(self.columns), "column", "value"
        )
        counts = materialize(long.filter(F.col("value").isNotNull()).groupBy("column", "value").agg(F.count(F.lit(1)).alias("__n")), "categories")
        totals = {r["column"]: (r["n"], r["values"]) for r in counts.groupBy("column").agg(F.sum("__n").alias("n"), F.count(F.lit(1)).alias("values")).collect()}
        least = F.lit(None).cast("double")
        for column, (n, _) in totals.items():
            least = F.when(F.col("column") == column, F.lit(n * self.min_share)).otherwise(least)
        found: dict[str, list[str]] = {c: [] for c in self.columns}
        for row in counts.filter(F.col("__n") >= least).select("column", "value").collect():
            found[row["column"]].append(row["value"])
        self.categories, self.rare = {}, {}
        for column, values in found.items():
            values.sort()
            if len(values) < totals.get(column, (0, 0))[1]:
                own = counts.filter((F.col("column") == column) & (F.col("__n") < least))
                self.rare[column] = own.select("value", F.lit(1).alias("__rare"))
            self.categories[column] = values[1:] if self.drop_first else values
        return self

    @property
    def names(self) -> list[str]:
        out = []
        for c, values in (self.categories or {}).items():
            out += [onehot_name(c, v) for v in values] + ([onehot_name(c, RARE)] if c in self.rare and RARE not in values else [])
        return out

    def transform(self, df: DataFrame) -> DataFrame:
        if self.categories is None:
            raise ValueError("fit the encoder first")
        coded = onehot_fixed(df, self.categories)
        for column, table in self.rare.items():
            name = onehot_name(column, RARE)
            keyed = coded.withColumn("__value", F.col(column).cast("string"))
            joined = attach(keyed, table.withColumnRenamed("value", "__value"), ["__value"]).drop("__value")
            known = F.col(name) if name in coded.columns else F.lit(0)
            coded = joined.withColumn(name, F.greatest(known, F.coalesce("__rare", F.lit(0)))).drop("__rare")
        return coded


@dataclass
class LabelCodes:
    """Replace a category by its position among the sorted values seen at fit.

    Unseen values get -1. The vocabulary may be of any size: beyond a counted
    bound, positions come from a two-level running count.
    """

    columns: Sequence[str]
    suffix: str = "_encoded"
    tables: dict[str, DataFrame] = field(default_factory=dict)

    def fit(self, df: DataFrame) -> LabelCodes:
        for column in self.columns:
            counts = (
                df.select(F.col(column).cast("string").alias("value"))
                .filter(F.col("value").isNotNull())
                .groupBy("value")
                .agg(F.count(F.lit(1)).alias("__n"))
            )
            counts = materialize(counts, "vocabulary")
            if counts.count() <= ONE_TASK_VALUES:
                position = F.row_number().over(Window.orderBy("value"))
                placed = counts.withColumn("position", position)
            else:
                placed = running_totals(counts, [], [F.col("value")], {"position": F.lit(1)})
            table = placed.select("value", "__n", (F.col("position") - 1).cast("int").alias("code"))
            self.tables[column] = materialize(table, "codes")
        return self

    def transform(self, df: DataFrame) -> DataFrame:
        for column in self.columns:
            name = column + self.suffix
            if column not in self.tables:
                df = df.withColumn(name, F.lit(0))
                continue
            table = self.tables[column].select(F.col("value").alias("__value"), "__n", F.col("code").alias(name))
            keyed = df.withColumn("__value", F.col(column).cast("string"))
            df = attach(keyed, table, ["__value"], rows="__n").drop("__value")
            df = df.withColumn(name, F.coalesce(F.col(name), F.lit(-1)))
        return df


@dataclass
class RareGroups:
    """Replace categories seen fewer than ``threshold`` times at fit by one name."""

    columns: Sequence[str]
    threshold: int = 10
    name: str = "Rare"
    tables: dict[str, DataFrame] = field(default_factory=dict)

    def fit(self, df: DataFrame) -> RareGroups:
        for column in self.columns:
            counts = df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("__n"))
            kept = counts.withColumn("__rare", F.col("__n") < self.threshold)
            self.tables[column] = materialize(kept, "counts")
        return self

    def transform(self, df: DataFrame) -> DataFrame:
        for column in self.columns:
            df = attach(df, self.tables[column], [column], rows="__n")
            df = df.withColumn(column, F.when(F.col("__rare"), F.lit(self.name)).otherwise(F.col(column))).drop("__rare")
        return df


def align_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Exactly the given columns in the given order; absent ones are 0."""
    return df.select(*[F.col(f"`{c}`") if c in df.columns else F.lit(0).alias(c) for c in columns])
