"""Filling gaps from grouped statistics.

Every imputer is fitted once (``fit`` runs Spark jobs and keeps small stat
tables) and then applied to any table as a lazy projection with left joins.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortwise.operators.joins import attach
from cohortwise.operators.quantiles import grouped_median, no_nan
from cohortwise.session import materialize


def mode_table(df: DataFrame, column: str) -> DataFrame:
    """The most frequent value of a column (smallest on ties), one row."""
    counts = df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    top = F.min(F.struct((-F.col("n")).alias("neg"), F.col(column).alias("value")))
    return counts.agg(top["value"].alias("mode"), (-top["neg"]).alias("n"))


def column_mode(df: DataFrame, column: str, default=None):
    row = mode_table(df, column).first()
    return default if row["mode"] is None else row["mode"]


@dataclass
class MedianImputer:
    """Fill a numeric column by group medians, most specific level first.

    ``levels`` lists the key columns per level; an empty level is the whole
    table. With ``staged`` each further level is computed on the table as the
    earlier levels left it, otherwise all levels see the original values.
    """

    value: str
    levels: Sequence[Sequence[str]]
    staged: bool = False
    tables: list[DataFrame] = field(default_factory=list)

    def fit(self, df: DataFrame) -> MedianImputer:
        if not self.staged:
            found = medians_by_levels(df, self.value, self.levels, "__median", "__rows")
            every = materialize(found, "medians")
            self.tables = [
                every.filter(F.col("level") == i).select(*level, "__median", "__rows")
                for i, level in enumerate(self.levels)
            ]
            return self
        self.tables = []
        current = df
        for level in self.levels:
            medians = materialize(grouped_median(current, level, self.value, "__median", rows="__rows"), "medians")
            self.tables.append(medians)
            current = self._fill(current, level, medians)
        return self

    def transform(self, df: DataFrame) -> DataFrame:
        if not self.tables:
            raise ValueError("fit the imputer first")
        for level, medians in zip(self.levels, self.tables):
            df = self._fill(df, level, medians)
        return df

    def _fill(self, df: DataFrame, level: Sequence[str], medians: DataFrame) -> DataFrame:
        columns = df.columns
        if level:
            joined = attach(df, medians, level, rows="__rows")
        else:
            row = medians.first()
            joined = df.withColumn("__median", F.lit(row["__median"] if row else None).cast("double"))
        filled = F.coalesce(no_nan(F.col(self.value)), F.col("__median"))
        return joined.withColumn(self.value, filled).select(*columns)


def medians_by_levels(
    df: DataFrame, value: str, levels: Sequence[Sequence[str]], name: str = "median", rows: str = "n"
) -> DataFrame:
    """Medians of several key levels from one pass over the table.

    A row enters every level it has all keys for; columns a level leaves out
    are null, and ``level`` numbers the levels in the given order.
    """
    columns = list(dict.fromkeys(k for level in levels for k in level))
    typed = {c: df.schema[c].dataType for c in columns}
    entries = []
    for i, level in enumerate(levels):
        fields = [F.lit(i).alias("level")]
        fields += [(F.col(c) if c in level else F.lit(None).cast(typed[c])).alias(c) for c in columns]
        present = F.lit(True)
        for c in level:
            present = present & F.col(c).isNotNull()
        entries.append(F.when(present, F.struct(*fields)))
    long = (
        df.select(F.col(value), F.explode(F.array(*entries)).alias("__k"))
        .filter(F.col("__k").isNotNull())
        .select(value, *[F.col(f"__k.{c}").alias(c) for c in ["level", *columns]])
    )
    return grouped_median(long, ["level", *columns], value, name, keep_null_keys=True, rows=rows)


@dataclass
class ModeImputer:
    """Fill a category with its most frequent value."""

    column: str
    default: str | None = None
    value: object = None
    fitted: bool = False

    def fit(self, df: DataFrame) -> ModeImputer:
        self.value = column_mode(df, self.column, self.default)
        self.fitted = True
        return self

    def transform(self, df: DataFrame) -> DataFrame:
        if not self.fitted:
            raise ValueError("fit the imputer first")
        return df.withColumn(self.column, F.coalesce(F.col(self.column), F.lit(self.value)))


@dataclass
class NearestMedianImputer:
    """Fill a category with the one whose median amount, among rows of the same
    group, lies closest to the row's amount.

    ``categories`` is the fixed, ordered candidate list; earlier entries win
    ties. Groups without any candidate fall back to the column's mode.
    """

    column: str
    group: str
    amount: str
    categories: Sequence[str]
    default: str | None = None
    table: DataFrame | None = None
    mode: object = None

    def fit(self, df: DataFrame) -> NearestMedianImputer:
        known = df.filter(F.col(self.column).isin(*self.categories))
        medians = materialize(grouped_median(known, [self.group, self.column], self.amount), "medians")
        rank = F.array_position(F.array(*[F.lit(c) for c in self.categories]), F.col(self.column))
        # At most one entry per listed category ends up in a group's array.
        entry = F.struct(rank.alias("rank"), F.col(self.column).alias("category"), F.col("median").alias("median"))
        per_group = medians.groupBy(self.group).agg(F.sort_array(F.collect_list(entry)).alias("__candidates"))
        self.table = materialize(per_group, "candidates")
        self.mode = column_mode(df, self.column, self.default)
        return self

    def transform(self, df: DataFrame) -> DataFrame:
        if self.table is None:
            raise ValueError("fit the imputer first")
        columns = df.columns
        joined = attach(df, self.table, [self.group])
        distances = F.transform(
            F.col("__candidates"),
            lambda c: F.struct(
                F.abs(c["median"] - F.col(self.amount)).alias("distance"),
                c["rank"].alias("rank"),
                c["category"].alias("category"),
            ),
        )
        nearest = F.array_min(distances)["category"]
        filled = F.coalesce(F.col(self.column), nearest, F.lit(self.mode))
        return joined.withColumn(self.column, filled).select(*columns)


def fill_from_map(df: DataFrame, column: str, by: str, values: dict[str, float]) -> DataFrame:
    """Fill gaps with a constant chosen by another column."""
    constant = F.lit(None).cast("double")
    for key, value in values.items():
        constant = F.when(F.col(by) == key, F.lit(float(value))).otherwise(constant)
    return df.withColumn(column, F.coalesce(F.col(column), constant))


# Typical age per title, in two variants.
AGE_BY_TITLE = {"Mr": 32.32, "Miss": 21.68, "Mrs": 35.86, "Master": 4.57, "Officer": 49.0}
AGE_BY_RAW_TITLE = {"Mr": 32.32, "Miss": 21.68, "Mrs": 35.86, "Master": 4.57, "Dr": 49.0, "Rev": 49.0}


@dataclass
class SimpleImputer:
    """Fill columns by the table's median or mode, or by a constant."""

    median: Sequence[str] = ()
    mode: Sequence[str] = ()
    constant: dict[str, object] = field(default_factory=dict)
    values: dict[str, object] | None = None

    def fit(self, df: DataFrame) -> SimpleImputer:
        self.values = dict(self.constant)
        if self.median:
            long = df.select(*[no_nan(F.col(c)).alias(c) for c in self.median]).unpivot(
                [], list(self.median), "column", "value"
            )
            for row in grouped_median(long, ["column"], "value").collect():  # one row per listed column
                self.values[row["column"]] = row["median"]
        for column in self.mode:
            self.values[column] = column_mode(df, column)
        return self

    def transform(self, df: DataFrame) -> DataFrame:
        if self.values is None:
            raise ValueError("fit the imputer first")
        filled = {c: F.coalesce(F.col(c), F.lit(v)) for c, v in self.values.items() if v is not None}
        return df.withColumns(filled) if filled else df


def fill_zero(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Replace what is still missing by 0."""
    return df.na.fill(0, list(columns))


@dataclass
class GapFilling:
    """Age-like, fare-like and port-like gaps in the reference's order: the fare
    is filled before the port, so rows without a port skip to the class level."""

    age: str
    fare: str
    port: str
    klass: str
    sex: str
    default_port: str = "S"
    steps: list | None = None

    def fit(self, df: DataFrame) -> GapFilling:
        self.steps = [
            MedianImputer(self.age, [[self.klass, self.sex], []], staged=True).fit(df),
            MedianImputer(self.fare, [[self.klass, self.port], [self.klass]], staged=True).fit(df),
            ModeImputer(self.port, self.default_port).fit(df),
        ]
        return self

    def transform(self, df: DataFrame) -> DataFrame:
        if self.steps is None:
            raise ValueError("fit the imputer first")
        for step in self.steps:
            df = step.transform(df)
        return df
