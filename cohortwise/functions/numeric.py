"""Derived numeric columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def flag(condition: Column) -> Column:
    """1 where the condition holds, 0 elsewhere (also on null)."""
    return F.when(condition, 1).otherwise(0)


def group_size(a: Column, b: Column) -> Column:
    """Companions of two kinds plus the row itself."""
    return (a + b + 1).cast("int")


def is_alone(size: Column) -> Column:
    return flag(size == 1)


def ratio(amount: Column, size: Column) -> Column:
    """Amount per head; the amount itself where the ratio is undefined."""
    return F.coalesce(F.try_divide(amount, size), amount)


def log1p(value: Column) -> Column:
    return F.when(value > -1, F.log1p(value))


def root(value: Column) -> Column:
    return F.when(value >= 0, F.sqrt(value))


def square(value: Column) -> Column:
    return value * value


def ladder(value: Column, steps: Sequence[tuple[float, str]], above: str, missing: str) -> Column:
    """First label whose upper limit exceeds the value."""
    result = F.when(value.isNull(), missing)
    for limit, label in steps:
        result = result.when(value < limit, label)
    return result.otherwise(above)


# Age ladder.
AGE_LADDER = [
    (5, "Baby"), (12, "Child"), (18, "Teen"), (25, "YoungAdult"), (35, "Adult"), (50, "MiddleAge"), (65, "Senior"),
]


def age_category(age: Column) -> Column:
    return ladder(age, AGE_LADDER, "Elderly", "Unknown")


def size_class(size: Column, legacy: bool = False, edges: tuple[int, int, int] = (1, 3, 4)) -> Column:
    """Size class of a group: Alone, Small and Medium up to the ``edges``, Large beyond; null stays null.

    ``legacy`` gives what the reference computes, where later assignments
    overwrite earlier ones and only Small and Large remain.
    """
    if legacy:
        return F.when(size >= 5, "Large").when(size <= 4, "Small").otherwise("Medium")
    alone, small, medium = edges
    return F.when(size <= alone, "Alone").when(size <= small, "Small").when(size <= medium, "Medium").when(size > medium, "Large")


def family_flags(a: Column, b: Column, size: Column) -> dict[str, Column]:
    """Has either kind of companion, is a large group, is a pair."""
    return {"has_a": flag(a > 0), "has_b": flag(b > 0), "large_group": flag(size > 4), "pair": flag(size == 2)}
