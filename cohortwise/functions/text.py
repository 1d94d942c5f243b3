"""Tokens and categories taken from text columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Patterns for a title and a family name inside a name, and for
# the letters and digits of a ticket.
TITLE_PATTERN = r" ([A-Za-z]+)\."
SURNAME_PATTERN = r"([A-Za-z]+),"
PREFIX_PATTERN = r"([A-Za-z/.]+)"
TRAILING_DIGITS = r"(\d+)$"

# Title groups.
TITLES_RARE = {
    "Lady": "Rare", "Countess": "Rare", "Capt": "Rare", "Col": "Rare", "Don": "Rare", "Dr": "Rare", "Major": "Rare",
    "Rev": "Rare", "Sir": "Rare", "Jonkheer": "Rare", "Mlle": "Miss", "Ms": "Miss", "Mme": "Mrs",
}
TITLES_RARE_OR_OTHER = {**TITLES_RARE, "Dona": "Rare", "Master": "Master", "Mr": "Mr", "Mrs": "Mrs", "Miss": "Miss"}
TITLES_OFFICER = {
    "Mlle": "Miss", "Ms": "Miss", "Mme": "Mrs", "Lady": "Mrs", "Countess": "Mrs", "Capt": "Officer", "Col": "Officer",
    "Don": "Officer", "Dr": "Officer", "Major": "Officer", "Rev": "Officer", "Sir": "Officer", "Jonkheer": "Officer",
    "Dona": "Mrs",
}
TITLES_SHORT = {"Mlle": "Miss", "Ms": "Miss", "Mme": "Mrs"}
TITLES_KEPT = ["Mr", "Miss", "Mrs", "Master", "Officer"]
TITLE_BY_SEX = {"male": "Mr", "female": "Mrs"}


def token(text: Column, pattern: str | None, group: int = 1) -> Column:
    """First match of a pattern; null when there is none. Without a pattern the
    column already is the token."""
    if pattern is None:
        return text
    found = F.regexp_extract(text, pattern, group)
    return F.when(found != "", found)


def mapped(value: Column, mapping: dict[str, str]) -> Column:
    """The mapping's target, or null for a value it does not list."""
    targets: dict[str, list[str]] = {}
    for source, target in mapping.items():
        targets.setdefault(target, []).append(source)
    result = F.when(F.lit(False), F.lit(""))
    for target, sources in targets.items():
        result = result.when(value.isin(*sources), target)
    return result


def replace_values(value: Column, mapping: dict[str, str]) -> Column:
    """Replace listed values, keep all others."""
    return F.coalesce(mapped(value, mapping), value)


def token_mapped(text: Column, pattern: str, mapping: dict[str, str], missing: str = "Unknown") -> Column:
    """Token with listed values replaced; ``missing`` where nothing matches."""
    return F.coalesce(replace_values(token(text, pattern), mapping), F.lit(missing))


def token_grouped(
    text: Column, pattern: str, mapping: dict[str, str], other: str = "Other", missing: str = "Unknown"
) -> Column:
    """Token by a closed mapping: unlisted tokens become ``other``."""
    found = token(text, pattern)
    return F.when(found.isNull(), missing).otherwise(F.coalesce(mapped(found, mapping), F.lit(other)))


def token_or_fallback(
    text: Column, pattern: str, mapping: dict[str, str], kept: list[str], by: Column, fallback: dict[str, str]
) -> Column:
    """Token with replacements; a result not in ``kept`` is derived from another column."""
    value = replace_values(token(text, pattern), mapping)
    return F.when(value.isin(*kept), value).otherwise(mapped(by, fallback))


def first_char(text: Column, missing: str = "Unknown") -> Column:
    return F.when(F.length(text) > 0, F.substring(text, 1, 1)).otherwise(missing)


def _as_int(digits: Column) -> Column:
    return digits.try_cast("bigint")


def first_int(text: Column, missing: int = -1) -> Column:
    """First run of digits."""
    return F.coalesce(_as_int(F.regexp_extract(text, r"(\d+)", 1)), F.lit(missing).cast("bigint"))


def last_int(text: Column, missing: int = -1) -> Column:
    """Last run of digits."""
    return F.coalesce(_as_int(F.regexp_extract(text, r"(\d+)\D*$", 1)), F.lit(missing).cast("bigint"))


def trailing_int(text: Column, missing: int = 0) -> Column:
    """Digits at the very end."""
    return F.coalesce(_as_int(F.regexp_extract(text, TRAILING_DIGITS, 1)), F.lit(missing).cast("bigint"))


def has_value(column: Column) -> Column:
    return column.isNotNull().cast("int")


def token_count(text: Column) -> Column:
    """Number of space-separated tokens: spaces plus one, 0 for null."""
    spaces = F.length(text) - F.length(F.replace(text, F.lit(" "), F.lit("")))
    return F.coalesce(spaces + 1, F.lit(0)).cast("int")


def with_tokens(df: DataFrame, tokens: dict[str, tuple[str, str]]) -> DataFrame:
    """Add tokens as columns ``name: (text column, pattern)``, each matched once
    however often it is used afterwards."""
    raw = df.withColumns({name: F.regexp_extract(F.col(text), pattern, 1) for name, (text, pattern) in tokens.items()})
    return raw.withColumns({name: F.when(F.col(name) != "", F.col(name)) for name in tokens})


def letter_prefix(text: Column, missing: str = "None") -> Column:
    """First run of letters, slashes and dots."""
    return F.coalesce(token(text, PREFIX_PATTERN), F.lit(missing))


def prefix_without_digits(text: Column, numeric: str = "Numeric", missing: str = "Unknown") -> Column:
    """What is left of the text without digits, slashes and dots."""
    bare = F.trim(F.regexp_replace(text, r"\d+", ""))
    cleaned = F.trim(F.translate(bare, "/.", ""))
    return F.when(text.isNull(), missing).when(bare == "", numeric).otherwise(cleaned)


def family_name(text: Column) -> Column:
    """Letters right before the first comma that follows a letter."""
    return token(text, SURNAME_PATTERN)


def crossed(*columns: Column, missing: str = "Unknown") -> Column:
    """Values joined by underscores."""
    return F.concat_ws("_", *[F.coalesce(c.cast("string"), F.lit(missing)) for c in columns])
