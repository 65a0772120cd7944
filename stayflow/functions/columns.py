"""Small helpers for column names and ratios."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def underscored(name: str) -> str:
    return name.replace(" ", "_")


def underscore_columns(df: DataFrame) -> DataFrame:
    """Rename every column by replacing blanks with underscores."""
    return df.withColumnsRenamed({c: underscored(c) for c in df.columns if " " in c})


def named(name: str) -> str:
    """A column name as SQL text, for names that hold blanks or dots."""
    return "`" + name.replace("`", "``") + "`"


def text(value: str) -> str:
    """A string literal as SQL text."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def quoted(names: Iterable[str]) -> list[Column]:
    """Columns by exact name."""
    return [F.col(named(n)) for n in names]


def ratio(part: Column, whole: Column) -> Column:
    """Division that gives null, not an error, for a zero divisor."""
    return F.try_divide(part.cast("double"), whole.cast("double"))
