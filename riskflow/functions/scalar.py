"""Small column helpers shared by the scorers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_number(column: Column) -> Column:
    """Double value with NaN as null: Spark orders NaN above every number."""
    value = column.cast("double")
    return F.when(~F.isnan(value), value)


def quoted(name: str) -> str:
    """A column name for SQL text and column lookups, whatever characters it has."""
    escaped = name.replace("`", "``")
    return f"`{escaped}`"


def at_threshold(column: Column, threshold: float = 0.5) -> Column:
    return (column >= F.lit(threshold)).cast("int")


def percent_text(column: Column) -> Column:
    """A share as text with one decimal, e.g. 0.75 as ``75.0%``."""
    return F.format_string("%.1f%%", column * F.lit(100.0))
