"""Category to number encodings."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def equals_flag(column: Column, value: str) -> Column:
    """1 where the column equals ``value``, 0 everywhere else, nulls included."""
    return F.when(column == F.lit(value), 1).otherwise(0)


def mapped(column: Column, codes: Mapping[str, int]) -> Column:
    """The code of each listed value; any other value becomes null."""
    branches = F
    for value, code in codes.items():
        branches = branches.when(column == F.lit(value), F.lit(code))
    return branches


def encode_flags(df: DataFrame, columns: Iterable[str], value: str) -> DataFrame:
    return df.withColumns({name: equals_flag(F.col(name), value) for name in columns})


# How the two genders and the yes/no answers are coded.
MALE, YES = "Male", "Yes"
GENDER_CODES = {"Male": 1, "Female": 0}
