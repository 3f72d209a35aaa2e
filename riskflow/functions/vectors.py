"""Between columns, arrays and ML vectors, without Python in the row path."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def vector_of(columns: Sequence[str]) -> Column:
    return array_to_vector(F.array(*(F.col(name).cast("double") for name in columns)))


def unpacked(vector: str, names: Sequence[str]) -> list[Column]:
    """One column per vector slot."""
    values = vector_to_array(F.col(vector))
    return [values[i].alias(name) for i, name in enumerate(names)]


def positive_probability(column: str = "probability") -> Column:
    return vector_to_array(F.col(column))[1]


def ensure_vector(df: DataFrame, column: str = "features") -> DataFrame:
    """Turn a plain struct with a ``values`` array, as other writers store it, into a vector."""
    kind = df.schema[column].dataType
    if isinstance(kind, T.StructType) and "values" in kind.fieldNames():
        return df.withColumn(column, array_to_vector(F.col(f"{column}.values")))
    return df
