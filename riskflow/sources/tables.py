"""Reading and writing tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskflow.functions.scalar import quoted


def _cast(name: str, kind: T.DataType) -> Column:
    """A text column as ``kind``, null where it does not read as one; 3.0 is a whole number."""
    column = F.col(quoted(name))
    if isinstance(kind, T.IntegralType):
        number = column.try_cast("double")
        column = F.when(number == F.floor(number), number.try_cast("long"))
    return column.try_cast(kind).alias(name)


def typed(df: DataFrame, schema: T.StructType | str) -> DataFrame:
    """Text columns cast by name, in whatever order they come; others stay as they are.

    A column of the schema that the table lacks is an error.
    """
    if isinstance(schema, str):
        schema = T.StructType.fromDDL(schema)
    kinds = {field.name: field.dataType for field in schema.fields}
    missing = sorted(set(kinds) - set(df.columns))
    if missing:
        raise ValueError(f"the table lacks: {', '.join(missing)}")
    return df.select(
        *(_cast(n, kinds[n]) if n in kinds else F.col(quoted(n)) for n in df.columns)
    )


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame:
    """CSV with a header row, columns by header name.

    Without a schema Spark infers one, at the price of another scan.
    """
    reader = spark.read.option("header", True)
    if schema is None:
        return reader.option("inferSchema", True).csv(path)
    return typed(reader.csv(path), schema)


def write_csv(df: DataFrame, path: str, mode: str = "overwrite", sized: bool = False) -> None:
    _sized(df, (), sized).write.mode(mode).option("header", True).csv(path)


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def write_parquet(
    df: DataFrame,
    path: str,
    mode: str = "overwrite",
    partition_by: Sequence[str] = (),
    replace_partitions: bool = False,
    sized: bool = False,
) -> None:
    """``replace_partitions`` overwrites only the partitions that ``df`` has and leaves the files of the
    others. ``sized`` deals the rows anew, by the partition columns, so that files come out near the
    session's advisory size: small tasks are joined, a large partition is split."""
    writer = _sized(df, partition_by, sized).write.mode(mode).partitionBy(*partition_by)
    if replace_partitions:
        if not partition_by:
            raise ValueError("nothing to replace by: name the partition columns")
        writer = writer.option("partitionOverwriteMode", "dynamic")
    writer.parquet(path)


def _sized(df: DataFrame, partition_by: Sequence[str], sized: bool) -> DataFrame:
    """Rows dealt by size; a shuffle that adaptive execution may split and join as it likes."""
    return df.hint("rebalance", *partition_by) if sized else df


def _status(spark: SparkSession, path: str):
    """(file system, path) handles of any storage Spark can reach."""
    handle = spark._jvm.org.apache.hadoop.fs.Path(path)
    return handle.getFileSystem(spark._jsc.hadoopConfiguration()), handle


def exists(spark: SparkSession, path: str) -> bool:
    fs, handle = _status(spark, path)
    return fs.exists(handle)


def is_directory(spark: SparkSession, path: str) -> bool:
    fs, handle = _status(spark, path)
    return fs.exists(handle) and fs.getFileStatus(handle).isDirectory()


def children(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder; none if it is not there."""
    fs, handle = _status(spark, path)
    return [status.getPath().getName() for status in fs.listStatus(handle)] if fs.exists(handle) else []


def create_marker(spark: SparkSession, path: str) -> bool:
    """Create an empty file, unless it exists; whether this call did."""
    fs, handle = _status(spark, path)
    return fs.createNewFile(handle)


def version(spark: SparkSession, path: str) -> tuple[int, int]:
    """Last change and size of a table's files: another table under the same path differs."""
    fs, handle = _status(spark, path)
    files = [handle] if not is_directory(spark, path) else [s.getPath() for s in fs.listStatus(handle)]
    found = [fs.getFileStatus(f) for f in files]
    return max(s.getModificationTime() for s in found), sum(s.getLen() for s in found)


def candidates(folder: str, name: str) -> list[tuple[str, str]]:
    """Where a prepared table may be: its Parquet copy, else the cleaned CSV."""
    return [("parquet", f"{folder}/{name}"), ("csv", f"{folder}/{name}_cleaned.csv")]


def read_first_available(
    spark: SparkSession, locations: Sequence[tuple[str, str]], schema: T.StructType | None = None
) -> DataFrame:
    """The first (format, path) that exists; decided before any job is planned."""
    for kind, path in locations:
        if exists(spark, path):
            return read_csv(spark, path, schema) if kind == "csv" else read_parquet(spark, path)
    raise FileNotFoundError("none of these exists: " + ", ".join(path for _, path in locations))
