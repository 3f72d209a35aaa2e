"""Scoring records as they arrive.

Scoring looks at one record at a time, so the stream keeps no state and needs no
watermark. Fitted statistics come from the saved model, never from the batch.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from riskflow.operators.report import with_report
from riskflow.operators.score import ChosenModel, flat_result, score
from riskflow.sources.tables import is_directory


def read_stream(
    spark: SparkSession, path: str, schema: T.StructType, max_files: int | None = None
) -> DataFrame:
    """New Parquet files of a table folder; a single file is watched through its folder."""
    reader = spark.readStream.schema(schema)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    if not is_directory(spark, path):
        path, _, name = path.rpartition("/")
        reader = reader.option("pathGlobFilter", name)
    return reader.parquet(path)


def scored_stream(
    records: DataFrame, task: str, keep: list[str], model: ChosenModel | None = None
) -> DataFrame:
    """Key, flat result and texts of each arriving record."""
    return with_report(flat_result(score(records, task, model), *keep), task)


def write_stream(
    scored: DataFrame, sink: str, checkpoint: str, trigger: dict | None = None
) -> StreamingQuery:
    """Append to a Parquet folder; its log makes each micro-batch count exactly once."""
    return (
        scored.writeStream.format("parquet")
        .option("path", sink)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


def score_available(
    spark: SparkSession,
    source: str,
    schema: T.StructType,
    to_records: Callable[[DataFrame], DataFrame],
    task: str,
    keep: list[str],
    sink: str,
    checkpoint: str,
    model: ChosenModel | None = None,
) -> DataFrame:
    """Score everything that has arrived, then return the sink as a table."""
    records = to_records(read_stream(spark, source, schema))
    query = write_stream(scored_stream(records, task, keep, model), sink, checkpoint)
    query.awaitTermination()
    return spark.read.parquet(sink)
