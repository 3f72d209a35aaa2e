"""Scoring a stream by whatever model is registered when a micro-batch comes.

Each micro-batch is a batch job: the registry is looked at anew, and its rows go to a partition named
by the batch. A batch that Spark repeats after a failure replaces its partition, so the
sink holds every record once whatever happened in between.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from riskflow.operators.report import with_report
from riskflow.operators.score import ChosenModel, flat_result, score
from riskflow.sources import registry
from riskflow.sources.tables import write_parquet
from riskflow.streaming.score import read_stream

BATCH = "batch"


class CurrentModel:
    """The registered model of a task; loaded again only when another run has been committed."""

    def __init__(self, spark: SparkSession, path: str, task: str, minimum: str | None = None):
        self.spark, self.path, self.task, self.minimum = spark, path, task, minimum
        self.runs: tuple[str, ...] | None = None
        self.model: ChosenModel | None = None

    def get(self, columns: Sequence[str]) -> ChosenModel | None:
        runs = registry.committed(self.spark, self.path)
        if runs != self.runs:
            self.model = registry.resolve(self.spark, self.path, self.task, columns, self.minimum)
            self.runs = runs
        return self.model


def write_batch(scored: DataFrame, sink: str, batch_id: int) -> None:
    """The rows of a micro-batch as a partition of the sink, in place of an earlier attempt's."""
    write_parquet(
        scored.withColumn(BATCH, F.lit(batch_id)), sink, partition_by=[BATCH], replace_partitions=True
    )


def scorer(
    task: str, keep: Sequence[str], model: CurrentModel, to_records: Callable[[DataFrame], DataFrame], sink: str
) -> Callable[[DataFrame, int], None]:
    """What ``foreachBatch`` calls with the rows and the number of a micro-batch."""

    def score_batch(rows: DataFrame, batch_id: int) -> None:
        records = to_records(rows)
        chosen = model.get(records.columns)
        write_batch(with_report(flat_result(score(records, task, chosen), *keep), task), sink, batch_id)

    return score_batch


def score_arrivals(
    spark: SparkSession,
    source: str,
    schema: T.StructType,
    to_records: Callable[[DataFrame], DataFrame],
    task: str,
    keep: Sequence[str],
    registry_path: str,
    sink: str,
    checkpoint: str,
    trigger: dict | None = None,
    max_files: int | None = None,
    minimum: str | None = None,
) -> StreamingQuery:
    """Start scoring; by default what has arrived so far, then the query ends."""
    model = CurrentModel(spark, registry_path, task, minimum)
    return (
        read_stream(spark, source, schema, max_files)
        .writeStream.foreachBatch(scorer(task, keep, model, to_records, sink))
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )
