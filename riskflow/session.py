"""Session settings and the shared scratch folder."""

from __future__ import annotations

import os
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession

# Settings that hold on any cluster. Memory, cores and the number of shuffle
# partitions belong to the submit command; AQE coalesces or splits from there.
DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
}


def build_session(app_name: str = "riskflow", master: str | None = None, **conf) -> SparkSession:
    """Build or reuse a session; ``conf`` keys use ``__`` in place of dots."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = DEFAULTS | {key.replace("__", "."): str(value) for key, value in conf.items()}
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def find_package(spark: SparkSession) -> None:
    """Put this package's folder on the import path of Python workers started from now on; on a cluster whose
    executors lack it, submit the package with ``--py-files``."""
    root, environment = os.path.dirname(os.path.dirname(os.path.abspath(__file__))), spark.sparkContext.environment
    paths = [p for p in environment.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        environment["PYTHONPATH"] = os.pathsep.join([root, *paths])


def scratch_root(spark: SparkSession) -> str:
    """Folder for intermediate tables that the driver and every executor can read.

    ``spark.checkpoint.dir`` names it. Where that is unset, the session's
    warehouse folder serves, which Spark already needs to be shared.
    """
    configured = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get(
        "spark.checkpoint.dir", None
    )
    root = configured or spark.conf.get("spark.sql.warehouse.dir")
    return f"{root.rstrip('/')}/riskflow-scratch/{spark.sparkContext.applicationId}"


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the scratch root; never reused, so nothing is overwritten."""
    return f"{scratch_root(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def materialize(
    df: DataFrame, name: str, partition_by: Sequence[str] = (), session: SparkSession | None = None
) -> DataFrame:
    """Write ``df`` once to the scratch folder and read it back, in another session if one is given.

    Cuts the lineage with a table that outlives any executor.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.partitionBy(*partition_by).parquet(path)
    return (session or df.sparkSession).read.schema(df.schema).parquet(path)


class Counts:
    """What was counted along the way; there once the job that reads the counted table is done."""

    def __init__(self, observation: Observation, session: SparkSession, view: str):
        self._observation, self._session, self._view = observation, session, view

    def get(self) -> dict[str, int]:
        found = self._observation.get
        self._session.catalog.dropGlobalTempView(self._view)
        return found


def counting(df: DataFrame, *measures: Column) -> tuple[DataFrame, Counts]:
    """``df`` with aggregates that are computed by whichever job reads it, at no scan of their own.

    The table given back belongs to a session of its own, with the same settings: a session that has
    observed anything can no longer run MLlib's evaluators, which send their session to the tasks.
    """
    spark, view = df.sparkSession, f"counted_{uuid.uuid4().hex}"
    side = spark.newSession()
    for key, value in spark.conf.getAll.items():
        if side.conf.isModifiable(key) and side.conf.get(key, None) != value:
            side.conf.set(key, value)
    df.createGlobalTempView(view)
    observation = Observation()
    observed = side.table(f"global_temp.{view}").observe(observation, *measures)
    return observed, Counts(observation, side, view)


def discard(df: DataFrame) -> None:
    """Delete a table that ``materialize`` wrote, once nothing reads it any more."""
    root = scratch_root(df.sparkSession)
    for file in df.inputFiles()[:1]:
        name = file.split("riskflow-scratch/")[-1].split("/")[1]
        discard_path(df.sparkSession, f"{root}/{name}")


def discard_path(spark: SparkSession, place: str) -> None:
    """Delete a folder that ``scratch_path`` named."""
    path = spark._jvm.org.apache.hadoop.fs.Path(place)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
