"""Registry table: one row per trained model, committed run by run.

A run's rows go to the run's own folder; a marker file, created once they are all there,
makes them visible. Readers take marked runs only, so a run that stopped half-way is never seen
and runs at the same time do not touch each other's files.
"""

from __future__ import annotations

import logging
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskflow.operators.evaluate import with_gate
from riskflow.operators.score import FAMILIES, ChosenModel
from riskflow.sources.models import try_load
from riskflow.sources.tables import children, create_marker, exists

_log = logging.getLogger(__name__)

SCHEMA = (
    "run_id string, task string, family string, path string, auc double, accuracy double, "
    "precision double, recall double, f1 double, params string, train_seconds double, "
    "trained_at timestamp, gate string, complete boolean, dropped_rows long"
)


# Markers of finished runs; Spark's readers pass over folders that begin with an underscore.
_COMMITS = "_commits"


def stage(entries: DataFrame, path: str, run_id: str) -> None:
    """Write rows of a run, which nobody reads before ``commit``. A run writes in a folder of its own, so
    that runs at the same time do not clear each other's temporary files."""
    rows = entries.filter(F.col("run_id") == run_id).drop("run_id")
    rows.write.mode("append").parquet(f"{path}/run_id={run_id}")


def commit(spark: SparkSession, path: str, run_id: str) -> bool:
    """Make a run visible, all its rows at once; False if it was so already."""
    return create_marker(spark, f"{path}/{_COMMITS}/{run_id}")


def append(entries: DataFrame, path: str) -> None:
    """Stage and commit at once."""
    for row in entries.select("run_id").distinct().collect():
        stage(entries, path, row["run_id"])
        commit(entries.sparkSession, path, row["run_id"])


def committed(spark: SparkSession, path: str) -> tuple[str, ...]:
    """Ids of the runs that readers see."""
    return tuple(sorted(children(spark, f"{path}/{_COMMITS}")))


def read(spark: SparkSession, path: str) -> DataFrame:
    runs = [f"{path}/run_id={run}" for run in committed(spark, path)]
    if not runs:
        return spark.createDataFrame([], SCHEMA)
    names = [item.split()[0] for item in SCHEMA.split(", ")]
    return spark.read.schema(SCHEMA).option("basePath", path).parquet(*runs).select(*names)


def latest_run(registry: DataFrame) -> DataFrame:
    """The rows of each task's last run."""
    last = registry.groupBy("task").agg(F.max_by("run_id", "trained_at").alias("run_id"))
    return registry.join(last, ["task", "run_id"], "left_semi")


def best(registry: DataFrame, family_order: Iterable[str] = FAMILIES) -> DataFrame:
    """One row per task: the highest AUC among the models that can be loaded; a tie goes to
    the family named first."""
    if "complete" in registry.columns:
        registry = registry.filter(F.coalesce("complete", F.lit(True)))
    order = F.array(*(F.lit(name) for name in family_order))
    rank = F.struct(F.col("auc"), -F.array_position(order, F.col("family")))
    row = F.struct(*(F.col(name) for name in registry.columns if name != "task"))
    # A maximum rather than a ranked window: combined on the map side.
    return registry.groupBy("task").agg(F.max_by(row, rank).alias("row")).select("task", "row.*")


def deployable(registry: DataFrame, minimum: str = "acceptable") -> DataFrame:
    """Models that pass the quality gate."""
    passed = ["deployable"] if minimum == "deployable" else ["deployable", "acceptable"]
    return with_gate(registry.drop("gate")).filter(F.col("gate").isin(passed))


def resolve(
    spark: SparkSession,
    path: str,
    task: str,
    columns: Iterable[str] | None = None,
    minimum: str | None = None,
) -> ChosenModel | None:
    """Best model of the last run, else its others by family order, else None.

    A model that cannot be loaded, or that needs other than the given ``columns``,
    is passed over, which is logged. ``minimum`` (acceptable or deployable) leaves only models
    that pass the quality gate. Reads a handful of rows while planning, in one job; the
    scoring job itself reads none.
    """
    if not exists(spark, path):
        return None
    rows = latest_run(read(spark, path).filter(F.col("task") == task))
    if minimum:
        rows = deployable(rows, minimum)
    # The best first: highest AUC, ties by family; then the others by family.
    found = sorted(rows.collect(), key=lambda row: (-(row["auc"] or 0.0), FAMILIES.index(row["family"])))
    others = sorted(found[1:], key=lambda row: FAMILIES.index(row["family"]))
    for row in [*found[:1], *others]:
        model = try_load(row["path"], row["family"])
        if model is None:
            _log.warning("passed over, cannot be loaded: %s", row["path"])
        elif columns is not None and model.missing(columns):
            _log.warning("passed over, %s needs %s", row["path"], ", ".join(model.missing(columns)))
        else:
            return model
    return None


# The text form of the choice, "Best <task> model: <path>", and the ends of a
# model folder's name that tell its family.
_LINE = r"^Best (\w+) model:(.*)$"
_FAMILY_MARKS = {
    "lr": "logistic_regression", "logistic_regression": "logistic_regression",
    "rf": "random_forest", "random_forest": "random_forest",
}


def to_lines(best_rows: DataFrame) -> DataFrame:
    """The chosen model of each task as one text line."""
    return best_rows.select(
        F.format_string("Best %s model: %s", F.col("task"), F.col("path")).alias("value")
    )


def write_lines(best_rows: DataFrame, path: str) -> None:
    to_lines(best_rows).write.mode("overwrite").text(path)


def publish_lines(spark: SparkSession, path: str, text_path: str) -> None:
    """Write the best model of each task's last run as text, again if runs were committed
    meanwhile, so that of several writers the last one to finish has them all."""
    seen = None
    while seen != (seen := committed(spark, path)):
        write_lines(best(latest_run(read(spark, path))), text_path)


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """(task, path, family) out of such lines; other lines are skipped.

    Without a family column the last part of the path has to name it, by its end.
    """
    line = F.col("value")
    parsed = (
        spark.read.text(path)
        .filter(line.startswith("Best ") & line.rlike(_LINE))
        .select(
            F.regexp_extract(line, _LINE, 1).alias("task"),
            F.trim(F.regexp_extract(line, _LINE, 2)).alias("path"),
        )
    )
    folder, family = F.lower(F.regexp_extract("path", r"([^/]*)/*$", 1)), F
    for mark, name in _FAMILY_MARKS.items():
        family = family.when(folder.rlike(f"(^|_){mark}$"), F.lit(name))
    return parsed.withColumn("family", family.otherwise(F.lit("unknown")))
