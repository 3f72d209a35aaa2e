"""The three jobs: prepare a table, train its models, score new records."""

from __future__ import annotations

import json
import logging
import uuid
from collections.abc import Sequence
from dataclasses import replace
from datetime import datetime, timezone

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from riskflow.functions.encode import GENDER_CODES, MALE, YES, encode_flags, equals_flag, mapped
from riskflow.operators.evaluate import evaluate, with_gate
from riskflow.operators.prepare import fit_preparation, zero_impute
from riskflow.operators.quality import drop_columns, drop_nulls, is_complete, numeric_features
from riskflow.operators.report import with_report
from riskflow.operators.score import ChosenModel, flat_result, score, with_model_score
from riskflow.operators.train import LR, RF, Fitted, TrainingSet, together, training_set, tune
from riskflow.schemas import TASKS, Task
from riskflow.session import Counts, counting
from riskflow.sources import registry
from riskflow.sources.models import save_model, try_load
from riskflow.sources.tables import write_csv, write_parquet

_log = logging.getLogger(__name__)


def encoded(df: DataFrame, task: Task) -> DataFrame:
    """Text answers as 0/1; what is not ``Male`` or ``Yes`` becomes 0, numbers stay."""
    text = {f.name for f in df.schema.fields if isinstance(f.dataType, StringType)}
    df = encode_flags(df, [name for name in task.yes_no_columns if name in text], YES)
    if task.gender_column in text:
        df = df.withColumn(task.gender_column, equals_flag(F.col(task.gender_column), MALE))
    return df


def cleaned(df: DataFrame, task: Task) -> DataFrame:
    """The table ready for assembly: columns dropped, nulls dropped, zeros filled, text coded."""
    if task.zero_columns:
        df = zero_impute(df, task.zero_columns)
    if task.drop_columns:
        df = drop_nulls(drop_columns(df, task.drop_columns))
    return encoded(df, task)


def prepared(df: DataFrame, task: Task, key: Sequence[str] = ()) -> DataFrame:
    """Key columns, standardised vector and label of every clean row.

    One pass for all statistics, one to apply them. A feature that is still
    missing fails the job instead of turning into a number.
    """
    task = with_features(task, df, key)
    ready = df.select(*key, *(name for name in (*task.features, task.label) if name not in key))
    if task.drop_columns:
        ready = drop_nulls(ready, [*task.features, task.label])
    ready = encoded(ready, task)
    numeric_features(ready, {*key, task.label})
    stages = fit_preparation(ready, task.features, task.zero_columns).stages(handle_invalid="error")
    return PipelineModel(stages).transform(ready).select(*key, "features", task.label)


def save_prepared(df: DataFrame, task: Task, folder: str, key: Sequence[str] = ()) -> str:
    path = f"{folder}/{task.name}"
    write_parquet(prepared(df, task, key), path)
    return path


def export_cleaned(df: DataFrame, task: Task, path: str) -> None:
    """Cleaned, unscaled table as CSV; an unknown gender stays empty instead of 0."""
    clean = df
    if task.zero_columns:
        clean = zero_impute(clean, task.zero_columns)
    if task.drop_columns:
        clean = drop_nulls(drop_columns(clean, task.drop_columns))
    if task.gender_column:
        gender = mapped(F.col(task.gender_column), GENDER_CODES)
        clean = clean.withColumn(task.gender_column, gender)
    write_csv(clean, path)


def with_features(task: Task, records: DataFrame, key: Sequence[str]) -> Task:
    """The task with the features that this table offers."""
    if not task.open_features:
        return task
    others = {*key, *task.drop_columns, task.label}
    return replace(task, features=tuple(name for name in records.columns if name not in others))


def training_records(records: DataFrame, task: Task, key: Sequence[str]) -> DataFrame:
    """Encoded rows with key, features and label, those without a null or NaN in a feature or the
    label."""
    columns = [*key, *(name for name in (*task.features, task.label) if name not in key)]
    complete = drop_nulls(records.select(*columns), [*task.features, task.label])
    ready = encoded(complete, task)
    numeric_features(ready, {*key, task.label})
    return ready


def counting_dropped(records: DataFrame, task: Task) -> tuple[DataFrame, Counts]:
    """The records, and how many training leaves out because of a null or NaN: ``dropped_rows``,
    counted by the job that writes the others."""
    incomplete = ~is_complete(records, [*task.features, task.label])
    return counting(records, F.count_if(incomplete).alias("dropped_rows"))


def test_scores(data: TrainingSet, models: Sequence[Fitted]) -> DataFrame:
    """(candidate, score, prediction, label) of every model on the test split."""
    scored = data.test
    for fitted in models:
        chosen = ChosenModel(fitted.family, fitted.pipeline)
        scored = with_model_score(scored, chosen, prefix=fitted.family)
    per_model = (
        F.struct(
            F.lit(m.family).alias("candidate"),
            F.col(f"{m.family}_probability").alias("score"),
            F.col(f"{m.family}_prediction").alias("prediction"),
        )
        for m in models
    )
    return scored.select(F.col(data.label).alias("label"), F.inline(F.array(*per_model)))


def leaderboard(data: TrainingSet, models: Sequence[Fitted], task: str) -> DataFrame:
    """Test metrics of each model; all candidates in one job."""
    metrics = evaluate(test_scores(data, models), prediction="prediction")
    return with_gate(metrics).select(F.lit(task).alias("task"), "*")


def train_task(
    records: DataFrame,
    task: Task,
    key: Sequence[str],
    folder: str,
    run_id: str,
    families: Sequence[str] = (LR, RF),
    parallelism: int = 4,
    max_training_rows: int | None = None,
) -> tuple[DataFrame, list[Fitted]]:
    """Tune, save and evaluate each family; returns registry rows, written, and the models."""
    spark = records.sparkSession
    task = with_features(task, records, key)
    counted, tally = counting_dropped(records, task)
    data = training_set(
        training_records(counted, task, key), task, key,
        max_training_rows=max_training_rows, session=spark,
    )
    dropped = tally.get()["dropped_rows"]
    if dropped:
        _log.warning("%s: %d records with a missing value are not trained on", task.name, dropped)
    try:
        models = together(
            spark, lambda family: tune(data, family, parallelism=parallelism, nested=True), families,
            len(families),
        )
    finally:
        data.release()
    paths = {m.family: f"{folder}/{run_id}/{task.name}_{m.family}" for m in models}
    for m in models:
        save_model(m.pipeline, paths[m.family])
    facts = spark.createDataFrame(
        [
            (
                run_id, m.family, paths[m.family], json.dumps(m.params), float(m.seconds),
                datetime.now(timezone.utc),
                try_load(paths[m.family], m.family) is not None,
                dropped,
            )
            for m in models
        ],
        "run_id string, candidate string, path string, params string, train_seconds double, "
        "trained_at timestamp, complete boolean, dropped_rows long",
    )
    # One row per family on both sides. Written before the records they come from go.
    rows = leaderboard(data, models, task.name).join(facts, "candidate")
    columns = [item.split()[0] for item in registry.SCHEMA.split(", ")]
    rows = rows.withColumnRenamed("candidate", "family").select(*columns)
    rows = spark.createDataFrame(rows.collect(), registry.SCHEMA)
    data.discard()
    return rows, models


def train(
    tables: dict[str, tuple[DataFrame, Sequence[str]]],
    folder: str,
    parallelism: int = 4,
    max_training_rows: int | None = None,
) -> dict[str, list[Fitted]]:
    """Train every (task: table, key); the outcome goes to ``folder``/registry, all of it by one
    commit at the end.

    ``folder``/best_models names the best model of each task's last run, those of tasks
    trained before included. Tasks and families are trained at the same time, ``parallelism``
    forests of each task.
    """
    run_id, spark = uuid.uuid4().hex, next(iter(tables.values()))[0].sparkSession

    def trained(name: str) -> tuple[DataFrame, list[Fitted]]:
        records, key = tables[name]
        return train_task(
            records, TASKS[name], key, f"{folder}/models", run_id,
            parallelism=parallelism, max_training_rows=max_training_rows,
        )

    outcomes = dict(zip(tables, together(spark, trained, tables, len(tables))))
    for rows, _ in outcomes.values():
        registry.stage(rows, f"{folder}/registry", run_id)
    fitted = {name: models for name, (_, models) in outcomes.items()}
    registry.commit(spark, f"{folder}/registry", run_id)
    registry.publish_lines(spark, f"{folder}/registry", f"{folder}/best_models")
    return fitted


def score_table(
    df: DataFrame,
    task: str,
    keep: Sequence[str],
    folder: str | None = None,
    minimum: str | None = None,
) -> DataFrame:
    """Whole-table scoring with texts, through the registry's fallback chain; ``minimum`` is
    the quality gate that a model has to pass."""
    ready, model = encoded(df, TASKS[task]), None
    if folder:
        model = registry.resolve(df.sparkSession, f"{folder}/registry", task, ready.columns, minimum)
    return with_report(flat_result(score(ready, task, model), *keep), task)
