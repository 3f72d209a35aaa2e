"""Scoring whole tables: best model, alternative model, rule book."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass
from functools import reduce
from operator import and_

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskflow.functions.rules import RULE_BOOKS, with_rule_score
from riskflow.functions.scalar import as_number, quoted
from riskflow.functions.vectors import positive_probability
from riskflow.operators.prepare import SCALED_PREFIX

FAMILIES = ("logistic_regression", "random_forest")
RULE_BASED = "rule_based"
# Columns the model stages add on their way to a probability.
_MODEL_COLUMNS = ("features", "rawPrediction", "probability", "prediction")


@dataclass(frozen=True)
class ChosenModel:
    """A fitted pipeline: preparation stages, assembler, classifier."""

    family: str
    pipeline: PipelineModel

    def __post_init__(self):
        expected, given = self.pipeline.stages[-1].numFeatures, len(self.features)
        if expected != given:
            raise ValueError(f"the classifier takes {expected} features, its pipeline gives {given}")

    @property
    def features(self) -> tuple[str, ...]:
        """The record columns the model reads."""
        scaled = self.pipeline.stages[-2].getInputCols()
        return tuple(name.removeprefix(SCALED_PREFIX) for name in scaled)

    def missing(self, columns: Iterable[str]) -> list[str]:
        return sorted(set(self.features) - set(columns))


def with_model_score(df: DataFrame, model: ChosenModel, prefix: str = "model") -> DataFrame:
    """Add the model's probability and prediction; null where a feature is missing."""
    clash = sorted(set(_MODEL_COLUMNS) & set(df.columns))
    if clash:
        raise ValueError(f"rename or drop before scoring: {', '.join(clash)}")
    missing = model.missing(df.columns)
    if missing:
        raise ValueError(f"the model needs: {', '.join(missing)}")
    complete = reduce(and_, (as_number(F.col(quoted(name))).isNotNull() for name in model.features))
    return model.pipeline.transform(df).select(
        *df.columns,
        F.when(complete, positive_probability()).alias(f"{prefix}_probability"),
        F.when(complete, F.col("prediction").cast("int")).alias(f"{prefix}_prediction"),
    )


def _pair(prediction: Column, probability: Column) -> Column:
    return F.struct(
        prediction.cast("int").alias("prediction"), probability.cast("double").alias("probability")
    )


def result_struct(
    prediction: Column,
    probability: Column,
    model_used: Column,
    details: Mapping[str, tuple[Column, Column]],
) -> Column:
    nothing = (F.lit(None), F.lit(None))
    return F.struct(
        prediction.alias("prediction"),
        probability.alias("probability"),
        model_used.alias("model_used"),
        F.struct(
            *(_pair(*details.get(name, nothing)).alias(name) for name in (*FAMILIES, RULE_BASED))
        ).alias("details"),
    )


def score(
    df: DataFrame, task: str, model: ChosenModel | None = None, absent: Iterable[str] = ()
) -> DataFrame:
    """Add ``result``: the model's answer where it has one, else the rule book's.

    ``absent`` names rule inputs that the table may lack; any other missing one is an error.

    Row by row only: neither a shuffle nor an action, batch and streaming alike.
    """
    scored = with_rule_score(df, RULE_BOOKS[task], absent=absent)
    rule_prediction, rule_probability = F.col("rule_prediction"), F.col("rule_probability")
    details = {RULE_BASED: (rule_prediction, rule_probability)}
    if model is None:
        prediction, probability, used = rule_prediction, rule_probability, F.lit(RULE_BASED)
    else:
        scored = with_model_score(scored, model)
        by_model = F.col("model_probability").isNotNull()
        prediction = F.coalesce(F.col("model_prediction"), rule_prediction)
        probability = F.coalesce(F.col("model_probability"), rule_probability)
        used = F.when(by_model, F.lit(model.family)).otherwise(F.lit(RULE_BASED))
        details[model.family] = (F.col("model_prediction"), F.col("model_probability"))
    return scored.withColumn(
        "result", result_struct(prediction, probability, used, details)
    ).select(*df.columns, "result")


def flat_result(df: DataFrame, *keep: str) -> DataFrame:
    """The result struct as plain columns."""
    return df.select(
        *keep,
        "result.prediction",
        "result.probability",
        "result.model_used",
        *(
            F.col(f"result.details.{source}.{part}").alias(f"{source}_{part}")
            for source in (*FAMILIES, RULE_BASED)
            for part in ("prediction", "probability")
        ),
    )
