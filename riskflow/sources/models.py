"""Saving and loading fitted pipelines."""

from __future__ import annotations

import logging

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.ml import PipelineModel

from riskflow.operators.score import ChosenModel

_log = logging.getLogger(__name__)


def save_model(pipeline: PipelineModel, path: str) -> None:
    """Save preparation and classifier together, replacing what was there."""
    pipeline.write().overwrite().save(path)


def load_model(path: str, family: str) -> ChosenModel:
    return ChosenModel(family, PipelineModel.load(path))


def try_load(path: str, family: str) -> ChosenModel | None:
    """The model, or None where it is missing, incomplete or not one of ours.

    Called while planning: a broken model must not fail the job at the sink.
    """
    try:
        return load_model(path, family)
    except (Py4JJavaError, PySparkException, ValueError, AttributeError) as error:
        _log.warning("model %s not usable: %s", path, str(error).splitlines()[0])
        return None
