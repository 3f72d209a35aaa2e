"""Result struct and the texts shown for a prediction."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskflow.functions.scalar import percent_text
from riskflow.schemas import TASKS

# The shown texts per task and prediction (1 high, 0 low).
TEXTS = {
    "diabetes": {
        1: ("High Risk of Diabetes", "Further clinical tests are recommended."),
        0: ("Low Risk of Diabetes", "Maintain a healthy lifestyle and regular check-ups."),
    },
    "heart": {
        1: ("High Risk of Heart Attack", "Immediate medical consultation is advised."),
        0: ("Low Risk of Heart Attack", "Maintain a healthy lifestyle and regular check-ups."),
    },
}
BANDS = {1: "high-risk", 0: "low-risk"}
MESSAGE = ("The prediction indicates a ", " probability of {subject}.")


def _choose(prediction: Column, high: str, low: str) -> Column:
    return F.when(prediction == 1, F.lit(high)).otherwise(F.lit(low))


def with_report(
    df: DataFrame, task: str, prediction: str = "prediction", probability: str = "probability"
) -> DataFrame:
    """Add risk band, headline, message and recommendation to scored rows."""
    texts = TEXTS[task]
    p = F.col(prediction)
    return df.withColumns(
        {
            "risk_band": _choose(p, BANDS[1], BANDS[0]),
            "headline": _choose(p, texts[1][0], texts[0][0]),
            "message": F.concat(
                F.lit(MESSAGE[0]),
                percent_text(F.col(probability)),
                F.lit(MESSAGE[1].format(subject=TASKS[task].subject)),
            ),
            "recommendation": _choose(p, texts[1][1], texts[0][1]),
        }
    )
