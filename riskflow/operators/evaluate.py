"""Exact evaluation of scored tables, any number of candidates per job."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskflow.session import discard, materialize

# Gates on the AUC: fixed values.
ACCEPTABLE_AUC, DEPLOYABLE_AUC = 0.70, 0.80


def unpivot_scores(
    df: DataFrame, scores: Mapping[str, str], label: str, keep: Sequence[str] = ()
) -> DataFrame:
    """(candidate, score, label) rows out of one score column per candidate."""
    named = df.select(
        *keep,
        F.col(label).alias("label"),
        *(F.col(column).cast("double").alias(name) for name, column in scores.items()),
    )
    return named.unpivot([*keep, "label"], list(scores), "candidate", "score")


def score_counts(df: DataFrame, group: Sequence[str], score: str, label: str, prediction: str) -> DataFrame:
    """Positives and negatives per distinct score, and how many of each are predicted positive.

    Combined on the map side, so a score shared by many rows costs one row per task.
    Rows of equal score are ties whatever their prediction. Rows without a score or a
    label cannot be ranked: they count for nothing and go after the aggregate. A
    filter before it would be pushed below the scoring and compute every score twice.
    """
    scored = F.col(score).isNotNull() & ~F.isnan(score)
    positive, negative = scored & (F.col(label) == 1), scored & (F.col(label) != 1)
    predicted = F.coalesce(F.col(prediction) == 1, F.lit(False))
    return (
        df.groupBy(*group, F.col(score).alias("score"))
        .agg(
            F.count_if(positive).alias("n_pos"),
            F.count_if(negative).alias("n_neg"),
            F.count_if(positive & predicted).alias("tp"),
            F.count_if(negative & predicted).alias("fp"),
        )
        .filter(F.col("n_pos") + F.col("n_neg") > 0)
    )


def _score_edges(counts: DataFrame, buckets: int) -> list[float]:
    """Cuts at approximate quantiles of the distinct scores; a table without rows has none."""
    cuts = [i / buckets for i in range(1, buckets)]
    edges = sorted(set(counts.approxQuantile("score", cuts, 0.25 / buckets)))
    return [float("-inf"), *(edges or [0.0]), float("inf")]


def _default_buckets(counts: DataFrame) -> int:
    partitions = int(counts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(64, 4 * partitions)


def _ranked_by_bucket(counts: DataFrame, group: Sequence[str], buckets: int | None) -> DataFrame:
    """Positives, negatives and ordered pairs inside each bucket of scores."""
    buckets = max(2, buckets or _default_buckets(counts))
    bucketed = Bucketizer(
        splits=_score_edges(counts, buckets), inputCol="score", outputCol="bucket"
    ).transform(counts)
    inside = (
        Window.partitionBy(*group, "bucket")
        .orderBy("score")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    below = F.sum("n_neg").over(inside) - F.col("n_neg")
    return bucketed.withColumn("pairs", _pairs(F.col("n_pos"), below, F.col("n_neg")))


def _pairs(positives: Column, negatives_below: Column, negatives_equal: Column) -> Column:
    """Positives ranked above negatives, ties counted half; doubles, as products outgrow a long."""
    return positives.cast("double") * (
        negatives_below.cast("double") + negatives_equal.cast("double") / F.lit(2.0)
    )


def _sums() -> list[Column]:
    return [F.sum(name).alias(name) for name in ("n_pos", "n_neg", "tp", "fp")]


def evaluate(
    df: DataFrame,
    group: Sequence[str] = ("candidate",),
    score: str = "score",
    label: str = "label",
    prediction: str | None = None,
    buckets: int | None = None,
) -> DataFrame:
    """AUC, accuracy, precision, recall and F1 of every group.

    The AUC is the exact rank statistic over distinct scores. The scores are cut
    into buckets at approximate quantiles and ranked inside each bucket; a window
    over the buckets adds the pairs between them. The cuts only balance the work,
    any cuts give the same result. No task sees more than one bucket.
    """
    if prediction is None:
        prediction = "prediction"
        df = df.withColumn(prediction, (F.col(score) >= 0.5).cast("int"))
    return evaluate_counts(score_counts(df, group, score, label, prediction), group, buckets)


def evaluate_counts(
    counts: DataFrame, group: Sequence[str] = ("candidate",), buckets: int | None = None
) -> DataFrame:
    """The same from positives and negatives per distinct score, as ``score_counts`` gives them."""
    # Two passes read the counts, so write them once.
    counts = materialize(counts, "score_counts")
    ranked = _ranked_by_bucket(counts, group, buckets)
    by_bucket = ranked.groupBy(*group, "bucket").agg(*_sums(), F.sum("pairs").alias("pairs"))
    between = (
        Window.partitionBy(*group)
        .orderBy("bucket")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    lower = F.coalesce(F.sum("n_neg").over(between), F.lit(0)).cast("double")
    totals = (
        by_bucket.withColumn("pairs", F.col("pairs") + F.col("n_pos").cast("double") * lower)
        .groupBy(*group)
        .agg(*(F.sum(name).alias(name) for name in ("n_pos", "n_neg", "tp", "fp", "pairs")))
    )
    # A row per group; once it is written, the counts are of no more use.
    totals = materialize(totals, "evaluated")
    discard(counts)
    return _report(totals, group)


def _report(totals: DataFrame, group: Sequence[str]) -> DataFrame:
    n_pos, n_neg, tp, fp = (F.col(name) for name in ("n_pos", "n_neg", "tp", "fp"))
    fn, tn = n_pos - tp, n_neg - fp
    return totals.select(
        *group,
        (n_pos + n_neg).alias("n_rows"),
        F.try_divide(F.col("pairs"), n_pos.cast("double") * n_neg.cast("double")).alias("auc"),
        *_ratios(tp, fp, fn, tn),
    )


def _ratios(tp: Column, fp: Column, fn: Column, tn: Column) -> list[Column]:
    return [
        F.try_divide(tp + tn, tp + fp + fn + tn).alias("accuracy"),
        F.try_divide(tp, tp + fp).alias("precision"),
        F.try_divide(tp, tp + fn).alias("recall"),
        F.try_divide(2 * tp, 2 * tp + fp + fn).alias("f1"),
    ]


def classification_report(
    df: DataFrame, group: Sequence[str] = (), prediction: str = "prediction", label: str = "label"
) -> DataFrame:
    """Confusion counts and their ratios in one aggregate."""
    p, y = F.col(prediction) == 1, F.col(label) == 1
    counts = df.groupBy(*group).agg(
        F.count_if(p & y).alias("tp"),
        F.count_if(p & ~y).alias("fp"),
        F.count_if(~p & y).alias("fn"),
        F.count_if(~p & ~y).alias("tn"),
    )
    return counts.select("*", *_ratios(*(F.col(name) for name in ("tp", "fp", "fn", "tn"))))


def with_gate(df: DataFrame, auc: str = "auc") -> DataFrame:
    """Quality gate of each evaluated candidate."""
    gate = (
        F.when(F.col(auc) >= DEPLOYABLE_AUC, "deployable")
        .when(F.col(auc) >= ACCEPTABLE_AUC, "acceptable")
        .otherwise("rejected")
    )
    return df.withColumn("gate", gate)
