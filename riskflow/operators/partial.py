"""Statistics and score counts stored per part of the input, merged without reading a part again.

A store is a folder with one partition per part. Writing a part replaces that part alone, so a
repeated or corrected delivery does not count twice.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from riskflow.functions.scalar import as_number, quoted
from riskflow.operators.evaluate import evaluate_counts, score_counts
from riskflow.operators.prepare import Preparation
from riskflow.sources.tables import write_parquet

PART = "part"

STATS_SCHEMA = (
    "feature string, n_rows long, n_zero long, n long, mean double, m2 double, part string"
)


def part_statistics(df: DataFrame, features: Sequence[str], part: Column) -> DataFrame:
    """Per part and feature: rows, zeros, and the count, mean and sum of squared deviations of
    the other values; nulls and NaN count as rows only. One aggregate, combined on the map side."""
    measures, entries = [F.count(F.lit(1)).alias("n_rows")], []
    for i, name in enumerate(features):
        number = as_number(F.col(quoted(name)))
        value = F.when(number != 0, number)
        measures += [
            F.count_if(number == 0).alias(f"zero_{i}"),
            F.count(value).alias(f"n_{i}"),
            F.avg(value).alias(f"mean_{i}"),
            F.var_pop(value).alias(f"var_{i}"),
        ]
        entries.append(
            F.struct(
                F.lit(name).alias("feature"), F.col("n_rows"), F.col(f"zero_{i}").alias("n_zero"),
                F.col(f"n_{i}").alias("n"), F.coalesce(f"mean_{i}", F.lit(0.0)).alias("mean"),
                (F.coalesce(f"var_{i}", F.lit(0.0)) * F.col(f"n_{i}")).alias("m2"),
            )
        )
    by_part = df.groupBy(part.cast("string").alias(PART)).agg(*measures)
    return by_part.select(PART, F.inline(F.array(*entries)))


def save_parts(stats: DataFrame, path: str) -> None:
    """Write the parts that ``stats`` has, in place of what was stored for them."""
    write_parquet(stats, path, partition_by=[PART], replace_partitions=True)


def read_statistics(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(STATS_SCHEMA).parquet(path)


def merged_statistics(stats: DataFrame) -> DataFrame:
    """One row per feature over all parts: ``n_rows``, ``n_zero``, ``n``, ``mean_nonzero``; ``mean`` and
    ``std`` of all values; ``filled_std``, that with zeros replaced by the others' mean.

    Deviations are summed around the common mean, as for parallel variances, so
    large means cost no digits. A part is one row of a feature.
    """
    of_feature = Window.partitionBy("feature")
    total = F.sum("n").over(of_feature)
    common = F.try_divide(F.sum(F.col("n") * F.col("mean")).over(of_feature), total)
    merged = (
        stats.withColumn("common", common)
        .withColumn("m2", F.col("m2") + F.coalesce(F.col("n") * F.pow(F.col("mean") - F.col("common"), 2), F.lit(0.0)))
        .groupBy("feature")
        .agg(
            *(F.sum(name).alias(name) for name in ("n_rows", "n_zero", "n", "m2")),
            F.first("common").alias("mean_nonzero"),
        )
    )
    values = F.col("n") + F.col("n_zero")
    # Zeros are one more part, of mean 0 and no deviation.
    all_m2 = F.col("m2") + F.coalesce(
        F.pow("mean_nonzero", 2) * F.col("n") * F.col("n_zero") / F.nullif(values, F.lit(0)), F.lit(0.0)
    )
    of_one_less = F.nullif(values - 1, F.lit(0))
    some = values > 0
    return merged.select(
        "feature", "n_rows", "n_zero", "n", "mean_nonzero",
        F.try_divide(F.coalesce(F.col("mean_nonzero") * F.col("n"), F.lit(0.0)), values).alias("mean"),
        F.when(some, F.sqrt(all_m2 / of_one_less)).alias("std"),
        F.when(some, F.sqrt(F.col("m2") / of_one_less)).alias("filled_std"),
    )


def preparation(
    stats: DataFrame, features: Sequence[str], zero_columns: Sequence[str] = ()
) -> Preparation:
    """The fitted preparation of all stored parts, from their statistics alone."""
    rows = {row["feature"]: row for row in merged_statistics(stats).collect()}  # a row per feature
    empty = [name for name in zero_columns if not rows[name]["n"]]
    if empty:
        raise ValueError(f"no non-zero value to impute from: {', '.join(empty)}")
    fill = {name: rows[name]["mean_nonzero"] for name in zero_columns}
    return Preparation(
        features=tuple(features),
        fill=fill,
        mean={name: fill.get(name, rows[name]["mean"]) or 0.0 for name in features},
        std={
            name: rows[name]["filled_std" if name in fill else "std"] or 0.0 for name in features
        },
        n_rows=rows[features[0]]["n_rows"],
    )


def save_score_counts(
    scored: DataFrame,
    path: str,
    part: Column,
    group: Sequence[str] = ("candidate",),
    score: str = "score",
    label: str = "label",
    prediction: str = "prediction",
) -> None:
    """Positives and negatives per distinct score of each part, in place of those stored for it."""
    parted = scored.withColumn(PART, part.cast("string"))
    counts = score_counts(parted, [PART, *group], score, label, prediction)
    write_parquet(counts, path, partition_by=[PART], replace_partitions=True)


def evaluate_stored(spark: SparkSession, path: str, group: Sequence[str] = ("candidate",)) -> DataFrame:
    """Metrics over all stored parts: counts of equal scores are added, then ranked once."""
    sums = [F.sum(name).alias(name) for name in ("n_pos", "n_neg", "tp", "fp")]
    counts = spark.read.parquet(path).groupBy(*group, "score").agg(*sums)
    return evaluate_counts(counts, group)
