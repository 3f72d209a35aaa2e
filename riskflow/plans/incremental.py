"""Queries over stored parts: ingestion with rejects, merged statistics, replaced partitions, model refresh."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskflow.functions import rules
from riskflow.operators import evaluate as ev
from riskflow.operators import partial, quality
from riskflow.operators.score import flat_result, score
from riskflow.plans import jobs
from riskflow.plans.queries import query, trained
from riskflow.schemas import DIABETES, DIABETES_SCHEMA, HEART
from riskflow.session import scratch_path
from riskflow.sources import registry, tables
from riskflow.sources.ingest import Ingested, ingest, read_text
from riskflow.sources.views import (
    DIABETES_KEY,
    HEART_KEY,
    diabetes_from,
    diabetes_records,
    heart_records,
    table,
)
from riskflow.streaming.refresh import CurrentModel, scorer, score_arrivals


def _ingested(spark, sf_dir) -> Ingested:
    """Diabetes records as a CSV with letters for digits, fractions of a year, words, blanks and
    empty cells in it."""
    text = diabetes_records(spark, sf_dir).select(
        *(F.col(name).cast("string").alias(name) for name in DIABETES_SCHEMA.fieldNames())
    )
    damaged = text.withColumns(
        {
            "glucose": F.expr("CASE WHEN l_orderkey % 97 = 5 THEN '14O' ELSE glucose END"),
            "age": F.expr("CASE WHEN l_partkey % 89 = 3 THEN concat(age, '.5') ELSE age END"),
            "bmi": F.expr("CASE WHEN l_suppkey % 31 = 7 THEN 'n/a' ELSE bmi END"),
            "insulin": F.expr("CASE WHEN l_orderkey % 53 = 0 THEN NULL ELSE insulin END"),
            "dpf": F.expr("CASE WHEN l_orderkey % 59 = 1 THEN '   ' ELSE dpf END"),
        }
    )
    path = scratch_path(spark, "damaged_csv")
    tables.write_csv(damaged, path)
    return ingest(read_text(spark, path), DIABETES_SCHEMA, DIABETES_KEY)


@query
def csv_quarantine(spark, sf_dir):
    """Per column: rows, cells read, empty and rejected, counted while the file was read, beside the
    nulls in the resulting table and the rejects on the side."""
    found = _ingested(spark, sf_dir)
    rows = [(name, found.n_rows, *counts) for name, counts in found.counts.items()]
    counts = spark.createDataFrame(
        rows, "column_name string, n_rows long, n_read long, n_empty long, n_rejected long"
    )
    aside = found.rejects.groupBy(F.col("column").alias("column_name")).agg(
        F.count(F.lit(1)).alias("n_aside")
    )
    nulls = quality.profile(found.table).select("column_name", "n_null")
    return counts.join(nulls, "column_name").join(aside, "column_name", "left").withColumn(
        "n_aside", F.coalesce("n_aside", F.lit(0).cast("long"))
    )


@query
def csv_rejected_cells(spark, sf_dir):
    """Every cell that could not be read, with the key of its record and its text."""
    return _ingested(spark, sf_dir).rejects


def _by_line(records: DataFrame, lines: list[int]) -> DataFrame:
    return records.filter(F.col("l_linenumber").isin(lines))


@query
def merged_statistics(spark, sf_dir):
    """Statistics of several deliveries, merged: two at once, others one by one, one of them twice."""
    records = diabetes_records(spark, sf_dir)
    path, part = scratch_path(spark, "part_statistics"), F.col("l_linenumber")
    halved = records.withColumn("glucose", F.col("glucose") / 2)
    for delivery in (
        _by_line(records, [1, 2]), _by_line(halved, [3]), _by_line(records, [3]),
        records.filter("l_linenumber > 3"),
    ):
        partial.save_parts(partial.part_statistics(delivery, DIABETES.features, part), path)
    merged = partial.merged_statistics(partial.read_statistics(spark, path))
    digits = ("mean_nonzero", "mean", "std", "filled_std")
    return merged.select(
        "feature", "n_rows", "n_zero", *(F.round(name, 8).alias(name) for name in digits)
    )


@query
def merged_evaluation(spark, sf_dir):
    """Rule scores and measurements evaluated over stored counts of two batches; the first is not
    scored again for the second."""
    path = scratch_path(spark, "part_scores")
    for rest in (0, 1):
        batch = diabetes_records(spark, sf_dir).filter(F.col("l_orderkey") % 2 == rest)
        scored = rules.with_rule_score(batch, rules.DIABETES_RULES)
        scores = {"rule_score": "rule_probability", "glucose": "glucose", "bmi": "bmi", "dpf": "dpf"}
        named = ev.unpivot_scores(scored, scores, DIABETES.label)
        named = named.withColumn("prediction", (F.col("score") >= 0.5).cast("int"))
        partial.save_score_counts(named, path, F.lit(rest))
    report = partial.evaluate_stored(spark, path)
    return report.select(
        "candidate", "n_rows", *(F.round(n, 6).alias(n) for n in ("auc", "accuracy", "precision", "recall", "f1"))
    )


@query
def validated_once(spark, sf_dir):
    """Valid and rejected records out of one write, with what was counted along the way."""
    found = quality.write_validated(
        heart_records(spark, sf_dir), quality.HEART_INPUT_RULES, scratch_path(spark, "validated")
    )
    by_rules = found.rejected.groupBy(F.array_join("violations", ",").alias("violations"))
    rows = by_rules.agg(F.count(F.lit(1)).alias("n_rows"))
    valid = found.valid.agg(F.lit("").alias("violations"), F.count(F.lit(1)).alias("n_rows"))
    counted = [("n_rows", found.n_rows), ("n_rejected", found.n_rejected)]
    counted += [(f"rule {name}", n) for name, n in found.failures.items()]
    return rows.unionByName(valid).unionByName(
        spark.createDataFrame(counted, "violations string, n_rows long")
    )


@query
def partitions_replaced(spark, sf_dir):
    """Scores by segment; one segment is scored again from changed records. Its rows change, the
    other segments' files stay."""
    path = scratch_path(spark, "by_segment")
    records = jobs.encoded(heart_records(spark, sf_dir), HEART)

    def save(rows: DataFrame) -> None:
        scored = flat_result(score(rows, "heart"), *HEART_KEY, "state_name")
        tables.write_parquet(
            scored, path, partition_by=["state_name"], replace_partitions=True, sized=True
        )

    def files() -> DataFrame:
        return spark.read.parquet(path).select("state_name", F.input_file_name().alias("file")).distinct()

    save(records)
    before = files().groupBy("state_name").agg(F.sort_array(F.collect_list("file")).alias("before"))
    before = spark.createDataFrame(before.collect(), before.schema)  # a row per segment
    save(records.filter("state_name = 'BUILDING'").withColumn("smoking", F.lit(1)))
    after = files().groupBy("state_name").agg(F.sort_array(F.collect_list("file")).alias("after"))
    kept = before.join(after, "state_name").select(
        "state_name", (F.col("before") == F.col("after")).alias("files_kept")
    )
    sums = spark.read.parquet(path).groupBy("state_name").agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum("prediction").alias("n_high")
    )
    return sums.join(kept, "state_name")


@query
def stream_refreshed_model(spark, sf_dir):
    """Half the records arrive before a model is registered, half after; the last micro-batch is
    then repeated."""
    folder, _ = trained(spark, sf_dir)
    source, sink, log, runs = (
        scratch_path(spark, name) for name in ("arrivals", "refreshed", "refresh_log", "refresh_runs")
    )
    lineitem = table(spark, sf_dir, "lineitem")

    def arrive(rest: int) -> None:
        lineitem.filter(F.col("l_orderkey") % 2 == rest).write.mode("append").parquet(source)
        score_arrivals(
            spark, source, lineitem.schema, diabetes_from, "diabetes", DIABETES_KEY, runs, sink, log
        ).awaitTermination()

    arrive(0)
    rows = registry.latest_run(registry.read(spark, f"{folder}/registry"))
    registry.append(rows.filter("task = 'diabetes'"), runs)
    arrive(1)
    again = scorer("diabetes", DIABETES_KEY, CurrentModel(spark, runs, "diabetes"), diabetes_from, sink)
    again(lineitem.filter("l_orderkey % 2 = 1"), 1)
    streamed = spark.read.parquet(sink)
    return streamed.groupBy("batch").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(F.col("model_used") == "rule_based").alias("n_by_rules"),
        F.round(F.sum("rule_based_probability"), 4).alias("sum_rule_scores"),
    )
