"""Stored parts: rejects, merged statistics, replaced partitions, registry commits, model refresh."""

import random
import threading

import pytest
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.sql import functions as F

from riskflow.operators import partial, prepare, quality
from riskflow.operators.evaluate import evaluate
from riskflow.operators.train import LR, fit, training_set
from riskflow.plans import jobs
from riskflow.schemas import DIABETES, HEART
from riskflow.sources import registry, tables
from riskflow.sources.ingest import ingest, read_text
from riskflow.sources.views import DIABETES_KEY, HEART_KEY, diabetes_records, heart_records, table
from riskflow.streaming.refresh import CurrentModel, write_batch

SCHEMA = "id long, a int, b double"


def _rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def _plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


# --- ingestion -------------------------------------------------------------


def test_unreadable_cells_go_aside_and_the_row_stays(spark, tmp_path):
    path = tmp_path / "t.csv"
    path.write_text("b,id,a,note\n1.5,1,3.0,x\n,2,14O,y\n  ,3,2.5,\nabc,4,,z\nNaN,x5,7,w\n")
    found = ingest(read_text(spark, str(path)), SCHEMA, ["id"])
    assert _rows(found.rejects) == sorted(
        [("2", "a", "14O"), ("3", "a", "2.5"), ("4", "b", "abc"), ("x5", "id", "x5")], key=repr
    )
    assert found.table.columns == ["b", "id", "a", "note"]
    assert found.table.filter("id = 1").first()[:3] == (1.5, 1, 3)
    assert found.table.count() == found.n_rows == 5
    assert found.counts == {"id": (4, 0, 1), "a": (2, 1, 2), "b": (2, 2, 1)}


def test_lines_that_do_not_fit_the_header_are_rejected_whole(spark, tmp_path):
    path = tmp_path / "t.csv"
    path.write_text("id,a,b\n1,2,3\n2,2\n3,2,3,4\n")
    found = ingest(read_text(spark, str(path)), SCHEMA, ["id"])
    assert [r["id"] for r in found.table.collect()] == [1]
    assert sorted(r["raw"] for r in found.rejects.filter("column IS NULL").collect()) == ["2,2", "3,2,3,4"]
    assert (found.n_rows, found.n_malformed) == (3, 2)
    with pytest.raises(ValueError, match="lines"):
        found.check(0.5)


def test_too_many_rejects_are_an_error_that_names_the_column(spark):
    text = spark.createDataFrame([("1", "x", "1")] * 3 + [("2", "5", "1")], "id string, a string, b string")
    found = ingest(text, SCHEMA)
    found.check(0.75)
    with pytest.raises(ValueError, match=r"a \(3 of 4 rows\)"):
        found.check(0.5)


def test_empty_text_table(spark):
    found = ingest(spark.createDataFrame([], "id string, a string, b string"), SCHEMA, ["id"])
    assert (found.table.count(), found.rejects.count(), found.n_rows) == (0, 0, 0)
    found.check(0.0)


def test_text_is_read_once(spark):
    read = spark.sparkContext.accumulator(0)
    text = spark.createDataFrame(
        spark.sparkContext.parallelize(range(20), 2).map(lambda i: read.add(1) or (str(i), "x", "1")),
        "id string, a string, b string",
    )
    found = ingest(text, SCHEMA, ["id"])
    assert found.rejects.count() == 20 and found.table.count() == 20
    assert read.value == 20


# --- counts along the way ----------------------------------------------------


def test_dropped_rows_cost_no_scan(spark, sf_dir):
    records = heart_records(spark, sf_dir)
    task = jobs.with_features(HEART, records, HEART_KEY)
    counted, tally = jobs.counting_dropped(records, task)
    ready = jobs.training_records(counted, task, HEART_KEY)
    plan = _plan(ready)
    assert plan.count("CollectMetrics") == 1 and plan.count("Relation") == _plan(records).count("Relation")
    data = training_set(ready, task, HEART_KEY, session=spark)
    missing = records.filter("age IS NULL OR cholesterol IS NULL").count()
    assert tally.get()["dropped_rows"] == missing > 0
    assert data.train.count() + data.test.count() == records.count() - missing
    # What was counted leaves no trace: evaluators still run in this session.
    model = fit(data, LR)
    scored = model.pipeline.stages[-1].transform(data.train)
    assert BinaryClassificationEvaluator(labelCol=task.label).evaluate(scored) > 0.5
    assert data.train.sparkSession is spark
    data.discard()


def test_valid_and_rejected_from_one_write(spark, sf_dir, tmp_path):
    records = heart_records(spark, sf_dir)
    found = quality.write_validated(records, quality.HEART_INPUT_RULES, str(tmp_path / "v"))
    valid, rejected = quality.split_valid(records, quality.HEART_INPUT_RULES)
    assert found.valid.columns == records.columns
    assert _rows(found.valid) == _rows(valid)
    assert _rows(found.rejected.select(rejected.columns)) == _rows(rejected)
    assert (found.n_rows, found.n_rejected) == (records.count(), rejected.count())
    assert _plan(found.rejected).count("Relation") == 1 and "Join" not in _plan(found.rejected)


def test_validated_tables_without_one_part(spark, tmp_path):
    rule = quality.Rule("a", "a", 0, 10)
    for i, (values, n) in enumerate((([1, 2], 0), ([11, None], 2), ([], 0))):
        df = spark.createDataFrame([(v,) for v in values], "a int")
        found = quality.write_validated(df, [rule], str(tmp_path / f"t{i}"))
        assert (found.valid.count(), found.rejected.count()) == (len(values) - n, n)
        assert found.failures == {"a": n}


# --- sinks -------------------------------------------------------------------


def test_only_the_given_partitions_are_replaced(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.range(90).withColumn("p", F.col("id") % 3)
    tables.write_parquet(df, path, partition_by=["p"], sized=True)

    def others():
        return {f for f in spark.read.parquet(path).inputFiles() if "/p=1/" not in f}

    files = others()
    tables.write_parquet(df.filter("id = 1"), path, partition_by=["p"], replace_partitions=True)
    assert others() == files and len(files) >= 2
    assert [r["id"] for r in spark.read.parquet(path).filter("p = 1").collect()] == [1]
    with pytest.raises(ValueError, match="partition columns"):
        tables.write_parquet(df, path, replace_partitions=True)


def test_sized_writes_join_small_tasks(spark, tmp_path):
    df = spark.range(1000).repartition(40)
    tables.write_parquet(df, str(tmp_path / "many"))
    tables.write_parquet(df, str(tmp_path / "few"), sized=True)
    many, few = (len(spark.read.parquet(str(tmp_path / n)).inputFiles()) for n in ("many", "few"))
    assert many == 40 and few < 8


# --- mergeable statistics ----------------------------------------------------


def test_merged_preparation_equals_a_fit_on_all(spark, sf_dir, tmp_path):
    records = diabetes_records(spark, sf_dir)
    path, part = str(tmp_path / "s"), F.col("l_linenumber")
    for lines in ([1], [2, 3, 4], [5, 6, 7], [2]):
        partial.save_parts(
            partial.part_statistics(records.filter(part.isin(lines)), DIABETES.features, part), path
        )
    merged = partial.preparation(
        partial.read_statistics(spark, path), DIABETES.features, DIABETES.zero_columns
    )
    whole = prepare.fit_preparation(records, DIABETES.features, DIABETES.zero_columns)
    assert merged.n_rows == whole.n_rows
    for name in DIABETES.features:
        assert merged.mean[name] == pytest.approx(whole.mean[name], rel=1e-12)
        assert merged.std[name] == pytest.approx(whole.std[name], rel=1e-10)
    assert merged.fill == pytest.approx(whole.fill, rel=1e-12)


def test_large_means_cost_no_digits(spark):
    rnd = random.Random(1)
    rows = [(i % 9, 1e9 + rnd.random()) for i in range(900)] + [(10, None), (11, float("nan")), (12, 0.0)]
    df = spark.createDataFrame(rows, "p int, x double")
    got = partial.merged_statistics(partial.part_statistics(df, ["x"], F.col("p"))).first()
    values = [x for p, x in rows if p < 9]
    mean = sum(values) / len(values)
    m2 = sum((x - mean) ** 2 for x in values)
    assert (got["n_rows"], got["n_zero"], got["n"]) == (903, 1, 900)
    assert got["filled_std"] == pytest.approx((m2 / 900) ** 0.5, rel=1e-5)


def test_statistics_of_nothing(spark):
    df = spark.createDataFrame([("a", None), ("b", 0.0)], "p string, x double")
    got = partial.merged_statistics(partial.part_statistics(df, ["x"], F.col("p"))).first()
    assert got["mean_nonzero"] is None and got["mean"] == 0.0
    with pytest.raises(ValueError, match="impute"):
        partial.preparation(partial.part_statistics(df, ["x"], F.col("p")), ["x"], ["x"])


def test_evaluation_of_stored_batches_equals_one_of_all(spark, tmp_path):
    rnd = random.Random(2)
    rows = [("m", rnd.choice([0.1, 0.2, 0.5, rnd.random()]), rnd.randrange(2), i % 4) for i in range(2_000)]
    df = spark.createDataFrame(rows, "candidate string, score double, label int, batch int")
    df = df.withColumn("prediction", (F.col("score") >= 0.5).cast("int"))
    path = str(tmp_path / "c")
    for batch in (0, 1, 2, 3, 1):
        partial.save_score_counts(df.filter(F.col("batch") == batch), path, F.col("batch"))
    stored = partial.evaluate_stored(spark, path).first()
    assert stored.asDict() == pytest.approx(evaluate(df, prediction="prediction").first().asDict())


# --- registry ----------------------------------------------------------------


def _entries(spark, run_id, task, auc, at="2024-01-01 00:00:00"):
    row = (run_id, task, "random_forest", f"x/{run_id}/{task}_random_forest", auc)
    df = spark.createDataFrame([row], "run_id string, task string, family string, path string, auc double")
    names = [item.split(" ", 1) for item in registry.SCHEMA.split(", ")]
    return df.withColumn("trained_at", F.lit(at).cast("timestamp")).select(
        *(F.col(n) if n in (*df.columns, "trained_at") else F.lit(None).cast(k).alias(n) for n, k in names)
    )


def test_runs_are_seen_when_committed_and_not_before(spark, tmp_path):
    path, text = str(tmp_path / "registry"), str(tmp_path / "best")
    assert registry.read(spark, path).count() == 0
    # Two runs interleave, a third one dies before its commit.
    registry.stage(_entries(spark, "a", "heart", 0.7), path, "a")
    registry.stage(_entries(spark, "b", "diabetes", 0.8), path, "b")
    registry.stage(_entries(spark, "dead", "heart", 0.99, "2025-01-01 00:00:00"), path, "dead")
    assert registry.read(spark, path).count() == 0
    assert registry.commit(spark, path, "b")
    assert [r["run_id"] for r in registry.read(spark, path).collect()] == ["b"]
    registry.publish_lines(spark, path, text)
    registry.stage(_entries(spark, "a", "diabetes", 0.9, "2024-02-01 00:00:00"), path, "a")
    assert registry.commit(spark, path, "a") and not registry.commit(spark, path, "a")
    registry.publish_lines(spark, path, text)
    best = {r["task"]: r["path"] for r in registry.read_lines(spark, text).collect()}
    assert best == {"heart": "x/a/heart_random_forest", "diabetes": "x/a/diabetes_random_forest"}


def test_runs_at_the_same_time_lose_nothing(spark, tmp_path):
    path = str(tmp_path / "registry")

    def run(i):
        registry.append(_entries(spark, f"run{i}", f"task{i}", 0.5), path)

    threads = [threading.Thread(target=run, args=(i,)) for i in range(6)]
    for thread in threads:
        thread.start()
    for thread in threads:
        thread.join()
    assert registry.read(spark, path).select("task").distinct().count() == 6


# --- stream with model refresh -----------------------------------------------


def test_a_repeated_batch_adds_no_row(spark, tmp_path):
    sink = str(tmp_path / "sink")
    for batch, rows in ((0, 5), (1, 7), (1, 7), (2, 0)):
        write_batch(spark.range(rows), sink, batch)
    counts = {r["batch"]: r["count"] for r in spark.read.parquet(sink).groupBy("batch").count().collect()}
    assert counts == {0: 5, 1: 7}


def test_models_are_loaded_again_only_after_a_commit(spark, tmp_path, monkeypatch):
    path, calls = str(tmp_path / "registry"), []
    monkeypatch.setattr(registry, "resolve", lambda *args: calls.append(args) or len(calls))
    model = CurrentModel(spark, path, "heart")
    assert [model.get(["age"]) for _ in range(3)] == [1, 1, 1]
    registry.append(_entries(spark, "a", "heart", 0.9), path)
    assert [model.get(["age"]) for _ in range(3)] == [2, 2, 2]


def test_key_columns_of_the_view(spark, sf_dir):
    assert set(DIABETES_KEY) <= set(table(spark, sf_dir, "lineitem").columns)
