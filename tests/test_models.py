"""Training, registry and the fallback chain."""

import pytest
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from riskflow.operators.score import ChosenModel, flat_result, score, with_model_score
from riskflow.operators import train
from riskflow.operators.train import GRIDS, LR, RF, fit, training_set, tune
from riskflow.plans import jobs
from riskflow.plans.queries import trained
from riskflow.schemas import DIABETES, HEART
from riskflow.session import scratch_root
from riskflow.sources import registry, tables
from riskflow.sources.models import save_model, try_load
from riskflow.sources.views import DIABETES_KEY, HEART_KEY, diabetes_records, heart_records


@pytest.fixture(scope="module")
def fitted(spark, sf_dir):
    return trained(spark, sf_dir)


def test_registry_has_each_family_and_task(spark, fitted):
    rows = registry.read(spark, f"{fitted[0]}/registry").collect()
    assert {(r.task, r.family) for r in rows} == {(t, f) for t in ("diabetes", "heart") for f in (LR, RF)}
    assert all(r.complete and 0 < r.auc <= 1 and r.train_seconds > 0 for r in rows)
    assert all(r.auc > 0.9 and r.gate == "deployable" for r in rows if r.task == "diabetes")


def test_grids_are_complete_and_the_best_point_is_chosen(fitted):
    for fits in fitted[1].values():
        for model in fits:
            sizes = {LR: 9, RF: 4}
            assert len(model.grid) == sizes[model.family]
            best = max(model.grid, key=lambda point: point["mean_auc"])
            assert {k: v for k, v in best.items() if k != "mean_auc"} == model.params
            assert set(model.params) == set(GRIDS[model.family])


def test_probabilities_and_thresholds(spark, sf_dir, fitted):
    for model in fitted[1]["diabetes"]:
        chosen = ChosenModel(model.family, model.pipeline)
        scored = with_model_score(diabetes_records(spark, sf_dir), chosen)
        p, y = F.col("model_probability"), F.col("model_prediction")
        assert scored.filter(p.isNull() | (p < 0) | (p > 1)).count() == 0
        assert scored.filter((p > 0.5) != (y == 1)).count() == 0


def test_chain_prefers_the_registered_best(spark, sf_dir, fitted):
    folder = fitted[0]
    rows = registry.latest_run(registry.read(spark, f"{folder}/registry"))
    best = {r.task: r.family for r in registry.best(rows).collect()}
    assert registry.resolve(spark, f"{folder}/registry", "heart").family == best["heart"]
    result = jobs.score_table(heart_records(spark, sf_dir), "heart", HEART_KEY, folder)
    used = {r.model_used for r in result.select("model_used").distinct().collect()}
    assert used == {best["heart"], "rule_based"}
    lines = {r.task: r for r in registry.read_lines(spark, f"{folder}/best_models").collect()}
    assert set(lines) == {"diabetes", "heart"}


def test_incomplete_best_falls_to_the_other_family(spark, tmp_path, fitted):
    models = {m.family: m for m in fitted[1]["diabetes"]}
    good = str(tmp_path / "rf")
    save_model(models[RF].pipeline, good)
    rows = [
        ("r1", "diabetes", LR, str(tmp_path / "missing"), 0.95),
        ("r1", "diabetes", RF, good, 0.80),
    ]
    _append(spark, rows, tmp_path)
    chosen = registry.resolve(spark, str(tmp_path / "registry"), "diabetes")
    assert chosen.family == RF
    assert registry.resolve(spark, str(tmp_path / "registry"), "heart") is None
    assert registry.resolve(spark, str(tmp_path / "nowhere"), "heart") is None


def _append(spark, rows, folder, trained_at="2024-01-01 00:00:00"):
    df = spark.createDataFrame(rows, "run_id string, task string, family string, path string, auc double")
    columns = [item.split() for item in registry.SCHEMA.split(", ")]
    values = [
        (
            F.lit(trained_at).cast("timestamp")
            if name == "trained_at"
            else F.col(name) if name in df.columns else F.lit(None).cast(kind)
        ).alias(name)
        for name, kind in columns
    ]
    registry.append(df.select(*values), str(folder / "registry"))


def test_only_the_last_run_counts_and_ties_go_to_regression(spark, tmp_path):
    _append(spark, [("old", "heart", RF, "a", 0.99), ("old", "heart", LR, "b", 0.5)], tmp_path)
    _append(
        spark, [("new", "heart", RF, "c", 0.8), ("new", "heart", LR, "d", 0.8)], tmp_path,
        "2024-02-01 00:00:00",
    )
    table = registry.read(spark, str(tmp_path / "registry"))
    assert table.count() == 4
    assert registry.best(registry.latest_run(table)).first()["path"] == "d"
    assert registry.best(table).first()["path"] == "a"
    assert registry.deployable(table).count() == 3
    assert registry.deployable(table, "deployable").count() == 3


def test_text_lines(spark, tmp_path):
    path = tmp_path / "best.txt"
    path.write_text(
        "Best diabetes model: models/diabetes_model_lr\n"
        "note: ignored\n"
        "Best heart model:   /data/x:y/Heart_Model_RF  \n"
        "Best other model: models/tree\n"
    )
    rows = {r.task: (r.path, r.family) for r in registry.read_lines(spark, str(path)).collect()}
    assert rows == {
        "diabetes": ("models/diabetes_model_lr", LR),
        "heart": ("/data/x:y/Heart_Model_RF", RF),
        "other": ("models/tree", "unknown"),
    }


def test_model_needing_other_columns_is_passed_over(spark, tmp_path, fitted):
    path = str(tmp_path / "model")
    save_model(fitted[1]["diabetes"][0].pipeline, path)
    assert try_load(path, LR).features == DIABETES.features
    _append(spark, [("r1", "heart", LR, path, 0.9)], tmp_path)
    place = str(tmp_path / "registry")
    assert registry.resolve(spark, place, "heart", DIABETES.features) is not None
    assert registry.resolve(spark, place, "heart", HEART.features) is None


def test_classifier_of_another_width_is_refused(spark, fitted):
    wide, narrow = (fitted[1][task][0].pipeline for task in ("heart", "diabetes"))
    with pytest.raises(ValueError, match="8 features"):
        ChosenModel(LR, PipelineModel([*wide.stages[:-1], narrow.stages[-1]]))


def test_every_other_column_is_a_feature(spark, sf_dir):
    records = heart_records(spark, sf_dir).withColumn("income", F.col("ldl") * 2)
    task = jobs.with_features(HEART, records, HEART_KEY)
    assert task.features == (*HEART.features, "income")
    assert jobs.with_features(DIABETES, records, ()) is DIABETES
    noted = records.withColumn("note", F.lit("x"))
    with pytest.raises(ValueError, match="note"):
        jobs.training_records(noted, jobs.with_features(HEART, noted, HEART_KEY), HEART_KEY)


def test_missing_feature_goes_to_the_rule_book(spark, sf_dir, fitted):
    model = fitted[1]["diabetes"][0]
    chosen = ChosenModel(model.family, model.pipeline)
    gaps = diabetes_records(spark, sf_dir).withColumn("glucose", F.expr("nullif(glucose, 0)"))
    result = flat_result(score(gaps, "diabetes", chosen), "glucose")
    assert result.filter("glucose IS NULL").count() > 0
    assert result.filter("(glucose IS NULL) != (model_used = 'rule_based')").count() == 0
    wrong = result.filter("model_used = 'rule_based' AND probability != 0.2")
    assert wrong.count() == 0


def test_reserved_column_names_are_refused(spark, fitted):
    model = fitted[1]["diabetes"][0]
    chosen = ChosenModel(model.family, model.pipeline)
    df = spark.createDataFrame([(1,)], "prediction int")
    with pytest.raises(ValueError, match="prediction"):
        with_model_score(df, chosen)


def test_single_fit_is_repeatable(spark, sf_dir):
    records = jobs.training_records(heart_records(spark, sf_dir), HEART, HEART_KEY)
    weights = []
    for partitions in (3, 7):
        data = training_set(records.repartition(partitions), HEART, HEART_KEY)
        weights.append(fit(data, LR, regParam=0.1).classifier.coefficients.toArray())
        data.release()
    assert weights[0] == pytest.approx(weights[1], rel=1e-6)


def test_forest_does_not_depend_on_the_input_partitions(spark, sf_dir):
    records = jobs.training_records(heart_records(spark, sf_dir), HEART, HEART_KEY)
    weights = []
    for partitions in (1, 3, 7):
        data = training_set(records.repartition(partitions), HEART, HEART_KEY)
        assert data.train.rdd.getNumPartitions() == 8
        model = fit(data, RF, numTrees=5).classifier
        weights.append(model.featureImportances.toArray())
        data.discard()
    assert weights[0] == pytest.approx(weights[1], abs=1e-9)
    assert weights[0] == pytest.approx(weights[2], abs=1e-9)


def test_training_rows_can_be_bounded(spark, sf_dir):
    records = jobs.training_records(heart_records(spark, sf_dir), HEART, HEART_KEY)
    data = training_set(records, HEART, HEART_KEY, max_training_rows=300)
    assert 200 < data.train.count() < 400
    data.discard()


def test_one_fold_is_persisted_at_a_time(spark, sf_dir, monkeypatch):
    kind, now, most = type(spark.range(0)), [0], [0]
    persist, unpersist = kind.persist, kind.unpersist

    def counted(self, *args, **options):
        now[0] += 1
        most[0] = max(most[0], now[0])
        return persist(self, *args, **options)

    def released(self, *args, **options):
        now[0] -= 1
        return unpersist(self, *args, **options)

    records = jobs.training_records(heart_records(spark, sf_dir), HEART, HEART_KEY)
    data = training_set(records, HEART, HEART_KEY)
    monkeypatch.setattr(kind, "persist", counted)
    monkeypatch.setattr(kind, "unpersist", released)
    tune(data, LR, {"regParam": [0.1, 0.3]}, maxIter=2)
    assert (now[0], most[0]) == (0, 1)
    monkeypatch.undo()
    data.discard()


def _tables(spark):
    fs, root = tables._status(spark, scratch_root(spark))
    names = [s.getPath().getName() for s in fs.listStatus(root)] if fs.exists(root) else []
    return {n for n in names if "_records-" in n or n.startswith("score_counts-")}


def test_two_runs_leave_two_lines_and_no_scratch(spark, sf_dir, tmp_path, monkeypatch):
    monkeypatch.setattr(train, "GRIDS", {LR: {"regParam": [0.1]}, RF: {"numTrees": [2]}})
    before, folder = _tables(spark), str(tmp_path)
    jobs.train({"diabetes": (diabetes_records(spark, sf_dir), DIABETES_KEY)}, folder)
    renamed = heart_records(spark, sf_dir).withColumnRenamed("ldl", "air quality")
    jobs.train({"heart": (renamed, HEART_KEY)}, folder)
    lines = {r.task: r.family for r in registry.read_lines(spark, f"{folder}/best_models").collect()}
    assert set(lines) == {"diabetes", "heart"} and set(lines.values()) <= {LR, RF}
    rows = registry.read(spark, f"{folder}/registry").collect()
    missing = heart_records(spark, sf_dir).filter("age IS NULL OR cholesterol IS NULL").count()
    assert {r.dropped_rows for r in rows if r.task == "heart"} == {missing}
    assert _tables(spark) <= before
    model = registry.resolve(spark, f"{folder}/registry", "heart", jobs.encoded(renamed, HEART).columns)
    scored = with_model_score(jobs.encoded(renamed, HEART), model)
    assert scored.filter("model_probability IS NULL").count() == missing


def test_gate_keeps_models_out(spark, tmp_path, fitted):
    path = str(tmp_path / "model")
    save_model(fitted[1]["diabetes"][0].pipeline, path)
    _append(spark, [("r1", "diabetes", LR, path, 0.75)], tmp_path)
    place = str(tmp_path / "registry")
    assert registry.resolve(spark, place, "diabetes", minimum="acceptable") is not None
    assert registry.resolve(spark, place, "diabetes", minimum="deployable") is None


def test_training_reads_keys_of_both_tasks(spark, sf_dir):
    records = jobs.training_records(diabetes_records(spark, sf_dir), DIABETES, DIABETES_KEY)
    assert records.count() == diabetes_records(spark, sf_dir).count()


def test_writing_the_records_sorts_nothing(spark):
    """A task that has all records would otherwise hold them all to sort them by part."""
    rows = spark.range(60).select(
        F.col("id").alias("patient_id"), (F.col("id") % 2).alias("heart_attack_risk"), F.col("id").alias("age")
    )
    task = jobs.with_features(HEART, rows, HEART_KEY)
    data = training_set(rows.repartition(1), task, HEART_KEY, partitions=2)
    assert not [file for file in data.stored.inputFiles() if "/train=" in file]
    assert data.train.count() + data.test.count() == 60 and data.train.count() > 0 < data.test.count()
    assert "train" not in data.test.columns
    data.discard()


def test_forests_keep_the_nodes_of_rows(spark):
    """Rows are not sent from the root again at every level; the trees are the same."""
    from pyspark.ml.linalg import Vectors

    rows = spark.createDataFrame(
        [(Vectors.dense(i % 7, i % 11, i % 13), int(i % 7 + i % 11 > 8)) for i in range(400)],
        ["features", "label"],
    ).coalesce(2)
    kept = train.estimator(RF, "label", numTrees=3)
    assert kept.getCacheNodeIds()
    walked = train.estimator(RF, "label", numTrees=3, cacheNodeIds=False)
    rows = rows.cache()
    found = [forest.fit(rows).toDebugString.split("\n", 1)[1] for forest in (kept, walked)]
    assert found[0] == found[1]
    rows.unpersist()


def test_tasks_and_families_are_tuned_together(spark, tmp_path, monkeypatch):
    """Each tuning waits until all four are under way; in turn, the first would wait in vain."""
    import threading

    rows = [
        (i, *(float((i * k) % 17 + 1) for k in range(1, len(DIABETES.features) + 1)), i % 17 > 8)
        for i in range(300)
    ]
    columns = ["id", *DIABETES.features]
    diabetes = spark.createDataFrame([(*r[:-1], int(r[-1])) for r in rows], [*columns, DIABETES.label])
    heart = spark.createDataFrame(
        [(r[0], r[1], r[2], int(r[-1])) for r in rows], ["patient_id", "age", "cholesterol", HEART.label]
    )
    monkeypatch.setattr(train, "GRIDS", {LR: {"regParam": [0.1], "elasticNetParam": [0.0]}, RF: {"numTrees": [2]}})
    under_way, alone = threading.Barrier(4), jobs.tune

    def met(data, family, **options):
        under_way.wait(timeout=60)
        return alone(data, family, **options)

    monkeypatch.setattr(jobs, "tune", met)
    models = jobs.train({"diabetes": (diabetes, ["id"]), "heart": (heart, HEART_KEY)}, str(tmp_path))
    assert {(t, m.family) for t, fits in models.items() for m in fits} == {
        (t, f) for t in ("diabetes", "heart") for f in (LR, RF)
    }
    assert registry.read(spark, f"{tmp_path}/registry").count() == 4


def test_largest_forests_are_fitted_first(spark, sf_dir, monkeypatch):
    """Each AUC still belongs to its own grid point."""
    records = jobs.training_records(heart_records(spark, sf_dir), HEART, HEART_KEY)
    data = training_set(records, HEART, HEART_KEY)
    grid, begun = {"numTrees": [1, 2], "maxDepth": [1, 3]}, []
    kind = train.RandomForestClassifier
    fit_one = kind.fit

    def noted(self, part, params=None):
        if isinstance(params, dict):
            begun.append({p.name: v for p, v in params.items()})
        return fit_one(self, part, params)

    monkeypatch.setattr(kind, "fit", noted)
    found = tune(data, RF, grid, parallelism=1).grid
    assert [p["numTrees"] * p["maxDepth"] for p in begun[:4]] == [6, 3, 2, 1]
    alone = tune(data, RF, {"numTrees": [2], "maxDepth": [1]}, parallelism=1).grid[0]
    assert [p for p in found if (p["numTrees"], p["maxDepth"]) == (2, 1)] == [alone]
    data.discard()


def test_depths_are_grown_once(spark, monkeypatch):
    """Forests of one number of trees share a fit, and every point has the AUC of its own fit."""
    from pyspark.ml.linalg import Vectors
    from pyspark.ml.tuning import ParamGridBuilder

    rows = spark.createDataFrame(
        [
            (Vectors.dense(i % 7, i % 11, i * 31 % 53, i * 17 % 29), int(i * i % 19 + i % 7 + i % 11 > 17), i % 3)
            for i in range(900)
        ],
        ["features", "label", "fold"],
    ).repartition(3, "fold").cache()
    data = train.TrainingSet(rows, rows, None, "label", rows)
    base = train.estimator(RF, "label")
    grid = ParamGridBuilder().addGrid(base.numTrees, [3, 7]).addGrid(base.maxDepth, [2, 6, 0, 4])
    points, kind, fits = grid.build(), train.RandomForestClassifier, []
    fit_one = kind.fit
    monkeypatch.setattr(kind, "fit", lambda self, part, params: fits.append(1) or fit_one(self, part, params))
    alone = train.cross_validate(data, base, points, 3, 2)
    assert len(fits) == 24
    assert len(set(alone)) > 4
    assert train.cross_validate(data, base, points, 3, 2, nested=True) == pytest.approx(alone, abs=1e-12)
    assert len(fits) == 24 + 6
    rows.unpersist()


def test_a_training_run_grows_depths_once(spark, tmp_path, monkeypatch):
    rows = [
        (i, *(float((i * k) % 17 + 1) for k in range(1, len(DIABETES.features) + 1)), int(i % 17 > 8))
        for i in range(300)
    ]
    records = spark.createDataFrame(rows, ["id", *DIABETES.features, DIABETES.label])
    depths = {"numTrees": [2], "maxDepth": [1, 2]}
    monkeypatch.setattr(train, "GRIDS", {LR: {"regParam": [0.1], "elasticNetParam": [0.0]}, RF: depths})
    kind, fits = train.RandomForestClassifier, []
    fit_one = kind.fit
    monkeypatch.setattr(kind, "fit", lambda self, part, params: fits.append(1) or fit_one(self, part, params))
    models = jobs.train({"diabetes": (records, ["id"])}, str(tmp_path))["diabetes"]
    assert len(fits) == 3 + 1
    assert [len(m.grid) for m in models if m.family == RF] == [2]


def test_few_rows_are_dealt_to_few_partitions(spark, monkeypatch):
    rows = spark.range(600).select(
        F.col("id").alias("patient_id"), (F.col("id") % 2).alias("heart_attack_risk"), F.col("id").alias("age")
    )
    task = jobs.with_features(HEART, rows, HEART_KEY)
    usual = spark.conf.get("spark.sql.shuffle.partitions")

    def dealt(partitions):
        spark.conf.set("spark.sql.shuffle.partitions", partitions)
        try:
            data = training_set(rows, task, HEART_KEY)
            found = data.train.rdd.getNumPartitions(), data.train.count() + data.test.count()
            data.discard()
            return found
        finally:
            spark.conf.set("spark.sql.shuffle.partitions", usual)

    assert dealt(40) == (train.MIN_PARTITIONS, 600)
    assert dealt(5) == (5, 600)
    monkeypatch.setattr(train, "PARTITION_ROWS", 25)
    assert train.MIN_PARTITIONS < dealt(40)[0] < 30
    assert dealt(15) == (15, 600)
