import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.feature import StandardScaler
from pyspark.sql import functions as F

from riskflow.functions.vectors import ensure_vector, unpacked
from riskflow.operators import prepare, split
from riskflow.plans import jobs
from riskflow.schemas import DIABETES
from riskflow.sources.views import DIABETES_KEY, diabetes_records


def test_zero_impute_keeps_nulls_and_values(spark):
    df = spark.createDataFrame([(1, 0), (2, 4), (3, None), (4, 8)], "id int, a int")
    rows = prepare.zero_impute(df, ["a"]).orderBy("id").collect()
    assert [r.a for r in rows] == [6.0, 4.0, None, 8.0]


def test_nan_is_missing(spark):
    nan = float("nan")
    df = spark.createDataFrame([(1, 1.0), (2, 3.0), (3, 0.0), (4, nan)], "id int, a double")
    rows = prepare.zero_impute(df, ["a"]).orderBy("id").collect()
    assert [r.a for r in rows] == [1.0, 3.0, 2.0, None]
    fitted = prepare.fit_preparation(df, ["a"], ["a"])
    assert fitted.mean["a"] == 2.0 and fitted.fill["a"] == 2.0


def test_all_zero_column(spark):
    df = spark.createDataFrame([(0, 1), (0, 2)], "a int, b int")
    with pytest.raises(ValueError, match="a"):
        prepare.zero_impute(df, ["a", "b"])
    kept = prepare.zero_impute(df, ["a", "b"], on_all_zero="keep")
    assert [r.a for r in kept.collect()] == [0.0, 0.0]


def test_means_of_given_table_are_used(spark):
    df = spark.createDataFrame([(0.0,), (3.0,)], "a double")
    assert prepare.zero_impute(df, ["a"], {"a": 7.0}).agg(F.sum("a")).first()[0] == 10.0


def test_constant_column_scales_to_zero(spark):
    df = spark.createDataFrame([(5.0, 1.0), (5.0, 3.0)], "a double, b double")
    rows = prepare.standardize(df, ["a", "b"]).collect()
    assert [r.features[0] for r in rows] == [0.0, 0.0]
    fitted = prepare.fit_preparation(df, ["a", "b"])
    piped = PipelineModel(fitted.stages()).transform(df).collect()
    assert [r.features[0] for r in piped] == [0.0, 0.0]


def test_standardized_mean_and_deviation(spark, sf_dir):
    records = diabetes_records(spark, sf_dir)
    scaled = prepare.standardize(records, DIABETES.features)
    wide = scaled.select(*unpacked("features", DIABETES.features))
    for row in prepare.scaler_stats(wide, DIABETES.features).collect():
        assert row["mean"] == pytest.approx(0.0, abs=1e-9)
        assert row["std"] == pytest.approx(1.0, abs=1e-9)


def test_single_pass_equals_impute_then_scaler(spark, sf_dir):
    records = diabetes_records(spark, sf_dir)
    filled = prepare.zero_impute(records, DIABETES.zero_columns)
    assembled = prepare.assemble(filled, DIABETES.features, "raw")
    scaler = StandardScaler(inputCol="raw", outputCol="z", withMean=True, withStd=True).fit(assembled)
    fitted = prepare.fit_preparation(records, DIABETES.features, DIABETES.zero_columns)
    for i, name in enumerate(DIABETES.features):
        assert fitted.mean[name] == pytest.approx(scaler.mean[i], rel=1e-9)
        assert fitted.std[name] == pytest.approx(scaler.std[i], rel=1e-9)


def test_missing_feature_keeps_its_row(spark):
    df = spark.createDataFrame([(0.0, 1.0), (2.0, None), (4.0, 3.0)], "a double, b double")
    fitted = prepare.fit_preparation(df, ["a", "b"], ["a"])
    assert PipelineModel(fitted.stages()).transform(df).count() == 3


def test_plain_struct_becomes_vector(spark):
    df = spark.createDataFrame([((1, [1.0, 2.0]),)], "features struct<type:int,values:array<double>>")
    row = ensure_vector(df).select(*unpacked("features", ["a", "b"])).first()
    assert (row.a, row.b) == (1.0, 2.0)


def test_split_and_folds_ignore_partitioning(spark, sf_dir):
    records = diabetes_records(spark, sf_dir)

    def marks(df):
        marked = df.select(
            *DIABETES_KEY,
            split.is_train(DIABETES_KEY).alias("train"),
            split.fold_of(DIABETES_KEY).alias("fold"),
        )
        return sorted(tuple(row) for row in marked.collect())

    assert marks(records) == marks(records.repartition(13))
    train, test = split.hash_split(records, DIABETES_KEY)
    assert train.count() + test.count() == records.count()
    assert 0.75 < train.count() / records.count() < 0.85


def test_prepared_table_refuses_missing_values(spark):
    columns = ", ".join(f"{name} double" for name in DIABETES.features)
    rows = [(1.0, 90.0, 70.0, 20.0, 80.0, 25.0, 0.5, 30.0, 1), (2.0, 0.0, 71.0, 21.0, 81.0, 26.0, 0.6, None, 0)]
    df = spark.createDataFrame(rows, f"{columns}, outcome int")
    with pytest.raises(Exception, match="null"):
        jobs.prepared(df, DIABETES).collect()
    assert jobs.prepared(df.na.fill(40.0), DIABETES).count() == 2


def test_key_that_is_a_feature_stays(spark):
    columns = ", ".join(f"{name} double" for name in DIABETES.features)
    rows = [(1.0, 90.0, 70.0, 20.0, 80.0, 25.0, 0.5, 30.0, 1), (2.0, 0.0, 71.0, 21.0, 81.0, 26.0, 0.6, 40.0, 0)]
    df = spark.createDataFrame(rows, f"{columns}, outcome int")
    result = jobs.prepared(df, DIABETES, ["age"])
    assert result.columns == ["age", "features", "outcome"]
    assert [len(r.features) for r in result.collect()] == [8, 8]
