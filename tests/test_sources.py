import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskflow.functions.encode import GENDER_CODES, equals_flag, mapped
from riskflow.schemas import DIABETES_CSV_COLUMNS, DIABETES_CSV_SCHEMA
from riskflow.session import DEFAULTS, discard, materialize, scratch_path, scratch_root
from riskflow.sources import registry, tables


def test_session_settings(spark):
    assert all(spark.conf.get(key) == value for key, value in DEFAULTS.items())


def test_scratch_is_in_the_named_folder(spark):
    base = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    assert scratch_root(spark).startswith(base)
    assert scratch_path(spark, "x") != scratch_path(spark, "x")


def test_materialize_keeps_schema_and_rows(spark):
    df = spark.range(10).withColumn("part", F.col("id") % 2 == 0)
    stored = materialize(df, "t", ["part"])
    assert stored.schema.fieldNames() == ["id", "part"]
    assert stored.filter("part").count() == 5


def test_declared_schema_of_the_csv_header(spark, tmp_path):
    path = tmp_path / "records.csv"
    header = ",".join(DIABETES_CSV_COLUMNS)
    path.write_text(f"{header}\n4,150,72,33,0,32.5,0.6,47,1\n2,90,66,28,0,25.5,0.3,33,0\n")
    raw = spark.read.option("header", True).csv(str(path)).withColumnsRenamed(DIABETES_CSV_COLUMNS)
    declared = tables.typed(raw, DIABETES_CSV_SCHEMA)
    assert declared.schema == DIABETES_CSV_SCHEMA
    assert declared.agg(F.sum("glucose")).first()[0] == 240


def test_csv_columns_by_name(spark, tmp_path):
    path = tmp_path / "t.csv"
    path.write_text("b,extra,a\n1.5,x,3.0\n,y,2.5\nz,,9\n")
    df = tables.read_csv(spark, str(path), T.StructType.fromDDL("a int, b double"))
    assert [tuple(r) for r in df.collect()] == [(1.5, "x", 3), (None, "y", None), (None, None, 9)]


def test_discard_deletes_the_table(spark):
    stored = materialize(spark.range(5), "gone")
    path = stored.inputFiles()[0].rsplit("/", 1)[0]
    assert tables.exists(spark, path)
    discard(stored)
    assert not tables.exists(spark, path)
    assert tables.exists(spark, scratch_root(spark))


def test_family_marks(spark, tmp_path):
    path = str(tmp_path / "lines")
    ends = {
        "mlruns/a/diabetes_model_lr": "logistic_regression",
        "mlruns/heart_random_forest/": "random_forest",
        "x/heart_model_rf": "random_forest",
        "lr/perform": "unknown",
        "x/diabetes_logistic_regression": "logistic_regression",
    }
    lines = [(f"Best t{i} model: {end}",) for i, end in enumerate(ends)] + [("nothing",)]
    spark.createDataFrame(lines, "value string").write.text(path)
    got = {r.path: r.family for r in registry.read_lines(spark, path).collect()}
    assert got == ends


def test_first_available_order(spark, tmp_path):
    folder = str(tmp_path)
    locations = tables.candidates(folder, "t")
    with pytest.raises(FileNotFoundError):
        tables.read_first_available(spark, locations)
    tables.write_csv(spark.range(3), locations[1][1])
    assert tables.read_first_available(spark, locations).count() == 3
    tables.write_parquet(spark.range(5), locations[0][1])
    assert tables.read_first_available(spark, locations).count() == 5
    tables.write_parquet(spark.range(4), locations[0][1])
    assert tables.read_parquet(spark, locations[0][1]).count() == 4


def test_encodings_of_unknown_values(spark):
    df = spark.createDataFrame([("Male",), ("Female",), ("Other",), (None,)], "g string").coalesce(1)
    rows = df.select(
        equals_flag(F.col("g"), "Male").alias("flag"), mapped(F.col("g"), GENDER_CODES).alias("code")
    ).collect()
    assert [r.flag for r in rows] == [1, 0, 0, 0]
    assert [r.code for r in rows] == [1, 0, None, None]
