import pytest

from riskflow.__main__ import first_input, main, read_records
from riskflow.schemas import DIABETES_CSV_COLUMNS


@pytest.fixture()
def records_csv(tmp_path):
    path = tmp_path / "records.csv"
    rows = ["4,190,80,30,0,34.5,0.9,58,1", "2,95,64,21,100,24.5,0.3,29,0", "0,0,0,0,0,0,0.2,21,0"]
    path.write_text("\n".join([",".join(DIABETES_CSV_COLUMNS), *rows, ""]))
    return str(path)


def test_prepare_and_score(spark, tmp_path, records_csv):
    out = str(tmp_path / "out")
    main(["prepare", "diabetes", "--input", records_csv, "--format", "csv", "--output", out])
    assert spark.read.parquet(out).count() == 3
    scores = str(tmp_path / "scores")
    main(["score", "diabetes", "--input", records_csv, "--format", "csv", "--key", "age",
          "--output", scores])
    rows = {r.age: r for r in spark.read.parquet(scores).collect()}
    assert rows[58].risk_band == "high-risk" and rows[58].model_used == "rule_based"
    assert rows[58].message == "The prediction indicates a 95.0% probability of diabetes."
    cleaned = str(tmp_path / "cleaned")
    main(["export", "diabetes", "--input", records_csv, "--format", "csv", "--output", cleaned])
    again = {r.age: r for r in read_records(spark, "diabetes", cleaned, "csv").collect()}
    assert again[58].glucose == 190.0 and again[58].insulin == 100.0 and again[58].outcome == 1
    assert again[21].glucose == pytest.approx((190 + 95) / 2)
    assert again[21].bmi == pytest.approx((34.5 + 24.5) / 2) and again[21].pregnancies == 0


def test_csv_goes_by_header(spark, tmp_path):
    path = tmp_path / "keyed.csv"
    path.write_text(
        "patient_id,Outcome,Age,DiabetesPedigreeFunction,BMI,Insulin,SkinThickness,"
        "BloodPressure,Glucose,Pregnancies\n1001,1,50,0.5,31.5,80.5,30,70,140,2\n1002,0,x,,,,,,,\n"
    )
    rows = {r.patient_id: r for r in read_records(spark, "diabetes", str(path), "csv").collect()}
    assert rows["1001"].pregnancies == 2 and rows["1001"].glucose == 140.0
    assert rows["1001"].insulin == 80.5 and rows["1001"].outcome == 1
    assert rows["1002"].age is None and rows["1002"].glucose is None
    short = tmp_path / "short.csv"
    short.write_text("Age,Outcome\n50,1\n")
    with pytest.raises(ValueError, match="glucose"):
        read_records(spark, "diabetes", str(short), "csv")


def test_first_input_that_exists(spark, tmp_path, records_csv):
    assert first_input(spark, [str(tmp_path / "none"), records_csv], "parquet") == (records_csv, "csv")
    with pytest.raises(FileNotFoundError):
        first_input(spark, [str(tmp_path / "none")], "parquet")


def test_train_needs_a_key(records_csv):
    with pytest.raises(SystemExit):
        main(["train", "diabetes", "--input", records_csv, "--folder", "x"])
