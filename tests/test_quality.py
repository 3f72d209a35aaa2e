import pytest

from riskflow.operators import quality
from riskflow.plans import jobs
from riskflow.schemas import HEART
from riskflow.sources.views import heart_records


def test_valid_and_rejected_make_up_the_table(spark, sf_dir):
    records = heart_records(spark, sf_dir)
    valid, rejected = quality.split_valid(records, quality.HEART_INPUT_RULES)
    assert valid.count() + rejected.count() == records.count()
    assert rejected.filter("size(violations) = 0").count() == 0


def test_edges_are_valid(spark):
    rule = quality.Rule("age", "age", 20, 100)
    df = spark.createDataFrame([(19,), (20,), (100,), (101,), (None,)], "age int")
    flags = [len(r.violations) for r in quality.with_violations(df.coalesce(1), [rule]).collect()]
    assert flags == [1, 0, 0, 1, 1]


def test_null_may_be_allowed_and_nan_is_out_of_range(spark):
    rule = quality.Rule("bmi", "bmi", 0.0, 70.0, allow_null=True)
    df = spark.createDataFrame([(None,), (float("nan"),), (25.0,)], "bmi double")
    flags = [len(r.violations) for r in quality.with_violations(df.coalesce(1), [rule]).collect()]
    assert flags == [0, 1, 0]


def test_pregnancy_rule_needs_both_columns(spark):
    checks = (*quality.DIABETES_INPUT_RULES, quality.PREGNANCY_RULE)
    assert quality.PREGNANCY_RULE not in quality.applicable(checks, ["pregnancies"])
    df = spark.createDataFrame(
        [(1, "Male"), (0, "Male"), (3, "Female"), (3, None)], "pregnancies int, gender string"
    )
    assert quality.violations_by_rule(df, [quality.PREGNANCY_RULE]).first()["n_failed"] == 1


def test_drop_nulls_takes_nan_for_null(spark):
    df = spark.createDataFrame([(1, 1.0), (2, float("nan")), (3, None), (None, 2.0)], "a int, b double")
    assert quality.drop_nulls(df).count() == df.na.drop().count() == 1
    assert quality.drop_nulls(df, ["a"]).count() == 3


def test_text_left_in_features_is_named_before_any_job(spark, sf_dir):
    records = heart_records(spark, sf_dir)
    with pytest.raises(ValueError, match="state_name"):
        quality.numeric_features(records, {HEART.label})
    clean = jobs.cleaned(records, HEART)
    assert quality.numeric_features(clean, {HEART.label}) == list(HEART.features)


def test_profile_of_empty_table(spark):
    df = spark.createDataFrame([], "a int, b string")
    rows = quality.profile(df).collect()
    assert [(r.column_name, r.n_rows, r.n_null, r.n_zero) for r in rows] == [
        ("a", 0, 0, 0),
        ("b", 0, 0, None),
    ]


def test_answers_in_either_form(spark):
    checks = [r for r in quality.HEART_INPUT_RULES if r.answer]
    assert len(checks) == 7
    names = [r.name for r in checks]
    for kind, good, bad in (("int", 1, 2), ("string", "Yes", "Maybe")):
        df = spark.createDataFrame(
            [(good,) * 7, (bad,) * 7, (None,) * 7], ", ".join(f"{n} {kind}" for n in names)
        )
        flags = [len(r.violations) for r in quality.with_violations(df.coalesce(1), checks).collect()]
        assert flags == [0, 7, 7]


def test_any_column_name_can_be_profiled(spark):
    df = spark.createDataFrame([(1, None), (0, 2.0)], "`air quality` int, `it's` double")
    rows = {r.column_name: r for r in quality.profile(df).collect()}
    assert rows["air quality"].n_zero == 1 and rows["it's"].n_null == 1
    assert quality.drop_nulls(df).count() == 1
