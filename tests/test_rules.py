import itertools
import math

import pytest
from pyspark.sql import functions as F

from riskflow.functions import rules
from riskflow.functions.rules import DIABETES_RULES, HEART_RULES

DIABETES_SCHEMA = ", ".join(f"{name} double" for name in DIABETES_RULES.inputs)
# The published sample record first; results added up by hand.
DIABETES_ROWS = [
    ((1, 140, 80, 30, 45, 27.5, 0.5, 45), 1, 0.75),
    ((0, 120, 70, 20, 80, 25.0, 0.5, 30), 0, 0.20),
    ((0, 90, 70, 20, 80, 20.0, 0.5, 30), 0, 0.10),
    ((0, 91, 70, 20, 80, 20.0, 0.5, 30), 0, 0.20),
    ((0, 126, 70, 20, 14, 20.0, 0.5, 40), 1, 0.75),
    ((0, 200, 150, 20, 80, 45.0, 0.9, 70), 1, 0.95),
    ((0, None, 70, 20, 80, 20.0, 0.5, 30), 0, 0.20),
    ((0, math.nan, 70, 20, 80, 20.0, 0.5, 30), 0, 0.20),
    ((0, 90, 70, 20, 80, 20.0, math.nan, 30), 0, 0.20),
]


def _doubles(row):
    return tuple(None if v is None else float(v) for v in row)


def _scores(df, book, **options):
    scored = rules.with_rule_score(df, book, **options)
    return [(r.rule_prediction, r.rule_probability) for r in scored.collect()]


def test_diabetes_rows(spark):
    df = spark.createDataFrame([_doubles(row) for row, *_ in DIABETES_ROWS], DIABETES_SCHEMA)
    for (prediction, probability), (row, expected, value) in zip(
        _scores(df.coalesce(1), DIABETES_RULES), DIABETES_ROWS
    ):
        assert prediction == expected, row
        assert probability == pytest.approx(value, abs=1e-9), row


# Fixed values, as above.
HEART_ROWS = [
    (dict(age=50, gender=1, hypertension=1, smoking=1, physical_activity=1, diet_score=6,
          cholesterol=220), 1, 0.80),
    (dict(age=40, cholesterol=390, stress=10), 0, 0.20),
    (dict(age=39, diet_score=6, stress=4), 0, 0.10),
    (dict(age=39, gender=1, diabetes=1, obesity=1, cholesterol=220, physical_activity=1,
          diet_score=6), 0, 0.5),
    (dict(age=65, gender=1), 1, 0.55),
]


def test_heart_rows_with_defaults(spark):
    schema = ", ".join(f"{name} double" for name in HEART_RULES.inputs)
    rows = [
        tuple(float(row[name]) if name in row else None for name in HEART_RULES.inputs)
        for row, *_ in HEART_ROWS
    ]
    scored = _scores(spark.createDataFrame(rows, schema).coalesce(1), HEART_RULES)
    for (prediction, probability), (row, expected, value) in zip(scored, HEART_ROWS):
        assert prediction == expected, row
        assert probability == pytest.approx(value, abs=1e-9), row
    # nominally one half, but the doubles add up to just below
    assert scored[3][1] == 0.49999999999999994


def test_heart_without_columns(spark):
    df = spark.createDataFrame([(65, 1)], "age int, gender int")
    absent = set(HEART_RULES.inputs) - {"age", "gender"}
    [(prediction, probability)] = _scores(df, HEART_RULES, absent=absent)
    assert (prediction, probability) == (1, pytest.approx(0.55))


def test_positional_record_of_the_form(spark):
    """Stress and family history at the form's positions 12 and 13 are not read."""
    record = [50.0, 0, 0, 0, 0, 0, 0, 1, 5, 200, 120, 80, 10, 1]
    df = spark.createDataFrame([([float(v) for v in record],)], "record array<double>")
    fields = rules.positional_fields(HEART_RULES, rules.HEART_POSITIONS, "record")
    [(_, probability)] = _scores(df, HEART_RULES, fields=fields)
    assert probability == pytest.approx(0.15 + 0.15 - 0.10 + 0.05)


def _first(value, tiers, matches, otherwise):
    return next((step for bound, step in tiers if matches(value, bound)), otherwise)


def test_every_tier_combination_against_plain_sums(spark):
    """All edges of every diabetes ladder, bit by bit against left-to-right addition."""
    glucose = [90, 90.5, 110, 125, 125.5, 140, 160, 180, 181]
    bmi = [18, 18.5, 25, 30, 35, 40]
    age = [34, 35, 45, 55, 65]
    rows = [
        (1.0, float(g), float(b), 20.0, float(i), float(m), p, float(a))
        for g, m, a, p, b, i in itertools.product(
            glucose, bmi, age, [0.5, 0.6, 0.8, 0.9], [140, 141], [14, 15]
        )
    ]

    def expected(row):
        _, g, b, _, i, m, p, a = row
        total = 0.1
        le, lt, gt = (lambda v, x: v <= x), (lambda v, x: v < x), (lambda v, x: v > x)
        total += _first(
            g, [(90, 0.05), (110, 0.15), (125, 0.3), (140, 0.45), (160, 0.55), (180, 0.65)], le, 0.75
        )
        total += _first(m, [(18.5, 0.05), (25, 0.0), (30, 0.1), (35, 0.15), (40, 0.2)], lt, 0.25)
        total += _first(a, [(35, -0.05), (45, 0.0), (55, 0.1), (65, 0.15)], lt, 0.2)
        total += _first(p, [(0.8, 0.15), (0.5, 0.07)], gt, 0.0)
        total += 0.1 if b > 140 else 0.0
        total += 0.2 if i < 15 and g > 125 else 0.0
        total = max(0.05, min(0.95, total))
        return (1 if total >= 0.5 else 0, total)

    df = spark.createDataFrame(rows, DIABETES_SCHEMA).repartition(5)
    scored = rules.with_rule_score(df, DIABETES_RULES).collect()
    assert len(scored) == len(rows)
    for row in scored:
        inputs = tuple(row[name] for name in DIABETES_RULES.inputs)
        assert (row.rule_prediction, row.rule_probability) == expected(inputs), inputs


def test_misspelt_column_is_an_error(spark):
    df = spark.createDataFrame([(65, 1)], "age int, sex int")
    with pytest.raises(ValueError, match="gender"):
        rules.with_rule_score(df, HEART_RULES)


def test_caller_columns_survive(spark):
    df = spark.createDataFrame([(65, 1, "x")], "age int, gender int, stress_note string")
    absent = set(HEART_RULES.inputs) - {"age", "gender"}
    scored = rules.with_rule_score(df, HEART_RULES, absent=absent)
    assert scored.columns == [*df.columns, "rule_probability", "rule_prediction"]
    assert scored.select(F.col("age")).first()["age"] == 65
