import random

import pytest
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.sql import functions as F

from riskflow.operators import evaluate as ev


def _brute_force(rows):
    pos = [s for s, y in rows if y == 1]
    neg = [s for s, y in rows if y == 0]
    wins = sum((p > n) + (p == n) / 2 for p in pos for n in neg)
    return wins / (len(pos) * len(neg))


def _rows(seed):
    """A third of the rows share one score, the others are nearly all distinct."""
    rnd = random.Random(seed)
    rows = [(0.4, rnd.randint(0, 1)) for _ in range(150)]
    rows += [(rnd.random(), rnd.randint(0, 1)) for _ in range(250)]
    rows += [(round(rnd.gauss(0.5, 0.2), 1), rnd.randint(0, 1)) for _ in range(50)]
    return rows


@pytest.mark.parametrize("buckets", [1, 2, 7, 64, None])
def test_auc_does_not_depend_on_the_cut(spark, buckets):
    data = {"a": _rows(1), "b": _rows(2)}
    df = spark.createDataFrame(
        [(c, s, y) for c, rows in data.items() for s, y in rows],
        "candidate string, score double, label int",
    ).repartition(5)
    result = {r.candidate: r for r in ev.evaluate(df, buckets=buckets).collect()}
    for name, rows in data.items():
        assert result[name].auc == pytest.approx(_brute_force(rows), abs=1e-12)
        assert result[name].n_rows == len(rows)


def test_equals_mllib(spark):
    df = spark.createDataFrame(
        [("a", s, float(y)) for s, y in _rows(3)], "candidate string, score double, label double"
    )
    cut = ev.evaluate(df).first()
    exact = BinaryClassificationEvaluator(rawPredictionCol="score", numBins=0).evaluate(df)
    assert cut.auc == pytest.approx(exact, abs=1e-12)


def test_ties_with_mixed_predictions(spark):
    """Equal scores are ties whatever was predicted, in whatever way."""
    rows = [("a", 0.5, i % 2, (i // 2) % 2) for i in range(130)] + [("b", 0.5, 1, None), ("b", 0.1, 0, 1)]
    df = spark.createDataFrame(rows, "candidate string, score double, label int, prediction int")
    got = {r.candidate: r for r in ev.evaluate(df, prediction="prediction").collect()}
    assert got["a"].auc == 0.5 and got["a"].n_rows == 130
    positive = [r for r in rows[:130] if r[3] == 1]
    assert got["a"].precision == pytest.approx(sum(r[2] for r in positive) / len(positive))
    assert got["b"].auc == 1.0 and got["b"].accuracy == 0.0


def test_undefined_ratios_are_null(spark):
    one_class = spark.createDataFrame([("a", 0.1, 0), ("a", 0.2, 0)], "candidate string, score double, label int")
    row = ev.evaluate(one_class).first()
    assert row.auc is None and row.precision is None and row.recall is None
    assert row.accuracy == 1.0


def test_rows_without_score_are_not_ranked(spark):
    df = spark.createDataFrame(
        [("a", 0.1, 0), ("a", None, 1), ("a", float("nan"), 1), ("a", 0.9, 1), ("a", 0.5, None)],
        "candidate string, score double, label int",
    )
    row = ev.evaluate(df).first()
    assert (row.n_rows, row.auc) == (2, 1.0)


def test_report_counts(spark):
    df = spark.createDataFrame([(1, 1), (1, 0), (0, 1), (0, 0), (0, 0)], "prediction int, label int")
    row = ev.classification_report(df).first()
    assert (row.tp, row.fp, row.fn, row.tn) == (1, 1, 1, 2)
    assert (row.accuracy, row.precision, row.recall, row.f1) == (0.6, 0.5, 0.5, 0.5)


def test_gates(spark):
    df = spark.createDataFrame([(0.69,), (0.7,), (0.8,), (None,)], "auc double")
    gates = [r.gate for r in ev.with_gate(df.coalesce(1)).collect()]
    assert gates == ["rejected", "acceptable", "deployable", "rejected"]


def test_unpivot(spark):
    df = spark.createDataFrame([(1, 2, 0.5)], "y int, a int, b double")
    rows = ev.unpivot_scores(df, {"first": "a", "second": "b"}, "y").orderBy("candidate").collect()
    assert [(r.candidate, r.score, r.label) for r in rows] == [("first", 2.0, 1), ("second", 0.5, 1)]
    assert ev.unpivot_scores(df, {"first": "a"}, "y").select(F.col("score")).first()[0] == 2.0
