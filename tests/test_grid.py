"""The regression grid in common passes against MLlib, point by point."""

import numpy as np
import pytest
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.sql import functions as F

from riskflow.operators import grid
from riskflow.operators.train import GRIDS, LR, training_set, tune
from riskflow.plans import jobs
from riskflow.schemas import TASKS
from riskflow.sources.views import HEART_KEY, heart_records

POINTS = [
    {"regParam": r, "elasticNetParam": e}
    for r in GRIDS[LR]["regParam"] for e in GRIDS[LR]["elasticNetParam"]
]


@pytest.fixture(scope="module")
def data(spark, sf_dir):
    records = heart_records(spark, sf_dir)
    task = jobs.with_features(TASKS["heart"], records, HEART_KEY)
    found = training_set(jobs.training_records(records, task, HEART_KEY), task, HEART_KEY, partitions=2)
    yield found
    found.discard()


def by_mllib(data, point, folds=3):
    """Mean validation AUC, fitted until nothing moves."""
    lr = LogisticRegression(labelCol=data.label, maxIter=200, tol=1e-12, **point)
    judge = BinaryClassificationEvaluator(labelCol=data.label, numBins=0)
    fits = [lr.fit(data.train.filter(F.col("fold") != f)) for f in range(folds)]
    return np.mean([judge.evaluate(m.transform(data.train.filter(F.col("fold") == f))) for f, m in enumerate(fits)])


def test_same_aucs_and_choice_as_point_by_point(data):
    """A point of each kind of penalty; one without any feature left has an AUC of one half."""
    points = [POINTS[i] for i in (0, 1, 2, 4, 8)]
    got = grid.grid_aucs(data.train, data.label, points, 3)
    expected = [by_mllib(data, point) for point in points]
    assert got == pytest.approx(expected, abs=1e-6)
    assert int(np.argmax(got)) == int(np.argmax(expected))


def test_same_coefficients(data):
    rows = _rows(data)
    points = [{"regParam": 0.01, "elasticNetParam": 0.5}, {"regParam": 0.1, "elasticNetParam": 0.0}]
    weights, left_out = grid.fit_grid(rows, points, 3)
    for k, point in enumerate(p for p in points for _ in range(3)):
        lr = LogisticRegression(labelCol=data.label, maxIter=200, tol=1e-12, **point)
        model = lr.fit(data.train.filter(F.col("fold") != int(left_out[k])))
        assert weights[0, k] == pytest.approx(model.intercept, abs=2e-4)
        assert weights[1:, k] == pytest.approx(model.coefficients.toArray(), abs=2e-4)


def _rows(data):
    from pyspark.ml.functions import vector_to_array

    return data.train.select(
        vector_to_array("features").alias("x"), F.col(data.label).alias("y"), "fold"
    )


def test_passes_do_not_grow_with_the_grid(data, monkeypatch):
    passes = []
    inner = grid._summed
    monkeypatch.setattr(grid, "_summed", lambda rows, work: passes.append(1) or inner(rows, work))
    grid.fit_grid(_rows(data), POINTS[:1], 3)
    few = len(passes)
    grid.fit_grid(_rows(data), POINTS, 3)
    assert len(passes) - few <= few + 4 < grid.MAX_PASSES


def test_a_feature_that_does_not_vary(spark):
    rows = spark.range(300).selectExpr(
        "array(1.0D, CAST(id % 7 AS DOUBLE)) AS x", "CAST(id % 7 > 2 OR id % 5 = 0 AS INT) AS y",
        "CAST(id % 3 AS INT) AS fold",
    )
    weights, _ = grid.fit_grid(rows, POINTS[:2], 3)
    assert np.isfinite(weights).all() and not weights[1].any() and weights[2].all()


def test_folds_of_one_class_have_no_auc(spark):
    from riskflow.functions.vectors import vector_of

    df = spark.range(90).selectExpr(
        "CAST(id % 7 AS DOUBLE) AS a", "CAST(id % 3 AS INT) AS fold",
        "CAST(id % 7 > 2 AND id % 3 <> 1 AS INT) AS label",
    ).withColumn("features", vector_of(["a"]))
    aucs = grid.grid_aucs(df, "label", POINTS[:2], 3)
    assert all(0.9 < auc <= 1.0 for auc in aucs)


def test_tune_uses_it(data, monkeypatch):
    from riskflow.operators import train

    monkeypatch.setattr(train, "cross_validate", None)
    fitted = tune(data, LR)
    assert len(fitted.grid) == 9 and fitted.params["regParam"] in GRIDS[LR]["regParam"]


def test_rows_do_not_meet_problems_that_leave_them_out():
    """Not even as zeros: what is not a number would stay so."""
    rng = np.random.default_rng(1)
    x, y = np.column_stack([np.ones(60), rng.normal(size=(60, 2))]), rng.integers(0, 2, 60).astype(float)
    fold, left_out, weights = np.arange(60) % 3, np.array([0, 1, 2, 0]), rng.normal(size=(3, 4)) * 300
    got = grid._derivatives(weights, left_out)(x, y, fold)
    for k, out in enumerate(left_out):
        own, target = x[fold != out], y[fold != out]
        margin = own @ weights[:, k]
        p = 1 / (1 + np.exp(-margin))
        assert got[0, k] == pytest.approx((np.logaddexp(0, margin) - target * margin).sum())
        assert got[1:4, k] == pytest.approx(own.T @ (p - target))
        curvature = own.T @ (own * (p * (1 - p))[:, None])
        assert got[4:, k] == pytest.approx(curvature[np.triu_indices(3)])
    x[fold == 1] = np.nan
    assert np.isfinite(grid._derivatives(weights, left_out)(x, y, fold)).all(axis=0).tolist() == [False, True, False, False]


def test_passes_leave_out_what_has_converged(data, monkeypatch):
    sizes, inner = [], grid._derivatives
    monkeypatch.setattr(grid, "_derivatives", lambda w, out: sizes.append(len(out)) or inner(w, out))
    grid.fit_grid(_rows(data), POINTS, 3)
    assert sizes[0] == 27 > sizes[-1] > 0
    assert sizes == sorted(sizes, reverse=True)


def test_passes_read_blocks_that_hold_every_row(spark):
    rows = spark.range(7000).selectExpr(
        "array(CAST(id AS DOUBLE), 0.5D) AS x", "CAST(id % 2 AS INT) AS y", "CAST(id % 3 AS INT) AS fold"
    ).coalesce(1)
    found, blocks = [], grid._packed(rows).collect()
    for block in blocks:
        x, y = np.frombuffer(block["x"]).reshape(-1, 3), np.frombuffer(block["y"])
        assert 0 < len(y) == len(x) <= grid.BLOCK_ROWS
        assert (x[:, 0] == 1).all() and (x[:, 2] == 0.5).all()
        assert (x[:, 1] % 3 == block["fold"]).all() and (x[:, 1] % 2 == y).all()
        found += x[:, 1].tolist()
    assert sorted(found) == list(range(7000))
    assert len(blocks) < 20
