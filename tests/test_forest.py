"""Forests grown over packed blocks against MLlib's, and exact AUCs over them."""

import numpy as np
import pytest
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from riskflow.operators import forest, grid, packed, ranks, train
from riskflow.operators.forest import PackedForestClassifier
from riskflow.operators.train import RF, fit, training_set, tune
from riskflow.plans import jobs
from riskflow.schemas import HEART
from riskflow.sources.views import HEART_KEY, heart_records


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(5)
    x = np.column_stack([rng.normal(size=1500), rng.random(1500), rng.integers(0, 5, 1500), rng.random(1500)])
    y = x[:, 0] + 2 * x[:, 1] - x[:, 2] / 3 + rng.normal(size=1500) > 0.3
    df = spark.createDataFrame(
        [(Vectors.dense(*map(float, a)), int(b), i % 3) for i, (a, b) in enumerate(zip(x, y))],
        ["features", "label", "fold"],
    ).repartition(3).cache()
    yield df
    df.unpersist()


def _packed(rows, cuts=31, numbers=True):
    values = np.array([r["features"].toArray() for r in rows.select("features").collect()])
    parts = rows.select(vector_to_array("features").alias("x"), F.col("label").alias("y"), "fold")
    return packed.pack(parts, [packed.cuts_of(v, cuts + 1) for v in values.T], numbers)


@pytest.mark.parametrize("depth", [0, 1, 7])
def test_a_tree_without_bag_is_mllibs(rows, depth):
    settings = {"labelCol": "label", "numTrees": 1, "bootstrap": False, "maxDepth": depth, "seed": 3}
    own, mllib = (kind(**settings).fit(rows) for kind in (PackedForestClassifier, RandomForestClassifier))
    assert own.toDebugString.split("\n", 1)[1] == mllib.toDebugString.split("\n", 1)[1]
    assert own.featureImportances == mllib.featureImportances
    assert type(own) is type(mllib) and own.getNumTrees == 1 and own.numFeatures == 4


def test_least_rows_gain_and_subsets_as_mllib_has_them(rows):
    settings = {"labelCol": "label", "numTrees": 1, "bootstrap": False, "maxDepth": 6, "seed": 3,
                "minInstancesPerNode": 40, "minInfoGain": 0.004, "maxBins": 9}
    own, mllib = (kind(**settings).fit(rows) for kind in (PackedForestClassifier, RandomForestClassifier))
    assert own.toDebugString.split("\n", 1)[1] == mllib.toDebugString.split("\n", 1)[1]
    assert [forest._subset_size(s, 17, True) for s in ("auto", "all", "sqrt", "log2", "onethird", "4", "0.5")] == [
        5, 17, 5, 5, 6, 4, 9
    ]


def test_forests_are_as_good_as_mllibs(rows):
    judge = BinaryClassificationEvaluator(labelCol="label", numBins=0)
    part, rest = rows.filter("fold < 2"), rows.filter("fold = 2")
    found = [
        judge.evaluate(kind(labelCol="label", numTrees=20, maxDepth=6, seed=1).fit(part).transform(rest))
        for kind in (PackedForestClassifier, RandomForestClassifier)
    ]
    assert found[0] == pytest.approx(found[1], abs=0.02) and found[0] > 0.8


def test_bags_are_poisson():
    counts = np.bincount(forest._POISSON) / len(forest._POISSON)
    assert forest._POISSON.mean() == pytest.approx(1, abs=1e-4) and forest._POISSON.var() == pytest.approx(1, abs=1e-3)
    assert counts[:3] == pytest.approx([np.exp(-1), np.exp(-1), np.exp(-1) / 2], abs=1e-4)


def test_a_forest_starts_with_the_smaller_ones(rows):
    found = _packed(rows)
    try:
        small, large = (
            PackedForestClassifier(labelCol="label", numTrees=n, maxDepth=d, seed=1).fit(found).trees
            for n, d in ((2, 3), (5, 6))
        )
        for a, b in zip(small, large):
            whole = forest.Tree(*(list(getattr(b, f)) for f in ("left", "feature", "cut", "gain", "counts")))
            assert a.shares(3)[: len(a.left)].tolist() == whole.shares(3)[: len(a.left)].tolist()
            assert a.counts == b.counts[: len(a.counts)]
    finally:
        found.release()


def test_levels_in_several_passes_are_the_same(rows, monkeypatch):
    found = _packed(rows)
    try:
        base = PackedForestClassifier(labelCol="label", numTrees=4, maxDepth=5, seed=1)
        whole = base.fit(found).trees
        monkeypatch.setattr(forest, "PASS_CELLS", 5 * 64 * 2)
        monkeypatch.setattr(forest, "PIECE_NODES", 2)
        assert base.fit(found).trees == whole
    finally:
        found.release()


def test_grid_has_the_aucs_of_single_fits(rows):
    """One forest per fold has the exact AUC of every point's own forest."""
    found = _packed(rows)
    base = PackedForestClassifier(labelCol="label", seed=1)
    points = [{base.numTrees: n, base.maxDepth: d} for n in (2, 5) for d in (2, 6)]
    try:
        got = forest.forest_aucs(found, base, points, 3)
        judge = BinaryClassificationEvaluator(labelCol="label", numBins=0)
        for point, auc in zip(points, got):
            fits = [
                base.copy(point).fit(found.where([g for g in range(3) if g != f])).model(rows.sparkSession)
                for f in range(3)
            ]
            expected = [judge.evaluate(m.transform(rows.filter(F.col("fold") == f))) for f, m in enumerate(fits)]
            assert auc == pytest.approx(np.mean(expected), abs=1e-12)
        assert forest.forest_aucs(found, base, [{base.maxBins: 5}], 3) is None
        assert forest.forest_aucs(found, base, [{base.numTrees: 1}], 3) is None
    finally:
        found.release()


def _auc(scores, labels):
    up, down = scores[labels == 1], scores[labels == 0]
    return float(((up[:, None] > down) + (up[:, None] == down) / 2).mean())


@pytest.mark.parametrize("piece", [60, 10**6])
@pytest.mark.parametrize("digits", [0, 9])
def test_aucs_are_exact(rows, monkeypatch, piece, digits):
    """With ties or without, in one piece or many; one class alone has none, and NaN no rank."""
    monkeypatch.setattr(ranks, "PIECE_SCORES", piece)
    monkeypatch.setattr(ranks, "HELD_SCORES", 400)
    monkeypatch.setattr(packed, "BLOCK_ROWS", 100)
    found = _packed(rows)

    def scorer(fold, v, x):
        first, second = x.reshape(4, -1)[:2]
        odd = np.where(first > 1, np.nan, first)
        return 2 * fold, np.round(np.stack([first + second, odd]), digits)

    try:
        got = ranks.aucs(found, scorer, 6, True)
    finally:
        found.release()
    for fold in range(3):
        mine = rows.filter(F.col("fold") == fold).collect()
        x, y = np.array([r["features"].toArray() for r in mine]), np.array([r["label"] for r in mine])
        assert got[2 * fold] == pytest.approx(_auc(np.round(x[:, 0] + x[:, 1], digits), y), abs=1e-12)
        known = x[:, 0] <= 1
        assert got[2 * fold + 1] == pytest.approx(_auc(np.round(x[known, 0], digits), y[known]), abs=1e-12)
    assert ranks._between(rows.limit(0).selectExpr("0 AS group", "0 AS piece", "0D AS pairs", "0L AS up", "0L AS down"), 1) == [None]


def test_blocks_hold_every_row(rows, monkeypatch):
    monkeypatch.setattr(packed, "BLOCK_ROWS", 100)
    found = _packed(rows)
    try:
        assert sum(n for n, _ in found.sizes.values()) == 1500 == found.rows
        assert found.positives == rows.filter("label = 1").count()
        seen = []
        for r in found.numbers.collect():
            v = np.frombuffer(r["v"], np.uint8).reshape(4, -1)
            x = packed._numbers(r["x"], v.ravel()).reshape(4, -1)
            assert r["rows"] == x.shape[1] <= 100 and (v & 1 == v[0] & 1).all()
            for f, cuts in enumerate(found.cuts):
                assert (v[f] >> 1 == np.searchsorted(cuts, x[f])).all()
            seen += [(r["fold"], int(y), *map(float, values)) for y, values in zip(v[0] & 1, x.T)]
        expected = [(r["fold"], r["label"], *map(float, r["features"].toArray())) for r in rows.collect()]
        assert sorted(seen) == sorted(expected)
    finally:
        found.release()


def test_other_labels_are_left_to_mllib(spark):
    df = spark.createDataFrame([(Vectors.dense(float(i % 7), float(i % 5)), i % 3) for i in range(90)], ["features", "label"])
    model = PackedForestClassifier(labelCol="label", numTrees=2, seed=1).fit(df)
    assert model.numClasses == 3
    assert not PackedForestClassifier(labelCol="label", impurity="entropy").packable()


def test_warm_start_ends_where_a_cold_one_does(rows, monkeypatch):
    points = [{"regParam": r, "elasticNetParam": e} for r in (0.01, 0.3) for e in (0.0, 0.5, 1.0)]
    found = _packed(rows)
    try:
        cold, _ = grid._fit_packed(found, points, 3)
        monkeypatch.setattr(grid, "WARM_ROWS", 1)
        monkeypatch.setattr(grid, "first_blocks", lambda *a, inner=packed.first_blocks: inner(*a)[:3])
        warm, _ = grid._fit_packed(found, points, 3)
    finally:
        found.release()
    assert warm == pytest.approx(cold, abs=1e-8)


def test_tuning_and_fits_pack_the_rows_once(spark, sf_dir, monkeypatch):
    """A training run reads the dealt rows once, whatever is tuned; a forest alone keeps no numbers."""
    records = jobs.training_records(heart_records(spark, sf_dir), HEART, HEART_KEY)
    data = training_set(records, HEART, HEART_KEY)
    packs, inner = [], train.pack
    monkeypatch.setattr(train, "pack", lambda rows, cuts, numbers: packs.append(numbers) or inner(rows, cuts, numbers))
    monkeypatch.setattr(train, "GRIDS", {train.LR: train.GRIDS[train.LR], RF: {"numTrees": [2], "maxDepth": [1, 2]}})
    fit(data, RF, numTrees=2)
    fit(data, RF, numTrees=3)
    assert packs == [False]
    tune(data, train.LR, nested=True)
    tune(data, RF, nested=True)
    assert packs == [False, True]
    data.release()
    assert data.packing._packed is None
    data.discard()


def test_a_single_forest_keeps_a_byte_per_number(spark, sf_dir):
    """Not vectors, and neither an object nor a node per row and tree."""
    records = jobs.training_records(heart_records(spark, sf_dir), HEART, HEART_KEY)
    data = training_set(records, HEART, HEART_KEY)
    kept = spark._jsc.sc().getRDDStorageInfo
    before = {info.id() for info in kept()}
    fit(data, RF, numTrees=2)
    size = sum(info.memSize() + info.diskSize() for info in kept() if info.id() not in before)
    numbers = data.packed(numbers=False).rows * len(data.preparation.features)
    data.discard()
    assert numbers <= size < 2 * numbers


def test_rows_without_keys_still_have_cuts(spark, monkeypatch):
    """Their hashes are all alike, so that a share of hashes is all rows or none."""
    rows = spark.range(400).select(
        F.lit(None).cast("long").alias("patient_id"), F.lit(1).alias("heart_attack_risk"), F.lit(2.0).alias("age")
    )
    data = training_set(rows, jobs.with_features(HEART, rows, HEART_KEY), HEART_KEY)
    monkeypatch.setattr(train, "sample_share", lambda *_: 0.1)
    found = data.packed(numbers=False)
    assert found.rows == found.positives == 400 and [len(cuts) for cuts in found.cuts] == [0]
    data.discard()
