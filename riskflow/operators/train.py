"""Fitting and tuning the two model families."""

from __future__ import annotations

import threading
import time
from collections.abc import Callable, Iterable, Mapping, Sequence
from dataclasses import dataclass, field
from multiprocessing.pool import ThreadPool

from pyspark import StorageLevel, inheritable_thread_target
from pyspark.ml import PipelineModel
from pyspark.ml.classification import (
    LogisticRegression,
    RandomForestClassificationModel,
    RandomForestClassifier,
)
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.functions import vector_to_array
from pyspark.ml.tuning import ParamGridBuilder
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from riskflow.functions.scalar import quoted
from riskflow.operators.forest import PackedForestClassifier, forest_aucs
from riskflow.operators.grid import PENALTIES, grid_aucs
from riskflow.operators.packed import Packed, pack, sample_share
from riskflow.operators.prepare import SCALED_PREFIX, Preparation, fit_preparation
from riskflow.operators.split import digest_share, fold_of, is_train, key_digest
from riskflow.schemas import Task
from riskflow.session import discard, materialize, scratch_path

LR, RF = "logistic_regression", "random_forest"
# A forest's task carries the statistics of all nodes of a level, however few its rows: partitions have
# at least about so many rows, unless that leaves fewer partitions than the second number.
PARTITION_ROWS, MIN_PARTITIONS = 50_000, 12
# Iterations, seed, folds and the two parameter grids.
MAX_ITER, SEED, FOLDS = 10, 42, 3
GRIDS = {
    LR: {"regParam": [0.01, 0.1, 0.3], "elasticNetParam": [0.0, 0.5, 1.0]},
    RF: {"numTrees": [10, 20], "maxDepth": [5, 10]},
}


def estimator(family: str, label: str, **params):
    """An untrained classifier of the family; ``params`` are MLlib's own."""
    if family == LR:
        return LogisticRegression(**{"labelCol": label, "maxIter": MAX_ITER} | params)
    # What MLlib fits itself keeps each row's nodes, instead of finding them from the root at every level.
    return PackedForestClassifier(**{"labelCol": label, "seed": SEED, "cacheNodeIds": True} | params)


class Packing:
    """The dealt rows, packed when they are first asked for and then for all tunings of the training set."""

    def __init__(self, rows: DataFrame, sample: Callable[[float], DataFrame], n_rows: int, vectors: DataFrame):
        self._rows, self._sample, self._n_rows = rows, sample, n_rows
        self._lock, self._packed, self._done = threading.Lock(), None, False
        # The train split as vectors, not dealt: what does not draw bags by partition needs no order.
        self.vectors = vectors

    def get(self, numbers: bool) -> Packed | None:
        with self._lock:
            if self._done and numbers and self._packed and self._packed.numbers is None:
                self._drop()
            if not self._done:
                self._packed, self._done = self._pack(numbers), True
            return self._packed

    def _pack(self, numbers: bool) -> Packed | None:
        usual = estimator(RF, "label")
        share = sample_share(self._n_rows, usual.getMaxBins())
        cuts = usual.cuts(self._sample(share), self._n_rows)
        if not cuts and self._n_rows:  # rows whose hashes are all alike
            cuts = usual.cuts(self._rows.sample(share, SEED), self._n_rows)
        return pack(self._rows, cuts, numbers) if cuts else None

    def _drop(self) -> None:
        if self._packed:
            self._packed.release()
        self._packed, self._done = None, False

    def release(self) -> None:
        with self._lock:
            self._drop()


@dataclass(frozen=True)
class TrainingSet:
    """Prepared train split with folds, the raw test split and the fitted preparation."""

    train: DataFrame
    test: DataFrame
    preparation: Preparation
    label: str
    stored: DataFrame
    packing: Packing | None = None

    def packed(self, numbers: bool = True) -> Packed | None:
        """The train split in blocks, shared by all tunings; None where there are none. A forest alone
        does without the numbers."""
        return self.packing.get(numbers) if self.packing else None

    def release(self) -> None:
        """Drop the vectors from memory; the test split can still be read."""
        self.train.unpersist()
        if self.packing:
            self.packing.release()

    def discard(self) -> None:
        """Release the vectors and delete the written records; nothing can be read after."""
        self.release()
        discard(self.stored)


def training_set(
    records: DataFrame,
    task: Task,
    key: Sequence[str],
    partitions: int | None = None,
    max_training_rows: int | None = None,
    session: SparkSession | None = None,
) -> TrainingSet:
    """Split by key hash, fit the preparation on the train split only and apply it.

    The records are written once, as they come, so that joins, filters and hashes
    upstream run once; a task that writes them holds none, however many it has. A forest
    draws its bags per partition, so the train split is dealt by the key's digest
    to ``partitions`` (the session's shuffle partitions, fewer for few rows) and sorted in each: the
    input's files and the cluster's cores do not change the model. What needs no order, the statistics and a
    regression's fit, reads the written table. Tuning packs the dealt rows once (see ``packed``); the
    vectors are kept in memory and on disk once something else reads them. Lost blocks are
    recomputed from the written table.

    ``max_training_rows`` bounds the train split, about, to the rows with the
    smallest digests. It is off by default. ``session`` is where the result belongs, by default
    where the records do.
    """
    spark = session or records.sparkSession
    digest = key_digest(key)
    marked = records.select(
        *task.features, task.label,
        # Eight bytes of the digest's hash name the record's place as well as its 32 digits.
        F.xxhash64(digest).alias("place"), *([digest_share(digest).alias("share")] if max_training_rows else []),
        fold_of(key, FOLDS).alias("fold"), is_train(key).alias("train"),
    )
    # One table for both parts: writing them apart would sort all rows of a task by part.
    stored = materialize(marked, f"{task.name}_records", session=spark)
    train, test = stored.filter("train").drop("train"), stored.filter("NOT train").drop("train")
    if max_training_rows:
        share = max_training_rows / max(1, train.count())
        train = train.filter(F.col("share") < share)
    partitions = partitions or _partitions(train)
    preparation = fit_preparation(train, task.features, task.zero_columns)
    order = ["place", *(quoted(name) for name in (*task.features, task.label))]
    dealt = train.repartition(partitions, "place").sortWithinPartitions(*order)

    def vectors(rows: DataFrame) -> DataFrame:
        return PipelineModel(preparation.stages()).transform(rows).select("features", task.label, "fold")

    def numbers(rows: DataFrame) -> DataFrame:
        scaled = (F.col(quoted(SCALED_PREFIX + name)) for name in task.features)
        return preparation.stages()[0].transform(rows).select(
            F.array(*scaled).alias("x"), F.col(quoted(task.label)).alias("y"), "fold"
        )

    def sample(share: float) -> DataFrame:
        """About so many rows, the same ones however they are dealt."""
        number = F.xxhash64(*(F.col(name) for name in order)).bitwiseAND((1 << 40) - 1)
        few = train.filter(number < int(share * (1 << 40))) if share < 1 else train
        return numbers(few).limit(100_000)

    return TrainingSet(
        train=vectors(dealt).persist(StorageLevel.MEMORY_AND_DISK),
        test=test.drop("place", "share"),
        preparation=preparation,
        label=task.label,
        stored=stored,
        packing=Packing(numbers(dealt), sample, preparation.n_rows, vectors(train)),
    )


def _partitions(train: DataFrame) -> int:
    """The session's shuffle partitions, or fewer where they would have few rows."""
    most = int(train.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    if most <= MIN_PARTITIONS:
        return most
    return min(most, max(MIN_PARTITIONS, -(-train.count() // PARTITION_ROWS)))


@dataclass(frozen=True)
class Fitted:
    """One trained model with how it was found."""

    family: str
    pipeline: PipelineModel
    features: tuple[str, ...]
    params: dict[str, float]
    seconds: float
    grid: list[dict[str, float]] = field(default_factory=list)

    @property
    def classifier(self):
        return self.pipeline.stages[-1]


def fit(data: TrainingSet, family: str, **params) -> Fitted:
    """A single fit with the given parameters."""
    started = time.monotonic()
    base, packed = estimator(family, data.label, **params), None
    if family == RF and base.packable() and base.getMaxBins() == estimator(RF, data.label).getMaxBins():
        packed = data.packed(numbers=False)
    if packed and not packed.positives:
        packed = None
    model = base.fit(packed).model(data.train.sparkSession) if packed else base.fit(data.train)
    return _fitted(data, family, model, params, started)


def tune(
    data: TrainingSet,
    family: str,
    grid: Mapping[str, Sequence[float]] | None = None,
    parallelism: int = 4,
    folds: int = FOLDS,
    nested: bool = False,
    **params,
) -> Fitted:
    """Cross-validated grid search by AUC, refitted on the whole train split.

    Folds come from the key hash, so every run compares the same splits. A tie
    goes to the point that comes first in the grid. A regression's penalties are tried all at once
    (see ``grid``); other parameters and forests are fitted point by point, or with ``nested``
    all forests of a fold at once (see ``forest_aucs``), where only trees and depth differ, else
    forests of several depths (see ``cross_validate``).
    """
    started = time.monotonic()
    base = estimator(family, data.label, **params)
    values = dict(grid or GRIDS[family])
    builder = ParamGridBuilder()
    for name in values:
        builder = builder.addGrid(base.getParam(name), list(values[name]))
    points = builder.build()
    packed, aucs = None, None
    if family == LR and not params and set(values) == set(PENALTIES):
        by_name = [{param.name: value for param, value in point.items()} for point in points]
        packed = data.packed()
        aucs = grid_aucs(data.train, data.label, by_name, folds, packed)
    elif family == RF and nested and not params and base.packable():
        packed = data.packed()
        aucs = forest_aucs(packed, base, points, folds) if packed else None
    if aucs is None:
        packed, aucs = None, cross_validate(data, base, points, folds, parallelism, nested and family == RF)
    tried = [
        {param.name: value for param, value in point.items()} | {"mean_auc": auc}
        for point, auc in zip(points, aucs)
    ]
    best = max(range(len(points)), key=lambda i: (aucs[i], -i))
    if not packed:
        model = base.fit(data.train, points[best])
    elif family == LR:
        model = base.fit(data.packing.vectors, points[best])
    else:
        model = base.fit(packed, points[best]).model(data.train.sparkSession)
    chosen = {param.name: value for param, value in points[best].items()}
    return _fitted(data, family, model, chosen, started, tried)


def cross_validate(
    data: TrainingSet, base, points, folds: int, parallelism: int, nested: bool = False
) -> list[float]:
    """Mean validation AUC of each grid point.

    A plain filter on the fold column keeps the rows in the JVM; MLlib's own fold
    column check passes every row through Python. One fold at a time: its training
    part is persisted, its grid points are fitted, the largest first and at most ``parallelism``
    at once, and the part is released before the next fold.

    With ``nested``, forests that differ in depth alone are grown once, to the largest depth. Bags and
    feature subsets are drawn level by level from the seed, so the upper levels of a deep forest are
    the shallow one (see ``cut_scores``).
    """
    spark = data.train.sparkSession
    evaluator = BinaryClassificationEvaluator(labelCol=data.label)
    largest_first = sorted(range(len(points)), key=lambda i: -_levels(points[i]))
    groups: dict[object, list[int]] = {}  # in order of their largest point, which is each one's first
    for i in largest_first:
        others = frozenset((p.name, value) for p, value in points[i].items() if p.name != "maxDepth")
        groups.setdefault(others if nested else i, []).append(i)
    sums = [0.0] * len(points)
    for fold in range(folds):
        part = data.train.filter(F.col("fold") != fold).persist(StorageLevel.MEMORY_AND_DISK)
        rest = data.train.filter(F.col("fold") == fold)

        def validation_aucs(group: list[int], part=part, rest=rest) -> list[float]:
            model = base.fit(part, points[group[0]])
            found = [evaluator.evaluate(model.transform(rest))]
            if group[1:]:
                cuts = [points[i].get(base.maxDepth, base.getMaxDepth()) for i in group[1:]]
                leaves = model.copy({model.leafCol: "leaves"}).transform(rest)
                for score in cut_scores(spark, model, cuts, "leaves"):
                    cut = leaves.select(data.label, score.alias("score"))
                    found.append(evaluator.evaluate(cut, {evaluator.rawPredictionCol: "score"}))
            return found

        try:
            aucs = together(spark, validation_aucs, groups.values(), parallelism)
        finally:
            part.unpersist(blocking=True)
        for group, found in zip(groups.values(), aucs):
            for i, auc in zip(group, found):
                sums[i] += auc
    return [total / folds for total in sums]


def cut_scores(
    spark: SparkSession, model: RandomForestClassificationModel, depths: Sequence[int], leaf_column: str
) -> list[Column]:
    """The raw prediction of class 1 by the same forest grown to each of smaller ``depths``, from the
    leaves that a row reaches in ``model``.

    The nodes come from the saved model: at most two to the depth for each tree, whatever the rows.
    """
    path = scratch_path(spark, "forest")
    model.save(path)
    stored = spark.read.parquet(f"{path}/data")
    trees: list[dict[int, Row]] = [{} for _ in range(model.getNumTrees)]
    for tree, node in stored.select("treeID", "nodeData").collect():
        trees[tree][node.id] = node
    discard(stored)
    leaves = vector_to_array(leaf_column)
    scores = []
    for depth in depths:
        score = F.lit(0.0)
        for t, nodes in enumerate(trees):
            # As one text per tree, which the planner folds; a literal per leaf would be a call each.
            text = ",".join(map(repr, _cut_shares(nodes, 0, depth)[0]))
            shares = F.split(F.lit(text), ",").cast("array<double>")
            score = score + F.get(shares, F.get(leaves, F.lit(t)).cast("int"))
        scores.append(score)
    return scores


def _cut_shares(nodes: Mapping[int, Row], at: int, levels: int) -> tuple[list[float], float | None]:
    """For each leaf below a node, left to right, the share of class 1 where the tree ends when only
    ``levels`` more are grown; and the node's prediction if the tree ends at the node itself.

    Like MLlib, two leaves that predict the same are one.
    """
    node = nodes[at]
    total = sum(node.impurityStats)
    own = node.impurityStats[1] / total if total else 0.0
    if node.leftChild < 0:
        return [own], node.prediction
    left, left_end = _cut_shares(nodes, node.leftChild, levels - 1)
    right, right_end = _cut_shares(nodes, node.rightChild, levels - 1)
    merged = left_end is not None and left_end == right_end
    if levels <= 0 or merged:
        return [own] * (len(left) + len(right)), node.prediction if levels <= 0 else left_end
    return left + right, None


def _levels(point) -> float:
    """Levels of all trees of a forest's grid point, which is about its work."""
    named = {param.name: value for param, value in point.items()}
    return named.get("numTrees", 1) * named.get("maxDepth", 1)


def together(spark: SparkSession, work: Callable, items: Iterable, parallelism: int) -> list:
    """``work`` of each item, in order; begun in order and at most ``parallelism`` at once, so that
    their jobs fill the cores that others leave."""
    items = list(items)
    with ThreadPool(max(1, min(parallelism, len(items)))) as pool:
        return pool.map(inheritable_thread_target(spark)(work), items, chunksize=1)


def _fitted(data, family, model, params, started, tried=()) -> Fitted:
    return Fitted(
        family=family,
        pipeline=PipelineModel([*data.preparation.stages(), model]),
        features=data.preparation.features,
        params=dict(params),
        seconds=round(time.monotonic() - started, 2),
        grid=list(tried),
    )


def grid_table(spark: SparkSession, fitted: Fitted) -> DataFrame:
    """One row per tried grid point: parameters, mean AUC and whether it was chosen."""
    names = [name for name in fitted.grid[0] if name != "mean_auc"]
    rows = [
        (
            fitted.family,
            *(float(point[name]) for name in names),
            float(point["mean_auc"]),
            all(point[name] == fitted.params[name] for name in names),
        )
        for point in fitted.grid
    ]
    columns = ", ".join(f"`{name}` double" for name in names)
    return spark.createDataFrame(rows, f"family string, {columns}, mean_auc double, chosen boolean")


def feature_importance(spark: SparkSession, fitted: Fitted) -> DataFrame:
    """Feature names with the forest's importances, or the coefficients of a regression."""
    model = fitted.classifier
    weights = model.featureImportances if fitted.family == RF else model.coefficients
    rows = list(zip(fitted.features, (float(w) for w in weights.toArray())))
    return spark.createDataFrame(rows, "feature string, weight double").orderBy(F.desc(F.abs("weight")))
