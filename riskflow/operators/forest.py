"""MLlib's random forest for two classes, grown over packed blocks.

MLlib holds an object per row, a weight per row and tree, and goes through both at every level. Here a
row is a byte per feature (see ``packed``), and numpy counts the rows of all nodes, features and bins of a
level at once; bags are drawn anew from each block's number instead of being kept. What is grown is
MLlib's: bins, gini gain, leaves, merged leaves and feature subsets by the same rules, a Poisson weight per row
and tree; the model is MLlib's own class. A tree without bag and
subsets equals MLlib's. Counts are whole numbers, so neither partitions nor cores change a forest.

A forest's first trees and upper levels do not depend on how many more are grown, so that one forest per
fold has the scores of all smaller ones.
"""

from __future__ import annotations

import json
import math
import time
from collections.abc import Callable, Iterator, Mapping, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskflow.operators import ranks
from riskflow.operators.packed import MOST_BINS, Packed, cuts_of, pack, read, sample_share
from riskflow.session import discard_path, scratch_path

# Nodes whose counts are added up in one place, and numbers that a task holds in one pass: a level of
# more goes in several.
PIECE_NODES, PASS_CELLS = 64, 1 << 22
# What MLlib takes for no impurity.
_EPSILON = 2.0**-52
# Its forests give up on nodes below this depth.
_MOST_DEPTH = 30
_POISSON_STEPS = 1 << 16


def _poisson_table() -> np.ndarray:
    """The Poisson weight, of mean one, that each of 65,536 equally likely numbers stands for."""
    shares = np.exp(-1.0) / np.array([math.factorial(k) for k in range(10)], float)
    ends = np.round(np.cumsum(shares) * _POISSON_STEPS).astype(int)
    return np.searchsorted(ends, np.arange(_POISSON_STEPS), side="right").astype(np.uint8)


_POISSON = _poisson_table()


@dataclass
class Tree:
    """Nodes in the order of their making. A leaf's left child is itself; a right child follows the left."""

    left: list[int] = field(default_factory=lambda: [0])
    feature: list[int] = field(default_factory=lambda: [0])
    cut: list[int] = field(default_factory=lambda: [MOST_BINS])
    gain: list[float] = field(default_factory=lambda: [-1.0])
    counts: list[tuple[int, int]] = field(default_factory=lambda: [(0, 0)])

    def split(self, node: int, feature: int, cut: int, gain: float, left, right) -> int:
        """The node's new left child."""
        child = len(self.left)
        self.left[node], self.feature[node], self.cut[node], self.gain[node] = child, feature, cut, gain
        for offset, counts in enumerate((left, right)):
            self.left.append(child + offset)
            self.feature.append(0)
            self.cut.append(MOST_BINS)
            self.gain.append(-1.0)
            self.counts.append(counts)
        return child

    def arrays(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Left child, feature, and the largest byte that goes left."""
        cut = np.minimum(2 * np.array(self.cut, np.int64) + 1, 255).astype(np.uint8)
        return np.array(self.left, np.int64), np.array(self.feature, np.int64), cut

    def prediction(self, node: int) -> float:
        return float(self.counts[node][1] > self.counts[node][0])

    def share(self, node: int) -> float:
        """Share of class 1."""
        total = sum(self.counts[node])
        return self.counts[node][1] / total if total else 0.0

    def ends(self, levels: int) -> list[bool]:
        """For every node whether the tree ends there, when only so many levels are grown. Like MLlib, two
        leaves that predict the same are one."""
        ends = [False] * len(self.left)

        def prediction(node: int, more: int) -> float | None:
            left = self.left[node]
            if left == node or more == 0:
                ends[node] = True
                return self.prediction(node)
            both = prediction(left, more - 1), prediction(left + 1, more - 1)
            ends[node] = both[0] is not None and both[0] == both[1]
            return both[0] if ends[node] else None

        prediction(0, levels)
        return ends

    def shares(self, levels: int) -> np.ndarray:
        """For every node that a row comes to in so many steps, the share that the tree gives it."""
        ends, found = self.ends(levels), np.zeros(len(self.left))
        todo: list[tuple[int, float | None]] = [(0, None)]
        while todo:
            node, value = todo.pop()
            if value is None and ends[node]:
                value = self.share(node)
            found[node] = 0.0 if value is None else value
            if self.left[node] != node:
                todo += [(self.left[node], value), (self.left[node] + 1, value)]
        return found


@dataclass(frozen=True)
class Settings:
    trees: int
    depth: int
    bagged: bool
    features: int
    subset: int
    most_bins: int
    least_rows: int
    least_gain: float
    seed: int


def _gini(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    """In MLlib's order of operations, so that ties fall alike."""
    total = np.maximum(zeros + ones, 1).astype(float)
    first, second = zeros / total, ones / total
    return 1.0 - first * first - second * second


def _walk(v: np.ndarray, rows: np.ndarray, node: np.ndarray, tree, size: int, steps: int) -> np.ndarray:
    left, feature, cut = tree
    start = feature * size
    for _ in range(steps):
        node = left.take(node) + (v.take(start.take(node) + rows) > cut.take(node))
    return node


def _counts(trees: Sequence[tuple], works: Mapping[int, tuple], level: int, settings: Settings):
    """Rows by class of each (tree, node of the level, feature of its subset, bin).

    ``works`` has per tree: the place of each node in this pass or -1, the subsets of its nodes, and the
    pieces as (number, first place, end).
    """
    cells = 2 * settings.most_bins
    last = max(works)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = {t: np.zeros((settings.subset, len(subsets) * cells)) for t, (_, subsets, _) in works.items()}
        for number, v in read(batches, "id", "v"):
            size = len(v) // settings.features
            rng = np.random.Generator(np.random.SFC64([settings.seed % (1 << 64), number]))
            for t in range(last + 1):
                if settings.bagged:  # each tree's draws follow those of the tree before
                    weights = _POISSON.take(rng.integers(0, _POISSON_STEPS, size, dtype=np.uint16))
                if t not in works:
                    continue
                place, subsets, _ = works[t]
                rows = np.flatnonzero(weights > 0) if settings.bagged else np.arange(size)
                weights = weights.take(rows).astype(float) if settings.bagged else None
                node = _walk(v, rows, np.zeros(len(rows), np.int64), trees[t], size, level)
                at = place.take(node)
                live = at >= 0
                if not live.all():
                    at, rows = at[live], rows[live]
                    weights = weights[live] if settings.bagged else None
                base = at * cells
                for k in range(settings.subset):
                    byte = v.take((subsets[:, k] * size).take(at) + rows)
                    sums[t][k] += np.bincount(base + byte, weights, len(subsets) * cells)
        for t, (_, _, pieces) in works.items():
            for piece, start, end in pieces:
                mine = sums[t][:, start * cells : end * cells].astype(np.int64)
                if mine.any():
                    yield pa.RecordBatch.from_pydict(
                        {"piece": pa.array([piece], pa.int32()), "sums": pa.array([mine.tobytes()], pa.binary())}
                    )

    return run


_SPLIT = np.dtype(
    [("feature", np.int32), ("cut", np.int32), ("gain", float), ("left", np.int64, 2), ("all", np.int64, 2)]
)


def _best(sums: np.ndarray, subsets: np.ndarray, widths: np.ndarray, settings: Settings) -> np.ndarray:
    """The best split of each node, the first of equal ones; a gain of minus infinity where there is none."""
    nodes = len(subsets)
    counts = sums.reshape(settings.subset, nodes, settings.most_bins, 2).transpose(1, 0, 2, 3)
    total = counts[:, 0].sum(axis=1)
    left = counts.cumsum(axis=2)[:, :, :-1]
    right = total[:, None, None] - left
    n_left, n_right, n = left.sum(axis=3), right.sum(axis=3), total.sum(axis=1)
    share = np.maximum(n, 1).astype(float)[:, None, None]
    gain = (
        _gini(total[:, 0], total[:, 1])[:, None, None]
        - n_left / share * _gini(left[..., 0], left[..., 1])
        - n_right / share * _gini(right[..., 0], right[..., 1])
    )
    allowed = np.arange(settings.most_bins - 1) < widths[subsets][:, :, None]
    allowed &= (n_left >= settings.least_rows) & (n_right >= settings.least_rows)
    allowed &= gain >= settings.least_gain
    gain = np.where(allowed, gain, -np.inf).reshape(nodes, -1)
    best = gain.argmax(axis=1) if gain.shape[1] else np.zeros(nodes, int)
    found = np.zeros(nodes, _SPLIT)
    found["all"], found["gain"] = total, -np.inf
    if gain.shape[1]:
        k, cut = np.divmod(best, settings.most_bins - 1)
        each = np.arange(nodes)
        found["feature"], found["cut"] = subsets[each, k], cut
        found["gain"], found["left"] = gain[each, best], left[each, k, cut]
    return found


def _passes(subsets: Mapping[int, np.ndarray], settings: Settings) -> Iterator[dict[int, tuple[int, int]]]:
    """Which of each tree's open nodes go in one pass: tree -> (first, end)."""
    most = max(1, PASS_CELLS // (2 * settings.most_bins * settings.subset))
    now, left = {}, most
    for t, own in subsets.items():
        start = 0
        while start < len(own):
            if not left or t in now:
                yield now
                now, left = {}, most
            end = min(len(own), start + left)
            now[t], left, start = (start, end), left - (end - start), end
    if now:
        yield now


def grow(packed: Packed, settings: Settings) -> list[Tree]:
    """The forest, level by level; a pass over the blocks for each, all trees at once."""
    trees = [Tree() for _ in range(settings.trees)]
    draws = [np.random.Generator(np.random.SFC64([settings.seed % (1 << 64), 1, t])) for t in range(settings.trees)]
    widths = np.array([len(cuts) for cuts in packed.cuts], np.int64)
    nodes = [[0] for _ in trees]  # those that may be split
    blocks = packed.dealt("id", "v")
    for level in range(max(1, settings.depth)):
        subsets = {t: _subsets(draws[t], len(own), settings) for t, own in enumerate(nodes) if own}
        if not subsets:
            break
        arrays = [tree.arrays() for tree in trees]
        found = {t: np.zeros(len(own), _SPLIT) for t, own in enumerate(nodes)}
        for part in _passes(subsets, settings):
            works, pieces = {}, {}
            for t, (start, end) in part.items():
                place = np.full(len(trees[t].left), -1, np.int64)
                place[nodes[t][start:end]] = np.arange(end - start)
                own = []
                for a in range(0, end - start, PIECE_NODES):
                    b = min(a + PIECE_NODES, end - start)
                    own.append((len(pieces), a, b))
                    pieces[len(pieces)] = (t, start + a, start + b)
                works[t] = (place, subsets[t][start:end], own)
            for piece, best in _splits(blocks, arrays, works, pieces, subsets, widths, level, settings):
                t, a, b = pieces[piece]
                found[t][a:b] = best
        nodes = [_next(trees[t], own, found[t], level, settings) for t, own in enumerate(nodes)]
    return trees


def _subsets(rng: np.random.Generator, nodes: int, settings: Settings) -> np.ndarray:
    """The features that each node may be split by, in their order."""
    if settings.subset >= settings.features:
        return np.tile(np.arange(settings.features), (nodes, 1))
    drawn = rng.random((nodes, settings.features)).argsort(axis=1)[:, : settings.subset]
    return np.sort(drawn, axis=1)


def _splits(blocks, arrays, works, pieces, subsets, widths, level, settings) -> Iterator[tuple[int, np.ndarray]]:
    of_piece = {piece: subsets[t][a:b] for piece, (t, a, b) in pieces.items()}

    def best(parts: pa.Table) -> pa.Table:
        piece = parts.column("piece")[0].as_py()
        sums = sum(np.frombuffer(value.as_buffer(), np.int64) for value in parts.column("sums"))
        found = _best(sums, of_piece[piece], widths, settings)
        return pa.table({"piece": pa.array([piece], pa.int32()), "splits": pa.array([found.tobytes()], pa.binary())})

    counted = blocks.mapInArrow(_counts(arrays, works, level, settings), "piece int, sums binary")
    splits = counted.groupBy("piece").applyInArrow(best, "piece int, splits binary")
    for row in splits.collect():  # a few numbers per node
        yield row["piece"], np.frombuffer(row["splits"], _SPLIT)


def _next(tree: Tree, nodes: Sequence[int], found: np.ndarray, level: int, settings: Settings) -> list[int]:
    """Split the nodes that gain by it; the children that may be split in turn."""
    following = []
    for node, best in zip(nodes, found):
        if not level:
            tree.counts[0] = tuple(int(n) for n in best["all"])
        if level >= settings.depth or best["gain"] <= 0:
            continue
        left = tuple(int(n) for n in best["left"])
        right = tuple(int(n) for n in best["all"] - best["left"])
        child = tree.split(node, int(best["feature"]), int(best["cut"]), float(best["gain"]), left, right)
        if level + 1 < settings.depth:
            following += [
                child + offset for offset, counts in enumerate((left, right)) if _gini(*map(np.array, counts)) >= _EPSILON
            ]
    return following


@dataclass(frozen=True)
class Grown:
    """A forest as it was grown."""

    trees: list[Tree]
    cuts: Sequence[np.ndarray]
    forest: RandomForestClassifier

    def model(self, spark: SparkSession) -> RandomForestClassificationModel:
        return _model(spark, self.forest, self.trees, self.cuts)


class PackedForestClassifier(RandomForestClassifier):
    """MLlib's estimator and parameters. A table gives MLlib's model, ``Packed`` rows what it is made of.

    What is not grown here (other labels than 0 and 1, categorical features, weights, and parameters
    beside trees, depth, bins, subsets, seed and least rows and gain) MLlib fits itself.
    """

    def _fit(self, dataset: DataFrame | Packed) -> RandomForestClassificationModel | Grown:
        if isinstance(dataset, Packed):
            return Grown(grow(dataset, self.settings(len(dataset.cuts))), dataset.cuts, self)
        packed = self._packed(dataset) if self.packable(dataset) else None
        if packed is None:
            return super()._fit(dataset)
        try:
            if not packed.positives:  # MLlib has an error for it
                return super()._fit(dataset)
            return self._fit(packed).model(dataset.sparkSession)
        finally:
            packed.release()

    def packable(self, dataset: DataFrame | None = None) -> bool:
        """Whether the parameters, and the table's columns, are those that are grown here."""
        usual = {"impurity": "gini", "subsamplingRate": 1.0, "minWeightFractionPerNode": 0.0}
        if any(self.getOrDefault(name) != value for name, value in usual.items()):
            return False
        if self.isSet("weightCol") or self.isSet("thresholds") or self.getOrDefault("leafCol"):
            return False
        if not 2 <= self.getMaxBins() <= MOST_BINS or self.getMaxDepth() > _MOST_DEPTH:
            return False
        if dataset is None:
            return True
        described = json.dumps([dataset.schema[c].metadata for c in (self.getFeaturesCol(), self.getLabelCol())])
        return '"nominal"' not in described and '"binary"' not in described

    def _packed(self, dataset: DataFrame) -> Packed | None:
        rows = dataset.select(
            vector_to_array(self.getFeaturesCol()).alias("x"), F.col(self.getLabelCol()).alias("y"),
            F.lit(0).alias("fold"),
        )
        n = rows.count()
        share = sample_share(n, self.getMaxBins())
        sample = rows if share >= 1 else rows.sample(share, self.getSeed())
        cuts = self.cuts(sample, n)
        return pack(rows, cuts) if cuts else None

    def cuts(self, sample: DataFrame, rows: int) -> list[np.ndarray]:
        """The cuts between bins, of the few rows of ``sample``; none without any."""
        values = [row["x"] for row in sample.select("x").collect()]
        if not values:
            return []
        most = min(self.getMaxBins(), rows)
        return [cuts_of(column, most) for column in np.array(values, float).T]

    def settings(self, features: int) -> Settings:
        return Settings(
            trees=self.getNumTrees(), depth=self.getMaxDepth(), bagged=self.getBootstrap(), features=features,
            subset=_subset_size(self.getFeatureSubsetStrategy(), features, self.getNumTrees() > 1),
            most_bins=self.getMaxBins(), least_rows=self.getMinInstancesPerNode(),
            least_gain=self.getMinInfoGain(), seed=self.getSeed(),
        )


def _subset_size(strategy: str, features: int, many: bool) -> int:
    """How many features a node may be split by, as MLlib reads the parameter."""
    strategy = strategy.lower()
    if strategy == "auto":
        strategy = "sqrt" if many else "all"
    named = {
        "all": features,
        "sqrt": math.ceil(math.sqrt(features)),
        "log2": max(1, math.ceil(math.log2(features))),
        "onethird": math.ceil(features / 3.0),
    }
    if strategy in named:
        return named[strategy]
    if strategy.isdigit() and int(strategy) > 0:
        return min(int(strategy), features)
    return math.ceil(float(strategy) * features)


# Parameters of a forest that its trees do not have.
_OF_FORESTS = ("numTrees", "bootstrap", "featureSubsetStrategy", "subsamplingRate")
_NODES = (
    "treeID int, nodeData struct<id int, prediction double, impurity double, impurityStats array<double>, "
    "rawCount long, gain double, leftChild int, rightChild int, "
    "split struct<featureIndex int, leftCategoriesOrThreshold array<double>, numCategories int>>"
)


def _model(
    spark: SparkSession, forest: RandomForestClassifier, trees: Sequence[Tree], cuts: Sequence[np.ndarray]
) -> RandomForestClassificationModel:
    """The trees as MLlib's model, by way of its own file format."""
    path = scratch_path(spark, "grown")
    rows = [(t, *node) for t, tree in enumerate(trees) for node in _node_rows(tree, cuts)]
    values = list(zip(*rows))
    split = pa.StructArray.from_arrays(
        [pa.array(values[9], pa.int32()), pa.array(values[10], pa.list_(pa.float64())), pa.array(values[11], pa.int32())],
        names=["featureIndex", "leftCategoriesOrThreshold", "numCategories"],
    )
    kinds = [pa.int32(), pa.float64(), pa.float64(), pa.list_(pa.float64()), pa.int64(), pa.float64(), pa.int32(), pa.int32()]
    names = ["id", "prediction", "impurity", "impurityStats", "rawCount", "gain", "leftChild", "rightChild"]
    node = pa.StructArray.from_arrays(
        [*(pa.array(column, kind) for column, kind in zip(values[1:9], kinds)), split], names=[*names, "split"]
    )
    table = pa.table({"treeID": pa.array(values[0], pa.int32()), "nodeData": node})
    spark.createDataFrame(table, _NODES).coalesce(1).write.parquet(f"{path}/data")

    def described(kind: str, uid: str, leave_out: Sequence[str] = (), **more) -> str:
        params = [
            {p.name: value for p, value in values.items() if p.name not in leave_out}
            for values in (forest._paramMap, forest._defaultParamMap)
        ]
        return json.dumps(
            {
                "class": f"org.apache.spark.ml.classification.{kind}", "timestamp": int(time.time() * 1000),
                "sparkVersion": spark.version, "uid": uid, "paramMap": params[0], "defaultParamMap": params[1],
            }
            | more
        )

    size = {"numFeatures": len(cuts), "numClasses": 2}
    of_tree = [
        (t, described("DecisionTreeClassificationModel", f"{forest.uid}_tree_{t}", _OF_FORESTS), 1.0)
        for t in range(len(trees))
    ]
    spark.createDataFrame(of_tree, "_1 int, _2 string, _3 double").coalesce(1).write.parquet(f"{path}/treesMetadata")
    whole = described("RandomForestClassificationModel", forest.uid, numTrees=len(trees), **size)
    spark.createDataFrame([(whole,)], "value string").coalesce(1).write.text(f"{path}/metadata")
    model = RandomForestClassificationModel.load(path)
    discard_path(spark, path)
    return model


def _node_rows(tree: Tree, cuts: Sequence[np.ndarray]) -> list[tuple]:
    """The nodes as MLlib stores them, numbered from the root, left before right."""
    ends, rows = tree.ends(_MOST_DEPTH + 1), []

    def add(node: int) -> int:
        number, counts = len(rows), tree.counts[node]
        impurity = float(_gini(np.array(counts[0]), np.array(counts[1]))) if sum(counts) else 0.0
        own = (number, tree.prediction(node), impurity, [float(n) for n in counts], sum(counts))
        rows.append((*own, -1.0, -1, -1, -1, [], -1))
        if not ends[node]:
            left, right = (add(tree.left[node] + offset) for offset in (0, 1))
            feature = tree.feature[node]
            cut = float(cuts[feature][tree.cut[node]])
            rows[number] = (*own, tree.gain[node], left, right, feature, [cut], -1)
        return number

    add(0)
    return rows


def _scorer(trees: Sequence[Tree], points: Sequence[tuple[int, int]], features: int, fold_points: int) -> Callable:
    """Sums of shares by the first so many trees, each cut at a depth, for (trees, depth) of each point."""
    depths = sorted({depth for _, depth in points})
    tables = [(tree.arrays(), [tree.shares(depth) for depth in depths]) for tree in trees]

    def run(fold: int, v: np.ndarray) -> tuple[int, np.ndarray]:
        size = len(v) // features
        rows = np.arange(size)
        scores = np.zeros((len(points), size))
        for t, (arrays, shares) in enumerate(tables):
            node, gone = np.zeros(size, np.int64), 0
            for depth, share in zip(depths, shares):
                node, gone = _walk(v, rows, node, arrays, size, depth - gone), depth
                gives = share.take(node)
                for i, (n, own) in enumerate(points):
                    if own == depth and t < n:
                        scores[i] += gives
        return fold * fold_points, scores

    return run


def forest_aucs(
    packed: Packed, base: PackedForestClassifier, points: Sequence[Mapping], folds: int
) -> list[float] | None:
    """Mean validation AUC of each grid point: per fold one forest, of the most trees and the largest depth,
    has the scores of all points. None, if they differ in anything else."""
    if any({p.name for p in point} - {"numTrees", "maxDepth"} for point in points):
        return None
    sizes = [
        (int(point.get(base.numTrees, base.getNumTrees())), int(point.get(base.maxDepth, base.getMaxDepth())))
        for point in points
    ]
    present = [fold for fold in range(folds) if fold in packed.sizes]
    if min(n for n, _ in sizes) < 2 or len(present) < folds:
        return None  # a single tree takes all features
    parts = [packed.where([f for f in packed.sizes if f != fold]) for fold in range(folds)]
    if any(part.positives == 0 for part in parts):
        return None
    largest = {base.numTrees: max(n for n, _ in sizes), base.maxDepth: max(d for _, d in sizes)}
    found: list[float | None] = []
    for fold, part in enumerate(parts):
        scorer = _scorer(base.fit(part, largest).trees, sizes, len(packed.cuts), len(points))
        found += ranks.aucs(packed.where([fold]), scorer, folds * len(points))[fold * len(points) :][: len(points)]
    return ranks.fold_means(found, len(points), folds)
