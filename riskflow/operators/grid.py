"""All points of a regularised logistic regression grid, on all folds, in the same passes.

A pass is one aggregate over the train split that carries, for every grid point and fold left out, the
loss, its gradient and its second derivatives; a task adds them up over blocks of rows, packed
and persisted once for all passes, the driver sums the tasks' numbers. Between passes it takes a Newton step for
each of these small problems, by coordinate descent where there is an absolute penalty. The number of
passes is that of the slowest problem to converge, not points times folds times iterations; a pass
carries only the problems that have not converged. Of many rows, the driver solves a few blocks first: Newton's
steps begin there, over all rows, and end where they would from anywhere else.

The objective is MLlib's: mean log loss plus the elastic net penalty on coefficients of features
scaled by their deviation in the training folds, intercept free. It is minimised until it stands still.
"""

from __future__ import annotations

import logging
from collections.abc import Callable, Iterator, Mapping, Sequence

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskflow.operators import ranks
from riskflow.operators.packed import Packed, first_blocks, pack, read

_log = logging.getLogger(__name__)

# The parameters that a grid names, all of them.
PENALTIES = ("regParam", "elasticNetParam")
MAX_PASSES = 40
# Largest change of a scaled coefficient at which a problem counts as solved.
TOLERANCE = 1e-9
# Rows that are worked on at once, so that what is computed of them stays in a core's cache.
BLOCK_ROWS = 2048
# Rows from which on a few blocks are solved first.
WARM_ROWS = 500_000
_SWEEPS = 1000


def _packed(rows: DataFrame) -> DataFrame:
    """The rows as blocks: up to ``BLOCK_ROWS`` of one fold in a row, numbers as bytes, features with a
    leading one. A pass then moves few large values instead of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            y = batch.column("y").to_numpy().astype(float)
            x = batch.column("x").flatten().to_numpy().reshape(len(y), -1)
            x, fold = np.column_stack([np.ones(len(y)), x]), batch.column("fold").to_numpy()
            blocks = [
                (int(f), mine[i : i + BLOCK_ROWS])
                for f in np.unique(fold)
                for mine in (np.flatnonzero(fold == f),)
                for i in range(0, len(mine), BLOCK_ROWS)
            ]
            yield pa.RecordBatch.from_pydict(
                {
                    "fold": pa.array([f for f, _ in blocks], pa.int32()),
                    "x": pa.array([x[at].tobytes() for _, at in blocks], pa.binary()),
                    "y": pa.array([y[at].tobytes() for _, at in blocks], pa.binary()),
                }
            )

    return rows.mapInArrow(run, "fold int, x binary, y binary")


def _arrays(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray, int]]:
    """Features with a leading one, labels and fold of each block, of ``packed`` in parts."""
    if "v" in batch.schema.names:
        for fold, rows, v, x in read([batch], "fold", "rows", "v", "x"):
            yield from _parts(fold, rows, v, x)
        return
    for f, x, y in zip(batch.column("fold").to_pylist(), batch.column("x"), batch.column("y")):
        target = np.frombuffer(y.as_buffer())
        yield np.frombuffer(x.as_buffer()).reshape(len(target), -1), target, f


def _parts(fold: int, rows: int, v: np.ndarray, x: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, int]]:
    """At most ``BLOCK_ROWS`` rows each, fewer where their products would leave a core's cache."""
    x, y = x.reshape(-1, rows), (v[:rows] & 1).astype(float)
    width = len(x) + 1
    step = max(256, min(BLOCK_ROWS, (1 << 18) // (width * (width + 1))))
    for at in range(0, rows, step):
        own = np.empty((width, min(step, rows - at)))
        own[0], own[1:] = 1.0, x[:, at : at + step]
        yield own.T, y[at : at + step], fold


def _pairs(width: int) -> tuple[np.ndarray, np.ndarray]:
    return np.triu_indices(width)


def _added(blocks: Iterator[tuple[np.ndarray, np.ndarray, int]], of_block) -> np.ndarray | None:
    total = None
    for x, y, fold in blocks:
        values = of_block(x, y, np.full(len(y), fold))
        total = values if total is None else total + values
    return total


def _summed(blocks: DataFrame, of_block) -> np.ndarray:
    """Element-wise sum, over all blocks, of the array that ``of_block`` gives. A task sends one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = _added((block for batch in batches for block in _arrays(batch)), of_block)
        if total is not None:
            yield pa.RecordBatch.from_pydict(
                {"sums": pa.array([total.tobytes()], pa.binary()), "length": pa.array([len(total)], pa.int32())}
            )

    total = 0.0
    for row in blocks.mapInArrow(run, "sums binary, length int").collect():
        total = total + np.frombuffer(row["sums"]).reshape(row["length"], -1)
    return total


def _moments(folds: int):
    """Per fold: rows, and per column the sum and the sum of squares."""

    def of_block(x: np.ndarray, y: np.ndarray, fold: np.ndarray) -> np.ndarray:
        own = (fold[:, None] == np.arange(folds)).astype(float)
        return np.concatenate([own.T @ x, own.T @ (x * x)], axis=1)

    return of_block


def _derivatives(weights: np.ndarray, left_out: np.ndarray):
    """Per problem (a column of ``weights``): loss, gradient and upper half of the second derivatives
    over the rows outside its fold."""
    width = len(weights)

    def of_block(x: np.ndarray, y: np.ndarray, fold: np.ndarray) -> np.ndarray:
        sums = np.zeros((1 + width + width * (width + 1) // 2, len(left_out)))
        same = bool(len(fold)) and bool((fold == fold[0]).all())
        for f in fold[:1] if same else np.unique(fold):
            # A fold's rows meet only the problems that do not leave it out.
            mine, used = fold == f, np.flatnonzero(left_out != f)
            own = np.ascontiguousarray((x if same else x[mine]).T)
            target = y if same else y[mine]
            margin = weights[:, used].T @ own
            # log(1 + e^m) and 1 / (1 + e^-m) without overflow
            small = np.exp(-np.abs(margin))
            loss = np.maximum(margin, 0) - target * margin + np.log1p(small)
            share = 1.0 / (1.0 + small)
            p = np.where(margin >= 0, share, small * share)
            sums[0, used] += loss.sum(axis=1)
            sums[1 : 1 + width, used] += own @ (p - target).T
            products, at = np.empty((width * (width + 1) // 2, own.shape[1])), 0
            for k in range(width):
                np.multiply(own[k], own[k:], out=products[at : at + width - k])
                at += width - k
            small *= share * share
            sums[1 + width :, used] += products @ small.T
        return sums

    return of_block


def _newton(w, gradient, hessian, absolute, square) -> np.ndarray:
    """The minimum of each problem's quadratic model with its penalties; all problems abreast.

    ``w`` and ``gradient`` have a column per problem, ``hessian`` a matrix per problem; the first
    row, the intercept, has no penalty.
    """
    new, slope = w.copy(), gradient.copy()
    for _ in range(_SWEEPS):
        most = 0.0
        for k in range(len(w)):
            curve = hessian[:, k, k]
            l1, l2 = (absolute, square) if k else (0.0 * absolute, 0.0 * square)
            target = curve * new[k] - slope[k]
            value = np.sign(target) * np.maximum(np.abs(target) - l1, 0) / np.maximum(curve + l2, 1e-300)
            change = np.where(curve + l2 > 0, value - new[k], 0.0)
            new[k] += change
            slope += hessian[:, :, k].T * change
            most = max(most, float(np.abs(change).max()))
        if most < TOLERANCE / 100:
            break
    return new


def fit_grid(
    rows: DataFrame, points: Sequence[Mapping[str, float]], folds: int
) -> tuple[np.ndarray, np.ndarray]:
    """Weights, intercept first, as a column per (point, fold left out), and that fold.

    ``rows`` have ``x`` (array of doubles), ``y`` (0 or 1) and ``fold``.
    """
    blocks = _packed(rows).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        return _solve(lambda of_block: _summed(blocks, of_block), points, folds)
    finally:
        blocks.unpersist()


def _fit_packed(packed: Packed, points: Sequence[Mapping[str, float]], folds: int):
    """The same over packed blocks."""
    start = None
    if packed.rows >= WARM_ROWS:
        few = [part for block in first_blocks(packed, 1, "fold", "rows", "v", "x") for part in _parts(*block)]
        start, _ = _solve(lambda of_block: _added(few, of_block), points, folds)
    blocks = packed.dealt("fold", "rows", "v", "x")
    return _solve(lambda of_block: _summed(blocks, of_block), points, folds, start)


def _solve(
    summed: Callable[[Callable], np.ndarray],
    points: Sequence[Mapping[str, float]],
    folds: int,
    start: np.ndarray | None = None,
) -> tuple[np.ndarray, np.ndarray]:
    """Weights and folds left out; ``summed`` adds up over all rows, ``start`` are weights to begin from."""
    problems = [(point, fold) for point in points for fold in range(folds)]
    left_out = np.array([fold for _, fold in problems])
    by_fold = summed(_moments(folds))
    width = by_fold.shape[1] // 2
    outside = by_fold.sum(axis=0) - by_fold
    n, mean = outside[:, 0], outside[:, :width] / outside[:, :1]
    variance = (outside[:, width:] / outside[:, :1] - mean**2) * (n / np.maximum(n - 1, 1))[:, None]
    std = np.sqrt(np.maximum(variance, 0))
    # A feature that does not vary keeps a coefficient of zero.
    scale = np.where(std > 1e-12, 1.0 / np.where(std > 1e-12, std, 1.0), 0.0)
    scale[:, 0] = 1.0
    scale, n = scale[left_out].T, n[left_out]
    reg, mix = (np.array([point[name] for point, _ in problems]) for name in PENALTIES)
    absolute, square = reg * mix, reg * (1 - mix)
    i, j = _pairs(width)

    def penalty(w: np.ndarray, of: np.ndarray) -> np.ndarray:
        return absolute[of] * np.abs(w[1:]).sum(axis=0) + square[of] / 2 * (w[1:] ** 2).sum(axis=0)

    w = np.zeros((width, len(problems)))
    if start is not None and np.isfinite(start).all():
        w = np.where(scale > 0, start / np.where(scale > 0, scale, 1.0), 0.0)
    best, best_value, step = w.copy(), np.full(len(problems), np.inf), np.zeros_like(w)
    now = np.arange(len(problems))  # those that have not converged; a pass is about them alone
    for _ in range(MAX_PASSES):
        tried, scaled = w[:, now], scale[:, now]
        sums = summed(_derivatives(tried * scaled, left_out[now]))
        value = sums[0] / n[now] + penalty(tried, now)
        worse = value > best_value[now] + 1e-12
        # Where the step went too far, half of it; the others go on from where they are.
        best_value[now] = np.where(worse, best_value[now], value)
        best[:, now] = np.where(worse, best[:, now], tried)
        gradient = sums[1 : 1 + width] / n[now] * scaled
        hessian = np.zeros((len(now), width, width))
        hessian[:, i, j] = hessian[:, j, i] = (sums[1 + width :] / n[now] * scaled[i] * scaled[j]).T
        newton = _newton(tried, gradient, hessian, absolute[now], square[now]) - tried
        step[:, now] = np.where(worse, step[:, now] / 2, newton)
        w[:, now] = best[:, now] + step[:, now]
        now = now[np.abs(step[:, now]).max(axis=0) >= TOLERANCE]
        if not len(now):
            break
    else:
        _log.warning("%d of %d grid problems have not converged", len(now), len(problems))
    return best * scale, left_out


def _scorer(weights: np.ndarray, left_out: np.ndarray, folds: int, points: int):
    """Margins of a block under every point's fit without the block's fold."""
    own = [np.flatnonzero(left_out == fold) for fold in range(folds)]

    def run(fold: int, v: np.ndarray, x: np.ndarray) -> tuple[int, np.ndarray]:
        fits = weights[:, own[fold]].T
        return fold * points, fits[:, :1] + fits[:, 1:] @ x.reshape(weights.shape[0] - 1, -1)

    return run


def grid_aucs(
    train: DataFrame,
    label: str,
    points: Sequence[Mapping[str, float]],
    folds: int,
    packed: Packed | None = None,
) -> list[float]:
    """Mean validation AUC of each grid point over the folds.

    ``train`` has ``features``, the label and ``fold``; ``packed`` are its rows, where they have been packed
    already. A fold without rows of both classes has no AUC and counts for nothing.
    """
    own = None
    if packed is None:
        rows = train.select(
            vector_to_array("features").alias("x"), F.col(label).cast("int").alias("y"), "fold"
        )
        first = rows.first()
        own = packed = pack(rows, [np.empty(0)] * len(first["x"]), numbers=True) if first else None
    if packed is None:
        raise ValueError("a regression grid takes the labels 0 and 1, and at least one row")
    try:
        weights, left_out = _fit_packed(packed, points, folds)
        found = ranks.aucs(packed, _scorer(weights, left_out, folds, len(points)), folds * len(points), True)
    finally:
        if own:
            own.release()
    return ranks.fold_means(found, len(points), folds)
