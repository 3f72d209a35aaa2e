"""Exact AUCs of many scores per block of rows, without a row per score.

A task sorts its scores per group, takes equal ones together and cuts them into pieces; a piece meets
its counterparts of all tasks in one place, where ordered pairs are counted. The driver adds up a few
numbers per piece. The cuts only balance the work, any cuts give the same result.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from riskflow.operators.packed import Packed, first_blocks, read

# Scores of a group that meet in one place, about; and scores that a task keeps before it sends them.
PIECE_SCORES, HELD_SCORES = 250_000, 4_000_000
_PIECES = "group int, piece int, scores binary, positives binary, negatives binary"

# (fold, v) or (fold, v, x) of a block -> first group and a row of scores per group from there on
Scorer = Callable[..., tuple[int, np.ndarray]]


def _counted(scores: np.ndarray, positives: np.ndarray, negatives: np.ndarray) -> tuple:
    """Sorted distinct scores with the sums of both counts."""
    order = np.argsort(scores, kind="stable")
    scores, positives, negatives = scores[order], positives[order], negatives[order]
    first = np.flatnonzero(np.concatenate([[True], scores[1:] != scores[:-1]]))
    return scores[first], np.add.reduceat(positives, first), np.add.reduceat(negatives, first)


def _pairs(scores: np.ndarray, positives: np.ndarray, negatives: np.ndarray) -> tuple[float, int, int]:
    """Positives ranked above negatives, ties counted half; positives; negatives."""
    _, up, down = _counted(scores, positives, negatives)
    below = np.cumsum(down) - down
    return float((up * (below + down / 2.0)).sum()), int(up.sum()), int(down.sum())


def _cuts(packed: Packed, scorer: Scorer, groups: int, names: Sequence[str]) -> list[np.ndarray]:
    """Where each group's scores are cut."""
    fold_rows = max((rows for rows, _ in packed.sizes.values()), default=0)
    pieces = -(-fold_rows // PIECE_SCORES)
    if pieces <= 1:
        return [np.empty(0)] * groups
    found: dict[int, list] = {}
    for block in first_blocks(packed, 1, *names):
        first, scores = scorer(*block)
        for i, own in enumerate(scores):
            found.setdefault(first + i, []).append(own)
    shares = np.arange(1, pieces) / pieces
    return [
        np.unique(np.quantile(np.concatenate(found[g]), shares)) if g in found else np.empty(0)
        for g in range(groups)
    ]


def aucs(packed: Packed, scorer: Scorer, groups: int, numbers: bool = False) -> list[float | None]:
    """The AUC of each group; None where it has rows of one class only. NaN scores are left out.
    ``numbers``: the scorer takes the blocks' numbers too."""
    names = ("fold", "v", "x") if numbers else ("fold", "v")
    cuts = _cuts(packed, scorer, groups, names)

    def sent(held: dict[int, list]) -> Iterator[pa.RecordBatch]:
        for group, parts in held.items():
            scores, labels = (np.concatenate(values) for values in zip(*parts))
            known = ~np.isnan(scores)
            scores, labels = scores[known], labels[known].astype(np.int64)
            if not len(scores):
                continue
            scores, up, down = _counted(scores, labels, 1 - labels)
            ends = [0, *np.searchsorted(scores, cuts[group]), len(scores)]
            rows = [(piece, a, b) for piece, (a, b) in enumerate(zip(ends, ends[1:])) if a < b]
            # Counts as narrow as they fit: most scores are one row's.
            narrow = np.uint8 if max(up.max(), down.max()) < 256 else np.int64
            up, down = up.astype(narrow), down.astype(narrow)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([group] * len(rows), pa.int32()),
                    pa.array([piece for piece, _, _ in rows], pa.int32()),
                    *(
                        pa.array([values[a:b].tobytes() for _, a, b in rows], pa.binary())
                        for values in (scores, up, down)
                    ),
                ],
                names=["group", "piece", "scores", "positives", "negatives"],
            )

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = {}, 0
        for block in read(batches, *names):
            first, scores = scorer(*block)
            labels = (block[1][: scores.shape[1]] & 1).astype(np.int8)
            for i, own in enumerate(scores):
                held.setdefault(first + i, []).append((own, labels))
            size += scores.size
            if size >= HELD_SCORES:
                yield from sent(held)
                held, size = {}, 0
        yield from sent(held)

    def counted(piece: pa.Table) -> pa.Table:
        scores = [np.frombuffer(value.as_buffer()) for value in piece.column("scores")]
        counts = [
            np.concatenate(
                [
                    np.frombuffer(value.as_buffer(), np.uint8 if value.as_buffer().size == len(own) else np.int64)
                    for own, value in zip(scores, piece.column(name))
                ]
            ).astype(np.int64)
            for name in ("positives", "negatives")
        ]
        pairs, up, down = _pairs(np.concatenate(scores), *counts)
        return pa.table(
            {
                "group": pa.array([piece.column("group")[0].as_py()], pa.int32()),
                "piece": pa.array([piece.column("piece")[0].as_py()], pa.int32()),
                "pairs": [pairs], "up": [up], "down": [down],
            }
        )

    pieces = packed.columns(*names).mapInArrow(split, _PIECES)
    summed = pieces.groupBy("group", "piece").applyInArrow(
        counted, "group int, piece int, pairs double, up long, down long"
    )
    return _between(summed, groups)


def _between(summed: DataFrame, groups: int) -> list[float | None]:
    of_group: dict[int, list] = {}
    for row in summed.collect():  # a row per group and piece
        of_group.setdefault(row["group"], []).append(row)
    found: list[float | None] = []
    for group in range(groups):
        pairs, up, down = 0.0, 0, 0
        for row in sorted(of_group.get(group, ()), key=lambda r: r["piece"]):
            pairs += row["pairs"] + float(row["up"]) * down
            up, down = up + row["up"], down + row["down"]
        found.append(pairs / (float(up) * float(down)) if up and down else None)
    return found


def fold_means(found: Sequence[float | None], points: int, folds: int) -> list[float]:
    """Per point the mean over the folds, from AUCs by fold and point; a fold that has none counts for
    nothing."""
    means = []
    for point in range(points):
        own = [auc for fold in range(folds) if (auc := found[fold * points + point]) is not None]
        means.append(sum(own) / len(own) if own else 0.0)
    return means
