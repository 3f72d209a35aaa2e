"""Training rows as blocks of bytes, packed and persisted once for all passes of tuning.

A block has up to some ten thousand rows of one fold: ``x``, its numbers column by column, compressed, and
``v``, a byte per number that holds the number's bin and, in the lowest bit, the row's label. A pass then
moves few large values instead of every row. The numbers are kept on disk, outside the heap; the bytes, which
are an eighth, in memory where there is room.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskflow.session import find_package

# Rows of a block: as many as fit in so many bytes of numbers, and at most the second number.
BLOCK_BYTES, BLOCK_ROWS = 1 << 22, 1 << 15
# A bin and a label share a byte.
MOST_BINS = 128
_SCHEMA = "id long, fold int, rows int, positives int, others int, v binary, x binary"
_CODEC = "lz4_raw"


@dataclass(frozen=True)
class Packed:
    """The blocks without ``x``, with it if it was asked for, the cuts between the bins of each feature, and
    per fold the rows and positives."""

    blocks: DataFrame
    numbers: DataFrame | None
    cuts: tuple[np.ndarray, ...]
    sizes: Mapping[int, tuple[int, int]]

    def where(self, folds: Sequence[int]) -> Packed:
        """The rows of some folds."""
        sizes = {fold: size for fold, size in self.sizes.items() if fold in set(folds)}
        mine = F.col("fold").isin(*folds)
        numbers = None if self.numbers is None else self.numbers.filter(mine)
        return replace(self, blocks=self.blocks.filter(mine), numbers=numbers, sizes=sizes)

    @property
    def rows(self) -> int:
        return sum(rows for rows, _ in self.sizes.values())

    @property
    def positives(self) -> int:
        return sum(positives for _, positives in self.sizes.values())

    def columns(self, *names: str) -> DataFrame:
        return (self.numbers if "x" in names else self.blocks).select(*names)

    def dealt(self, *names: str) -> DataFrame:
        """Columns of the blocks in about two tasks per core: a task sends its sums once."""
        tasks = 2 * self.blocks.sparkSession.sparkContext.defaultParallelism
        return self.columns(*names).coalesce(tasks)

    def release(self) -> None:
        self.blocks.unpersist()
        if self.numbers is not None:
            self.numbers.unpersist()


def sample_share(rows: int, most_bins: int) -> float:
    """The share of rows that MLlib looks at for the cuts between bins."""
    return min(1.0, max(most_bins * most_bins, 10_000) / max(rows, 1))


def cuts_of(values: np.ndarray, most_bins: int) -> np.ndarray:
    """MLlib's cuts of a continuous feature: between all distinct values, or at even steps of rank."""
    found, counts = np.unique(values, return_counts=True)
    middles = (found[:-1] + found[1:]) / 2.0
    if len(middles) < most_bins:
        return middles
    below, step = np.cumsum(counts), len(values) / most_bins
    cuts, target = [], step
    for i in range(1, len(found)):
        if abs(below[i - 1] - target) < abs(below[i] - target):
            cuts.append(middles[i - 1])
            target += step
    return np.array(cuts)


def pack(rows: DataFrame, cuts: Sequence[np.ndarray], numbers: bool = False) -> Packed | None:
    """``rows`` have ``x`` (array of doubles), ``y`` (0 or 1) and ``fold``; with ``numbers``, ``x`` is kept
    too. None, if some other label is among them."""
    find_package(rows.sparkSession)
    whole = _blocks(rows, cuts, numbers)
    if numbers:
        whole = whole.persist(StorageLevel.DISK_ONLY)
    blocks = whole.drop("x").persist(StorageLevel.MEMORY_AND_DISK)
    # Read once here, so that tunings which begin at the same time do not pack twice.
    sums = blocks.groupBy("fold").agg(*(F.sum(name).alias(name) for name in ("rows", "positives", "others")))
    found = sums.collect()  # a row per fold
    sizes = {row["fold"]: (row["rows"], row["positives"]) for row in found}
    packed = Packed(blocks, whole if numbers else None, tuple(cuts), sizes)
    if any(row["others"] for row in found):
        packed.release()
        return None
    return packed


def _blocks(rows: DataFrame, cuts: Sequence[np.ndarray], numbers: bool) -> DataFrame:
    width = len(cuts)
    most = max(1, min(BLOCK_ROWS, BLOCK_BYTES // (8 * max(width, 1))))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = 0
        held: dict[int, list] = {}
        codec = pa.Codec(_CODEC)

        def packed(fold: int, least: int) -> Iterator[pa.RecordBatch]:
            nonlocal number
            parts = held[fold]
            while parts and sum(len(y) for _, y in parts) >= least:
                x, y = (np.concatenate(values) for values in zip(*parts))
                parts[:] = [(x[most:], y[most:])] if len(y) > most else []
                x, y = np.ascontiguousarray(x[:most].T), y[:most]
                v = np.empty(x.shape, np.uint8)
                for f in range(width):
                    v[f] = np.searchsorted(cuts[f], x[f])
                label = y == 1
                v = (v << 1) | label
                # Names a block and its bags: the same in whichever task a lost one is made again.
                name = hashlib.blake2b(v.tobytes(), digest_size=7, salt=number.to_bytes(8))
                values = (
                    int.from_bytes(name.digest()), fold, len(y), int(label.sum()), int((~np.isin(y, (0, 1))).sum()),
                    v.tobytes(), codec.compress(x.tobytes(), asbytes=True) if numbers else None,
                )
                number += 1
                yield pa.RecordBatch.from_arrays([pa.array([value]) for value in values], names=names)

        names = [item.split()[0] for item in _SCHEMA.split(", ")]
        for batch in batches:
            if not batch.num_rows:
                continue
            y = batch.column("y").to_numpy(zero_copy_only=False).astype(float)
            x = batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(len(y), -1)
            folds = batch.column("fold").to_numpy(zero_copy_only=False)
            for fold in np.unique(folds):
                mine = folds == fold
                held.setdefault(int(fold), []).append((x[mine], y[mine]))
                yield from packed(int(fold), most)
        for fold in sorted(held):
            yield from packed(fold, 1)

    fixed = rows.select("x", F.col("y").cast("double"), F.col("fold").cast("int"))
    return fixed.mapInArrow(_typed(run), _SCHEMA)


def _typed(run):
    """Whole numbers as the schema has them."""
    kinds = pa.schema(
        [("id", pa.int64()), ("fold", pa.int32()), ("rows", pa.int32()), ("positives", pa.int32()),
         ("others", pa.int32()), ("v", pa.binary()), ("x", pa.binary())]
    )
    return lambda batches: (batch.cast(kinds) for batch in run(batches))


def _numbers(x, v: np.ndarray) -> np.ndarray:
    return np.frombuffer(pa.Codec(_CODEC).decompress(x, 8 * len(v)))


def read(batches: Iterator[pa.RecordBatch], *names: str) -> Iterator[tuple]:
    """The named columns of each block, bytes as arrays; ``x`` along with ``v``."""
    for batch in batches:
        for at in range(batch.num_rows):
            found = {name: batch.column(name)[at] for name in names}
            if "v" in found:
                found["v"] = np.frombuffer(found["v"].as_buffer(), np.uint8)
            if "x" in found:
                found["x"] = _numbers(found["x"].as_buffer(), found["v"])
            yield tuple(value if isinstance(value, np.ndarray) else value.as_py() for value in found.values())


def first_blocks(packed: Packed, each: int, *names: str) -> list[tuple]:
    """The named columns of at most ``each`` blocks of every fold: enough to begin from or to cut scores
    at; nothing is decided on them."""
    found = []
    for fold in sorted(packed.sizes):
        taken = packed.columns(*names).filter(F.col("fold") == fold).take(each)
        for row in taken:
            values = row.asDict()
            if "v" in values:
                values["v"] = np.frombuffer(values["v"], np.uint8)
            if "x" in values:
                values["x"] = _numbers(values["x"], values["v"])
            found.append(tuple(values[name] for name in names))
    return found
