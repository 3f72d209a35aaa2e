"""Best-fit packing of tokenized documents into sequences of a fixed length.

``cut`` turns id strings into pieces of at most ``capacity`` ids. ``pack`` deals the pieces
to partitions by a hash of their number, packs each by best-fit decreasing and certifies it
with lower bounds from dual feasible functions: a partition with as many sequences as its
bound cannot be improved. The others release their sequences with gaps, and as many of
their sequences with the most pieces; the released pieces exchange partitions and are packed
anew, in fewer partitions each round, as long as that saves sequences.

Only histograms of lengths (``capacity`` rows) and one row of figures per partition are summed
up for the driver. Repeated rows are packed one by one. A document without ids still takes
one place, its end id. An empty table gives no rows.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskflow.session import materialize

CAPACITY = 2048
END_ID = 0
# Pieces that one partition packs in the first round.
ITEMS_PER_PARTITION = 20_000
# Partitions whose released pieces meet in one partition of the next round; as many times the
# pieces of the first round is the most that a partition packs in any.
FAN_IN = 8
MAX_ROUNDS = 6

_ID_BYTES = 4
_DFF_K = 64


def cut(docs: DataFrame, ids: Column, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """``docs`` with one row per piece: ``piece``, ``start``, ``length`` and ``ids``.

    ``ids`` is binary, four bytes an id, little-endian; ``end_id`` is put after each document.
    Null counts as no ids. Columns of ``docs`` by those four names are replaced.
    """
    end = F.lit(int(end_id).to_bytes(_ID_BYTES, "little"))
    kept = [c for c in docs.columns if c not in ("piece", "start", "length", "ids")]
    whole = docs.select(
        *kept, F.concat(F.coalesce(ids, F.lit(b"")), end).alias("__whole")
    )
    width = capacity * _ID_BYTES
    pieces = F.transform(
        F.sequence(F.lit(0), F.expr(f"CAST((octet_length(__whole) - 1) DIV {width} AS INT)")),
        lambda i: F.substring("__whole", i * width + 1, F.lit(width)),
    )
    return whole.select(*kept, F.posexplode(pieces).alias("piece", "ids")).select(
        *kept,
        "piece",
        (F.col("piece").cast("long") * capacity).alias("start"),
        (F.octet_length("ids") / _ID_BYTES).cast("long").alias("length"),
        "ids",
    )


def lower_bound(lengths: np.ndarray, counts: np.ndarray, capacity: int) -> int:
    """Fewest sequences that any packing of these lengths can have, at the least.

    The largest of the bounds by volume, by the functions that round lengths above
    ``capacity - e`` up to a whole sequence and those below ``e`` down to nothing, and by
    those that round down to a multiple of ``1 / k``.
    """
    if not len(lengths):
        return 0
    lengths, counts = lengths.astype(np.int64), counts.astype(np.int64)
    best = -(-int((lengths * counts).sum()) // capacity)
    for e in np.unique(np.minimum(lengths, capacity - lengths)):
        large = lengths > capacity - e
        middle = (lengths >= e) & ~large
        volume = int((lengths * counts)[middle].sum())
        best = max(best, int(counts[large].sum()) + -(-volume // capacity))
    for k in range(1, _DFF_K + 1):
        multiple, rest = np.divmod((k + 1) * lengths, capacity)
        value = np.where(rest == 0, multiple * k, multiple * (k + 1))
        best = max(best, -(-int((value * counts).sum()) // (k * (k + 1))))
    return best


def best_fit_decreasing(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bin and offset of each item, and the gap of each bin."""
    bins = np.empty(len(lengths), dtype=np.int64)
    offsets = np.empty(len(lengths), dtype=np.int64)
    gaps: list[int] = []
    with_gap: list[list[int]] = [[] for _ in range(capacity + 1)]
    occupied = 0  # bit g is set while some bin has gap g
    for i in np.argsort(-lengths, kind="stable").tolist():
        length = int(lengths[i])
        fitting = occupied >> length
        if fitting:
            gap = length + (fitting & -fitting).bit_length() - 1
            bin_ = with_gap[gap].pop()
            if not with_gap[gap]:
                occupied &= ~(1 << gap)
        else:
            gap, bin_ = capacity, len(gaps)
            gaps.append(gap)
        bins[i], offsets[i] = bin_, capacity - gap
        gaps[bin_] = gap - length
        if gap > length:
            with_gap[gap - length].append(bin_)
            occupied |= 1 << (gap - length)
    return bins, offsets, np.asarray(gaps, dtype=np.int64)


def _pack_partition(capacity: int):
    def pack(table: pa.Table) -> pa.Table:
        table = table.sort_by("__item")  # the same rows give the same packing
        lengths = table.column("length").to_numpy()
        items = table.column("__item").to_numpy()
        bins, offsets, gaps = best_fit_decreasing(lengths, capacity)
        released = gaps > 0
        if released.any():
            fullest = np.argsort(-np.bincount(bins, minlength=len(gaps)), kind="stable")
            released[fullest[: max(8, int(released.sum()))]] = True
        first = np.full(len(gaps), np.iinfo(np.int64).max)
        np.minimum.at(first, bins, items)
        bound = lower_bound(*np.unique(lengths, return_counts=True), capacity)
        certified = np.full(len(items), len(gaps) == bound)
        for name, values in (
            ("sequence_id", first[bins]),  # unique, as every item is in one bin
            ("offset", offsets),
            ("__released", released[bins]),
            ("__heads", items == first[bins]),
            ("__certified", certified),
        ):
            table = table.append_column(name, pa.array(values))
        return table

    return pack


@dataclass
class Packing:
    """``rows``: the pieces with ``sequence_id`` and ``offset``; ``sequences``: how many
    there are; ``bound``: how many any packing has at least; ``certified``: those in
    partitions that reach their own bound."""

    rows: DataFrame
    sequences: int
    bound: int
    certified: int


def pack(
    pieces: DataFrame,
    capacity: int = CAPACITY,
    items_per_partition: int = ITEMS_PER_PARTITION,
    max_rounds: int = MAX_ROUNDS,
) -> Packing:
    """Places every piece, by its column ``length`` (1 to ``capacity``).

    Other columns go along unchanged; ``sequence_id`` and ``offset`` are replaced.
    """
    pieces = pieces.drop("sequence_id", "offset").withColumn(
        "__item", F.monotonically_increasing_id()
    )
    pieces = materialize(pieces, "pieces")  # from here on, an item keeps its number
    sizes = pieces.groupBy("length").count().collect()  # at most `capacity` rows
    lengths = np.array([row["length"] for row in sizes], dtype=np.int64)
    counts = np.array([row["count"] for row in sizes], dtype=np.int64)
    bound = lower_bound(lengths, counts, capacity)
    full = int(counts[lengths == capacity].sum())
    certified = full  # a piece that fills a sequence
    whole = pieces.filter(F.col("length") == capacity)
    whole = whole.withColumn("sequence_id", F.col("__item")).withColumn(
        "offset", F.lit(0).cast("long")
    )
    # Only numbers and lengths go through the rounds; what else the pieces have moves once.
    slim, done = ["__item", "length"], []
    waiting = pieces.filter(F.col("length") < capacity).select(slim)
    n_waiting, total, partitions, before = int(counts.sum()) - full, full, 0, None
    for turn in range(max_rounds):
        if not n_waiting:
            break
        room = items_per_partition * (FAN_IN if turn else 1)
        least = -(-n_waiting // room)
        partitions = max(least, partitions // FAN_IN, 1)
        packed = _round(waiting, turn, partitions, capacity)
        kept, released = (packed.filter(F.col("__released") == flag) for flag in (False, True))
        figures = packed.groupBy("__released").agg(
            F.count(F.lit(1)).alias("items"),
            F.sum(F.col("__heads").cast("long")).alias("bins"),
            F.count_if(F.col("__heads") & F.col("__certified")).alias("certified"),
        ).collect()
        by_flag = {row["__released"]: row for row in figures}
        bins = sum(row["bins"] for row in figures)
        if before is not None and bins >= before[1]:
            break  # the exchange saved nothing: the packing before it stands
        total += bins - (before[1] if before else 0)
        certified += sum(row["certified"] for row in figures) - (before[3] if before else 0)
        if before is not None:
            done.append(before[2])
        n_waiting, open_bins, open_certified = (
            (by_flag[True][name] for name in ("items", "bins", "certified")) if True in by_flag else (0, 0, 0)
        )
        before = (released, open_bins, kept, open_certified)
        waiting = released.select(slim)
        if total == bound or partitions == 1:
            break
    if before is not None:
        done += [before[2], before[0]]
    if done:
        places = [part.select("__item", "sequence_id", "offset") for part in done]
        others = pieces.filter(F.col("length") < capacity).join(
            reduce(DataFrame.unionByName, places), "__item"
        )
        whole = whole.unionByName(others)
    return Packing(whole.drop("__item"), total, bound, certified)


def _round(items: DataFrame, turn: int, partitions: int, capacity: int) -> DataFrame:
    dealt = items.withColumn("__part", F.pmod(F.xxhash64("__item", F.lit(turn)), F.lit(partitions)))
    schema = ", ".join(
        [f"`{f.name}` {f.dataType.simpleString()}" for f in dealt.schema.fields]
        + ["sequence_id bigint", "offset bigint"]
        + [f"__{flag} boolean" for flag in ("released", "heads", "certified")]
    )
    packed = dealt.groupBy("__part").applyInArrow(_pack_partition(capacity), schema)
    return materialize(packed.drop("__part"), f"packed-{turn}")


def sequences(rows: DataFrame) -> DataFrame:
    """The sequences themselves, from packed rows that still have ``ids``: their ids in
    order and the lengths of their pieces. A sequence has at most ``capacity`` pieces."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "length", "ids")))
    joined = F.aggregate(parts, F.lit(b""), lambda acc, p: F.concat(acc, p["ids"]))
    return rows.groupBy("sequence_id").agg(
        joined.alias("ids"),
        F.transform(parts, lambda p: p["length"]).alias("lengths"),
    )
