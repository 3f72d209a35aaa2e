"""Rows in blocks of bounded size, and what whole-corpus statistics say about a block's keys.

Some operators look up a corpus-wide number for each little part of a text. A row per part and
document would be far more data than the texts, so a task goes over its rows block by block:
``emit`` turns a block into its distinct keys (``code``, ``n``) and its rows, packed.
Statistics are then DataFrame operations over keys, a key of the whole corpus being at most one
row per block, and ``finish`` brings the answers to a block's keys and its packed rows together again
in one task. Blocks end by bytes, so neither step holds more than a block, however the keys
are spread; a single row larger than a block is a block alone.

The most frequent keys are in nearly every block. A bounded number of them may go to all tasks at once
(``frequent``), and only the others by block.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskflow.session import materialize

# Bytes of text that are packed together.
PACK_BYTES = 1 << 22

_SCHEMA = "block long, code long, n long, packed binary"


def split_by_bytes(batches: Iterator[pa.RecordBatch], column: str, limit: int) -> Iterator[pa.Table]:
    """The rows in order, cut wherever a table would go beyond ``limit`` bytes of ``column``."""
    held: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        lengths = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy()
        start = 0
        for row, length in enumerate(lengths.tolist()):
            if size and size + length > limit:
                yield pa.Table.from_batches([*held, batch.slice(start, row - start)])
                held, size, start = [], 0, row
            size += length
        if batch.num_rows > start:
            held.append(batch.slice(start))
    if held:
        yield pa.Table.from_batches(held)


def pack(rows: pa.Table) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, rows.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
        out.write_table(rows)
    return sink.getvalue().to_pybytes()


def unpack(packed: bytes) -> pa.Table:
    return pa.ipc.open_stream(packed).read_all()


def in_blocks(
    docs: DataFrame,
    column: str,
    limit: int,
    emit: Callable[[pa.Table], tuple[np.ndarray, np.ndarray, pa.Table]],
    name: str,
) -> tuple[DataFrame, DataFrame]:
    """(keys: ``block``, ``code``, ``n``; packed rows: ``block``, ``packed``), written once.

    ``emit`` gives, for a block, its codes, their counts and the rows to pack; the packed ones are cut
    by the bytes of their own ``column``.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = TaskContext.get().partitionId() << 32
        for number, block in enumerate(split_by_bytes(batches, column, limit)):
            codes, counts, rows = emit(block)
            for start in range(0, len(codes), _BATCH_KEYS):
                part = slice(start, start + _BATCH_KEYS)
                yield _rows(first + number, codes[part], counts[part])
            for part in split_by_bytes(rows.to_batches(), column, PACK_BYTES):
                yield _rows(first + number, packed=pack(part))
            del block, codes, counts, rows
            pa.default_memory_pool().release_unused()

    # Not parted by it: that would sort all rows.
    stored = materialize(docs.mapInArrow(run, _SCHEMA).withColumn("is_key", F.col("packed").isNull()), name)
    keys = stored.filter("is_key").select("block", "code", "n")
    return keys, stored.filter("NOT is_key").select("block", "packed")


# Keys that go to Spark at a time.
_BATCH_KEYS = 1 << 17


def _rows(block: int, codes=None, counts=None, packed: bytes | None = None) -> pa.RecordBatch:
    n = 1 if codes is None else len(codes)
    return pa.RecordBatch.from_arrays(
        [
            pa.array(np.full(n, block, dtype=np.int64)),
            pa.nulls(n, pa.int64()) if codes is None else pa.array(codes, pa.int64()),
            pa.nulls(n, pa.int64()) if codes is None else pa.array(counts, pa.int64()),
            pa.nulls(n, pa.binary()) if packed is None else pa.array([packed], pa.binary()),
        ],
        ["block", "code", "n", "packed"],
    )


def frequent(counted: DataFrame, most: int) -> DataFrame:
    """The keys of the highest counts ``c``, at most ``most``: all from some count on."""
    # Counts in steps of an eighth of a doubling; few, whatever the corpus.
    steps = counted.filter("c > 0").groupBy(F.floor(8 * F.log2("c")).alias("step")).count().collect()
    least, total = None, 0
    for row in sorted(steps, key=lambda row: -row["step"]):
        total += row["count"]
        if total > most:
            break
        least = row["step"]
    return counted.filter(F.lit(False) if least is None else F.floor(8 * F.log2("c")) >= least)


def finish(
    answers: DataFrame,
    packed: DataFrame,
    prepare: Callable[[pa.Table], Callable[[pa.Table], pa.RecordBatch]],
    schema: str,
) -> DataFrame:
    """What ``prepare(answers of a block)`` makes of the packed rows of that block.

    ``answers`` have ``block``, ``code`` and further columns; a task gets those of a block sorted by
    code, all before its rows.
    """
    further = [f for f in answers.schema.fields if f.name not in ("block", "code")]
    both = answers.withColumn("packed", F.lit(None).cast("binary")).unionByName(
        packed.select(
            "block", F.lit(None).cast("long").alias("code"),
            *(F.lit(None).cast(f.dataType).alias(f.name) for f in further), "packed",
        )
    )
    # Rows have no code and come last.
    order = ["block", F.asc_nulls_last("code")]

    def answers_of(batch: pa.RecordBatch) -> pa.RecordBatch:
        return batch.drop_columns(["block", "packed"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, held, apply = None, [], None
        for batch in batches:
            blocks = batch.column("block").to_numpy()
            is_row = batch.column("packed").is_valid().to_numpy(zero_copy_only=False)
            changes = np.flatnonzero((np.diff(blocks) != 0) | (np.diff(is_row.astype(np.int8)) != 0)) + 1
            edges = [0, *changes.tolist(), batch.num_rows]
            for start, end in zip(edges, edges[1:]):
                if start == end:
                    continue
                if blocks[start] != block:
                    block, held, apply = blocks[start], [answers_of(batch.slice(0, 0))], None
                if not is_row[start]:
                    held.append(answers_of(batch.slice(start, end - start)))
                    continue
                if apply is None:
                    apply, held = prepare(pa.Table.from_batches(held)), []
                for one in batch.column("packed").slice(start, end - start):
                    yield apply(unpack(one.as_py()))

    return both.repartition("block").sortWithinPartitions(*order).mapInArrow(run, schema)
