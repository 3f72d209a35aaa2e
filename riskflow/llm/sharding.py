"""Shards of bounded size by extendible hashing, in DataFrame operations only.

A directory is indexed by the first bits of a hash. A bucket over the byte limit splits on its
next bit; the others stay as they are, so several slots of the directory lead to one shard. A
shard is named after its bits: ``s`` holds everything, ``s01`` what starts with 01.

The bits are 60 of a digest of the key, then 60 of a hash of the row's number: rows that
share a key, null keys among them, split as well. A document over the limit gets a shard of its
own. Documents without bytes (null or empty) weigh nothing and go with their bits. The sum of
bytes per slot decides; documents move once, when a caller writes them.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskflow.session import materialize

_HALF = 60
_BITS = 2 * _HALF
# Slots of a directory for each shard that the bytes need at least, as a power of two.
_SPARE_BITS = 3
_MOST_BITS_A_ROUND = 26


def _bits(hash_: Column) -> Column:
    return F.lpad(F.bin(hash_), _HALF, "0")


def key_bits(key: Column) -> Column:
    """The first 60 bits of the key's digest, as text."""
    digest = F.md5(F.coalesce(key.cast("string"), F.lit("")).cast("binary"))
    return _bits(F.conv(F.substring(digest, 1, _HALF // 4), 16, 10).cast("long"))


def _row_bits() -> Column:
    return _bits(F.shiftrightunsigned(F.xxhash64(F.monotonically_increasing_id()), 64 - _HALF))


def _directory(rows: DataFrame, base: int, depth: int, limit: int) -> DataFrame:
    """A row per slot of ``depth`` bits: its ``shard`` bits if a bucket of ``base`` to
    ``depth`` bits around it fits, else null."""
    slots = rows.groupBy(F.substring("__bits", 1, depth).alias("slot")).agg(
        F.sum("__bytes").alias("bytes"), F.count(F.lit(1)).alias("n")
    )
    buckets = slots.select(
        "*", F.explode(F.sequence(F.lit(base), F.lit(depth))).alias("depth")
    ).withColumn("bucket", F.expr("substring(slot, 1, depth)"))
    fitting = buckets.groupBy("depth", "bucket").agg(
        F.sum("bytes").alias("shard_bytes"), F.sum("n").alias("shard_docs")
    ).filter((F.col("shard_bytes") <= limit) | (F.col("shard_docs") == 1))
    shortest = (
        buckets.select("slot", "depth", "bucket").join(fitting, ["depth", "bucket"])
        .groupBy("slot")
        .agg(F.min(F.struct("depth", "bucket", "shard_bytes", "shard_docs")).alias("best"))
        .select("slot", "best.*")
    )
    return slots.select("slot", F.col("bytes").alias("slot_bytes")).join(shortest, "slot", "left")


def assign(docs: DataFrame, key: Column, size: Column, limit: int) -> DataFrame:
    """``docs`` with ``shard``, ``depth``, ``shard_bytes`` and ``shard_docs`` (columns by those
    names are replaced). ``size`` is a document's bytes, null for none."""
    if limit < 1:
        raise ValueError("the byte limit must be positive")
    added = ("shard", "depth", "shard_bytes", "shard_docs")
    kept = [c for c in docs.columns if c not in added]
    rows = materialize(
        docs.select(
            *kept,
            F.concat(key_bits(key), _row_bits()).alias("__bits"),
            F.coalesce(size.cast("long"), F.lit(0).cast("long")).alias("__bytes"),
        ),
        "weights",
    )
    most = rows.agg(F.sum("__bytes")).first()[0] or 0
    done, base, left = [], 0, True
    while left:
        needed = math.ceil(math.log2(max(1, most / limit)))
        depth = min(_BITS, base + min(needed + _SPARE_BITS, _MOST_BITS_A_ROUND))
        directory = materialize(_directory(rows, base, depth, limit), "directory")
        slot = F.substring("__bits", 1, depth) == F.col("slot")
        resolved = directory.filter("bucket IS NOT NULL").drop("slot_bytes")
        done.append(
            rows.join(resolved, slot).select(
                *kept, F.concat(F.lit("s"), "bucket").alias("shard"), *added[1:]
            )
        )
        open_slots = directory.filter("bucket IS NULL").select("slot", "slot_bytes")
        most = open_slots.agg(F.max("slot_bytes")).first()[0]
        left = most is not None
        if left:
            rows = materialize(rows.join(open_slots.select("slot"), slot, "left_semi"), "oversized")
            spread = rows.agg(F.countDistinct(F.substring("__bits", 1, _HALF))).first()[0]
            # Rows of one key only differ from the second half on.
            base = max(depth, _HALF) if spread == open_slots.count() else depth
    return reduce(DataFrame.unionByName, done)


def write_shards(assigned: DataFrame, path: str) -> None:
    """One folder of Parquet files per shard."""
    assigned.repartition("shard").write.partitionBy("shard").parquet(path)
