"""Near duplicates by MinHash bands and sequential Bayesian verification.

A document is the set of its distinct shingles of ``shingle`` words. Equal sets are one class from
the start, so copies cost one row. Classes whose signatures agree in a band meet in a
bucket; of buckets with the same members one is kept. Buckets do not emit their pairs: a task
compares the signatures of at most two blocks of a bucket in batches of ``BATCH`` hashes. After each
batch, pairs whose similarity is at or above the threshold with a probability below ``miss``
(uniform prior) are pruned. First, every row hands on a few of its most similar partners, which
are verified on their full sets and connect most of what belongs together. Then the buckets that still
have several components come with their full sets, and each row outside a bucket's largest
component is verified, in the task, against all partners that are not pruned and not yet
connected with it; only links leave the task. So every pair that was not pruned is verified or
connected, and a group of near copies costs rows in proportion to its members: of a bucket of
many blocks each meets the first block only at first, and after that only what is
not yet connected asks.

A link as similar as the threshold shares no band with probability (1 - 0.8 ** 4) ** 32, below
1e-7, and is pruned with probability ``miss``.

Words are runs of characters other than ASCII white space, with A-Z in lower case; shingles
are compared by 64-bit hashes, sets of equal classes by 128-bit digests. With fewer words than a
shingle, the whole sequence is one. Null, empty and blank texts have no shingles and link with
nothing. Rows that repeat an id are rows of their own; rows without an id belong to their
group but never name it.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskflow.llm import memory
from riskflow.llm.components import connected_components
from riskflow.session import materialize

SHINGLE = 5
THRESHOLD = (80, 100)
BANDS, BAND_ROWS = 32, 4
# Hashes of a signature: those of the bands, and as many again for comparisons.
HASHES = 256
BATCH = 64
MISS = 1e-5
# Partners that a row hands on per bucket at first.
FIRST_PARTNERS = 2
# Rows of a block; larger buckets are split, and their blocks meet in pairs. Blocks that
# come with full sets are smaller, and have about so many bytes of them.
BLOCK, SET_BLOCK = 1024, 512
BLOCK_BYTES = 1 << 24

_WORD_MEMORY = 200_000
_CHUNK = 2048
_MIX = np.uint64(0x9E3779B97F4A7C15)  # odd, as multipliers below must be
_SEED = 20_240_501


class _WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        value = xxhash.xxh3_64_intdigest(word)
        if len(word) <= 32:
            if len(self) >= _WORD_MEMORY:
                self.clear()
            self[word] = value
        return value


@lru_cache(maxsize=1)
def _word_hashes() -> _WordHashes:
    return memory.remember(_WordHashes())


@lru_cache(maxsize=1)
def _permutations() -> tuple[np.ndarray, np.ndarray]:
    random = np.random.default_rng(_SEED)
    factors = random.integers(0, 1 << 32, HASHES, dtype=np.uint32) | np.uint32(1)
    return factors[:, None], random.integers(0, 1 << 32, HASHES, dtype=np.uint32)[:, None]


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * _MIX
    return h ^ (h >> np.uint64(29))


def shingle_set(text: str | None, shingle: int) -> np.ndarray:
    """Sorted distinct hashes of the text's shingles."""
    words = text.encode("utf-8", "surrogatepass").lower().split() if text else []
    if not words:
        return np.empty(0, dtype=np.uint64)
    hashes = np.fromiter(map(_word_hashes().__getitem__, words), np.uint64, len(words))
    width = min(shingle, len(words))
    n = len(words) - width + 1
    combined = np.full(n, width, dtype=np.uint64)
    for i in range(width):
        combined = _mixed(combined + hashes[i : i + n])
    return np.unique(combined)


def minima(shingles: np.ndarray) -> np.ndarray:
    """The least value of each of ``HASHES`` permutations."""
    factors, shifts = _permutations()
    small = (shingles ^ (shingles >> np.uint64(32))).astype(np.uint32)[None, :]
    least = np.full(HASHES, np.iinfo(np.uint32).max, dtype=np.uint32)
    for start in range(0, small.shape[1], _CHUNK):
        permuted = small[:, start : start + _CHUNK] * factors
        permuted += shifts
        np.minimum(least, permuted.min(axis=1), out=least)
    return least


def signature(shingles: np.ndarray) -> bytes:
    """A 64-bit value per band, then the low byte of each minimum."""
    least = minima(shingles)
    bands = np.zeros(BANDS, dtype=np.uint64)
    for row in range(BAND_ROWS):
        bands = _mixed(bands + least[row : BANDS * BAND_ROWS : BAND_ROWS].astype(np.uint64))
    return bands.tobytes() + least.astype(np.uint8).tobytes()


def _digest(shingles: np.ndarray) -> bytes:
    return hashlib.blake2b(shingles.tobytes(), digest_size=16).digest()


def _signed(shingle: int):
    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memory.use("near_dedup")
        for batch in batches:
            sizes, keys, signatures = [], [], []
            for text in batch.column("text"):
                own = shingle_set(text.as_py(), shingle)
                sizes.append(len(own))
                keys.append(_digest(own) if len(own) else None)
                signatures.append(signature(own) if len(own) else None)
            yield pa.RecordBatch.from_pydict(
                {
                    "doc_id": batch.column("doc_id"),
                    "text_hash": batch.column("text_hash"),
                    "n_shingles": pa.array(sizes, pa.int64()),
                    "set_key": pa.array(keys, pa.binary()),
                    "signature": pa.array(signatures, pa.binary()),
                }
            )

    return sign


def _shingled(shingle: int):
    def shingles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memory.use("near_dedup")
        for batch in batches:
            sets = [shingle_set(text.as_py(), shingle) for text in batch.column("text")]
            yield pa.RecordBatch.from_pydict(
                {
                    "node": batch.column("node"),
                    "shingles": pa.array([s.tobytes() for s in sets], pa.binary()),
                }
            )

    return shingles


@lru_cache(maxsize=8)
def least_matches(threshold: float, miss: float) -> tuple[tuple[int, int], ...]:
    """After how many hashes, how many must match for a pair to stay.

    Bytes also match by chance, once in 256 times. With a uniform prior and m of n matches,
    the share of matches is Beta(m + 1, n - m + 1); it is at least t with the probability that
    n + 1 trials of chance t succeed at most m times.
    """
    t, found = threshold + (1 - threshold) / 256, []
    for n in range(BATCH, HASHES + 1, BATCH):
        below = 0.0
        for m in range(n + 1):
            below += math.comb(n + 1, m) * t**m * (1 - t) ** (n + 1 - m)
            if below >= miss:
                found.append((n, m))
                break
    return tuple(found)


def _partners(row: int, others: np.ndarray, sketches: np.ndarray, bands: np.ndarray, band: int, steps) -> tuple[np.ndarray, np.ndarray]:
    """Of ``others``, those not pruned against ``row`` whose first common band this is, and
    their matches."""
    matches, start = np.zeros(len(others), dtype=np.int64), 0
    for n, least in steps:
        same = sketches[others, start:n] == sketches[row, start:n]
        matches = matches + same.sum(axis=1)
        kept = matches >= least
        others, matches, start = others[kept], matches[kept], n
    if band and len(others):
        first = ~(bands[others, :band] == bands[row, :band]).any(axis=1)
        others, matches = others[first], matches[first]
    return others, matches


class _Group:
    """Rows of one bucket that came together: two blocks of it, or one."""

    def __init__(self, rows: pa.RecordBatch, steps):
        self.rows, self.steps = rows, steps
        self.band = rows.column("band")[0].as_py()
        raw = np.frombuffer(b"".join(rows.column("signature").to_pylist()), np.uint8)
        raw = raw.reshape(len(rows), 8 * BANDS + HASHES)
        self.bands = raw[:, : 8 * BANDS].copy().view(np.uint64)
        self.sketches = raw[:, 8 * BANDS :]
        self.nodes, self.component, self.salt = (
            rows.column(c).to_numpy() for c in ("node", "component", "salt")
        )
        self.asks = rows.column("asks").to_numpy(zero_copy_only=False)
        self.crossing = rows.column("i")[0].as_py() != rows.column("j")[0].as_py()

    def partners(self, row: int) -> np.ndarray:
        """Rows of other components that are not pruned against ``row``, best first."""
        foreign = self.component != self.component[row]
        if self.crossing:
            foreign &= self.salt != self.salt[row]
        # Of two rows that ask, the one with the smaller number asks for both.
        foreign &= ~self.asks | (self.nodes > self.nodes[row])
        others, matches = _partners(
            row, np.flatnonzero(foreign), self.sketches, self.bands, self.band, self.steps
        )
        return others[np.lexsort((self.nodes[others], -matches))]

    def first_pairs(self) -> list[tuple[int, int]]:
        return [
            (int(self.nodes[row]), int(other))
            for row in np.flatnonzero(self.asks).tolist()
            for other in self.nodes[self.partners(row)[:FIRST_PARTNERS]].tolist()
        ]

    def links(self, threshold: tuple[int, int]) -> list[tuple[int, int]]:
        """Verified pairs that connect components not yet connected here."""
        sets, parent = self.rows.column("shingles"), {}

        def find(x: int) -> int:
            while x in parent:
                x = parent[x]
            return x

        found = []
        for row in np.flatnonzero(self.asks).tolist():
            own = None
            for other in self.partners(row).tolist():
                a, b = find(int(self.component[row])), find(int(self.component[other]))
                if a == b:
                    continue
                own = np.frombuffer(sets[row].as_py(), np.uint64) if own is None else own
                if _are_near(own, np.frombuffer(sets[other].as_py(), np.uint64), threshold):
                    parent[max(a, b)] = min(a, b)
                    found.append((int(self.nodes[row]), int(self.nodes[other])))
        return found


def _in_groups(of_group):
    """Runs ``of_group`` over the rows of each (``band``, ``value``, ``i``, ``j``), which come
    one after the other; gives the pairs that it returns."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memory.use("near_dedup")
        rest = None
        for last, batch in _with_last(batches):
            rows = _one_batch([batch] if rest is None else [rest, batch])
            keys = [rows.column(c).to_numpy() for c in ("band", "value", "i", "j")]
            changed = np.zeros(len(rows) - 1, dtype=bool)
            for key in keys:
                changed |= key[1:] != key[:-1]
            starts = [0, *(np.flatnonzero(changed) + 1).tolist(), len(rows)]
            found: list[tuple[int, int]] = []
            # The last group of a batch may go on in the next one.
            for start, end in zip(starts[: -1 if last else -2], starts[1:]):
                if end - start > 1:
                    found += of_group(rows.slice(start, end - start))
            rest = None if last else rows.slice(starts[-2])
            yield pa.RecordBatch.from_pydict(
                {
                    "a": pa.array([min(f) for f in found], pa.int64()),
                    "b": pa.array([max(f) for f in found], pa.int64()),
                }
            )

    return run


def _one_batch(batches: list[pa.RecordBatch]) -> pa.RecordBatch:
    """All rows in one batch; with 64-bit offsets, as sets together may pass 2 GiB."""
    schema = pa.schema(
        [(f.name, pa.large_binary() if pa.types.is_binary(f.type) else f.type) for f in batches[0].schema]
    )
    table = pa.Table.from_batches([b.cast(schema) for b in batches])
    found = table.combine_chunks().to_batches(max_chunksize=len(table))
    if len(found) != 1:
        raise ValueError(f"{len(table)} rows came in {len(found)} batches")
    return found[0]


def _with_last(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[bool, pa.RecordBatch]]:
    """Non-empty batches, each with whether it is the last."""
    before = None
    for batch in batches:
        if batch.num_rows:
            if before is not None:
                yield False, before
            before = batch
    if before is not None:
        yield True, before


def _are_near(a: np.ndarray, b: np.ndarray, threshold: tuple[int, int]) -> bool:
    part, whole = threshold
    if whole * min(len(a), len(b)) < part * max(len(a), len(b)):
        return False
    both = len(np.intersect1d(a, b, assume_unique=True))
    return whole * both >= part * (len(a) + len(b) - both)


def _verified(threshold: tuple[int, int]):
    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            linked = [
                _are_near(
                    np.frombuffer(a.as_py(), np.uint64), np.frombuffer(b.as_py(), np.uint64), threshold
                )
                for a, b in zip(batch.column("shingles_a"), batch.column("shingles_b"))
            ]
            yield batch.select(["a", "b"]).filter(pa.array(linked, pa.bool_()))

    return verify


def _buckets(classes: DataFrame) -> DataFrame:
    """``band``, ``value``, ``n``, ``bytes`` (of their sets), ``node`` for every band value that several
    classes have.

    Of several buckets with the same members only the one of the first band is kept.
    """
    values = F.array(*(F.xxhash64(F.substring("signature", 1 + 8 * i, 8)) for i in range(BANDS)))
    bands = classes.select("node", "n_shingles", F.posexplode(values).alias("band", "value"))
    shared = bands.groupBy("band", "value").agg(
        F.count(F.lit(1)).alias("n"),
        (F.sum("n_shingles") * 8).alias("bytes"),
        F.min("node").alias("low"),
        F.max("node").alias("high"),
        F.bit_xor(F.xxhash64("node")).alias("members"),
    ).filter("n > 1")
    kept = shared.groupBy("n", "low", "high", "members").agg(
        F.min(F.struct("band", "value")).alias("bucket"), F.first("bytes").alias("bytes")
    ).select("bucket.*", "n", "bytes")
    return bands.drop("n_shingles").join(kept, ["band", "value"])


def _open(members: DataFrame, components: DataFrame) -> DataFrame:
    """Members of buckets that have several components, with their ``component``, whether they
    ask: all but those of the bucket's largest component, and how many do (``n_asks``)."""
    marked = members.join(components, "node", "left").withColumn(
        "component", F.coalesce("component", "node")
    )
    marked = materialize(marked, "members")
    largest = (
        marked.groupBy("band", "value", "component").agg(F.count(F.lit(1)).alias("size"))
        .groupBy("band", "value")
        .agg(
            F.max(F.struct("size", "component"))["component"].alias("main"),
            (F.sum("size") - F.max("size")).alias("n_asks"),
        )
        .filter("n_asks > 0")
    )
    return marked.join(largest, ["band", "value"]).withColumn(
        "asks", F.col("component") != F.col("main")
    ).drop("main")


def _with_first_block(members: DataFrame, signed: DataFrame, block: int) -> DataFrame:
    """Members with what ``signed`` has of their nodes; a bucket of more than ``block`` rows is split, and
    each block meets itself and the bucket's first block. Rows that come along as that first block
    do not ask. So a bucket is copied twice at most, however large it is."""
    columns = ["band", "value", "node", "component"]
    n_blocks = F.ceil(F.col("n") / block).cast("int")
    own = members.withColumn("j", F.pmod(F.xxhash64("node"), n_blocks).cast("int"))
    first = own.filter("j = 0 AND n > %d" % block).withColumn(
        "j", F.explode(F.sequence(F.lit(1), n_blocks - 1))
    )
    met = own.select(*columns, F.lit(True).alias("asks"), "j").union(
        first.select(*columns, F.lit(False).alias("asks"), "j")
    ).withColumns({"salt": F.lit(0), "i": F.col("j")})
    return _dealt(met, signed)


def _dealt(met: DataFrame, signed: DataFrame) -> DataFrame:
    key = ["band", "value", "i", "j"]
    return met.join(signed, "node").repartition(*key).sortWithinPartitions(*key, "node")


def _grouped(members: DataFrame, signed: DataFrame, block: int) -> DataFrame:
    """Members with what ``signed`` has of their nodes, the rows of a bucket after each other.

    A bucket of more than ``block`` rows, or ``BLOCK_BYTES`` of what is compared, is split: blocks of rows
    that ask meet each other and the blocks of the rest, which do not meet among themselves.
    """
    columns = ["band", "value", "node", "component", "asks", "salt"]
    # Rows of a block: as many as fit, of the bucket's mean size.
    fitting = F.greatest(F.lit(1), F.least(F.lit(block), F.floor(F.lit(BLOCK_BYTES) * F.col("n") / F.col("bytes"))))
    members = members.withColumn("block", fitting)
    alone = members.filter("n <= block").withColumn("salt", F.lit(0)).select(
        *columns, F.lit(0).alias("i"), F.lit(0).alias("j")
    )
    asking = F.ceil(F.col("n_asks") / F.col("block")).cast("int")
    others = F.ceil((F.col("n") - F.col("n_asks")) / F.col("block")).cast("int")
    salt = F.when(F.col("asks"), F.pmod(F.xxhash64("node"), asking)).otherwise(
        asking + F.pmod(F.xxhash64("node"), others)
    )
    last = asking - 1 + F.when(F.col("asks"), others).otherwise(0)
    split = (
        members.filter("n > block")
        .withColumn("salt", salt.cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), last)))
        .select(*columns, F.least("salt", "other").alias("i"), F.greatest("salt", "other").alias("j"))
    )
    return _dealt(alone.union(split), signed)


def _linked(pairs: DataFrame, sets: DataFrame, threshold: tuple[int, int]) -> DataFrame:
    """The pairs that full sets confirm."""
    full = pairs
    for side in ("a", "b"):
        full = full.join(
            sets.select(F.col("node").alias(side), F.col("shingles").alias(f"shingles_{side}")), side
        )
    return full.mapInArrow(_verified(threshold), "a long, b long")


def _components(members: DataFrame, classes: DataFrame, sets: DataFrame, miss: float, threshold: tuple[int, int]) -> DataFrame:
    """``node``, ``component`` of all nodes that a link reaches."""
    steps = least_matches(threshold[0] / threshold[1], miss)
    signed = classes.select("node", "signature")
    alone = members.withColumn("component", F.col("node"))
    first = _with_first_block(alone, signed, BLOCK).mapInArrow(
        _in_groups(lambda rows: _Group(rows, steps).first_pairs()), "a long, b long"
    )
    links = materialize(_linked(first.distinct(), sets, threshold), "links")
    components = connected_components(links)
    more = _grouped(_open(members, components), signed.join(sets, "node"), SET_BLOCK).mapInArrow(
        _in_groups(lambda rows: _Group(rows, steps).links(threshold)), "a long, b long"
    )
    more = materialize(more, "links")
    if more.isEmpty():
        return components
    # Stars of the components found first, joined by the further links.
    stars = components.select(F.col("node").alias("a"), F.col("component").alias("b"))
    return connected_components(stars.union(more))


def near_duplicates(
    docs: DataFrame, shingle: int = SHINGLE, threshold: tuple[int, int] = THRESHOLD, miss: float = MISS
) -> DataFrame:
    """``doc_id``, ``text_hash``, ``n_shingles``, ``component_id`` and ``first`` per row of
    ``docs`` (``doc_id``, ``text``).

    ``component_id`` is the smallest id of all documents reachable over links; ``first``
    marks the rows that come first in it, by id (nulls last) and hash of the text.
    """
    texts = docs.select("doc_id", "text", F.xxhash64("text").alias("text_hash"))
    signed = materialize(
        texts.mapInArrow(
            _signed(shingle),
            f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, text_hash long,"
            " n_shingles long, set_key binary, signature binary",
        ),
        "signed",
    )
    key = F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "text_hash")
    classes = signed.filter("set_key IS NOT NULL").groupBy("set_key").agg(
        F.min(key).alias("least"),
        F.first("n_shingles").alias("n_shingles"),
        F.first("signature").alias("signature"),
    )
    classes = materialize(
        classes.withColumn("node", F.monotonically_increasing_id()), "classes"
    )
    members = materialize(_buckets(classes), "members")
    wanted = classes.join(members.select("node").distinct(), "node", "left_semi").select(
        "node", F.col("least.doc_id").alias("w_id"), F.col("least.text_hash").alias("w_hash")
    )
    same = F.col("doc_id").eqNullSafe(F.col("w_id")) & (F.col("text_hash") == F.col("w_hash"))
    chosen = texts.join(wanted, same).select("node", "text").mapInArrow(
        _shingled(shingle), "node long, shingles binary"
    )
    sets = materialize(chosen.dropDuplicates(["node"]), "sets")
    components = _components(members, classes, sets, miss, threshold)
    named = classes.select("set_key", "node", "least")
    named = named.join(components, "node", "left").withColumn(
        "component", F.coalesce("component", "node")
    )
    smallest = named.groupBy("component").agg(F.min("least").alias("head"))
    heads = named.join(smallest, "component").select("set_key", "head")
    rows = signed.drop("signature").join(heads, "set_key", "left")
    return rows.select(
        "doc_id",
        "text_hash",
        "n_shingles",
        F.when(F.col("head").isNull(), F.col("doc_id")).otherwise(F.col("head.doc_id")).alias("component_id"),
        (F.col("head").isNull() | (F.col("head") == key)).alias("first"),
    )
