"""Exact top-k search by inner product over norm buckets.

Vectors are ordered by dimension and length and cut into buckets of at most ``BUCKET_ROWS``. A query needs a threshold: the k-th best
score of a first look at the longest vectors. In a bucket, that threshold and the longest
vector give a least cosine for any row that could still enter: above one, the bucket is skipped;
where it is high, rows whose largest coordinates lie outside the range it allows are skipped; where
it is low, rows that are too short are. What remains is verified by its full product.

Buckets of vectors and blocks of queries are single rows of two tables. Each block goes to
``FAN_OUT`` buckets at a time, by equal keys, and a query's best of each bucket are merged by
Spark. Scores are exact while sums stay below 2**53. Vectors that are null or hold a null or
a non-finite number, and rows without an id, take no part; only vectors of equal dimension are
compared. Rows that repeat an id are rows of their own: a query skips itself alone.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskflow.session import materialize

BUCKET_ROWS = 4096
# Buckets that one copy of a block of queries meets.
FAN_OUT = 16
# Least cosine from which on coordinates prune better than lengths.
COORDINATE_COSINE = 0.6
FOCUS_COORDINATES = 3

_FLOAT, _LONG = "<f8", "<i8"
_SLACK = 1e-9
_PACKED = "dim int, longest double, ids binary, rows binary, vectors binary"


def scaled(embedding: Column, scale: int = 1024) -> Column:
    """floor(scale * x) of each component, as doubles; null if any is null or not finite."""
    bad = F.exists(
        embedding, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    )
    return F.when(
        embedding.isNotNull() & ~bad,
        F.transform(embedding, lambda x: F.floor(x.cast("double") * scale).cast("double")),
    )


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows in the order of dimension and length, as one row per bucket."""
    for batch in batches:
        dims = batch.column("dim").to_numpy()
        ids = batch.column("vec_id").to_numpy().astype(_LONG)
        rows = batch.column("row").to_numpy().astype(_LONG)
        norms = batch.column("norm").to_numpy()
        offsets = np.concatenate([[0], np.cumsum(dims)])
        flat = batch.column("v").flatten().to_numpy().astype(_FLOAT)
        changes = np.flatnonzero(np.diff(dims)) + 1
        for start, end in zip([0, *changes], [*changes, len(dims)]):
            cuts = [*range(start, end, BUCKET_ROWS), end]
            for a, b in zip(cuts, cuts[1:]):
                yield pa.RecordBatch.from_pydict(
                    {
                        "dim": pa.array([dims[a]], pa.int32()),
                        "longest": pa.array([float(norms[a])]),
                        "ids": pa.array([ids[a:b].tobytes()], pa.binary()),
                        "rows": pa.array([rows[a:b].tobytes()], pa.binary()),
                        "vectors": pa.array([flat[offsets[a] : offsets[b]].tobytes()], pa.binary()),
                    }
                )


def _buckets(vectors: DataFrame, name: str) -> DataFrame:
    """Equal lengths are spread by a hash, so ties do not make a range of their own grow."""
    order = [F.col("dim"), F.col("norm").desc(), F.xxhash64("row"), F.col("row")]
    ordered = vectors.repartitionByRange(*order).sortWithinPartitions(*order)
    packed = ordered.mapInArrow(_pack, _PACKED)
    return materialize(packed.withColumn("number", F.monotonically_increasing_id()), name)


def _rows_of(ids: bytes, rows: bytes, vectors: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    ids_ = np.frombuffer(ids, _LONG)
    return ids_, np.frombuffer(rows, _LONG), np.frombuffer(vectors, _FLOAT).reshape(len(ids_), -1)


def _best(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the k best: highest score first, ties by smaller id."""
    places = np.arange(len(scores))
    if len(scores) > k:
        places = np.flatnonzero(scores >= np.partition(scores, -k)[-k])
    return places[np.lexsort((ids[places], -scores[places]))][:k]


def _thresholds(k: int):
    """The k-th best score of each query in its first bucket, or minus infinity."""

    def first_look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for pair in batch.to_pylist():
                _, q_rows, queries = _rows_of(pair["q_ids"], pair["q_rows"], pair["q_vectors"])
                _, rows, vectors = _rows_of(pair["ids"], pair["rows"], pair["vectors"])
                least = np.full(len(queries), -np.inf)
                for i, query in enumerate(queries):
                    scores = (vectors @ query)[rows != q_rows[i]]
                    if len(scores) >= k:
                        least[i] = np.partition(scores, -k)[-k]
                yield pa.RecordBatch.from_pydict(
                    {
                        **{c: pa.array([pair[c]], pa.binary()) for c in ("q_ids", "q_rows", "q_vectors")},
                        "dim": pa.array([pair["dim"]], pa.int32()),
                        "least": pa.array([least.astype(_FLOAT).tobytes()], pa.binary()),
                    }
                )

    return first_look


def _candidates(query: np.ndarray, least: float, vectors: np.ndarray, norms: np.ndarray, unit: np.ndarray) -> np.ndarray | slice:
    """Rows of a bucket, longest first, that may score ``least`` or more."""
    size = float(np.sqrt(query @ query))
    if least <= 0 or not size or not norms[0]:
        return slice(None)
    cosine = least / (size * norms[0])
    if cosine > 1 + _SLACK:
        return slice(0)
    if cosine < COORDINATE_COSINE:
        return slice(int(np.searchsorted(-norms, -least / size * (1 - _SLACK), side="right")))
    cosine = min(cosine, 1.0)
    direction = query / size
    keep = np.ones(len(norms), dtype=bool)
    for f in np.argsort(-np.abs(direction))[:FOCUS_COORDINATES]:
        x = direction[f]
        reach = np.sqrt(max(0.0, (1 - x * x) * (1 - cosine * cosine))) + _SLACK
        if x < cosine:
            keep &= unit[:, f] <= x * cosine + reach
        if x > -cosine:
            keep &= unit[:, f] >= x * cosine - reach
    return np.flatnonzero(keep)


def _search(k: int):
    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for pair in batch.to_pylist():
                q_ids, q_rows, queries = _rows_of(pair["q_ids"], pair["q_rows"], pair["q_vectors"])
                ids, rows, vectors = _rows_of(pair["ids"], pair["rows"], pair["vectors"])
                least = np.frombuffer(pair["least"], _FLOAT)
                norms = np.sqrt((vectors * vectors).sum(axis=1))
                unit = vectors / np.where(norms > 0, norms, 1)[:, None]
                found: list[tuple] = []
                for i, query in enumerate(queries):
                    some = _candidates(query, least[i], vectors, norms, unit)
                    scores, some_ids = vectors[some] @ query, ids[some]
                    others = (rows[some] != q_rows[i]) & (scores >= least[i])
                    scores, some_ids = scores[others], some_ids[others]
                    best = _best(scores, some_ids, k)
                    found.append((np.full(len(best), i), some_ids[best], scores[best]))
                who, vec_ids, scores = (np.concatenate(x) for x in zip(*found))
                yield pa.RecordBatch.from_pydict(
                    {
                        "query_id": pa.array(q_ids[who]),
                        "query_row": pa.array(q_rows[who]),
                        "vec_id": pa.array(vec_ids),
                        "score": pa.array(scores.astype(np.int64)),
                    }
                )

    return search


def top_k(vectors: DataFrame, is_query: Column, k: int = 10) -> DataFrame:
    """``query_id``, ``rank`` (from 1), ``vec_id``, ``score``: the k best other rows for each
    row of ``vectors`` (``vec_id``, ``v``: whole numbers as doubles) where ``is_query`` holds.
    """
    numbered = materialize(
        vectors.filter("vec_id IS NOT NULL AND v IS NOT NULL").select(
            F.col("vec_id").cast("long"), "v",
            F.size("v").alias("dim"),
            F.sqrt(F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x)).alias("norm"),
            F.coalesce(is_query, F.lit(False)).alias("asks"),
            F.monotonically_increasing_id().alias("row"),
        ),
        "vectors",
    )
    buckets = _buckets(numbered, "buckets")
    blocks = _buckets(numbered.filter("asks"), "blocks").select(
        "dim", *(F.col(c).alias(f"q_{c}") for c in ("ids", "rows", "vectors"))
    )
    # A row per dimension: the bucket with the longest vectors.
    first = buckets.groupBy("dim").agg(
        F.min_by(F.struct("ids", "rows", "vectors"), F.struct(-F.col("longest"), "number")).alias("b")
    ).select("dim", "b.*")
    asked = materialize(
        blocks.join(first, "dim").mapInArrow(
            _thresholds(k), "q_ids binary, q_rows binary, q_vectors binary, dim int, least binary"
        ),
        "queries",
    )
    copies = buckets.groupBy("dim").agg(
        F.ceil(F.count(F.lit(1)) / FAN_OUT).cast("int").alias("copies")
    )  # a row per dimension
    spread = buckets.join(copies, "dim").withColumn(
        "copy", F.pmod(F.xxhash64("number"), F.col("copies")).cast("int")
    )
    copied = asked.join(copies, "dim").select(
        *asked.columns, F.explode(F.sequence(F.lit(0), F.col("copies") - 1)).alias("copy")
    )
    pairs = copied.join(spread.drop("copies", "longest", "number"), ["dim", "copy"])
    found = pairs.mapInArrow(
        _search(k), "query_id long, query_row long, vec_id long, score long"
    )
    best = Window.partitionBy("query_row").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score"
    )
