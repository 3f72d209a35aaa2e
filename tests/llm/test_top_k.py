"""Operator 2 against all products."""

import random

import pytest
from compare import connect, differences
from pyspark.sql import functions as F

from riskflow.llm import top_k
from riskflow.llm.oracle import ORACLE
from riskflow.llm.queries import QUERIES

SCHEMA = "vec_id long, embedding array<float>, label string"


def _expected(rows, k, asks):
    scaled = []
    for vec_id, vector, _ in rows:
        if vec_id is None or vector is None or any(x is None or x != x or abs(x) == float("inf") for x in vector):
            continue
        scaled.append((vec_id, [int(1024 * x // 1) for x in vector]))
    found = []
    for i, (query_id, q) in enumerate(scaled):
        if not asks(query_id):
            continue
        scores = [
            (-sum(a * b for a, b in zip(q, v)), vec_id)
            for j, (vec_id, v) in enumerate(scaled) if j != i and len(v) == len(q)
        ]
        found += [(query_id, r, v, -s) for r, (s, v) in enumerate(sorted(scores)[:k], 1)]
    return sorted(found)


def _rows(n, dim, seed, spread):
    rnd = random.Random(seed)
    return [
        (i, [rnd.choice([-1, 0.5, 0.25]) * rnd.random() * rnd.choice(spread) for _ in range(dim)], "x")
        for i in range(n)
    ]


@pytest.mark.parametrize("dim, spread", [(8, [1]), (3, [0.1, 1, 20])])
def test_any_norms(spark, monkeypatch, dim, spread):
    rows = [(i, [float(f"{x:.4f}") for x in v], s) for i, v, s in _rows(400, dim, dim, spread)]
    rows = [(i, [round(x * 1024) / 1024 for x in v], s) for i, v, s in rows]
    df = spark.createDataFrame(rows, SCHEMA).repartition(4)
    vectors = df.select("vec_id", top_k.scaled(F.col("embedding")).alias("v"))
    got = top_k.top_k(vectors, F.col("vec_id") % 7 == 0, 5).collect()
    assert sorted(map(tuple, got)) == _expected(rows, 5, lambda i: i % 7 == 0)


def test_pruning_keeps_every_row_that_counts():
    import numpy as np

    rnd = np.random.default_rng(4)
    for trial in range(200):
        vectors = rnd.normal(size=(60, 4)) * rnd.choice([0.1, 1, 5], size=(60, 1))
        norms = np.sqrt((vectors**2).sum(axis=1))
        order = np.argsort(-norms)
        vectors, norms = vectors[order], norms[order]
        unit = vectors / norms[:, None]
        query = rnd.normal(size=4)
        scores = vectors @ query
        least = float(np.partition(scores, -3)[-3]) * (1 if trial % 2 else 0.99)
        kept = np.zeros(60, dtype=bool)
        kept[top_k._candidates(query, least, vectors, norms, unit)] = True
        assert kept[scores >= least].all()


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, [1.0, 0.5], "a"), (1, [1.0, 0.5], "a"), (2, None, "a"), (3, [1.0, None], "a"),
        (4, [nan, 1.0], "a"), (5, [inf, 1.0], "a"), (6, [0.0, 0.0], "a"), (7, [1.0], "a"),
        (8, [], "a"), (None, [1.0, 1.0], "a"), (9, [-1.0, -0.25], "a"), (0, [1.0, 0.5], "b"),
    ] + [(20 + i, [0.5, 0.5], "tie") for i in range(30)]
    df = spark.createDataFrame(rows, SCHEMA)
    vectors = df.select("vec_id", top_k.scaled(F.col("embedding")).alias("v"), F.lit(1).alias("dim"))
    got = top_k.top_k(vectors, F.col("vec_id").isin(0, 6, 7, 9, 20), 10).collect()
    assert sorted(map(tuple, got)) == _expected(rows, 10, lambda i: i in (0, 6, 7, 9, 20))
    assert top_k.top_k(vectors.limit(0), F.lit(True), 10).count() == 0
    assert top_k.top_k(vectors, F.lit(None).cast("boolean"), 10).count() == 0


def test_query_equals_sql(spark, sf_dir):
    df = QUERIES["op2_norm_bucketed_top_k"](spark, sf_dir)
    assert differences(df, connect(sf_dir), ORACLE["op2_norm_bucketed_top_k"]) == []
