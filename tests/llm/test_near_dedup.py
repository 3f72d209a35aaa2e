"""Operator 3 against all pairs."""

import random
import re

import numpy as np
import pyarrow as pa
import pytest
from conftest import WORDS, sentence
from pyspark.sql import functions as F

from riskflow.llm import near_dedup
from riskflow.llm.queries import QUERIES


def _shingles(text, k):
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lowered)
    if len(words) < k:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + k]) for i in range(len(words) - k + 1)}


def _expected(rows, k):
    """(number of shingles, smallest id reachable) by comparing all pairs."""
    sets = [_shingles(text, k) for _, text in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= 80 * len(sets[i] | sets[j]):
                parent[find(i)] = find(j)
    groups = {}
    for i in range(len(rows)):
        groups.setdefault(find(i), []).append(i)
    result = []
    for i, (doc_id, _) in enumerate(rows):
        ids = [rows[j][0] for j in groups[find(i)] if rows[j][0] is not None]
        result.append((doc_id, len(sets[i]), min(ids, default=None)))
    return sorted(result, key=str)


def _edited(rnd, text, edits):
    words = text.split()
    for _ in range(edits):
        words[rnd.randrange(len(words))] = "edit" + rnd.choice(WORDS)
    return " ".join(words)


def _corpus(seed):
    rnd = random.Random(seed)
    texts = []
    for _ in range(6):
        base = sentence(rnd, rnd.randint(30, 300))
        texts += [base, base.upper()] + [_edited(rnd, base, rnd.randint(0, 8)) for _ in range(14)]
    shared = sentence(rnd, 40)
    texts += [sentence(rnd, 60) + " " + shared for _ in range(20)]
    texts += [sentence(rnd, rnd.randint(1, 6)) for _ in range(40)]
    # A chain: each is near the next, the ends are far apart.
    chain = [f"w{i}" for i in range(100)]
    for i in range(12):
        texts.append(" ".join([*(f"c{j}" for j in range(3 * i)), *chain[3 * i :]]))
    rnd.shuffle(texts)
    return list(enumerate(texts))


@pytest.mark.parametrize("k", [4, 5])
def test_components_by_all_pairs(spark, k):
    rows = _corpus(k)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = near_dedup.near_duplicates(df, shingle=k).collect()
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got), key=str) == _expected(rows, k)
    firsts = [r.component_id for r in got if r.first]
    assert sorted(firsts) == sorted({r.component_id for r in got})


def test_odd_rows(spark, odd_texts):
    rows = list(enumerate(odd_texts)) + [(None, "one two three four five six")] * 2
    rows += [(700, "one two three four five six"), (3, "one two three four five six"), (4, "a b"), (4, "A  b")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    clashing = df.withColumn("node", F.lit("x")).withColumn("signature", F.lit(1))
    got = near_dedup.near_duplicates(clashing, shingle=4).collect()
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got), key=str) == _expected(rows, 4)
    assert near_dedup.near_duplicates(df.limit(0)).count() == 0


def _counted_pairs(spark, monkeypatch, rows):
    compared = []
    linked = near_dedup._linked

    def counted(pairs, *rest):
        compared.append(pairs.count())
        return linked(pairs, *rest)

    monkeypatch.setattr(near_dedup, "_linked", counted)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = near_dedup.near_duplicates(df).collect()
    return sum(compared), sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got), key=str)


def test_large_group_takes_few_pairs(spark, monkeypatch):
    """Copies and near copies: pairs grow with the members, not with their square."""
    rnd = random.Random(9)
    base = sentence(rnd, 400)
    rows = [(i, base) for i in range(300)] + [(300 + i, _edited(rnd, base, 6)) for i in range(300)]
    pairs, got = _counted_pairs(spark, monkeypatch, rows)
    assert {c for *_, c in got} == {0} and pairs < 20 * len(rows)


@pytest.mark.parametrize("block", [16, 1024])
def test_copies_near_and_far_from_the_threshold(spark, monkeypatch, block):
    """Many members a bit too far from all others, in one block and in many."""
    monkeypatch.setattr(near_dedup, "BLOCK", block)
    monkeypatch.setattr(near_dedup, "SET_BLOCK", block)
    rnd = random.Random(8)
    base = sentence(rnd, 150)
    rows = [(i, _edited(rnd, base, rnd.randint(0, 14))) for i in range(160)]
    pairs, got = _counted_pairs(spark, monkeypatch, rows)
    assert got == _expected(rows, 5)
    assert pairs < 160 * 159 / 2 / 4


def test_signatures_estimate_similarity():
    rnd = random.Random(1)
    base = sentence(rnd, 3000)
    a, b = (near_dedup.shingle_set(t, 4) for t in (base, _edited(rnd, base, 100)))
    exact = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
    same = (near_dedup.minima(a) == near_dedup.minima(b)).mean()
    assert abs(same - exact) < 0.15


def test_least_matches_keep_the_chosen_miss_probability():
    steps = near_dedup.least_matches(0.8, 1e-6)
    assert [n for n, _ in steps] == [64, 128, 192, 256]
    assert all(a / n < 0.8 for n, a in steps) and steps[-1][1] / 256 > 0.65
    strict = near_dedup.least_matches(0.8, 0.05)
    assert all(b >= a for (_, a), (_, b) in zip(steps, strict))


def test_query_by_all_pairs(spark, sf_dir):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    got = QUERIES["op3_minhash_near_dedup"](spark, sf_dir).collect()
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got), key=str) == _expected(rows, 4)
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)


def test_batches_beyond_32_bit_offsets():
    batches = [pa.RecordBatch.from_pydict({"a": [1, 2], "b": [b"x", None]}) for _ in range(3)]
    one = near_dedup._one_batch(batches)
    assert one.num_rows == 6 and one.schema.field("b").type == pa.large_binary()
    assert one.column("b").to_pylist() == [b"x", None] * 3
