from __future__ import annotations

import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from conftest import sentence
from riskflow.llm import blocks, ppm, queries


class Plain:
    """The same model symbol by symbol, over dictionaries."""

    def __init__(self, texts, order):
        self.order, self.seen = order, defaultdict(Counter)
        for text in texts:
            for context, symbol in self.steps(text):
                for k in range(order + 1):
                    self.seen[context[order - k :]][symbol] += 1

    def steps(self, text):
        marked = b"\xff" * self.order + ppm.symbols_of(text) + b"\xfe"
        return [(marked[i - self.order : i], marked[i]) for i in range(self.order, len(marked))]

    def probability(self, context, symbol):
        p, excluded = 1.0, set()
        for k in range(self.order, -1, -1):
            here = {s: c for s, c in self.seen.get(context[self.order - k :], {}).items() if s not in excluded}
            total = sum(here.values())
            if not here:
                continue
            if symbol in here:
                return p * (here[symbol] - 0.5) / total
            p *= len(here) / 2 / total
            excluded |= set(here)
        return p / (ppm.SYMBOLS - len(excluded))

    def score(self, text):
        return sum(math.log10(self.probability(*step)) for step in self.steps(text))


def words(text):
    return [*ppm.symbols_of(text).split(), None]


def brute_force(rows, order=ppm.ORDER):
    learned = [t for i, t in rows if i is None or zlib.crc32(str(i).encode()) % 5 != 1]
    plain, counts = Plain(learned, order), Counter(w for t in learned for w in words(t))
    n, v = sum(counts.values()), len(counts)
    found = []
    for i, text in rows:
        own = [counts[w] for w in words(text)]
        base = sum(math.log10((c + 0.5) / (n + 0.5 * (v + 1))) for c in own)
        found.append(((i is not None, i or 0), len(own), sum(c > 0 for c in own), n, base, plain.score(text)))
    return sorted(found)


def answers(spark, rows, folder):
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    docs.withColumn("score", F.lit("clash")).repartition(4).write.parquet(f"{folder}/documents.parquet")
    found = queries.QUERIES["op11_ppm_scores"](spark, str(folder)).collect()
    for row in found:
        out = row["doc_id"] is not None and zlib.crc32(str(row["doc_id"]).encode()) % 5 == 1
        assert row["held_out"] == out
    return sorted(
        ((r["doc_id"] is not None, r["doc_id"] or 0), r["n_tokens"], r["n_known"], r["train_tokens"],
         r["base_score"], r["score"])
        for r in found
    )


def agree(found, expected):
    assert [row[:4] for row in found] == [row[:4] for row in expected]
    for a, b in zip(found, expected):
        assert a[4:] == pytest.approx(b[4:], rel=1e-9)


def test_brute_force(spark, tmp_path, odd_texts):
    rnd = random.Random(3)
    texts = [t if t is None or len(t) < 5_000 else t[:5_000] for t in odd_texts]
    rows = list(enumerate(texts)) + [(100 + i, sentence(rnd, 40)) for i in range(60)]
    rows += [(None, "no id"), (3, "repeated id")] + [(200, "Repeated ROW")] * 3
    agree(answers(spark, rows, tmp_path), brute_force(rows))


@pytest.mark.parametrize("rows", [[], [(1, None)]])
def test_hardly_any_rows(spark, tmp_path, rows):
    agree(answers(spark, rows, tmp_path), brute_force(rows))


def test_without_training_rows(spark):
    docs = spark.createDataFrame([(1, "ab"), (2, "")], "doc_id long, text string")
    rows = {r["doc_id"]: r for r in ppm.score(docs, F.lit(False)).collect()}
    assert rows[1]["score"] == pytest.approx(-3 * math.log10(ppm.SYMBOLS))
    assert (rows[2]["n_tokens"], rows[2]["n_known"], rows[2]["base_score"]) == (1, 0, 0.0)


def test_probabilities_of_a_context_sum_to_one(spark):
    texts = ["abracadabra", "abra bar", "a cad", "", "bra"]
    plain = Plain(texts, 3)
    contexts = [b"\xff\xff\xff", b"abr", b"\xffab", b"zzz", b"zra", b"ra "]
    counted = Counter(int.from_bytes(c + bytes([s])) for t in texts for c, s in plain.steps(t))
    asked = [int.from_bytes(c + bytes([s])) for c in contexts for s in range(255)]
    trie = ppm.Trie(spark.createDataFrame(list(counted.items()), "code long, c long"), 3)
    rows = spark.createDataFrame([(code, counted.get(code)) for code in asked], "code long, c long")
    values = {r["code"]: 10 ** r["value"] for r in trie.log_probabilities(rows).collect()}
    for context in contexts:
        own = [values[int.from_bytes(context + bytes([s]))] for s in range(255)]
        assert own == pytest.approx([plain.probability(context, s) for s in range(255)])
        assert sum(own) == pytest.approx(1.0)


def test_blocks_do_not_change_scores(spark, odd_texts):
    rows = [(i, t) for i, t in enumerate(odd_texts * 3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    learns = F.col("doc_id") % 2 == 0
    large, small = (
        {r["doc_id"]: r for r in ppm.score(docs, learns, block_bytes=size).collect()}
        for size in (1 << 25, 2_000)
    )
    for i, row in large.items():
        assert small[i]["score"] == pytest.approx(row["score"], rel=1e-9)
        assert small[i]["n_known"] == row["n_known"]


def test_long_text_in_slices(monkeypatch):
    text = b"some words and more of them " * 50
    whole = ppm.grams([b"\xff" * 5 + text + b"\xfe"], 5)
    monkeypatch.setattr(ppm, "_CHUNK_BYTES", 100)
    parts = [ppm.grams(marked, 5) for _, marked in ppm.in_chunks([text], 5)]
    assert len(parts) > 10
    assert [c for part in parts for c in part.tolist()] == whole.tolist()


def test_blocks_end_by_bytes():
    batch = pa.RecordBatch.from_pydict({"t": ["a" * n for n in (3, 3, 3, 50, 1, 1)] + [None]})
    sizes = [t.num_rows for t in blocks.split_by_bytes(iter([batch, batch]), "t", 8)]
    assert sizes == [2, 1, 1, 5, 1, 1, 3]
    assert sum(sizes) == 14


def test_held_out_texts_are_likelier_than_by_words(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir.replace('sf0.001', 'sf0.1')}/documents.parquet").select("doc_id", "text")
    crc = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    out = ppm.score(docs, crc % 5 != 1).filter(crc % 5 == 1)
    # Of words that training lacks, the word model does not say which; the trie spells them.
    row = out.agg(F.sum("score").alias("score"), F.sum("base_score").alias("base")).first()
    assert row["score"] > row["base"]


def test_lookup_is_one_access_for_most_codes():
    """Each code has its own value, and few are left to be searched for; codes of either sign."""
    rng = np.random.default_rng(1)
    codes = np.unique(np.concatenate([rng.integers(0, 1 << 48, 50_000), rng.integers(-(1 << 63), 0, 50_000), np.arange(5_000)]))
    values = np.arange(len(codes), dtype=float) - 7
    searched = []

    def search(known, asked):
        searched.append(len(asked))
        return np.searchsorted(known, asked)

    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(ppm, "_search", search)
        order = rng.permutation(len(codes))
        find = ppm.lookup(codes[order], values[order])
        asked = rng.integers(0, len(codes), 300_000)
        assert (find(codes[asked]) == values[asked]).all()
    assert sum(searched) < len(asked) / 20
    assert (ppm.lookup(codes[:1], values[:1])(codes[:1].repeat(3)) == values[0]).all()
    assert len(ppm.lookup(codes[:0], values[:0])(codes[:0])) == 0
