"""Operator 10: segments by brute force, learning on made-up and given labels."""

import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from conftest import sentence
from pyspark.sql import functions as F

from riskflow.llm import toxicity
from riskflow.llm.queries import QUERIES

BAD = ["vile", "rotten", "scummy", "wretched"]


def _brute(scores):
    """Maximal segments by their definition: the best segment, then left and right of it."""
    if not any(s > 0 for s in scores):
        return []
    sums = np.concatenate([[0.0], np.cumsum(scores)])
    best = None
    for i in range(len(scores)):
        for j in range(i + 1, len(scores) + 1):
            value = sums[j] - sums[i]
            if best is None or value > best[2] + 1e-12 or abs(value - best[2]) <= 1e-12 and j - i < best[1] - best[0]:
                best = (i, j, value)
    i, j, value = best
    right = [(a + j, b + j, s) for a, b, s in _brute(scores[j:])]
    return _brute(scores[:i]) + [best] + right


def test_segments_by_brute_force():
    rnd = random.Random(2)
    for _ in range(300):
        # No ties: no two sums are equal.
        scores = np.array([rnd.choice([-1, -1, 1]) * rnd.random() for _ in range(rnd.randint(0, 25))])
        got = toxicity.segments(scores)
        assert [(a, b) for a, b, _ in got] == [(a, b) for a, b, _ in _brute(scores)]
        assert [s for *_, s in got] == pytest.approx([s for *_, s in _brute(scores)])


def test_segments_in_linear_time():
    scores = np.where(np.arange(200_000) % 3 == 0, 1.0, -0.6)
    assert toxicity.segments(scores)


def _labelled(n, seed):
    rnd = random.Random(seed)
    docs, labels = [], []
    for i in range(n):
        text, toxic = sentence(rnd, rnd.randint(20, 120)), int(rnd.random() < 0.25)
        if toxic:
            words = text.split()
            at = rnd.randrange(len(words))
            words[at:at] = [rnd.choice(BAD) + rnd.choice(["", "est", "ly"]) for _ in range(rnd.randint(2, 5))]
            text = " ".join(words)
        docs.append((i, text))
        labels.append((i, 1, toxic))
    return docs, labels


@pytest.fixture(scope="module")
def made_up(spark):
    docs, labels = _labelled(900, 5)
    odd = [(5000, None), (5001, ""), (5002, " \n"), (5003, "vile " * 20_000), (None, "vile rotten"), (3, "again 3")]
    d = spark.createDataFrame(docs + odd, "doc_id long, text string").repartition(3)
    l = spark.createDataFrame(
        labels + [(0, 1, None), (None, 1, 1), (1, 0, labels[1][2]), (9_999, 1, 1)],
        "doc_id long, quality int, toxic int",
    )
    return d, l, dict((i, t) for i, _, t in labels)


def test_held_out_rows_are_told_apart(spark, made_up):
    docs, labels, truth = made_up
    model = toxicity.learn(docs, labels)
    clashing = docs.withColumn("score", F.lit("x")).withColumn("words", F.lit(1))
    rows = clashing.select(
        "*", toxicity.held_out(F.col("doc_id")).alias("held"), toxicity.score(F.col("text"), model).alias("found")
    ).collect()
    assert len(rows) == docs.count()
    for r in rows:
        assert 0 <= r.found.score <= 1
        if r.doc_id is not None:
            assert r.held == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1)
        for p in r.found.passages:
            assert 0 <= p.start < p.end <= len(r.text) and p.expected < toxicity.MAX_EXPECTED
            assert any(r.text[p.start :].startswith(bad) for bad in BAD)
    own = {r.doc_id: r.found.score for r in rows if r.doc_id in truth and r.text != "again 3" and r.held}
    wrong = [i for i, s in own.items() if (s >= 0.7) != bool(truth[i])]
    assert len(own) > 200 and len(wrong) <= 0.05 * len(own)
    by_id = {r.doc_id: r.found for r in rows}
    assert by_id[5000] == by_id[5001] == by_id[5002] and by_id[5000].score < 0.5
    assert by_id[5003].score >= 0.7


def test_learning_sees_no_held_out_row(spark, made_up):
    docs, labels, _ = made_up
    rows = toxicity.training_rows(docs, labels)
    texts = {r.text for r in rows.collect()}
    held = {r.text for r in docs.filter(toxicity.held_out(F.col("doc_id"))).collect()}
    assert texts and not texts & held
    assert toxicity.training_rows(docs, labels, 50).count() <= 50


def test_one_class_or_no_rows(spark, made_up):
    docs, labels, _ = made_up
    for some in (labels.filter("toxic = 0"), labels.limit(0)):
        model = toxicity.learn(docs, some)
        assert not model.odds
        found = docs.limit(20).select(toxicity.score(F.col("text"), model).alias("f")).collect()
        assert all(r.f.score < 0.7 and not r.f.passages for r in found)
    model = toxicity.learn(docs.limit(0), labels)
    assert docs.limit(0).select(toxicity.score(F.col("text"), model)).count() == 0


def test_query_on_held_out_labels(spark):
    sf_dir = "/root/testdata/sf0.1"
    truth = {r.doc_id: r.toxic for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    rows = [r for r in QUERIES["op10_toxic_passages"](spark, sf_dir).collect() if r.held_out and r.doc_id in truth]
    toxic = [r.predicted for r in rows if truth[r.doc_id]]
    clean = [r.predicted for r in rows if not truth[r.doc_id]]
    # 2,600 labelled rows to learn from; ten times as many find nearly all.
    assert len(toxic) > 50 and sum(toxic) >= 0.85 * len(toxic) and sum(clean) <= 0.01 * len(clean)


def test_loss_is_lowered_until_clean_texts_lose():
    """The words that tell nothing lose more; the features' own odds stay as they are."""
    model = toxicity.Model({"a": (2.0, 9.0), "b": (-0.05, 5.0)}, loss=-0.2)
    words, others = {2.0: 400, -0.05: 100}, 500
    model.loss = toxicity.lowered_loss(model, words, others)
    mean = (2.0 * 400 - 0.05 * 100 + model.loss * others + toxicity._typical_gain(model)) / 1001
    assert mean == pytest.approx(-0.1)
    toxicity.fit_extreme_values(model, words, others, {2.0: 3})
    assert 0.01 < model.rate < 10
    # Unchanged where they lose anyway.
    assert toxicity.lowered_loss(toxicity.Model({"a": (2.0, 9.0)}, loss=-1.0), {2.0: 1}, 900) == -1.0


def test_places_are_those_of_the_text():
    model = toxicity.Model({"bad": (5.0, 9.0)}, loss=-0.1, rate=2.0, factor=0.1)
    for before in ("", "İİİİ ", "ẞΣ "):
        _, found = toxicity.evidence(f"{before}bad BAD bad bad", model)
        start, end, *_ = found[0]
        assert f"{before}bad BAD bad bad"[start:end] == "bad BAD bad bad"


def test_repeated_ids_learn_the_same_text(spark):
    rows = [(i, t) for i in range(40) for t in ("later words", "early words", None)]
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)], "doc_id long, toxic int")
    for n in (1, 5):
        docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(n)
        assert {r.text for r in toxicity.training_rows(docs, labels).collect()} == {"early words"}


def _word_list(text):
    return re.findall(r"[^\W_]+", text.lower())


def test_model_and_scores_recomputed(spark):
    """Odds, extreme values, calibration and scores of a small table, in plain Python."""
    docs, labels = _labelled(300, 9)
    model = toxicity.learn(
        spark.createDataFrame(docs, "doc_id long, text string"),
        spark.createDataFrame(labels, "doc_id long, quality int, toxic int"),
    )
    known = {i: t for i, _, t in labels if zlib.crc32(str(i).encode()) % 3 != 1}
    texts = {i: t for i, t in docs if i in known}
    counts = {0: Counter(), 1: Counter()}
    for i, text in texts.items():
        own = Counter(f for w in _word_list(text) for f in toxicity.features_of(w))
        counts[known[i]].update({f: min(n, toxicity.MOST_PER_TEXT) for f, n in own.items()})
    both = {f: (counts[0][f], counts[1][f]) for f in counts[0] | counts[1] if counts[0][f] + counts[1][f] > 1}
    clean, toxic = (sum(n[k] for n in both.values()) for k in (0, 1))
    weight = toxicity.PRIOR * (clean + toxic)
    odds = {}
    for f, (c, t) in both.items():
        alpha = weight * (c + t) / (clean + toxic)
        c, t = c + alpha, t + alpha
        value = math.log(t / (toxic + weight - t)) - math.log(c / (clean + weight - c))
        z = value / math.sqrt(1 / t + 1 / c)
        if abs(z) >= toxicity.MIN_Z:
            odds[f] = (value, abs(z))
    assert model.odds.keys() == odds.keys() and odds
    for f, pair in odds.items():
        assert model.odds[f] == pytest.approx(pair)

    def word_score(word):
        own = [odds[f] for f in toxicity.features_of(word) if f in odds]
        return max(own, key=lambda x: x[1])[0] if own else model.loss

    gains = sorted(v for v, _ in odds.values() if v > 0)
    typical = float(np.median(gains))
    scores = [word_score(w) for i in texts if not known[i] for w in _word_list(texts[i])]
    # The rate at which e^(rate * score) has mean one over clean words and one word of typical gain.
    mean = np.mean(np.exp(model.rate * np.array([*np.round(scores, 2), typical])))
    assert mean == pytest.approx(1.0, abs=2e-2)
    told, labels_ = [], []
    for i, text in texts.items():
        own = np.array([word_score(w) for w in _word_list(text)])
        sums = 0.0
        for _, _, s in _brute(own):
            expected = math.log(model.factor * len(own)) - model.rate * s
            sums -= expected if expected < math.log(toxicity.MAX_EXPECTED) else 0.0
        told.append(sums)
        labels_.append(known[i])
        assert toxicity.evidence(text, model)[0] == pytest.approx(sums)
    # The calibration is where the ridged likelihood stands still.
    x = np.log1p(np.array(told))
    p = 1 / (1 + np.exp(-(model.slope * x + model.shift)))
    assert (x * (np.array(labels_) - p)).sum() - 1e-2 * model.slope == pytest.approx(0, abs=1e-4)
