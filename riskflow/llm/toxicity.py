"""Toxicity by maximum-scoring segments of token log-odds.

``learn`` counts, in labelled documents, which documents of each class have a word or a word
beginning, and gives each the log-odds between the classes under an informative Dirichlet
prior (all counted documents together), with its standard error. Features that differ
clearly score their log-odds; a word scores as its most certain feature, any other word a small
loss, set so that an average clean text loses. In a text, one pass finds all maximal
segments (no part of which could be left out with gain); extreme-value statistics over the clean
documents say how many segments of a score or more a clean text of that length has by chance. The
segments' evidence together, calibrated on the labelled documents by logistic regression, is the
document's score.

Learning takes at most ``MAX_TRAINING`` labelled rows, those with the smallest hash of their
id; all else goes over all rows and whole texts. A null or empty text has no segments.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskflow.llm import memory
from riskflow.session import materialize

# Labelled rows to learn from; the counts of that many texts are what the driver gets.
MAX_TRAINING = 20_000
# Weight of the prior as a share of all counts.
PRIOR = 0.1
# Standard errors by which a feature's log-odds must differ from none.
MIN_Z = 3.8
# Features kept, by certainty; bounds what every task holds.
MAX_FEATURES = 50_000
PREFIXES = (4, 5, 6)
# Score of a word that tells nothing, as a share of a typical gain.
LOSS = 0.1
# Times that one document counts a feature, at most.
MOST_PER_TEXT = 5
# Expected segments in a clean text of that length, below which one is significant.
MAX_EXPECTED = 0.05

_WORD = re.compile(r"[^\W_]+")


def features_of(word: str) -> list[str]:
    """The word itself and its beginnings, marked by a star."""
    return [word, *(f"{word[:n]}*" for n in PREFIXES if len(word) >= n)]


@dataclass
class Model:
    """``odds``: feature to (log-odds, certainty); ``loss``: score of any other word;
    ``rate`` and ``factor``: of the extreme-value distribution, by which a clean text of n
    words has ``factor * n * exp(-rate * s)`` segments of score s or more; ``slope``,
    ``shift``: of the calibration."""

    odds: dict[str, tuple[float, float]]
    loss: float = -1.0
    rate: float = 1.0
    factor: float = 1.0
    slope: float = 1.0
    shift: float = -2.0
    known: dict[str, float] = field(default_factory=dict)

    def word_score(self, word: str) -> float:
        found = self.known.get(word)
        if found is None:
            own = [self.odds[f] for f in features_of(word) if f in self.odds]
            found = max(own, key=lambda x: x[1])[0] if own else self.loss
            if len(self.known) >= 200_000:
                self.known.clear()
            self.known[word] = found
        return found


def segments(scores: np.ndarray) -> list[tuple[int, int, float]]:
    """All maximal segments ``(start, end, score)`` of positive score, in linear time.

    Runs over the positive scores only; what lies between two of them is summed up before.
    """
    places = np.flatnonzero(scores > 0)
    total = np.concatenate([[0.0], np.cumsum(scores)])
    # Candidates: start, end, sum before it, sum at its end, and the candidate before it whose
    # sum before is smaller.
    found: list[list] = []
    for place in places.tolist():
        one = [place, place + 1, float(total[place]), float(total[place + 1]), -1]
        while True:
            j = len(found) - 1
            while j >= 0 and found[j][2] >= one[2]:
                j = found[j][4]
            if j < 0 or found[j][3] >= one[3]:
                one[4] = j
                found.append(one)
                break
            one = [found[j][0], one[1], found[j][2], one[3], -1]
            del found[j:]
    return [(start, end, after - before) for start, end, before, after, _ in found]


def _lowered(text: str) -> str:
    """In lower case, every character at its own place: one whose lower case is longer stays."""
    lower = text.lower()
    if len(lower) == len(text):
        return lower
    return "".join(low if len(low := char.lower()) == 1 else char for char in text)


def evidence(text: str | None, model: Model) -> tuple[float, list[tuple[int, int, float, float]]]:
    """What a text's significant segments tell, and those segments: start and end in the
    text, score, expected number in a clean text."""
    lowered = _lowered(text) if text else ""
    words = _WORD.findall(lowered)
    scores = np.fromiter(map(model.word_score, words), dtype=float, count=len(words))
    if not (scores > 0).any():
        return 0.0, []
    significant, told = [], 0.0
    for start, end, score in segments(scores):
        log_expected = math.log(model.factor * len(words)) - model.rate * score
        if log_expected < math.log(MAX_EXPECTED):
            told -= log_expected
            significant.append((start, end, score, math.exp(log_expected)))
    if significant:
        ends = [m.span() for m in _WORD.finditer(lowered)]
        significant = [(ends[a][0], ends[b - 1][1], s, e) for a, b, s, e in significant]
    return told, significant


def probability(told: float, model: Model) -> float:
    return 1.0 / (1.0 + math.exp(-min(500.0, max(-500.0, model.slope * math.log1p(told) + model.shift))))


def held_out(doc_id: Column) -> Column:
    """Rows that learning never sees: crc32 of the id as text leaves 1 by 3."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def training_rows(docs: DataFrame, labels: DataFrame, limit: int = MAX_TRAINING) -> DataFrame:
    """``text`` and ``toxic`` of at most ``limit`` labelled documents that are not held out.

    ``copy_a`` and ``copy_b`` mark near copies. A document with several labels is toxic if one
    says so; rows without id or label are left out; of a document's repeated rows the text that is first in order counts.
    """
    chosen = (
        labels.filter("doc_id IS NOT NULL AND toxic IS NOT NULL")
        .filter(~held_out(F.col("doc_id")))
        .groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(limit)
    )
    texts = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    rows = texts.groupBy("doc_id", "toxic").agg(F.min("text").alias("text")).select(
        F.coalesce("text", F.lit("")).alias("text"), F.col("toxic").cast("int").alias("toxic")
    )
    return _with_copy_keys(rows)


def _with_copy_keys(rows: DataFrame) -> DataFrame:
    """Two values that near copies are likely to share: the least hashes of four words."""
    grams = F.transform(
        F.sequence(F.lit(0), F.greatest(F.size("words") - 4, F.lit(0))),
        lambda i: F.xxhash64(*(F.get("words", i + j) for j in range(4))),
    )
    return (
        rows.withColumn("words", F.split(F.lower("text"), r"\s+"))
        .withColumn("grams", grams)
        .withColumn("copy_a", F.array_min("grams"))
        .withColumn("copy_b", F.array_min(F.transform("grams", lambda g: F.xxhash64(g))))
        .drop("words", "grams")
    )


def text_counts(text: str) -> dict[str, int]:
    """How often each feature occurs in a text, up to a bound."""
    found: Counter = Counter()
    for word, n in Counter(_WORD.findall(_lowered(text))).items():
        for feature in features_of(word):
            found[feature] += n
    return {feature: min(n, MOST_PER_TEXT) for feature, n in found.items()}


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    memory.use("toxicity")
    by_class: dict[int, Counter] = {0: Counter(), 1: Counter()}
    for batch in batches:
        for text, toxic in zip(batch.column("text").to_pylist(), batch.column("toxic").to_pylist()):
            by_class[1 if toxic else 0].update(text_counts(text))
    names = list(by_class[0].keys() | by_class[1].keys())
    yield pa.RecordBatch.from_pydict(
        {
            "feature": pa.array(names, pa.string()),
            "clean": pa.array([by_class[0][f] for f in names], pa.int64()),
            "toxic": pa.array([by_class[1][f] for f in names], pa.int64()),
        }
    )


def _odds(counted: DataFrame) -> dict[str, tuple[float, float]]:
    """Features whose log-odds differ clearly, as plain columns over the counts."""
    sums = counted.agg(F.sum("clean").alias("c"), F.sum("toxic").alias("t")).first()
    clean, toxic = float(sums["c"] or 0), float(sums["t"] or 0)
    if not clean or not toxic:
        return {}
    weight = PRIOR * (clean + toxic)
    alpha = weight * (F.col("clean") + F.col("toxic")) / (clean + toxic)
    t, c = F.col("toxic") + alpha, F.col("clean") + alpha
    log_odds = F.log(t / (toxic + weight - t)) - F.log(c / (clean + weight - c))
    z = log_odds / F.sqrt(1 / t + 1 / c)
    kept = counted.select("feature", log_odds.alias("odds"), z.alias("z")).filter(F.abs("z") >= MIN_Z)
    rows = kept.orderBy(F.desc(F.abs("z")), "feature").limit(MAX_FEATURES).collect()
    return {row["feature"]: (row["odds"], abs(row["z"])) for row in rows}


def _clean_histogram(model: Model):
    """Of clean training texts: how often each word score occurs, words that tell nothing
    apart, and the segments' scores."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memory.use("toxicity")
        words: Counter = Counter()
        others = 0
        tops: Counter = Counter()
        for batch in batches:
            for text in batch.column("text").to_pylist():
                scores = np.fromiter(map(model.word_score, _WORD.findall(_lowered(text))), dtype=float)
                tells = scores[scores != model.loss]
                others += len(scores) - len(tells)
                values, counts = np.unique(np.round(tells, 2), return_counts=True)
                words.update(dict(zip(values.tolist(), counts.tolist())))
                tops.update(round(s, 1) for _, _, s in segments(scores))
        rows = [(k, s, n) for k, c in (("word", words), ("segment", tops)) for s, n in c.items()]
        rows.append(("other", 0.0, others))
        yield pa.RecordBatch.from_pydict(
            {
                "kind": pa.array([r[0] for r in rows], pa.string()),
                "score": pa.array([r[1] for r in rows], pa.float64()),
                "n": pa.array([r[2] for r in rows], pa.int64()),
            }
        )

    return count


def _typical_gain(model: Model) -> float:
    gains = [odds for odds, _ in model.odds.values() if odds > 0]
    return float(np.median(gains)) if gains else 1.0


def lowered_loss(model: Model, words: dict[float, int], others: int) -> float:
    """The loss of a word that tells nothing, lowered where clean texts would not lose on average."""
    n_words = sum(words.values()) + others + 1
    mean = (sum(s * n for s, n in words.items()) + model.loss * others + _typical_gain(model)) / n_words
    if mean < -0.01 or not others:
        return model.loss
    return model.loss - (mean + 0.1) * n_words / others


def fit_extreme_values(model: Model, words: dict[float, int], others: int, tops: dict[float, int]) -> None:
    """Rate and factor from the scores of words and segments in clean texts, each with how often it
    occurs, and the number of words that score the loss."""
    typical = _typical_gain(model)
    # One more word, of a typical gain, stands for what clean texts might have but did not.
    values = np.array([*words.keys(), model.loss, typical])
    counts = np.array([*words.values(), others, 1], dtype=float)
    n_words = counts.sum()
    shares = counts / n_words

    def moment(rate: float) -> float:
        return float((shares * np.exp(np.minimum(rate * values, 700))).sum())

    low, high = 0.0, 1.0
    while moment(high) < 1 and high < 1e3:
        high *= 2
    for _ in range(80):
        middle = (low + high) / 2
        low, high = (middle, high) if moment(middle) < 1 else (low, middle)
    model.rate = max(high, 1e-6)
    chance = sum(n for s, n in tops.items() if s >= typical) + 1
    model.factor = chance * math.exp(model.rate * typical) / n_words


def fit_calibration(model: Model, told: np.ndarray, toxic: np.ndarray) -> None:
    """Logistic regression of the label on the log of the evidence, lightly ridged."""
    x = np.column_stack([np.log1p(told), np.ones(len(told))])
    weights, ridge = np.zeros(2), np.diag([1e-2, 1e-6])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ weights, -30, 30)))
        slope = x.T @ (toxic - p) - ridge @ weights
        curve = (x * (p * (1 - p))[:, None]).T @ x + ridge
        step = np.linalg.solve(curve, slope)
        weights += np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-9:
            break
    model.slope, model.shift = max(float(weights[0]), 0.0), float(weights[1])


def _clean_counts(model: Model, clean: DataFrame) -> tuple[dict[float, int], int, dict[float, int]]:
    counted = (
        clean.mapInArrow(_clean_histogram(model), "kind string, score double, n long")
        .groupBy("kind", "score").agg(F.sum("n").alias("n")).collect()
    )  # scores are rounded, so few
    words, tops = ({r["score"]: r["n"] for r in counted if r["kind"] == k} for k in ("word", "segment"))
    return words, sum(r["n"] for r in counted if r["kind"] == "other"), tops


def _calibrate(model: Model, rows: DataFrame) -> None:
    """Over the training rows, of which there are at most ``MAX_TRAINING``."""

    @F.arrow_udf("double")
    def told(texts: pa.Array) -> pa.Array:
        memory.use("toxicity")
        return pa.array([evidence(x.as_py(), model)[0] for x in texts], pa.float64())

    model.loss = -LOSS * _typical_gain(model)
    clean = rows.filter("toxic = 0").select("text")
    words, others, tops = _clean_counts(model, clean)
    loss = lowered_loss(model, words, others)
    if loss != model.loss:
        # Segments are others under another loss.
        model.loss = loss
        model.known.clear()
        words, others, tops = _clean_counts(model, clean)
    fit_extreme_values(model, words, others, tops)
    found = rows.select(told("text").alias("told"), "toxic").collect()
    fit_calibration(
        model, np.array([r["told"] for r in found]), np.array([float(r["toxic"]) for r in found])
    )


def learn(docs: DataFrame, labels: DataFrame, limit: int = MAX_TRAINING) -> Model:
    """A model from labelled documents; without both classes, one that finds nothing."""
    rows = materialize(training_rows(docs, labels, limit), "labelled")
    # Copies of one text say no more than one of them: what they alone have is no sign of a class.
    single = rows.dropDuplicates(["copy_a", "toxic"]).dropDuplicates(["copy_b", "toxic"])
    counted = single.select("text", "toxic").mapInArrow(_counts, "feature string, clean long, toxic long").groupBy(
        "feature"
    ).agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
    counted = materialize(counted.filter(F.col("clean") + F.col("toxic") > 1), "features")
    model = Model(_odds(counted))
    if model.odds:
        _calibrate(model, rows)
    return model


def score(text: Column, model: Model) -> Column:
    """Struct of ``score`` (0 to 1) and ``passages``: start and end in the text, score,
    expected number by chance."""
    schema = (
        "score double, passages array<struct<start: int, end: int, score: double, expected: double>>"
    )

    @F.pandas_udf(schema)
    def scored(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        memory.use("toxicity")
        for batch in batches:
            found = [evidence(x, model) for x in batch]
            yield pd.DataFrame(
                {
                    "score": [probability(told, model) for told, _ in found],
                    "passages": [
                        [dict(zip(("start", "end", "score", "expected"), p)) for p in passages]
                        for _, passages in found
                    ],
                }
            )

    return scored(text)
