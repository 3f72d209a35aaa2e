"""Prediction by partial matching over bytes, learned from a corpus and scored per document.

The model is a trie of byte contexts up to ``ORDER`` long, one table per order, with how often each
symbol followed each context anywhere in the training texts. A text's probability is the product over
its bytes, A-Z lowered, and one end mark. A byte is predicted from the longest context that
training has seen; in one of t occurrences and d distinct symbols, a symbol seen c times has
probability (c - 1/2) / t, and the escape d / 2t (method D) leads to the context one byte shorter,
where the symbols that the longer one has seen are excluded: they count neither in t nor in d.
Below order 0 the symbols left are alike. Before a text there are ``ORDER`` start marks. Start and end marks are bytes that UTF-8
never uses.

Everything a symbol has been seen with in a long context it has been seen with in the shorter ones, so
what is excluded after an escape follows from the longer context alone, and with it
the probability of every symbol in every context: a table of the context's own numbers.

Texts run in blocks (see ``blocks``): a block's distinct byte strings of ``ORDER`` + 1 are its keys. One
aggregate counts them over the corpus, the shorter orders follow from it, strings that
training has not seen are resolved order by order, and each block gets the probabilities of its own
keys back. What is gathered grows with the corpus; no task holds more of it than a block needs.

The words of the texts (between ASCII white space, by 63-bit hashes) are keys too, for the
additive word model that ``score`` reports beside it: negative numbers, as strings are positive.

Null texts count as empty: an end mark alone. Rows with a null or repeated id are rows like any
other. Without training rows all symbols are alike and no word is known.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskflow.llm import blocks
from riskflow.session import materialize

# Bytes of the longest context; with its symbol it has to fit into 56 bits.
ORDER = 5
# Bytes of text in a block.
BLOCK_BYTES = 1 << 24
# Bytes of text whose strings are in memory at once, where they are counted and where they are looked up;
# and words.
_CHUNK_BYTES, _LOOKUP_BYTES, _CHUNK_WORDS = 1 << 21, 1 << 19, 1 << 18
# Chunks' distinct keys that are held before they are added up.
_HELD_PARTS = 6

START, END = 0xFF, 0xFE
# All byte values but the start mark.
SYMBOLS = 255

# Most frequent strings and words that every task of the last step holds, 16 bytes each; the others come
# block by block.
FREQUENT = 1 << 19


def symbols_of(text: str | None) -> bytes:
    """The text as the model reads it, without marks."""
    return text.encode().lower() if text else b""


def grams(marked: list[bytes], order: int) -> np.ndarray:
    """Strings of ``order`` + 1 bytes as numbers, all that are within one of the texts.

    Of several texts each begins with start marks; a string that ends in one reaches from one text
    into the next.
    """
    raw = np.frombuffer(b"".join(marked), np.uint8)
    n = len(raw) - order
    codes = np.zeros(n, dtype=np.int64)
    for i in range(order + 1):
        codes <<= 8
        codes |= raw[i : i + n]
    return codes[raw[order:] != START]


def in_chunks(
    texts: Iterable[bytes], order: int, limit: int | None = None
) -> Iterator[tuple[list[int], list[bytes]]]:
    """Marked texts with their numbers, in chunks of bounded size.

    A longer text comes in slices, each with the context that its first byte has.
    """
    limit = limit or _CHUNK_BYTES
    start, end = bytes([START]) * order, bytes([END])
    numbers, held, size = [], [], 0
    for number, text in enumerate(texts):
        marked = start + text + end
        if held and size + len(marked) > limit:
            yield numbers, held
            numbers, held, size = [], [], 0
        if len(marked) > limit:
            for at in range(0, len(text) + 1, limit):
                yield [number], [marked[at : at + limit + order]]
            continue
        numbers.append(number)
        held.append(marked)
        size += len(marked)
    if held:
        yield numbers, held


def word_codes(text: bytes) -> np.ndarray:
    """Hashes of the words, then that of the end, as negative numbers; no word is empty."""
    words = [*text.split(), b""]
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    return ~(hashes >> np.uint64(1)).view(np.int64)


def _counted(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Codes with counts, summed up over parts."""
    if not parts:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    codes, counts = (np.concatenate(columns) for columns in zip(*parts))
    # The parts are sorted runs, which a stable sort merges.
    by_code = np.argsort(codes, kind="stable")
    codes = codes[by_code]
    first = np.flatnonzero(np.diff(codes, prepend=codes[:1] - 1))
    return codes[first], np.add.reduceat(counts[by_code], first)


def _emit(order: int):
    """A block's strings and words, each with how often the block's training rows have it."""

    def emit(block: pa.Table):
        learns = block.column("learns").to_pylist()
        parts: list[tuple[np.ndarray, np.ndarray]] = []

        def add(codes: np.ndarray, learn: bool) -> None:
            found, counts = np.unique(codes, return_counts=True)
            parts.append((found, counts * learn))
            if len(parts) > _HELD_PARTS:
                parts[:] = [_counted(parts)]

        def texts(learn: bool) -> Iterator[bytes]:
            return (
                symbols_of(text.as_py()) for text, own in zip(block.column("text"), learns) if own == learn
            )

        for learn in (True, False):
            for _, chunk in in_chunks(texts(learn), order):
                add(grams(chunk, order), learn)
            held, size = [], 0
            for text in texts(learn):
                held.append(word_codes(text))
                size += len(held[-1])
                if size > _CHUNK_WORDS:
                    add(np.concatenate(held), learn)
                    held, size = [], 0
            if held:
                add(np.concatenate(held), learn)
        codes, counts = _counted(parts)
        return codes, counts, block

    return emit


# The last ``size`` + 1, and the last ``size``, bytes of a string; the context before its symbol.
_LAST = "code & (shiftleft(1L, 8 * (size + 1)) - 1)"
_SHORTER = "code & (shiftleft(1L, 8 * size) - 1)"
_CONTEXT = "shiftright(code, 8)"


class Trie:
    """``grams`` (``size``, ``code``, ``c``): the strings of ``size`` + 1 bytes and how often training
    has them. ``contexts`` (``size``, ``context``) for sizes from 1: occurrences ``t`` and distinct
    symbols ``d``; ``left`` and ``more``: occurrences and symbols that the context one byte shorter
    has besides this one's symbols. ``t``, ``d``: those of the empty context.

    A join by the string or context one byte shorter meets at most one row per first byte.
    """

    def __init__(self, counted: DataFrame, order: int):
        self.order = order
        sizes = F.explode(F.sequence(F.lit(0), F.lit(order))).alias("size")
        self.grams = materialize(
            counted.select("code", "c", sizes).groupBy("size", F.expr(_LAST).alias("code"))
            .agg(F.sum("c").alias("c")),
            "strings", ["size"],
        )
        root = self.grams.filter("size = 0").agg(F.sum("c").alias("t"), F.count("c").alias("d")).first()
        self.t, self.d = root["t"] or 0, root["d"]
        below = self.grams.selectExpr("size + 1 AS size", "code AS shorter", "c AS below")
        own = self.grams.filter("size > 0").withColumn("shorter", F.expr(_SHORTER)).join(below, ["size", "shorter"])
        contexts = materialize(
            own.groupBy("size", F.expr(_CONTEXT).alias("context")).agg(
                F.sum("c").alias("t"), F.count("c").alias("d"), F.sum("below").alias("excluded")
            ),
            "contexts",
        )
        parents = contexts.selectExpr("size + 1 AS size", "context AS shorter", "t AS parent_t", "d AS parent_d")
        shorter = F.expr("context & (shiftleft(1L, 8 * (size - 1)) - 1)")
        self.contexts = materialize(
            contexts.withColumn("shorter", shorter).join(parents, ["size", "shorter"], "left").selectExpr(
                "size", "context", "t", "d",
                f"coalesce(parent_d, {self.d}) - d AS more",
                f"coalesce(parent_t, {self.t}) - excluded AS left",
            ),
            "contexts",
        )

    def log_probabilities(self, asked: DataFrame) -> DataFrame:
        """``code``, ``c`` and ``value``, the log10 probability of its last byte after the others, of the
        distinct strings ``asked`` (``code``, ``c``: null where training has not seen it)."""
        asked = asked.withColumn("size", F.lit(self.order))
        seen = asked.filter("c IS NOT NULL")
        unseen = materialize(self._with_context(asked.filter("c IS NULL")), "unseen")
        # What the shorter contexts know, once for all strings that end alike.
        sizes = F.explode(F.sequence(F.lit(0), F.lit(self.order - 1))).alias("size")
        ends = unseen.select("code", sizes).select("size", F.expr(_LAST).alias("code")).distinct()
        known = self._with_context(ends.join(self.grams, ["size", "code"], "left"))
        known = materialize(known, "known", ["size"])
        escaped = self._after(unseen, known, self.order)
        return (
            self._with_context(seen).selectExpr("code", "log10((c - 0.5D) / t) AS value", "c")
            .unionByName(escaped.select("code", F.col("fresh").alias("value"), "c"))
        )

    def _with_context(self, strings: DataFrame) -> DataFrame:
        contexts = self.contexts
        own = strings.withColumn("context", F.expr(_CONTEXT))
        return own.join(contexts, ["size", "context"], "left").drop("context")

    def _after(self, strings: DataFrame, known: DataFrame, size: int) -> DataFrame:
        """``code``, ``c``; ``fresh``: log-probability where no longer context was seen; ``after``: what
        follows an escape from its context."""
        if size == 0:
            last = -math.log10(max(SYMBOLS - self.d, 1))
            found = f"log10((c - 0.5D) / {self.t}D)" if self.t else "0D"
            unseen = math.log10(self.d / (2 * self.t)) + last if self.t else last
            return strings.selectExpr(
                "code", "c", f"CASE WHEN c IS NOT NULL THEN {found} ELSE {unseen!r}D END AS fresh",
                f"{last!r}D AS after",
            )
        shorter = self._after(known.filter(F.col("size") == size - 1), known, size - 1)
        shorter = shorter.selectExpr("code AS shorter", "c AS c1", "fresh AS fresh1", "after AS after1")
        own = strings.withColumn("shorter", F.expr(_SHORTER)).join(shorter, "shorter", "left")
        return own.selectExpr(
            "code", "c", "t", "d", "fresh1",
            "CASE WHEN c IS NOT NULL OR t IS NULL THEN NULL"
            " WHEN c1 IS NOT NULL THEN log10((c1 - 0.5D) / left)"
            " WHEN more > 0 THEN log10(0.5D * more / left) + after1 ELSE after1 END AS after",
        ).selectExpr(
            "code", "c",
            "CASE WHEN c IS NOT NULL THEN log10((c - 0.5D) / t) WHEN t IS NULL THEN fresh1"
            " ELSE log10(0.5D * d / t) + after END AS fresh",
            "after",
        )


# An odd number whose product with a code has well mixed upper bits, and tables one after the other.
_MIX, _TABLES = np.uint64(0x9E3779B97F4A7C15), 4
# No code has this value.
_SHARED = np.inf


def _places(codes: np.ndarray, bits: int) -> np.ndarray:
    return ((codes.view(np.uint64) * _MIX) >> np.uint64(64 - bits)).view(np.int64)


def lookup(codes: np.ndarray, values: np.ndarray):
    """A function that gives the values of known codes.

    A table has the value of each code that is alone at its place; those that share one go to the next
    table, with their upper bits mixed anew, and what is left after the last is searched for. That is one
    access for most codes, where a search needs one for every halving.
    """
    tables = []
    while len(codes) and len(tables) < _TABLES:
        bits = max(1, (2 * len(codes) - 1).bit_length())
        places = _places(codes, bits)
        last = np.zeros(1 << bits, np.int32)
        last[places] = numbers = np.arange(len(codes), dtype=np.int32)
        beaten = places[last[places] != numbers]
        del last, numbers
        table = np.full(1 << bits, _SHARED)
        table[places] = values
        table[beaten] = _SHARED
        shared = table[places] == _SHARED
        tables.append((bits, table))
        codes, values = _mixed(codes[shared]), values[shared]
    by_code = np.argsort(codes, kind="stable")
    codes, values = codes[by_code], values[by_code]

    def find(asked: np.ndarray, level: int = 0) -> np.ndarray:
        if level == len(tables):
            return values[_search(codes, asked)]
        bits, table = tables[level]
        found = table[_places(asked, bits)]
        missing = np.flatnonzero(found == _SHARED)
        if len(missing):
            found[missing] = find(_mixed(asked[missing]), level + 1)
        return found

    return find


_search = np.searchsorted


def _mixed(codes: np.ndarray) -> np.ndarray:
    """Other numbers for the codes, one to one."""
    mixed = codes.view(np.uint64) * _MIX
    return (mixed ^ (mixed >> np.uint64(32))).view(np.int64)


def _scored(order: int, n_tokens: int, n_distinct: int, common):
    """Looks up a block's strings and words, also among those ``common`` to all blocks, and sums up
    by text."""

    def prepare(answers: pa.Table):
        find = lookup(
            *(
                np.concatenate([answers.column(c).to_numpy(), shared])
                for c, shared in zip(("code", "value"), common.value)
            )
        )
        del answers

        def apply(rows: pa.Table) -> pa.RecordBatch:
            texts = [symbols_of(text.as_py()) for text in rows.column("text")]
            scores = np.zeros(len(texts))
            for numbers, chunk in in_chunks(texts, order, _LOOKUP_BYTES):
                sizes = np.array([len(marked) - order for marked in chunk])
                logs = find(grams(chunk, order))
                scores[numbers] += np.add.reduceat(logs, np.cumsum(sizes) - sizes)
            words = [word_codes(text) for text in texts]
            sizes = np.array([len(own) for own in words], dtype=np.int64)
            starts = np.cumsum(sizes) - sizes
            c = find(np.concatenate(words))
            logs = np.log10((c + 0.5) / (n_tokens + 0.5 * (n_distinct + 1)))
            return pa.RecordBatch.from_arrays(
                [
                    rows.column("doc_id").combine_chunks(),
                    pa.array(sizes),
                    pa.array(np.add.reduceat((c > 0).astype(np.int64), starts)),
                    pa.array(np.add.reduceat(logs, starts)),
                    pa.array(scores),
                ],
                ["doc_id", "n_tokens", "n_known", "base_score", "score"],
            )

        return apply

    return prepare


def score(
    docs: DataFrame, learns: Column, order: int = ORDER, block_bytes: int = BLOCK_BYTES
) -> DataFrame:
    """Per row of ``docs`` (``doc_id``, ``text``): ``doc_id``, ``n_tokens`` (words and one end), ``n_known``
    (those that training has), ``train_tokens``, ``base_score`` (log10 probability by words, half a
    count added to each and to one unknown) and ``score``, that of the text by the trie. ``learns`` marks
    the training rows.
    """
    spark = docs.sparkSession
    texts = docs.select("doc_id", "text", F.coalesce(learns, F.lit(False)).alias("learns"))
    keys, packed = blocks.in_blocks(texts, "text", block_bytes, _emit(order), "strings")
    counted = keys.groupBy("code").agg(F.sum("n").alias("c"))
    counted = materialize(counted.withColumn("is_word", F.col("code") < 0), "counted", ["is_word"])
    strings, words = counted.filter("NOT is_word").select("code", "c"), counted.filter("is_word")
    trie = Trie(strings.filter("c > 0"), order)
    values = trie.log_probabilities(strings.withColumn("c", F.nullif("c", F.lit(0))))
    totals = words.agg(F.sum("c").alias("n"), F.count_if(F.col("c") > 0).alias("v")).first()
    n_tokens, n_distinct = totals["n"] or 0, totals["v"]
    known = materialize(
        values.unionByName(words.select("code", F.col("c").cast("double").alias("value"), "c")), "known"
    )
    common = blocks.frequent(known, FREQUENT)
    shared = common.select("code", "value").toArrow()
    answers = keys.join(F.broadcast(common.select("code")), "code", "left_anti").join(
        known.select("code", "value"), "code"
    ).select("block", "code", "value")
    shared = spark.sparkContext.broadcast(tuple(shared.column(c).to_numpy() for c in ("code", "value")))
    id_type = docs.schema["doc_id"].dataType.simpleString()
    scored = blocks.finish(
        answers, packed, _scored(order, n_tokens, n_distinct, shared),
        f"doc_id {id_type}, n_tokens long, n_known long, base_score double, score double",
    )
    return scored.withColumn("train_tokens", F.lit(n_tokens).cast("long"))
