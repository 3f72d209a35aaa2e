"""Token counts of whole texts under a byte-level BPE of the tokenizers library.

``whole_tokens`` proves once per vocabulary which of its strings the library encodes
as one token when they stand alone. A text is cut where a printable ASCII character meets
a blank, which no pre-token spans; a cut piece that is such a string counts one. The rest
goes through the library, each distinct piece once while it is remembered.

Null and empty texts count 0. Strings of special tokens inside a text count as the library
counts them by default, as one token each.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from riskflow.llm.latin import LETTERS, SIGNS, Cache, byte_level

# Distinct pieces and pre-tokens that a Python worker remembers, and the longest it does.
MEMORY_PIECES, MEMORY_PRE_TOKENS = 300_000, 600_000
MEMORY_CHARS = 48

_BLANKS = " \t\n\r"
# A piece: blanks and the printable run after them, or blanks at the end of the text.
_PIECES = re.compile(rf"[{_BLANKS}]*[^{_BLANKS}]+|[{_BLANKS}]+")
# A piece of one or two pre-tokens: a word, then signs that neither open a contraction nor
# spell a special token.
_PLAIN = re.compile(rf"( ?[{LETTERS}]+)([{SIGNS.replace(r"\<", "").replace(r"\>", "")}]+)?")
# White space outside _BLANKS: a text with any of it is not cut, as a cut right after it
# would change how a run of white space splits.
OTHER_SPACE = re.compile(
    "[\x0b\x0c\x1c-\x1f\x85\xa0 ᠎ -​    　﻿]"
)


@lru_cache(maxsize=4)
def load(tokenizer_path: str) -> Tokenizer:
    with open(tokenizer_path, encoding="utf-8") as file:
        tokenizer = Tokenizer.from_str(file.read())
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


@lru_cache(maxsize=4)
def whole_tokens(tokenizer_path: str) -> frozenset[str]:
    """Vocabulary strings that form a single piece and encode alone as exactly their own id."""
    tokenizer = load(tokenizer_path)
    vocabulary = tokenizer.get_vocab(with_added_tokens=False)
    ids = list(vocabulary.values())
    texts = [tokenizer.decode([i]) for i in ids]
    encoded = tokenizer.encode_batch_fast(texts, add_special_tokens=False)
    return frozenset(
        text
        for text, i, got in zip(texts, ids, encoded)
        if got.ids == [i]
        and _PIECES.fullmatch(text) is not None
        and not OTHER_SPACE.search(text)
    )


class _PreTokenCounts(Cache):
    """Token counts by pre-token: one for the proven strings, the library's merges for others."""

    def __init__(self, tokenizer: Tokenizer, whole: frozenset[str]):
        super().__init__(MEMORY_PRE_TOKENS, MEMORY_CHARS)
        self.tokenize = tokenizer.model.tokenize
        self.whole = whole

    def compute(self, pre_token: str) -> int:
        return 1 if pre_token in self.whole else len(self.tokenize(byte_level(pre_token)))


class PieceCounts(Cache):
    """Token counts by piece: one for the proven strings, the library's for others."""

    def __init__(self, tokenizer: Tokenizer, whole: frozenset[str]):
        super().__init__(MEMORY_PIECES, MEMORY_CHARS)
        self.tokenizer = tokenizer
        self.whole = whole
        self.pre_tokens = _PreTokenCounts(tokenizer, whole)

    def compute(self, piece: str) -> int:
        if piece in self.whole:
            return 1
        if plain := _PLAIN.fullmatch(piece):
            word, signs = plain.groups()
            return self.pre_tokens[word] + (self.pre_tokens[signs] if signs else 0)
        return len(self.tokenizer.encode(piece, add_special_tokens=False).ids)


@lru_cache(maxsize=4)
def piece_counts(tokenizer_path: str) -> PieceCounts:
    return PieceCounts(load(tokenizer_path), whole_tokens(tokenizer_path))


def splits_by_blanks(tokenizer: Tokenizer) -> bool:
    """Whether pieces are safe: no added token has a blank, looks at its neighbours or lacks
    an angle bracket, no normalizer works across pieces, and the pre-tokenizer is the plain
    byte-level one."""
    spec = json.loads(tokenizer.to_str())
    pre = spec["pre_tokenizer"] or {}
    return (
        spec["normalizer"] is None
        and pre.get("type") == "ByteLevel"
        and pre.get("use_regex", True)
        and not pre.get("add_prefix_space", True)
        and not any(
            token["single_word"] or token["lstrip"] or token["rstrip"]
            or re.search(r"\s", token["content"])
            or not re.search("[<>]", token["content"])
            for token in spec["added_tokens"]
        )
    )


def count_text(text: str | None, tokenizer: Tokenizer, counts: PieceCounts | None) -> int:
    if not text:
        return 0
    if counts is None or OTHER_SPACE.search(text):
        return len(tokenizer.encode(text, add_special_tokens=False).ids)
    return sum(map(counts.__getitem__, _PIECES.findall(text)))


def token_count(text: Column, tokenizer_path: str) -> Column:
    """Number of tokens of each whole text, as the library for the file gives it."""

    @F.arrow_udf("long")
    def count(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        tokenizer = load(tokenizer_path)
        counts = piece_counts(tokenizer_path) if splits_by_blanks(tokenizer) else None
        for batch in batches:
            yield pa.array((count_text(x.as_py(), tokenizer, counts) for x in batch), pa.int64())

    return count(text)
