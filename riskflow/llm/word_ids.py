"""Ids of whole texts under a tokenizer file of the tokenizers library.

The result is binary, each id an unsigned 32-bit integer, little-endian. Null and empty texts
have no ids. Texts are cut at ASCII blanks where the tokenizer drops white space before it
merges; each distinct word is encoded once while a worker remembers it.
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

from riskflow.llm import memory
from riskflow.llm.latin import LETTERS, SIGNS, Cache, byte_level, packed
from riskflow.llm.token_counts import load

# Distinct words, and runs of letters or signs in them, that a Python worker remembers, and
# the longest that it does.
MEMORY_WORDS, MEMORY_PARTS = 400_000, 400_000
MEMORY_CHARS = 48

# Signs before a word, the word, signs after it; none can open a contraction or, without
# angle brackets, spell a special token.
_SAFE_SIGNS = SIGNS.replace("\\<", "").replace("\\>", "")
_PLAIN = re.compile(rf"([{_SAFE_SIGNS}]+)?([{LETTERS}]+)([{_SAFE_SIGNS}]+)?")


def drops_blanks(tokenizer: Tokenizer) -> bool:
    """Whether words between ASCII blanks encode independently of each other: white space is
    removed before merging, and no added token reaches over it."""
    spec = json.loads(tokenizer.to_str())
    normalizer = spec["normalizer"] or {"type": "Sequence", "normalizers": []}
    parts = normalizer.get("normalizers", [normalizer])
    pre = spec["pre_tokenizer"] or {}
    first = (pre.get("pretokenizers") or [pre])[0]
    return (
        all(
            part["type"] in ("NFC", "Lowercase")
            or part["type"] == "Replace"
            and part["pattern"] == {"Regex": r"\s+"}
            and part["content"] == " "
            for part in parts
        )
        and first.get("type") == "Split"
        and first["behavior"] == "Removed"
        and first["invert"]
        and first["pattern"]["Regex"].endswith(r"|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")
        and not any(
            token["single_word"] or token["lstrip"] or token["rstrip"]
            or re.search(r"\s", token["content"])
            or not re.search("[<>]", token["content"])
            for token in spec["added_tokens"]
        )
    )


def _lowers(tokenizer: Tokenizer) -> bool:
    return '"Lowercase"' in tokenizer.to_str().split('"model"')[0]


class _PartIds(Cache):
    """Ids by run of letters or signs, which is one pre-token."""

    def __init__(self, tokenizer: Tokenizer):
        super().__init__(MEMORY_PARTS, MEMORY_CHARS)
        self.tokenize = tokenizer.model.tokenize

    def compute(self, part: str) -> bytes:
        return packed([token.id for token in self.tokenize(byte_level(part))])


class WordIds(Cache):
    """Ids by word, as little-endian bytes."""

    def __init__(self, tokenizer: Tokenizer):
        super().__init__(MEMORY_WORDS, MEMORY_CHARS)
        self.tokenizer = tokenizer
        self.lowers = _lowers(tokenizer)
        self.parts = memory.remember(_PartIds(tokenizer))

    def compute(self, word: str) -> bytes:
        if plain := _PLAIN.fullmatch(word.lower() if self.lowers else word):
            before, letters, after = plain.groups()
            ids = self.parts[letters]
            if before:
                ids = self.parts[before] + ids
            return ids + self.parts[after] if after else ids
        return packed(self.tokenizer.encode(word, add_special_tokens=False).ids)


@lru_cache(maxsize=4)
def word_ids(tokenizer_path: str) -> WordIds:
    return memory.remember(WordIds(load(tokenizer_path)))


def _by_blanks(text: str) -> list[str]:
    return text.replace("\n", " ").replace("\t", " ").replace("\r", " ").split(" ")


def encode_text(text: str | None, tokenizer: Tokenizer, words: WordIds | None) -> bytes:
    if not text:
        return b""
    if words is None:
        ids = tokenizer.encode(text, add_special_tokens=False).ids
        return packed(ids)
    return b"".join(map(words.__getitem__, _by_blanks(text)))


def encode(text: Column, tokenizer_path: str) -> Column:
    """Ids of each whole text, without added special tokens."""

    @F.arrow_udf("binary")
    def ids(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        memory.use("word_ids")
        tokenizer = load(tokenizer_path)
        words = word_ids(tokenizer_path) if drops_blanks(tokenizer) else None
        for batch in batches:
            yield pa.array((encode_text(x.as_py(), tokenizer, words) for x in batch), pa.binary())

    return ids(text)
