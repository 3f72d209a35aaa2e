"""Byte-level BPE encoding and decoding with the tiktoken library and a local rank file.

``encode`` and ``decode`` are columns, so they go with any other columns of a
table. Ids travel as binary, each an unsigned 32-bit integer, little-endian.

Null and empty texts have no ids; ids that are null decode to nothing. Long texts
are cut, before encoding, at places where no match of the pattern can reach across. Very long
runs of white space, for which the library's matching runs out of stack, are taken out by their
own rule: all of a run but its last character is one match, or all of it at the end of a text.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import Column
from pyspark.sql import functions as F

# Characters of a text that are encoded at a time.
PIECE_CHARS = 1 << 16

# Characters of white space in a row that are not left to the library's matching.
LONG_RUN = 100_000

# Fixed value: the published splitting pattern of the 50k byte-level vocabularies.
PATTERN = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
)

# Every alternative of such patterns is either white space alone or has white space only
# in front, so a match never goes from a printable character over to a blank. ASCII only:
# there, all libraries agree on what is white space.
_SAFE_CUT = re.compile(r"(?<=[!-~])(?=[ \n])")


# What the library counts as white space.
_SPACES = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
_LONG_RUN = re.compile(rf"[{_SPACES}]{{{LONG_RUN},}}")


@lru_cache(maxsize=4)
def load(ranks_path: str, pattern: str = PATTERN) -> tiktoken.Encoding:
    """The encoding of a rank file; kept for the life of a Python worker."""
    with open(ranks_path, "rb") as file:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}
    return tiktoken.Encoding(
        "local", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}
    )


def safe_pieces(text: str, size: int = PIECE_CHARS) -> Iterator[str]:
    """The text in pieces of about ``size`` characters that encode independently.

    A stretch without any safe cut stays whole, however long it is.
    """
    start = 0
    while len(text) - start > size:
        cut = _SAFE_CUT.search(text, start + size)
        if cut is None:
            break
        yield text[start : cut.start()]
        start = cut.start()
    yield text[start:]


def encode_text(text: str | None, encoding: tiktoken.Encoding) -> bytes:
    if not text:
        return b""
    parts, start = [], 0
    if len(text) >= LONG_RUN and encoding._pat_str == PATTERN:
        for run in _LONG_RUN.finditer(text):
            end = run.end() if run.end() == len(text) else run.end() - 1
            parts += _encoded_pieces(text[start : run.start()], encoding)
            parts.append(encoding._encode_single_piece(text[run.start() : end]))
            start = end
    parts += _encoded_pieces(text[start:], encoding)
    return b"".join(np.asarray(ids, dtype="<u4").tobytes() for ids in parts)


def _encoded_pieces(text: str, encoding: tiktoken.Encoding) -> list[list[int]]:
    return [encoding.encode_ordinary(piece) for piece in safe_pieces(text)]


def decode_ids(ids: bytes | None, encoding: tiktoken.Encoding) -> bytes:
    return encoding.decode_bytes(np.frombuffer(ids, dtype="<u4").tolist()) if ids else b""


def _encoded(texts: pa.Array, encoding: tiktoken.Encoding) -> pa.Array:
    return pa.array((encode_text(x.as_py(), encoding) for x in texts), pa.binary())


def _decoded(ids: pa.Array, encoding: tiktoken.Encoding) -> pa.Array:
    return pa.array((decode_ids(x.as_py(), encoding) for x in ids), pa.binary())


def encode(text: Column, ranks_path: str, pattern: str = PATTERN) -> Column:
    """Ids of each whole text as binary."""

    @F.arrow_udf("binary")
    def ids(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield _encoded(batch, load(ranks_path, pattern))

    return ids(text)


def decode(ids: Column, ranks_path: str, pattern: str = PATTERN) -> Column:
    """The bytes that the ids stand for, which need not be valid UTF-8."""

    @F.arrow_udf("binary")
    def raw(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield _decoded(batch, load(ranks_path, pattern))

    return raw(ids)


def encode_and_decode(text: Column, ranks_path: str, pattern: str = PATTERN) -> Column:
    """Struct of ``ids`` and the bytes ``decoded`` from them, in one pass of one worker."""

    @F.arrow_udf("ids binary, decoded binary")
    def both(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            ids = _encoded(batch, load(ranks_path, pattern))
            decoded = _decoded(ids, load(ranks_path, pattern))
            yield pa.StructArray.from_arrays([ids, decoded], ["ids", "decoded"])

    return both(text)


def id_count(ids: Column) -> Column:
    return F.coalesce(F.octet_length(ids) / 4, F.lit(0)).cast("long")
