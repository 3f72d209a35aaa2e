"""Alignment of two tokenizers' tokens over the same bytes.

Both tokenizers' cumulative byte ends go into dictionaries from end to index. The ends that both
have, by intersection of the key sets, sorted, slice the two id lists into groups; inside a group no
boundary is shared, so its links (pairs of tokens whose bytes overlap) follow by walking both
slices. ``align`` gives groups and links of a text; ``aligned`` adds, over a table, how often each
pair of ids is linked in the corpus, counted over all links of all texts.

Between a word and the white space behind it neither tokenizer's tokens reach across, provided that
their vocabularies show it; there texts are cut into pieces, and each distinct piece of a block is
aligned once. Texts for which that is not proven are aligned whole.

Texts run in blocks (see ``blocks``): a block's links are numbered by their distinct pairs, a pair of a
block is one row of the corpus-wide count, and a document keeps its links as small numbers
until the counts come back.

Null and empty texts, and texts whose tokens' bytes are not the text with a blank in front
(a tokenizer that normalises them, say), have no tokens: all figures are zero and the groups are
empty. Strings of special tokens inside a text are plain text.
"""

from __future__ import annotations

import hashlib
import json
import re
from array import array
from collections.abc import Callable, Iterable, Iterator, Sequence
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import sentencepiece
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from riskflow.llm import blocks
from riskflow.llm.bpe import PATTERN
from riskflow.llm.latin import byte_values
from riskflow.llm.token_counts import splits_by_blanks

# Bytes of text in a block; its links are held at once.
BLOCK_BYTES = 1 << 24
# Pairs of ids, and groups of several ids, that a Python worker remembers.
MEMORY_PAIRS = 50_000

_SPACE = "▁"

# Characters for which two libraries might differ: outside Latin letters, and white space other than
# blanks and line ends. And white space so long that one of them runs out of stack.
_UNUSUAL = re.compile("[^\t\n\r -\x7e\xa1-\u017f]")
_LONG_RUN = 10_000
_RUN = re.compile(rf"[\t\n\r ]{{{_LONG_RUN}}}")
# White space and the word after it; at the end of a text also the white space there.
_PIECE = re.compile(r"[ \t\n]*[^ \t\n]+(?:[ \t\n]+\Z)?|[ \t\n]+")
# Characters of distinct pieces that are aligned as one text.
_JOINED_CHARS = 1 << 16


def is_usual(text: str) -> bool:
    return not _UNUSUAL.search(text) and not (len(text) > _LONG_RUN and _RUN.search(text))


class ByteLevel:
    """A byte-level vocabulary of the tokenizers library; a blank is put before the text.

    Where the file's merges come in the order of their ids and its pre-tokenizer is the usual one,
    tiktoken gives the same ids from the same entries, and does so for usual texts.
    """

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            content = file.read()
        self.tokenizer = Tokenizer.from_str(content)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.tokenizer.encode_special_tokens = True
        entries = self.tokenizer.get_vocab(with_added_tokens=False)
        ranks = {byte_values(entry): i for entry, i in entries.items()}
        self.bytes = [b""] * self.tokenizer.get_vocab_size()
        for value, i in ranks.items():
            self.bytes[i] = value
        self.fast = None
        if splits_by_blanks(self.tokenizer) and _merges_in_order(content, entries):
            self.fast = tiktoken.Encoding("local", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})

    def encode(self, text: str) -> list[int]:
        text = " " + text
        if self.fast is None or not is_usual(text):
            return self.tokenizer.encode(text, add_special_tokens=False).ids
        return self.fast.encode_ordinary(text)

    def decode(self, ids: list[int]) -> bytes:
        return self.fast.decode_bytes(ids) if self.fast else b"".join(map(self.bytes.__getitem__, ids))

    @property
    def splits_words(self) -> bool:
        """Whether no token of a usual text goes on from a word to the white space behind it."""
        return self.fast is not None


def _merges_in_order(content: str, entries: dict[str, int]) -> bool:
    """Whether a merge's result has the higher id the later the merge comes."""
    pairs = (m.split(" ") if isinstance(m, str) else m for m in json.loads(content)["model"]["merges"])
    ids = [entries["".join(pair)] for pair in pairs]
    return all(x < y for x, y in zip(ids, ids[1:]))


class Pieces:
    """A sentencepiece model, which puts a blank before the text itself."""

    def __init__(self, path: str):
        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.bytes = [
            bytes([int(piece[3:5], 16)]) if self.model.is_byte(i) else piece.replace(_SPACE, " ").encode()
            for i, piece in enumerate(map(self.model.id_to_piece, range(self.model.get_piece_size())))
        ]

        pieces = map(self.model.id_to_piece, range(self.model.get_piece_size()))
        #: Whether no token of a usual text goes on from a word to the white space behind it: none
        #: has a blank after anything else, and none a tab or line feed.
        self.splits_words = not any(
            _SPACE in piece.lstrip(_SPACE) or re.search("[\t\n ]", piece) for piece in pieces
        )

    def encode(self, text: str) -> list[int]:
        return self.model.encode(text, num_threads=1)

    def decode(self, ids: list[int]) -> bytes:
        """The pieces' own bytes; the model's decoding drops the first blank."""
        return b"".join(map(self.bytes.__getitem__, ids))


@lru_cache(maxsize=4)
def load(path: str) -> ByteLevel | Pieces:
    return Pieces(path) if path.endswith(".model") else ByteLevel(path)


@dataclass(frozen=True)
class Alignment:
    """The ids of both, where the groups begin and the last one ends in them, the byte ends of the
    groups, each group as text (``a1,a2|b1,b2``), and, by group, the links as numbers of id pairs."""

    a_ids: list[int]
    b_ids: list[int]
    a_cuts: np.ndarray
    b_cuts: np.ndarray
    ends: list[int]
    written: list[str]
    links: np.ndarray
    of_group: np.ndarray


def expanded(a_ids: Sequence[int], a_sizes: Sequence[int], b_ids: Sequence[int], b_sizes: Sequence[int]) -> list[tuple[int, int]]:
    """Links of one group, from left to right: pairs of ids whose byte ranges overlap.

    ``a_sizes`` and ``b_sizes`` are the tokens' bytes, at least one each.
    """
    x, y, a_end, b_end, links = 0, 0, a_sizes[0], b_sizes[0], []
    while True:
        links.append((a_ids[x], b_ids[y]))
        behind = a_end - b_end
        x, y = x + (behind <= 0), y + (behind >= 0)
        if x == len(a_ids) or y == len(b_ids):
            return links
        a_end += a_sizes[x] if behind <= 0 else 0
        b_end += b_sizes[y] if behind >= 0 else 0


def _numbers(values: Iterable[int]) -> np.ndarray:
    return np.frombuffer(array("q", values), dtype=np.int64)


class _Bounded(dict):
    """Values by key, all forgotten when there are too many."""

    def __init__(self, compute: Callable):
        super().__init__()
        self.compute = compute

    def __missing__(self, key):
        if len(self) >= MEMORY_PAIRS:
            self.clear()
        value = self[key] = self.compute(key)
        return value


class Aligner:
    """Aligns texts under two tokenizer files."""

    def __init__(self, a_path: str, b_path: str):
        self.a, self.b = load(a_path), load(b_path)
        self.a_sizes, self.b_sizes = (
            np.array([len(x) for x in side.bytes], dtype=np.int64) for side in (self.a, self.b)
        )
        self.width = len(self.b.bytes)
        self.pairs = _Bounded(lambda code: f"{code // self.width}|{code % self.width}")
        self.groups = _Bounded(self._group)

    def _group(self, group: tuple[tuple[int, ...], tuple[int, ...]]) -> tuple[str, list[int]]:
        """A group of several tokens as text, and its links."""
        a, b = group
        links = expanded(a, self.a_sizes[list(a)].tolist(), b, self.b_sizes[list(b)].tolist())
        text = f"{','.join(map(str, a))}|{','.join(map(str, b))}"
        return text, [x * self.width + y for x, y in links]

    def tokens(self, text: str | None) -> tuple[list[int], list[int]]:
        """Ids of both, none where either's bytes are not a blank and the text."""
        if not text:
            return [], []
        whole = b" " + text.encode()
        a_ids, b_ids = self.a.encode(text), self.b.encode(text)
        if self.a.decode(a_ids) != whole or self.b.decode(b_ids) != whole:
            return [], []
        return a_ids, b_ids

    def align(self, text: str | None) -> Alignment:
        a_ids, b_ids = self.tokens(text)
        a, b = _numbers(a_ids), _numbers(b_ids)
        # How many tokens have ended at each end.
        a_at = dict(zip(np.cumsum(self.a_sizes[a]).tolist(), range(1, len(a) + 1)))
        b_at = dict(zip(np.cumsum(self.b_sizes[b]).tolist(), range(1, len(b) + 1)))
        # B's ends come in order, so what is in both does.
        common = list(filter(a_at.__contains__, b_at))
        a_cuts = _numbers([0, *map(a_at.__getitem__, common)])
        b_cuts = _numbers([0, *map(b_at.__getitem__, common)])
        first = a[a_cuts[:-1]] * self.width + b[b_cuts[:-1]]
        # Most slices hold one token of each side, which are its link.
        single = (np.diff(a_cuts) == 1) & (np.diff(b_cuts) == 1)
        written = list(map(self.pairs.__getitem__, first.tolist()))
        links, sizes = [], []
        several = np.flatnonzero(~single)
        places = (cuts[several + step].tolist() for cuts in (a_cuts, b_cuts) for step in (0, 1))
        for k, i, next_i, j, next_j in zip(several.tolist(), *places):
            written[k], more = self.groups[tuple(a_ids[i:next_i]), tuple(b_ids[j:next_j])]
            links += more
            sizes.append(len(more))
        all_links = np.concatenate([first[single], _numbers(links)])
        of_group = np.concatenate([np.flatnonzero(single), np.repeat(several, sizes)])
        order = np.argsort(of_group, kind="stable")
        return Alignment(
            a_ids, b_ids, a_cuts, b_cuts, common, written, all_links[order], of_group[order]
        )

    @property
    def splits_words(self) -> bool:
        return self.a.splits_words and self.b.splits_words

    def pieces(self, text: str) -> list[str] | None:
        """The text, a blank in front, in pieces that align on their own; None if that is not sure,
        as it is not with carriage returns, which entries have behind signs."""
        if not self.splits_words or "\r" in text or not is_usual(text):
            return None
        return _PIECE.findall(" " + text)


@lru_cache(maxsize=2)
def aligner(a_path: str, b_path: str) -> Aligner:
    return Aligner(a_path, b_path)


class Measured:
    """Numbers, groups and links of texts or pieces, one after the other."""

    def __init__(self):
        self.figures: list[tuple[int, int, int, int]] = []
        self.written: list[str] = []
        self.links: list[np.ndarray] = []

    def add(self, found: Alignment, ends: list[int] | None = None) -> bool:
        """The whole alignment as one, or as pieces that end at ``ends``, of which the first is left
        out; False if one of them is no common end."""
        if ends is None:
            cuts = [0, len(found.written)]
        else:
            cuts = np.searchsorted(found.ends, ends)
            if len(found.ends) <= cuts[-1] or [found.ends[k] for k in cuts] != ends:
                return False
            cuts = (cuts + 1).tolist()
        by_group = np.searchsorted(found.of_group, cuts).tolist()
        a, b = found.a_cuts[cuts].tolist(), found.b_cuts[cuts].tolist()
        for k in range(len(cuts) - 1):
            links = found.links[by_group[k] : by_group[k + 1]]
            self.links.append(links)
            self.written.append(";".join(found.written[cuts[k] : cuts[k + 1]]))
            self.figures.append((a[k + 1] - a[k], b[k + 1] - b[k], cuts[k + 1] - cuts[k], len(links)))
        return True


def _measured_pieces(work: Aligner, pieces: list[str]) -> Measured | None:
    """Distinct pieces in their order; None if they do not align on their own after all.

    They are aligned in long texts behind a word that is left out; one with white space behind its word
    can only come last.
    """
    found, start = Measured(), 0
    while start < len(pieces):
        end, size = start, 0
        while end < len(pieces) and size < _JOINED_CHARS:
            size += len(pieces[end])
            end += 1
            if pieces[end - 1][-1] in " \t\n":
                break
        text = "a" + "".join(pieces[start:end])
        ends = np.cumsum([2, *(len(piece.encode()) for piece in pieces[start:end])]).tolist()
        if not found.add(work.align(text), ends):
            return None
        start = end
    return found


def measure(work: Aligner, texts: list[str | None]) -> tuple[list, list[str], list[np.ndarray]]:
    """Figures, groups as text and links of each text."""
    index: dict[str, int] = {}
    cut: list[list[int] | None] = []
    for text in texts:
        pieces = work.pieces(text) if text else None
        cut.append(pieces and [index.setdefault(piece, len(index)) for piece in pieces])
    parts = _measured_pieces(work, list(index))
    figures, written, links = [], [], []
    if parts is not None and index:
        sizes = np.array(parts.figures, dtype=np.int64)
        all_links = np.concatenate(parts.links)
        starts = np.cumsum(sizes[:, 3]) - sizes[:, 3]
    for text, own in zip(texts, cut):
        if own and parts is not None:
            figures.append(tuple(sizes[own].sum(axis=0).tolist()))
            written.append(";".join(map(parts.written.__getitem__, own)))
            lengths = sizes[own, 3]
            shift = starts[own] - (np.cumsum(lengths) - lengths)
            links.append(all_links[np.repeat(shift, lengths) + np.arange(lengths.sum())])
        else:
            one = Measured()
            one.add(work.align(text))
            figures += one.figures
            written += one.written
            links += one.links
    return figures, written, links


def _by_frequency(codes: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Places of a block's pairs in the order of their numbers, the most frequent first."""
    return np.lexsort((codes, -counts))


def _emit(a_path: str, b_path: str):
    def emit(block: pa.Table):
        work = aligner(a_path, b_path)
        figures, written, codes = measure(work, block.column("text").to_pylist())
        digests = [hashlib.sha256(text.encode()).hexdigest() if text else "" for text in written]
        places, pairs = pd.factorize(np.concatenate(codes))
        counts = np.bincount(places, minlength=len(pairs))
        # A document's links, as sorted numbers, differ little from one to the next.
        number = np.empty(len(pairs), dtype=np.int64)
        number[_by_frequency(pairs, counts)] = np.arange(len(pairs))
        links, start = [], 0
        for one in codes:
            own = np.sort(number[places[start : start + len(one)]])
            links.append(np.diff(own, prepend=0).astype(np.uint32).tobytes())
            start += len(one)
        columns = dict(zip(("n_a", "n_b", "n_groups", "n_links"), zip(*figures)))
        rows = pa.table(
            {
                "doc_id": block.column("doc_id"),
                **{name: pa.array(column, pa.int64()) for name, column in columns.items()},
                "groups_sha256": pa.array(digests, pa.string()),
                "text": pa.array(links, pa.large_binary()),
            }
        )
        return pairs, counts, rows

    return emit


def _with_counts(answers: pa.Table):
    """Looks up, by a block's pair number, the pair's links and whether they are its second id's
    most frequent."""
    order = _by_frequency(answers.column("code").to_numpy(), answers.column("n").to_numpy())
    counts = answers.column("links").to_numpy()[order]
    best = answers.column("best").to_numpy(zero_copy_only=False)[order].astype(bool)

    def apply(rows: pa.Table) -> pa.RecordBatch:
        n_best, sums = [], []
        for links in rows.column("text"):
            own = np.cumsum(np.frombuffer(links.as_py(), np.uint32), dtype=np.int64)
            n_best.append(int(best[own].sum()))
            sums.append(int(counts[own].sum()))
        found = rows.drop_columns(["text", "groups_sha256"])
        found = found.append_column("n_best", pa.array(n_best, pa.int64()))
        found = found.append_column("count_sum", pa.array(sums, pa.int64()))
        found = found.append_column("groups_sha256", rows.column("groups_sha256"))
        return found.combine_chunks().to_batches(max_chunksize=len(found))[0]

    return apply


def pair_counts(keys: DataFrame, width: int) -> DataFrame:
    """``code``, ``links`` and ``best`` of every pair that is linked anywhere: its number of links
    and whether none with the same second id has more.

    A second id has at most as many pairs as the first vocabulary has ids.
    """
    links = keys.groupBy("code").agg(F.sum("n").alias("links"))
    return links.withColumn("b", F.col("code") % width).selectExpr(
        "code", "links", "links = max(links) OVER (PARTITION BY b) AS best"
    )


def aligned(docs: DataFrame, a_path: str, b_path: str, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Per row of ``docs`` (``doc_id``, ``text``): ``doc_id``, ``n_a``, ``n_b``, ``n_groups``,
    ``n_links``, ``n_best`` (links of a pair that none with the same second id exceeds), ``count_sum``
    (over links, the corpus-wide links of their pair) and ``groups_sha256``."""
    texts = docs.select("doc_id", "text")
    keys, packed = blocks.in_blocks(texts, "text", block_bytes, _emit(a_path, b_path), "links")
    counts = pair_counts(keys, len(load(b_path).bytes))
    answers = keys.join(counts, "code").select("block", "code", "n", "links", "best")
    id_type = docs.schema["doc_id"].dataType.simpleString()
    return blocks.finish(
        answers, packed, _with_counts,
        f"doc_id {id_type}, n_a long, n_b long, n_groups long, n_links long, n_best long,"
        " count_sum long, groups_sha256 string",
    )


def groups(docs: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """Per row of ``docs`` (``doc_id``, ``text``): ``doc_id`` and its ``groups``, in order, the ids
    of both sides."""
    id_type = docs.schema["doc_id"].dataType.simpleString()
    ids = pa.list_(pa.int32())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = aligner(a_path, b_path)
        for batch in batches:
            found = [work.align(text.as_py()) for text in batch.column("text")]
            rows = [
                [
                    {"a": one.a_ids[i:next_i], "b": one.b_ids[j:next_j]}
                    for i, next_i, j, next_j in zip(
                        one.a_cuts, one.a_cuts[1:], one.b_cuts, one.b_cuts[1:]
                    )
                ]
                for one in found
            ]
            kind = pa.list_(pa.struct([("a", ids), ("b", ids)]))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(rows, kind)], ["doc_id", "groups"]
            )

    return docs.select("doc_id", "text").mapInArrow(
        run, f"doc_id {id_type}, groups array<struct<a: array<int>, b: array<int>>>"
    )
