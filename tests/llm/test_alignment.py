from __future__ import annotations

import hashlib
import random
from collections import Counter

import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from conftest import sentence
from riskflow.llm import alignment, queries


@pytest.fixture(scope="module")
def paths(tokenizer_path):
    return tokenizer_path("byte_bpe_50k.json"), tokenizer_path("piece_bpe_32k.model")


class Plain:
    """The contract, token by token, with the libraries themselves."""

    def __init__(self, a_path, b_path):
        self.a = Tokenizer.from_file(a_path)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_path)
        printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
        others = [b for b in range(256) if b not in printable]
        self.byte_of = {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(others)}

    def a_bytes(self, i):
        return bytes(self.byte_of[c] for c in self.a.id_to_token(i))

    def b_bytes(self, i):
        piece = self.b.id_to_piece(i)
        if piece.startswith("<0x") and len(piece) == 6:
            return bytes([int(piece[3:5], 16)])
        return piece.replace("▁", " ").encode()

    def spans(self, ids, of):
        found, end = [], 0
        for i in ids:
            start, end = end, end + len(of(i))
            found.append((i, start, end))
        return found

    def document(self, text):
        """Groups, and the linked pairs."""
        if not text:
            return [], []
        whole = (" " + text).encode()
        a = self.spans(self.a.encode(" " + text, add_special_tokens=False).ids, self.a_bytes)
        b = self.spans(self.b.encode(text), self.b_bytes)
        if b"".join(self.a_bytes(i) for i, *_ in a) != whole or b"".join(self.b_bytes(i) for i, *_ in b) != whole:
            return [], []
        shared = {end for *_, end in a} & {end for *_, end in b}
        groups, start = [], 0
        for end in sorted(shared):
            own = [[i for i, s, e in side if start <= s and e <= end] for side in (a, b)]
            groups.append(tuple(own))
            start = end
        links = [(x, y) for x, s, e in a for y, t, f in b if max(s, t) < min(e, f)]
        return groups, links

    def rows(self, texts):
        found = {key: self.document(text) for key, text in texts}
        counts = Counter(pair for _, links in found.values() for pair in links)
        best = Counter()
        for (_, y), n in counts.items():
            best[y] = max(best[y], n)
        rows = []
        for key, (groups, links) in found.items():
            text = ";".join(f"{','.join(map(str, a))}|{','.join(map(str, b))}" for a, b in groups)
            rows.append((
                key, sum(len(a) for a, _ in groups), sum(len(b) for _, b in groups), len(groups),
                len(links), sum(counts[p] == best[p[1]] for p in links), sum(counts[p] for p in links),
                hashlib.sha256(text.encode()).hexdigest() if groups else "",
            ))
        return sorted(rows)


def odd(odd_texts):
    rnd = random.Random(5)
    texts = [t if t is None or len(t) < 3_000 else t[:3_000] for t in odd_texts]
    texts += ["▁ mark", "a<s>b</s><unk>", "tab\tand\nline", "nul\x00l", "\U0001F600 𝒜 ½ ﬁ", "  two  blanks ",
              "<0x41> is text", "é and é", "’quotes’ – dash", "x" * 300, " " * 40, "\n" * 30]
    texts += [sentence(rnd, 60) for _ in range(30)]
    texts += ["".join(rnd.choice("abc é日\n .,'1<|>") for _ in range(120)) for _ in range(30)]
    return list(enumerate(texts))


def as_rows(df):
    return sorted(
        (r["doc_id"], r["n_a"], r["n_b"], r["n_groups"], r["n_links"], r["n_best"], r["count_sum"], r["groups_sha256"])
        for r in df.collect()
    )


def test_query_against_brute_force(spark, tmp_path, odd_texts, paths):
    texts = odd(odd_texts)
    docs = spark.createDataFrame(texts, "doc_id long, text string").withColumn("links", F.lit(1))
    docs.repartition(4).write.parquet(f"{tmp_path}/documents.parquet")
    found = as_rows(queries.QUERIES["op13_tokenizer_alignment"](spark, str(tmp_path)))
    assert found == Plain(*paths).rows(texts)


def test_small_blocks_give_the_same(spark, odd_texts, paths):
    docs = spark.createDataFrame(odd(odd_texts), "doc_id long, text string").repartition(3)
    whole, parts = (as_rows(alignment.aligned(docs, *paths, block_bytes=n)) for n in (1 << 24, 500))
    assert whole == parts


def test_repeated_and_unnamed_rows(spark, paths):
    rows = [(1, "The same text."), (1, "The same text."), (None, "No id."), (2, None), (3, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = alignment.aligned(docs, *paths).collect()
    assert sorted(r["n_links"] for r in found)[:2] == [0, 0]
    same = [r for r in found if r["doc_id"] == 1]
    # Each link is counted in both rows.
    assert len(found) == 5 and len(same) == 2 and same[0] == same[1]
    assert same[0]["count_sum"] >= 2 * same[0]["n_links"]


def test_empty_table(spark, paths):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert alignment.aligned(docs, *paths).collect() == []


def test_groups_cover_all_ids(spark, odd_texts, paths):
    texts = odd(odd_texts)
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    plain = Plain(*paths)
    for row in alignment.groups(docs, *paths).collect():
        groups = [(g["a"], g["b"]) for g in row["groups"]]
        assert groups == plain.document(texts[row["doc_id"]][1])[0]


def test_same_ids_as_the_library(paths):
    """Where another library encodes, it gives the same ids."""
    work, plain = alignment.aligner(*paths), Plain(*paths)
    assert work.a.fast is not None
    rnd = random.Random(11)
    letters = "abcdeEFT  \n\t'.,;<|>019éüßÅœłİ½ªæ"
    for _ in range(3_000):
        text = "".join(rnd.choice(letters) for _ in range(rnd.randrange(60)))
        assert work.a.encode(text) == plain.a.encode(" " + text, add_special_tokens=False).ids


@pytest.mark.parametrize("text", ["\n" * 1_200_000, " " * 1_500_000 + "x", "x" * 1_000_000])
def test_very_long_runs(paths, text):
    found = alignment.aligner(*paths).align(text)
    assert len(found.links) == len(found.a_ids) + len(found.b_ids) - (len(found.a_cuts) - 1)


def test_links_of_a_group():
    assert alignment.expanded([1, 2, 3], [2, 3, 1], [7, 8], [4, 2]) == [(1, 7), (2, 7), (2, 8), (3, 8)]
    assert alignment.expanded([1], [5], [7, 8], [2, 3]) == [(1, 7), (1, 8)]


def test_pieces_align_as_whole_texts(paths):
    """Cut behind words and measured once per distinct piece, or not cut: the same."""
    work, rnd = alignment.aligner(*paths), random.Random(13)
    assert work.splits_words
    letters = "abcdeEFT   \n\n\t'.,;<|>019éüßÅœłİ½ªæ"
    texts = ["".join(rnd.choice(letters) for _ in range(rnd.randrange(80))) for _ in range(2_000)]
    texts += [None, "", " ", "\n", " a", "a ", "\na", "a\r\nb);\r c", "日本 语 a", "a" * 30_000 + " b"]
    for text, figures, written, links in zip(texts, *alignment.measure(work, texts)):
        whole = work.align(text)
        assert written == ";".join(whole.written)
        assert figures == (len(whole.a_ids), len(whole.b_ids), len(whole.a_cuts) - 1, len(whole.links))
        assert sorted(links.tolist()) == sorted(whole.links.tolist())


def test_pieces_that_do_not_stand_alone(paths, monkeypatch):
    """Where a cut turns out to be no common end, texts are aligned whole."""
    work = alignment.aligner(*paths)
    monkeypatch.setattr(alignment, "_PIECE", alignment.re.compile(r"[^e]+|e[^e]*"))
    texts = ["The letters there", "were never three"]
    for text, figures, written in zip(texts, *alignment.measure(work, texts)[:2]):
        assert written == ";".join(work.align(text).written)
        assert figures[0] == len(work.align(text).a_ids)
