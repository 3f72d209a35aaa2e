"""Operators 4 and 6, and the ids of operator 1, against their libraries."""

import hashlib
import random
import struct

import pytest
import tiktoken
from conftest import sentence
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import public_tokenizers
from riskflow.llm import bpe, token_counts, word_ids
from riskflow.llm.queries import QUERIES

ALPHABET = [chr(c) for c in range(32, 127)] + list("\t\n\r\x0b\x0c\x1c\x85\xa0 ́éÉß中İΣ²٠ſª😀")
ALPHABET += [" "] * 30 + ["\n"] * 8 + ["<|endoftext|>", "'s", "'ll", "the", "Hast"]


def _random_texts(n, size):
    rnd = random.Random(11)
    return ["".join(rnd.choices(ALPHABET, k=rnd.randint(0, size))) for _ in range(n)]


@pytest.fixture(scope="module")
def encoding(tokenizer_path):
    return bpe.load(tokenizer_path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


def test_pattern_is_the_published_one():
    assert bpe.PATTERN == public_tokenizers.PATTERN


def test_pieces_encode_independently(encoding):
    for text in _random_texts(3000, 40):
        pieces = list(bpe.safe_pieces(text, 5))
        assert "".join(pieces) == text
        ids = [i for piece in pieces for i in encoding.encode_ordinary(piece)]
        assert ids == encoding.encode_ordinary(text), text


def test_encode_and_decode(spark, documents, odd_texts, encoding, tokenizer_path):
    path = tokenizer_path("byte_bpe_50k.tiktoken")
    clashing = documents.withColumn("ids", F.lit("x")).withColumn("text_hash", F.lit(1))
    done = clashing.select("*", bpe.encode(F.col("text"), path).alias("own_ids"))
    done = done.withColumn("back", bpe.decode(F.col("own_ids"), path))
    rows = done.collect()
    assert len(rows) == documents.count() and {r.ids for r in rows} == {"x"}
    for r in rows:
        ids = encoding.encode_ordinary(r.text or "")
        assert bytes(r.own_ids) == struct.pack(f"<{len(ids)}I", *ids)
        assert bytes(r.back) == (r.text or "").encode()


def test_bytes_that_are_no_text(spark, encoding, tokenizer_path):
    path = tokenizer_path("byte_bpe_50k.tiktoken")
    raw = bytes(range(256))
    ids = encoding._encode_single_piece(raw) if hasattr(encoding, "_encode_single_piece") else []
    df = spark.createDataFrame([(bytearray(struct.pack(f"<{len(ids)}I", *ids)),), (None,)], "ids binary")
    back = [bytes(r.back) for r in df.select(bpe.decode(F.col("ids"), path).alias("back")).collect()]
    assert sorted(back) == sorted([raw if ids else b"", b""])


@pytest.mark.parametrize("module, name", [(token_counts, "byte_bpe_50k.json"), (word_ids, "word_bpe_49k.json")])
def test_text_by_text_as_the_library(module, name, odd_texts, tokenizer_path):
    path = tokenizer_path(name)
    library = Tokenizer.from_file(path)
    rnd = random.Random(3)
    texts = _random_texts(6000, 14) + [t for t in odd_texts if t] + [sentence(rnd, 400)]
    tokenizer = module.load(path)
    for text in texts:
        ids = library.encode(text, add_special_tokens=False).ids
        if module is token_counts:
            assert module.count_text(text, tokenizer, module.piece_counts(path)) == len(ids), text
        else:
            packed = module.encode_text(text, tokenizer, module.word_ids(path))
            assert packed == struct.pack(f"<{len(ids)}I", *ids), text


def test_whole_tokens_are_proven(tokenizer_path):
    path = tokenizer_path("byte_bpe_50k.json")
    whole = token_counts.whole_tokens(path)
    library = Tokenizer.from_file(path)
    for text in random.Random(5).sample(sorted(whole), 500):
        assert len(library.encode(text, add_special_tokens=False).ids) == 1
    assert " the" in whole and "<|endoftext|>" not in whole


def test_other_tokenizers_take_the_plain_way(tokenizer_path):
    words = token_counts.load(tokenizer_path("word_bpe_49k.json"))
    byte_level = token_counts.load(tokenizer_path("byte_bpe_50k.json"))
    assert not token_counts.splits_by_blanks(words) and word_ids.drops_blanks(words)
    assert token_counts.splits_by_blanks(byte_level) and not word_ids.drops_blanks(byte_level)


def test_counts_in_a_table(spark, documents, tokenizer_path):
    path = tokenizer_path("byte_bpe_50k.json")
    library = Tokenizer.from_file(path)
    column = token_counts.token_count(F.col("text"), path).alias("n")
    for r in documents.withColumn("count", F.lit(0)).select("*", column).collect():
        assert r.n == len(library.encode(r.text or "", add_special_tokens=False).ids)
    assert documents.limit(0).select(column).count() == 0


def test_queries_on_given_tables(spark, sf_dir, encoding, tokenizer_path):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    counted = {r.doc_id: r for r in QUERIES["op6_token_counts"](spark, sf_dir).collect()}
    coded = {r.doc_id: r for r in QUERIES["op4_byte_bpe"](spark, sf_dir).collect()}
    assert counted.keys() == coded.keys() == texts.keys()
    for doc_id, text in texts.items():
        ids = encoding.encode_ordinary(text)
        assert coded[doc_id].n_tokens == counted[doc_id].n_tokens == len(ids)
        assert coded[doc_id].ids_sha256 == hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest()
        assert coded[doc_id].decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()
        assert counted[doc_id].n_bytes == len(text.encode())
        assert counted[doc_id].over_limit == (len(ids) > 512)


@pytest.mark.parametrize("blank", ["\n", " ", "\t", " \n"])
@pytest.mark.parametrize("after", ["", "x", "word and more"])
def test_very_long_white_space(encoding, blank, after):
    """Ids as by the rule: all but the last character of a run is one match, all of it at the end."""
    run = (blank * 2_000_000)[:2_000_000]
    whole = "before" + run + after
    own = run if not after else run[:-1]
    expected = (
        encoding.encode_ordinary("before")
        + encoding._encode_single_piece(own.encode())
        + (encoding.encode_ordinary(run[-1] + after) if after else [])
    )
    got = bpe.encode_text(whole, encoding)
    assert got == struct.pack(f"<{len(expected)}I", *expected)
    assert bpe.decode_ids(got, encoding) == whole.encode()


def test_long_runs_by_the_same_rule_as_short_ones(encoding, monkeypatch):
    monkeypatch.setattr(bpe, "_LONG_RUN", bpe.re.compile(bpe._LONG_RUN.pattern.replace("100000", "2")))
    monkeypatch.setattr(bpe, "LONG_RUN", 2)
    for text in _random_texts(3000, 30):
        ids = encoding.encode_ordinary(text)
        assert bpe.encode_text(text, encoding) == struct.pack(f"<{len(ids)}I", *ids), text
