from __future__ import annotations

import random

import pytest

import public_tokenizers

WORDS = "the a of edge river stone light over and under quiet red glass north early paper".split()


def sentence(rnd: random.Random, n: int) -> str:
    return " ".join(rnd.choice(WORDS) + rnd.choice(["", "", "s", "er", ","]) for _ in range(n))


@pytest.fixture(scope="session")
def odd_texts():
    """Null, empty, blank, very short and very long texts, odd white space and scripts."""
    rnd = random.Random(7)
    return [
        None, "", " ", " \n\t ", "a", "ab", "Hello, world's end\n\n  again ", "x" * 40_000,
        sentence(rnd, 9_000), "naïve Ünïcode İstanbul ΣΑΣ ﬁ", "日本語のテキストです。" * 30,
        "a b c\u0085d\x0be\x1cf", "😀 👩‍👩‍👧 é é", "<|endoftext|> in <|startoftext|> text",
        "  leading", "trailing   ", "1234567 89,000.5 3²", "\r\n\r\n", "don't I'll we've 'sup",
    ]


@pytest.fixture(scope="session")
def tokenizer_path():
    return public_tokenizers.path


@pytest.fixture()
def documents(spark, odd_texts):
    rows = list(enumerate(odd_texts)) + [(3, "a second text of a repeated id"), (None, "no id")]
    rows += [(500, "repeated row")] * 3
    return spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
