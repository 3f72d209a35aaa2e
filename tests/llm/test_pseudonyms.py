"""Operator 7: formats hold, values link, the rest stays."""

import datetime
import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from riskflow.llm import pseudonyms
from riskflow.llm.queries import PSEUDONYM_KEY, QUERIES


def _luhn(digits):
    total = 0
    for i, d in enumerate(reversed(digits)):
        d = int(d) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def _iban(value):
    signs = re.sub("[^0-9A-Z]", "", value)
    return int("".join(str(int(c, 36)) for c in signs[4:] + signs[:4])) % 97 == 1


def _replaced(spark, texts, key="k"):
    df = spark.createDataFrame(list(enumerate(texts)), "i int, text string").repartition(2)
    rows = pseudonyms.pseudonymize(df, key, count="n").orderBy("i").collect()
    return [(r.text, r.n) for r in rows]


def _by_hand(text, key, kind):
    """The Feistel rounds over letters and digits, in plain Python."""
    def shifted(value, digest):
        out = []
        for i, c in enumerate(value, 1):
            by = int(digest[(i % 32) * 4 : (i % 32) * 4 + 4], 16)
            first, size = ("0", 10) if c.isdigit() else ("a", 26) if c.islower() else ("A", 26)
            out.append(chr((ord(c) - ord(first) + by) % size + ord(first)))
        return "".join(out)

    half = len(text) // 2
    left, right = text[:half], text[half:]
    for turn in range(1, pseudonyms.ROUNDS + 1):
        moved, other = (left, right) if turn % 2 else (right, left)
        digest = hashlib.sha512(f"{key}|{kind}|{turn}/{len(moved)}|{other}".encode()).hexdigest()
        moved = shifted(moved, digest)
        left, right = (moved, right) if turn % 2 else (left, moved)
    return left + right


def test_rounds_by_hand(spark):
    rnd = random.Random(1)
    values = ["".join(rnd.choices("0123456789abcXYZ", k=rnd.randint(2, 40))) for _ in range(60)]
    df = spark.createDataFrame([(v,) for v in values], "v string")
    for r in df.select("v", pseudonyms.permute_text(F.col("v"), "key", "kind").alias("p")).collect():
        assert r.p == _by_hand(r.v, "key", "kind")


@pytest.mark.parametrize("split", [(27, 5411), (10, 10)])
def test_numbers_are_permuted(spark, split):
    n = split[0] * split[1] if split[1] < 100 else 3000
    df = spark.range(n).select(pseudonyms.permute_number(F.col("id"), split, "k", "t").alias("p"))
    found = [r.p for r in df.collect()]
    assert len(set(found)) == n and 0 <= min(found) and max(found) < split[0] * split[1]


def test_texts_are_permuted(spark):
    df = spark.range(10_000).select(F.format_string("%04d", "id").alias("v"))
    found = {r.p for r in df.select(pseudonyms.permute_text(F.col("v"), "k", "t").alias("p")).collect()}
    assert len(found) == 10_000 and all(re.fullmatch("[0-9]{4}", p) for p in found)
    single = spark.createDataFrame([(c,) for c in "abcxyz0129"], "v string")
    rows = single.select("v", pseudonyms.permute_text(F.col("v"), "k", "t").alias("p")).collect()
    assert len({r.p for r in rows}) == 10 and all(r.p != r.v for r in rows)


def test_formats_hold_and_equal_values_link(spark):
    texts = [
        "call +1 (724) 555-7058, card 4944339490429605 or 4944 3394 9042 9605.",
        "again 4944-3394-9042-9605 and +1 (724) 555-7058; hoccrcif.96@mail8.example.com, x",
        "ip 61.131.143.218. ssn 123-45-6789 DE89 3704 0044 0532 0130 00, GB82WEST12345698765432",
        "born 1987-03-12, 03/12/1987, 12.03.1987 and 25/12/1990",
        "home (415) 555-1234 or 415.555.1234",
        "mail a@b.com and HOCC.rcif+7@Mail8.example.com",
    ]
    got = _replaced(spark, texts)
    assert [n for _, n in got] == [3, 3, 4, 4, 2, 2]
    assert got != _replaced(spark, texts, "other key")
    phone, card, spaced = re.fullmatch(r"call (\+1 \(\d{3}\) \d{3}-\d{4}), card (\d{16}) or (\d{4} \d{4} \d{4} \d{4})\.", got[0][0]).groups()
    assert _luhn(card) and spaced.replace(" ", "") == card != "4944339490429605"
    linked = re.fullmatch(r"again (\d{4}-\d{4}-\d{4}-\d{4}) and (\+1 .{14}); ([a-z]{8}\.\d\d)@mail8\.example\.com, x", got[1][0])
    assert linked[1].replace("-", "") == card and linked[2] == phone and linked[3] != "hoccrcif.96"
    ip, ssn, de, gb = re.fullmatch(r"ip ([\d.]+)\. ssn (\d{3}-\d\d-\d{4}) (DE.{25}), (GB.{20})", got[2][0]).groups()
    assert all(0 <= int(x) <= 255 for x in ip.split(".")) and ip != "61.131.143.218"
    assert ssn != "123-45-6789" and _iban(de) and _iban(gb)
    iso, us, point, eu = re.fullmatch(r"born (\S+), (\S+), (\S+) and (\S+)", got[3][0]).groups()
    day = datetime.date.fromisoformat(iso)
    assert us == day.strftime("%m/%d/%Y") and point == day.strftime("%d.%m.%Y")
    datetime.datetime.strptime(eu, "%d/%m/%Y")
    a, b = re.fullmatch(r"home \((\d{3})\) (\d{3}-\d{4}) or (?:\d{3}\.\d{3}\.\d{4})", got[4][0]).groups()
    assert got[4][0].split("or ")[1].replace(".", "") == a + b.replace("-", "") and a[0] >= "2" <= b[0]
    assert re.fullmatch(r"mail [b-z]@b\.com and [A-Z]{4}\.[a-z]{4}\+\d@Mail8\.example\.com", got[5][0])


def test_what_does_not_validate_stays(spark, odd_texts):
    texts = odd_texts + [
        "4944339490429606", "666-45-6789 000-12-3456 900-11-1111 123-00-1234", "1987-02-30 31/02/1990 13/13/2000",
        "999.1.1.1 1.2.3 1.2.3.4.5", "DE89370400440532013001", "version 1.2.3 of 2024", "a@b", "12345", "1690-01-01",
        "x" * 30_000 + " 4944339490429605x1 " + "7" * 500, "1 " * 3000,
    ]
    got = _replaced(spark, texts)
    assert [t for t, _ in got] == texts
    assert all(n == 0 for _, n in got)


def test_values_side_by_side(spark):
    values = [
        "61.131.143.218", "4944339490429605", "+1 (724) 555-7058", "4944 3394 9042 9605", "a.b@c.com",
        "123-45-6789", "+49 151 2345 678", "1987-03-12", "4944-3394-9042-9605",
    ]
    pairs = [f"{a} {b}" for a in values for b in values]
    for (text, n), pair in zip(_replaced(spark, pairs), pairs):
        assert n == 2, pair
        assert not any(v in text for v in values if v in pair), (pair, text)


def test_ssn_stays_valid(spark):
    rnd = random.Random(4)
    ssns = [f"{rnd.choice([1, 665, 667, 899, rnd.randint(1, 665)]):03d}-{rnd.randint(1, 99):02d}-{rnd.randint(1, 9999):04d}" for _ in range(200)]
    for text, n in _replaced(spark, ssns):
        area, group, serial = map(int, text.split("-"))
        assert n == 1 and 1 <= area <= 899 and area != 666 and 1 <= group <= 99 and 1 <= serial <= 9999


def test_clashing_columns_and_empty_tables(spark, documents):
    df = documents.withColumn("__x", F.lit(1)).withColumn("n", F.lit("old"))
    done = pseudonyms.pseudonymize(df, "k", count="n")
    assert done.columns == df.columns and done.count() == df.count()
    assert pseudonyms.pseudonymize(df.limit(0), "k").count() == 0


def test_query_leaves_no_planted_value(spark, sf_dir):
    before = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    df = QUERIES["op7_feistel_pseudonyms"](spark, sf_dir)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "InPandas" not in plan
    value = re.compile(r"[\w.+-]+@[\w-]+\.[\w.]+\w|\b\d{1,3}(?:\.\d{1,3}){3}\b|\+1 \(\d{3}\) \d{3}-\d{4}|\b\d{16}\b")
    private = lambda v: not re.fullmatch(r"\d{16}", v) or _luhn(v)
    hits = 0
    for r in df.collect():
        found = [v for v in value.findall(before[r.doc_id]) if private(v)]
        hits += len(found)
        assert not set(found) & set(value.findall(r.text)) and r.n_replaced >= len(found)
        if r.n_replaced == 0:
            assert r.text == before[r.doc_id]
        assert value.sub("", r.text) == value.sub("", before[r.doc_id])
    assert hits > 0 and PSEUDONYM_KEY


def test_phones_of_all_countries_in_any_spacing(spark):
    """A number is taken whole and has one pseudonym, spaced or compact; its country code stays."""
    numbers = [
        ("33", ["+33 6 12 34 56 78", "+33612345678", "+33.6.12.34.56.78", "+33 (0)6 12 34 56 78", "+33 612 345 678"]),
        ("33", ["+33 1 42 68 53 00", "+33142685300"]),
        ("34", ["+34 612 34 56 78", "+34612345678", "+34 612 345 678", "+34-612-345-678"]),
        ("49", ["+49 30 1234567", "+49301234567", "+49 (30) 1234567", "+49 (0)30 123 4567", "+49-30-1234567"]),
        ("49", ["+49 151 2345 6789", "+4915123456789", "+49 1512 3456789"]),
        ("44", ["+44 20 7946 0958", "+442079460958"]),
        ("351", ["+351 912 345 678", "+351912345678"]),
        ("420", ["+420 601 234 567", "+420601234567"]),
    ]
    found = iter(_replaced(spark, [f"call {v}, or not" for _, forms in numbers for v in forms]))
    for code, forms in numbers:
        new = set()
        for form in forms:
            text, n = next(found)
            assert n == 1 and form not in text, form
            kept = re.fullmatch(r"call (\+.*), or not", text)[1]
            assert re.sub("[0-9]", "9", kept) == re.sub("[0-9]", "9", form)
            assert ("(0)" in kept) == ("(0)" in form)
            new.add(re.sub("[^0-9]", "", kept.replace("(0)", "")))
        assert len(new) == 1 and new.pop().startswith(code), (forms, new)


def test_phones_beside_other_values(spark):
    phones = ["+33 6 12 34 56 78", "+34 612 34 56 78", "+49 30 1234567", "+49 151 2345 6789"]
    others = ["61.131.143.218", "4944 3394 9042 9605", "123-45-6789", "1987-03-12", "+33 1 42 68 53 00"]
    pairs = [(a, b) for a in phones for b in others]
    for (text, n), (a, b) in zip(_replaced(spark, [f"{a} {b}" for a, b in pairs]), pairs):
        assert n == 2 and a not in text and b not in text, (a, b, text)
    odd = ["+33 6 12 34 56 7", "+33 6 12 34 56 78 9", "+49 30 1234 5678 9012"]
    assert all(n == 1 for _, n in _replaced(spark, odd))
    few = ["+33 6 12", "+49 1234", "+331234567890123456789"]
    assert _replaced(spark, few) == [(t, 0) for t in few]
