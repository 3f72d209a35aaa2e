"""Operator 5 and the components below it."""

import random

import pytest
from compare import connect, differences
from pyspark.sql import functions as F

from riskflow.llm import url_filter
from riskflow.llm.components import connected_components
from riskflow.llm.oracle import ORACLE
from riskflow.llm.queries import QUERIES, URL_RULES

RULES = "host string, path string, action string"
LINK = '<html><head><link rel="canonical" href="%s"></head>'


def _components(edges):
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a is not None and b is not None and a != b:
            a, b = find(a), find(b)
            parent[max(a, b)] = min(a, b)
    return {x: find(x) for x in parent}


@pytest.mark.parametrize("shape", ["random", "chain", "hub", "none"])
def test_components(spark, shape):
    rnd = random.Random(3)
    edges = {
        "random": [(rnd.randrange(400), rnd.randrange(400)) for _ in range(220)],
        "chain": [(i, i + 1) for i in range(90)],
        "hub": [(500, i) for i in range(300)] + [(900, 901), (901, 901), (None, 3), (7, 7)] * 2,
        "none": [(1, 1), (None, None)],
    }[shape]
    df = spark.createDataFrame(edges, "a long, b long").repartition(4)
    got = {r.node: r.component for r in connected_components(df).collect()}
    assert got == _components(edges)


def test_rules_and_aliases(spark):
    pages = [
        (1, "http://A.net/x", ""), (2, "http://b.com/q", LINK % "http://a.net/x"),
        (3, "http://c.com/q?x#f", LINK % "http://b.com/q"),
        (4, "http://c.org/fr/z", '<meta http-equiv="refresh" content="0; url=http://b.com/q">'),
        (5, None, None), (6, "junk", ""), (7, "http://d.com/z", LINK % "/y"), (8, "http://d.com/y", ""),
        (9, "http://x.example.net/en/1", LINK % "http://a.net/x"), (10, "http://x.net", None),
        (11, "http://d.com/y", "<!-- <link rel=canonical href=http://a.net/x> -->"),
        (12, "http://example.com/de/1", ""), (13, "http://www.Example.com:80/de/1", ""),
        (14, "http://e.com/1", "<link href='//example.com/de/1' rel='canonical'>"),
        (15, "http://e.com/2", LINK % "mailto:x"), (16, "http://f.com/1", LINK % "http://e.com/1#a"),
        (16, "http://f.com/1", LINK % "http://e.com/1#a"),
    ]
    df = spark.createDataFrame(pages, "page_id long, url string, html string")
    df = df.withColumn("rule", F.lit("old")).withColumn("node", F.lit("x"))
    rules = spark.createDataFrame(URL_RULES, RULES)
    rows = url_filter.judge(df, rules).collect()
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in rows}
    assert len(rows) == len(pages) and {r.node for r in rows} == {"x"}
    assert got == {
        1: ("a.net", "/x", "net/", "block"), 2: ("b.com", "/q", None, "block"),
        3: ("c.com", "/q", None, "block"), 4: ("c.org", "/fr/z", "org/fr/", "allow"),
        5: ("", "", None, "allow"), 6: ("", "", None, "allow"), 7: ("d.com", "/z", None, "allow"),
        8: ("d.com", "/y", None, "allow"), 9: ("x.example.net", "/en/1", "example.net/en/", "allow"),
        10: ("x.net", "", None, "allow"), 11: ("d.com", "/y", None, "allow"),
        12: ("example.com", "/de/1", "example.com/de/", "block"),
        13: ("www.example.com:80", "/de/1", None, "allow"),
        14: ("e.com", "/1", None, "block"), 15: ("e.com", "/2", None, "allow"),
        16: ("f.com", "/1", None, "block"),
    }
    logged = spark.createDataFrame([("http://d.com/y", "http://a.net/x"), (None, "x")], "a string, b string")
    again = {r.page_id: r.verdict for r in url_filter.judge(df, rules, redirects=logged).collect()}
    assert again[7] == again[8] == again[11] == "block" and again[15] == "allow"


def test_many_rules_and_empty_tables(spark):
    rules = [(f"h{i % 50}.com", f"/{i % 7}", "block" if i % 3 else "allow") for i in range(400)]
    rules += [("com", "/", "allow"), ("com", "/", "block")]
    urls = [(i, f"http://www.h{i % 60}.com/{i % 9}x") for i in range(300)]
    pages = spark.createDataFrame(urls, "page_id long, url string").withColumn("html", F.lit(""))
    got = url_filter.judge(pages, spark.createDataFrame(rules, RULES)).collect()
    for r in got:
        host, path = r.url.split("/")[2], "/" + r.url.split("/")[3]
        fitting = [(len(h + p), h + p) for h, p, _ in rules if ("." + host).endswith("." + h) and path.startswith(p)]
        assert r.rule == max(fitting)[1]
    none = spark.createDataFrame([], RULES)
    assert {r.verdict for r in url_filter.judge(pages, none).collect()} == {"allow"}
    assert url_filter.judge(pages.limit(0), none).count() == 0


def test_query_equals_sql_and_stays_in_the_jvm(spark, sf_dir):
    df = QUERIES["op5_url_filter"](spark, sf_dir)
    assert differences(df, connect(sf_dir), ORACLE["op5_url_filter"]) == []
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "InPandas" not in plan and "NestedLoop" not in plan
