"""Operator 9: limits hold, nothing splits without need."""

import random

from compare import connect, differences
from pyspark.sql import functions as F

from riskflow.llm import sharding
from riskflow.llm.oracle import ORACLE, sharding_sql
from riskflow.llm.queries import QUERIES


def _assigned(spark, rows, limit):
    df = spark.createDataFrame(rows, "doc_id long, n long, shard int").repartition(3)
    return sharding.assign(df, F.col("doc_id"), F.col("n"), limit).collect()


def _check(got, limit):
    shards = {}
    for r in got:
        shards.setdefault(r.shard, []).append(r)
    for name, rows in shards.items():
        size = sum(r.n or 0 for r in rows)
        assert {(r.shard_bytes, r.shard_docs, r.depth) for r in rows} == {(size, len(rows), len(name) - 1)}
        assert size <= limit or len(rows) == 1
        if len(name) > 1:  # the bucket that was split did not fit
            above = [r for other in shards for r in shards[other] if other.startswith(name[:-1])]
            assert sum(r.n or 0 for r in above) > limit
    assert not any(a != b and b.startswith(a) for a in shards for b in shards)
    return shards


def test_limits_with_hot_and_null_keys(spark):
    rnd = random.Random(1)
    rows = [(i, rnd.randrange(300), 1) for i in range(1200)] + [(None, rnd.randrange(300), 1) for _ in range(500)]
    rows += [(7, 100, 1)] * 300 + [(8, None, 1), (9, 0, 1), (10, 5_000, 1), (11, 1_000, 1)]
    got = _assigned(spark, rows, 1000)
    assert sorted((str(r.doc_id), r.n or 0) for r in got) == sorted((str(a), b or 0) for a, b, _ in rows)
    shards = _check(got, 1000)
    assert len({r.shard for r in got if r.doc_id is None}) > 50
    assert [len(v) for v in shards.values() if v[0].shard_bytes > 1000] == [1]


def test_one_shard_and_none(spark):
    got = _assigned(spark, [(1, 5, 1), (2, 6, 1)], 100)
    assert {r.shard for r in got} == {"s"} and _check(got, 100)
    assert _assigned(spark, [(1, 0, 1), (2, None, 1)], 1)[0].shard == "s"
    df = spark.createDataFrame([], "doc_id long, n long")
    assert sharding.assign(df, F.col("doc_id"), F.col("n"), 10).count() == 0


def test_written_shards(spark, tmp_path):
    df = spark.range(200).withColumn("n", F.lit(10))
    assigned = sharding.assign(df, F.col("id"), F.col("n"), 300)
    sharding.write_shards(assigned, str(tmp_path / "out"))
    back = spark.read.parquet(str(tmp_path / "out"))
    assert back.count() == 200
    assert back.groupBy("shard").agg(F.sum("n").alias("n")).filter("n > 300").count() == 0


def test_small_limit_equals_sql(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    docs = docs.select("doc_id", F.octet_length("text").cast("long").alias("n_bytes"))
    df = sharding.assign(docs, F.col("doc_id"), F.col("n_bytes"), 20_000)
    assert df.select("shard").distinct().count() > 20
    assert differences(df, connect(sf_dir), sharding_sql(20_000)) == []


def test_query_equals_sql(spark, sf_dir):
    df = QUERIES["op9_extendible_sharding"](spark, sf_dir)
    assert differences(df, connect(sf_dir), ORACLE["op9_extendible_sharding"]) == []
