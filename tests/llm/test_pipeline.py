"""The pipeline's stages by brute force, and the contract's catalogue."""

import re

import corpus_pipeline
import __spark_entry__ as contract
from conftest import sentence
from pyspark.sql import functions as F

from riskflow.llm import stages, toxicity
from riskflow.llm.oracle import ORACLE
from riskflow.llm.queries import QUERIES


def test_catalogue():
    numbers = sorted(int(re.match(r"op(\d+)_", name)[1]) for name in QUERIES)
    assert numbers == list(range(1, 11))
    assert set(QUERIES) | {"pipeline"} <= set(contract.queries())
    assert set(ORACLE) <= set(QUERIES) and set(ORACLE) <= set(contract.oracle_sql())


def test_stages_in_turn(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").withColumn("found", F.lit(1)).withColumn("node", F.lit("x"))
    columns = docs.columns
    model = toxicity.learn(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    scored = docs.select("doc_id", toxicity.score(F.col("text"), model)["score"].alias("s")).collect()
    kept = {r.doc_id for r in scored if r.s < 0.7}
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["toxicity", "near_duplicates", "personal_data", "packing"]
    docs = corpus_pipeline.STAGES[0][1](spark, docs, sf_dir).cache()
    assert docs.columns == columns and {r.doc_id for r in docs.collect()} == kept
    before = {r.doc_id: r.text for r in docs.collect()}
    docs = corpus_pipeline.STAGES[1][1](spark, docs, sf_dir).cache()
    assert docs.columns == columns
    left = {r.doc_id: r.text for r in docs.collect()}
    sets = {i: _shingles(t) for i, t in before.items()}
    for i in before.keys() - left.keys():  # what goes has a near copy
        assert any(j != i and _near(sets[i], sets[j]) for j in before)
    for i in left:  # no two that stay are near copies
        assert not any(j < i and _near(sets[i], sets[j]) for j in left)
    docs = corpus_pipeline.STAGES[2][1](spark, docs, sf_dir).cache()
    assert docs.columns == columns and {r.doc_id for r in docs.collect()} == left.keys()
    assert all(r.n_chars == len(r.text) for r in docs.collect())
    packed = corpus_pipeline.STAGES[3][1](spark, docs, sf_dir).collect()
    assert {r.doc_id for r in packed} == left.keys()
    assert all(len(r.ids) == 4 * r.length <= 4 * 2048 for r in packed)


def _shingles(text):
    words = [w for w in re.split("[\x20\x09-\x0d]+", text.lower()) if w]
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def _near(a, b):
    both = len(a & b)
    return both > 0 and 100 * both >= 80 * len(a | b)


def test_repeated_rows_stay_once(spark, sf_dir):
    import random

    text = sentence(random.Random(1), 50)
    rows = [(1, text)] * 30 + [(2, text + " more"), (3, "other"), (3, "other"), (None, None), (None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    left = stages.keep_one_of_each_group(spark, docs, sf_dir).collect()
    assert sorted((str(r.doc_id), r.text) for r in left if r.text) == [("1", text), ("3", "other")]
    assert len(left) == 3


def test_run_on_given_tables(spark, sf_dir):
    df = corpus_pipeline.run(spark, sf_dir)
    assert df.count() > 100 and df.groupBy("doc_id", "piece").count().filter("count > 1").count() == 0
