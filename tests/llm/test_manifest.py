from __future__ import annotations

import hashlib
import re
import zlib

import pytest
from pyspark.sql import functions as F

from compare import connect, differences
from riskflow.llm import manifest, oracle, queries

TABLE = "doc_id long, source string, lang string, n_chars long, text string"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def tree(hashes):
    """Root and proofs, run by run."""
    proofs, below = [[] for _ in hashes], [[i] for i in range(len(hashes))]
    while len(hashes) > 1:
        upper, members = [], []
        for start in range(0, len(hashes), 16):
            run = hashes[start : start + 16]
            for k in range(len(run)):
                for leaf in below[start + k]:
                    proofs[leaf].append((k, run[:k] + run[k + 1 :]))
            upper.append(sha("".join(run)))
            members.append([leaf for part in below[start : start + 16] for leaf in part])
        hashes, below = upper, members
    return hashes[0], proofs


def brute_force(rows):
    def field(value):
        return "-" if value is None else f"{len(str(value).encode())}:{value}"

    def leaf(row, text):
        return sha("".join(map(field, (*(row[n] for n in ("doc_id", "source", "lang", "n_chars")), text))))

    def lower(text):
        return text and re.sub("[A-Z]", lambda m: m[0].lower(), text)

    groups = {}
    for row in rows:
        groups.setdefault(row["source"], []).append(row)
    found, order = [], sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    within = {}
    for source in order:
        groups[source].sort(key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, leaf(r, r["text"])))
        within[source] = tree([leaf(r, r["text"]) for r in groups[source]])
    root, above = tree([within[source][0] for source in order]) if order else (None, [])
    for source, rest in zip(order, above):
        subroot, proofs = within[source]
        for row, proof in zip(groups[source], proofs):
            steps, own = proof + rest, leaf(row, row["text"])
            changed = row["doc_id"] is not None and zlib.crc32(str(row["doc_id"]).encode()) % 5 == 0
            fold = leaf(row, lower(row["text"])) if changed else own
            for place, siblings in steps:
                fold = sha("".join([*siblings[:place], fold, *siblings[place:]]))
            siblings = "".join(h for _, run in steps for h in run)
            found.append((row["doc_id"], own, subroot, root, sha(siblings), fold, fold == root))
    return found


def answers(spark, rows, folder):
    spark.createDataFrame(rows, TABLE).repartition(5).write.parquet(f"{folder}/documents.parquet")
    return [tuple(r) for r in queries.QUERIES["op12_merkle_manifest"](spark, str(folder)).collect()]


def key(row):
    return (row[0] is not None, row[0] or 0, row[1:])


def documents(n, source="src{}".format, every=7):
    return [
        {"doc_id": 3 * i, "source": source(i % every), "lang": "en", "n_chars": i, "text": f"Text {i} É"}
        for i in range(n)
    ]


@pytest.mark.parametrize("n", [1, 17, 300])
def test_brute_force(spark, tmp_path, n):
    rows = documents(n)
    assert sorted(answers(spark, rows, tmp_path), key=key) == sorted(brute_force(rows), key=key)


def test_group_of_several_blocks(spark, tmp_path):
    """One source holds more than a block of leaves, so a second storey is built."""
    rows = documents(manifest.BLOCK + 600, source=lambda i: "hot" if i else "other", every=9)
    rows += documents(40, source="one{}".format, every=40)
    assert sorted(answers(spark, rows, tmp_path), key=key) == sorted(brute_force(rows), key=key)


def test_nulls_ties_and_repeated_rows(spark, tmp_path):
    rows = documents(40, source=lambda i: None if i == 0 else f"s{i}", every=3)
    rows += [dict.fromkeys(rows[0])] * 3
    rows += [rows[0]] * 20
    rows += [{**rows[1], "text": t} for t in ("other", "", None, "x" * 200_000)]
    rows += [{**rows[2], "source": s} for s in ("", "é", "z", "Z", "\U0001F600", "�")]
    assert sorted(answers(spark, rows, tmp_path), key=key) == sorted(brute_force(rows), key=key)


def test_empty_table(spark, tmp_path):
    assert answers(spark, [], tmp_path) == []


def test_other_columns_come_through(spark):
    leaves = spark.range(40).select(
        (F.col("id") % 2).alias("group"), F.col("id").alias("key"), F.sha2(F.col("id").cast("string"), 256).alias("hash"),
        F.col("id").alias("size"), F.lit("x").alias("row"), F.lit(1).alias("path"), F.lit(2).alias("odd name"),
    )
    found = manifest.manifest(leaves)
    assert found.columns == [*leaves.columns, "subroot", "root", "proof"]
    assert found.filter("size = key AND row = 'x' AND path = 1 AND `odd name` = 2").count() == 40
    assert found.filter(manifest.folded(F.col("hash"), F.col("proof")) != F.col("root")).isEmpty()


def test_leaves_are_grouped_in_one_exchange(spark):
    nodes = spark.range(100).selectExpr(
        "id % 2 AS group", "id AS rank", "50L AS size", "CAST(id AS STRING) AS hash", "id AS row"
    )
    plan = manifest._blocks(nodes)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "Join" not in plan


def test_equals_sql(spark, sf_dir):
    sql = oracle.ORACLE["op12_merkle_manifest"]
    assert differences(queries.QUERIES["op12_merkle_manifest"](spark, sf_dir), connect(sf_dir), sql) == []
