"""Corpus preparation in stages, each over all that its predecessor kept."""

from __future__ import annotations

from riskflow.llm import stages
from riskflow.llm.workers import find_package
from riskflow.session import materialize

STAGES = [
    ("toxicity", stages.reject_toxic),
    ("near_duplicates", stages.keep_one_of_each_group),
    ("personal_data", stages.replace_personal_data),
    ("packing", stages.pack_into_sequences),
]

# The stages learn from labels, hash, permute and pack, which SQL cannot express.
ORACLE_SQL = None


def run(spark, sf_dir):
    """The last stage's rows over ``documents``; each stage is written once and read again."""
    find_package(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
