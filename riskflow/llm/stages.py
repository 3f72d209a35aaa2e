"""Stages of the corpus pipeline: ``(spark, docs, sf_dir) -> DataFrame``.

All but the last return the columns of ``docs`` for the rows they keep.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import functions as F

from riskflow.llm import near_dedup, packing, pseudonyms, toxicity, word_ids
from riskflow.llm.queries import PSEUDONYM_KEY, TOXIC_SCORE


def reject_toxic(spark, docs, sf_dir):
    """Documents below the score from which one counts as toxic."""
    model = toxicity.learn(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    scored = docs.withColumn("__found", toxicity.score(F.col("text"), model))
    return scored.filter(F.col("__found.score") < TOXIC_SCORE).drop("__found")


def keep_one_of_each_group(spark, docs, sf_dir):
    """One document of each group of near copies (five words, 0.8); rows that repeat both id
    and text once."""
    found = near_dedup.near_duplicates(docs.select("doc_id", "text"))
    firsts = found.filter("first").select(
        F.col("doc_id").alias("__id"), F.col("text_hash").alias("__hash")
    ).distinct()
    hashed = docs.withColumn("__text_hash", F.xxhash64("text"))
    same = F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("__text_hash") == F.col("__hash"))
    kept = hashed.join(firsts, same, "left_semi")
    return kept.dropDuplicates(["doc_id", "__text_hash"]).select(docs.columns)


def replace_personal_data(spark, docs, sf_dir):
    """Every document, personal data replaced by pseudonyms of the same format."""
    replaced = pseudonyms.pseudonymize(docs, PSEUDONYM_KEY)
    if "n_chars" in docs.columns:
        replaced = replaced.withColumn("n_chars", F.char_length("text").cast("long"))
    return replaced.select(docs.columns)


def pack_into_sequences(spark, docs, sf_dir):
    """Pieces of all documents with their ids and their places in sequences of 2048 ids."""
    ids = word_ids.encode(F.col("text"), public_tokenizers.path("word_bpe_49k.json"))
    pieces = packing.cut(docs.select("doc_id", "text"), ids).select(
        "doc_id", "piece", "start", "length", "ids"
    )
    return packing.pack(pieces).rows
