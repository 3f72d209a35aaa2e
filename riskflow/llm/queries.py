"""One query per operator over its whole table: ``(spark, sf_dir) -> DataFrame``."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskflow.llm import (
    alignment,
    bpe,
    fingerprints,
    manifest,
    near_dedup,
    packing,
    ppm,
    pseudonyms,
    sharding,
    token_counts,
    top_k,
    toxicity,
    url_filter,
    word_ids,
)
from riskflow.llm.workers import find_package

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    @wraps(function)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        find_package(spark)
        return function(spark, sf_dir)

    QUERIES[function.__name__] = run
    return run


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op1_best_fit_packing(spark, sf_dir):
    """Pieces of all documents in sequences of at most 2048 ids."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    ids = word_ids.encode(F.col("text"), public_tokenizers.path("word_bpe_49k.json"))
    pieces = packing.cut(docs, ids).select(
        "doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32")
    )
    return packing.pack(pieces).rows


@query
def op4_byte_bpe(spark, sf_dir):
    """Encode every whole text, then decode the ids."""
    ranks = public_tokenizers.path("byte_bpe_50k.tiktoken")
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    coded = docs.select("doc_id", bpe.encode_and_decode(F.col("text"), ranks).alias("coded"))
    return coded.select(
        "doc_id",
        bpe.id_count(F.col("coded.ids")).alias("n_tokens"),
        F.sha2("coded.ids", 256).alias("ids_sha256"),
        F.sha2("coded.decoded", 256).alias("decoded_sha256"),
    )


@query
def op6_token_counts(spark, sf_dir):
    """Bytes and tokens of every whole text."""
    tokenizer = public_tokenizers.path("byte_bpe_50k.json")
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    counted = docs.select(
        "doc_id",
        F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"),
        token_counts.token_count(F.col("text"), tokenizer).alias("n_tokens"),
    )
    return counted.withColumn("over_limit", F.col("n_tokens") > 512)


# The rule book that the contract of the query states.
URL_RULES = [
    ("net", "/", "block"),
    ("example.net", "/en/", "allow"),
    ("example.com", "/de/", "block"),
    ("org", "/fr/", "allow"),
]


@query
def op5_url_filter(spark, sf_dir):
    """Verdict of every page by rules and by its aliases."""
    rules = spark.sql(f"SELECT * FROM VALUES {', '.join(map(str, URL_RULES))} AS r(host, path, action)")
    pages = _table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return url_filter.judge(pages, rules).select("page_id", "host", "path", "rule", "verdict")


@query
def op8_winnowing(spark, sf_dir):
    """Fingerprints of every whole text and of its edited text, and their likeness."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    pairs = fingerprints.edited_and_next(docs)
    own = fingerprints.winnow_characters(pairs, "text", "hashes", "positions")
    both = fingerprints.winnow_characters(own, "edited", "edited_hashes", "edited_positions")
    return both.select(
        "doc_id",
        F.char_length("text").cast("long").alias("n_chars"),
        F.sha2(F.col("edited"), 256).alias("edited_sha256"),
        fingerprints.as_text(F.col("hashes")).alias("fingerprint"),
        fingerprints.as_text(F.col("edited_hashes")).alias("edited_fingerprint"),
        fingerprints.likeness(F.col("hashes"), F.col("edited_hashes")).alias("near_edited"),
        fingerprints.likeness(F.col("hashes"), F.col("next_hashes")).alias("near_next"),
    )


SHARD_BYTES = 16 << 20


@query
def op9_extendible_sharding(spark, sf_dir):
    """Shards of at most 16 MiB of text."""
    docs = _table(spark, sf_dir, "documents").select(
        "doc_id", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes")
    )
    return sharding.assign(docs, F.col("doc_id"), F.col("n_bytes"), SHARD_BYTES).select(
        "doc_id", "n_bytes", "shard", "depth", "shard_bytes", "shard_docs"
    )


# For tests; a real run takes its own secret.
PSEUDONYM_KEY = "example key"


@query
def op7_feistel_pseudonyms(spark, sf_dir):
    """All documents with personal data replaced by pseudonyms of the same format."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return pseudonyms.pseudonymize(docs, PSEUDONYM_KEY, count="n_replaced")


@query
def op2_norm_bucketed_top_k(spark, sf_dir):
    """The ten highest inner products for every hundredth vector."""
    rows = _table(spark, sf_dir, "embeddings")
    vectors = rows.select("vec_id", top_k.scaled(F.col("embedding")).alias("v"))
    return top_k.top_k(vectors, F.col("vec_id") % 100 == 0, 10)


# From this score on a document counts as toxic.
TOXIC_SCORE = 0.7


@query
def op10_toxic_passages(spark, sf_dir):
    """Toxicity of every whole text, learned from labels that are not held out."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.learn(docs, _table(spark, sf_dir, "labels"))
    scored = docs.select(
        "doc_id",
        toxicity.held_out(F.col("doc_id")).alias("held_out"),
        toxicity.score(F.col("text"), model).alias("found"),
    )
    return scored.select(
        "doc_id",
        "held_out",
        "found.score",
        (F.col("found.score") >= TOXIC_SCORE).cast("int").alias("predicted"),
        F.size("found.passages").alias("n_passages"),
    )


@query
def op3_minhash_near_dedup(spark, sf_dir):
    """Components of documents linked by four-word shingles, four fifths in common."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    found = near_dedup.near_duplicates(docs, shingle=4)
    kept = F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False))
    return found.select("doc_id", "n_shingles", "component_id", kept.alias("kept"))


# Every fifth document, by the digest of its id, is tampered with.
TAMPERED = 5


@query
def op12_merkle_manifest(spark, sf_dir):
    """Leaf, subroot, root and proof of every document, and the root of a tampered copy."""
    docs = _table(spark, sf_dir, "documents")
    others = [F.col(name) for name in ("doc_id", "source", "lang", "n_chars")]
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % TAMPERED == 0
    lower = manifest.ascii_lower(F.col("text"))
    leaves = docs.select(
        F.col("source").alias("group"),
        F.col("doc_id").alias("key"),
        manifest.leaf([*others, F.col("text")]).alias("hash"),
        F.when(tampered, manifest.leaf([*others, lower])).alias("changed"),
    )
    proven = manifest.manifest(leaves)
    start = F.coalesce("changed", "hash")
    return proven.select(
        F.col("key").alias("doc_id"),
        F.col("hash").alias("leaf"),
        "subroot",
        "root",
        manifest.proof_digest(F.col("proof")).alias("proof_sha256"),
        manifest.folded(start, F.col("proof")).alias("folded_root"),
    ).withColumn("verified", F.col("folded_root") == F.col("root"))


@query
def op11_ppm_scores(spark, sf_dir):
    """Probability of every whole text under a byte trie, and under its words."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    crc = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    held_out = F.coalesce(crc % 5 == 1, F.lit(False))
    scored = ppm.score(docs, ~held_out)
    return scored.select(
        "doc_id", held_out.alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score"
    )


@query
def op13_tokenizer_alignment(spark, sf_dir):
    """Groups and links of two tokenizers' tokens in every whole text."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    a, b = (public_tokenizers.path(name) for name in ("byte_bpe_50k.json", "piece_bpe_32k.model"))
    return alignment.aligned(docs, a, b)
