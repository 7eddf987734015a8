"""Registered queries of the training-data operators and their SQL.

Each query applies one operator with its production parameters to the whole
table and derives the contract's digest columns from what it returns.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pricelens import config

from . import (
    bpe,
    conversations,
    embeddings,
    langid,
    lexical,
    lines,
    mixing,
    quality,
    repeats,
    replay,
    secrets,
    simhash,
    tokens,
)
from .common import read_table

WORD_VOCABULARY = "word_bpe_49k.json"
BYTE_VOCABULARY = "byte_bpe_50k.json"
BYTE_RANKS = "byte_bpe_50k.tiktoken"


def tokenizer_path(name: str) -> str:
    """Place of a public vocabulary file; operators take any path."""
    import public_tokenizers

    return str(public_tokenizers.path(name))


def byte_pattern() -> str:
    """The pre-tokenizer pattern that goes with the ranks."""
    import public_tokenizers

    return public_tokenizers.PATTERN


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    config.configure(spark)
    return read_table(spark, sf_dir, "documents")


def op1_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    config.configure(spark)
    return embeddings.embedding_groups(read_table(spark, sf_dir, "embeddings"))


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = lines.line_dedup(_documents(spark, sf_dir))
    return out.select("row.doc_id", "n_lines", "n_dropped", F.sha2(F.col("kept_text"), 256).alias("kept_sha256"))


def op3_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = repeats.suffix_dedup(_documents(spark, sf_dir))
    return out.select("row.doc_id", "n_bytes", (F.col("n_bytes") - F.length("kept")).cast("bigint").alias("n_removed"),
                      F.size("spans").cast("bigint").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = langid.identify(_documents(spark, sf_dir))
    return out.select("row.doc_id", "held_out", "lang_pred", "score")


def op5_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = secrets.scan_secrets(_documents(spark, sf_dir))
    counts = [secrets.count_kind(F.col("base"), k).alias(f"n_{k}") for k in ("assign", "access", "hex")]
    return out.select("row.doc_id", *counts, F.sha2(secrets.spans_text(F.col("base")), 256).alias("base_sha256"),
                      secrets.spans_text(F.col("spans")).alias("spans"))


def op6_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    shards = tokens.write_tokens(_documents(spark, sf_dir), tokenizer_path(WORD_VOCABULARY))
    out = tokens.read_tokens(shards)
    return out.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op7_bpe_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = tokenizer_path(BYTE_VOCABULARY)
    out = bpe.encode(_documents(spark, sf_dir), path, carry=["doc_id"], decoded=True)
    return out.select("row.doc_id", F.size("ids").cast("bigint").alias("n_tokens"),
                      F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
                      F.sha2("decoded", 256).alias("decoded_sha256"))


def op8_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = simhash.simhash_groups(_documents(spark, sf_dir))
    return out.select(F.col("id").alias("doc_id"), F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"),
                      "component_id")


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = quality.quality_rules(_documents(spark, sf_dir))
    return out.select("row.doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                      "base_failed", "kept")


def op10_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = mixing.mix_copies(_documents(spark, sf_dir))
    return out.select(F.col("id").alias("doc_id"), "size", "source_size", "target",
                      (F.col("copies") * F.col("size")).alias("taken"))


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    config.configure(spark)
    rows = conversations.damaged(read_table(spark, sf_dir, "conversations"))
    return conversations.summaries(conversations.repair(rows))


def op12_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.ranked_search(_documents(spark, sf_dir), read_table(spark, sf_dir, "benchmark"))


def op13_merge_replay_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    path, pattern = tokenizer_path(BYTE_RANKS), byte_pattern()
    out = replay.encode(_documents(spark, sf_dir), path, pattern, carry=["doc_id"], decoded=True)
    return out.select("row.doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"),
                      F.sha2("decoded", 256).alias("decoded_sha256"))


QUERIES = {
    "op1_embedding_near_dedup": op1_embedding_near_dedup,
    "op2_line_dedup": op2_line_dedup,
    "op3_suffix_dedup": op3_suffix_dedup,
    "op4_language_id": op4_language_id,
    "op5_secret_scan": op5_secret_scan,
    "op6_token_files": op6_token_files,
    "op7_bpe_codec": op7_bpe_codec,
    "op8_simhash_near_dedup": op8_simhash_near_dedup,
    "op9_quality_rules": op9_quality_rules,
    "op10_source_mixing": op10_source_mixing,
    "op11_conversation_repair": op11_conversation_repair,
    "op12_lexical_search": op12_lexical_search,
    "op13_merge_replay_codec": op13_merge_replay_codec,
}
