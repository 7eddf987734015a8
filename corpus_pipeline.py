"""Corpus pipeline: language ID, line dedup, SimHash dedup, mixing, BPE tokens.

``run`` applies the stages to ``documents``. Each stage is written as Parquet
in the shared folder and read back as the next one's documents, so a lost
executor never reaches further than the stage that is running, and the tables
that a stage staged for itself are deleted once its result is written.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pricelens import config
from pricelens.llm import bpe, langid, lines, mixing, simhash
from pricelens.llm.common import read_table, scratch_tables, staged, unpacked
from pricelens.llm.queries import BYTE_VOCABULARY, tokenizer_path

#: A text whose n-grams stand less close than this to every profile is in no known language.
MIN_SCORE = 0.2


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep documents in one of the learned languages."""
    out = langid.identify(docs)
    return unpacked(out.filter((F.col("lang_pred") != langid.UNDETERMINED) & (F.col("score") >= MIN_SCORE)))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop frequent lines; a document that this leaves without a word goes."""
    out = lines.line_dedup(docs).withColumn("n", mixing.word_count(F.col("kept_text")))
    cut = F.col("n_dropped") > 0
    new = {"text": F.col("kept_text"), "n_chars": F.length("kept_text").cast("bigint")}
    columns = [F.when(cut, new[c]).otherwise(F.col(f"row.{c}")).alias(c) if c in new else F.col(f"row.`{c}`")
               for c in docs.columns]
    return out.filter((F.col("n") > 0) | (F.col("n_dropped") == 0)).select(*columns)


def simhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group, once."""
    stays = simhash.simhash_groups(docs).filter("kept").select("id", "text_hash").distinct()
    # plain keys (NULL ids apart), so that the join's partitioning serves the last step too
    key = lambda i: [i.isNull().alias("__no_id"), F.coalesce(i, F.lit(0)).alias("__id")]
    mine = docs.select("*", *key(F.col("doc_id")), F.xxhash64(F.coalesce("text", F.lit(""))).alias("__text"))
    stays = stays.select(*key(F.col("id")), F.col("text_hash").alias("__text"))
    names = ["__no_id", "__id", "__text"]
    return mine.join(stays, names, "left_semi").dropDuplicates(names).select(*docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix: every copy of a document is a row."""
    return unpacked(mixing.mix(docs))


def bpe_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of every row's text, and whether they decode to it again."""
    path = tokenizer_path(BYTE_VOCABULARY)
    out = bpe.encode(docs, path, decoded=True)
    return unpacked(out.withColumn("n_tokens", F.size("ids").cast("bigint")).withColumn(
        "round_trip", F.col("decoded") == F.coalesce("row.text", F.lit(""))), "n_tokens", "ids", "round_trip")


STAGES = [
    ("language_id", language_id),
    ("line_dedup", line_dedup),
    ("simhash_near_dedup", simhash_dedup),
    ("source_mixing", mix_sources),
    ("bpe_tokens", bpe_tokens),
]

#: SQL cannot express profiles, bit distances and BPE merges.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    config.configure(spark)
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        with scratch_tables(spark):
            docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name}", lasting=True)
    return STAGES[-1][1](spark, docs, sf_dir)
