"""From raw documents to tokens, in five stages; each one works on all that the one before has kept."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from assayer.llm import bpe, lines, mixing, neardup, quality
from assayer.llm.common import SPACES
from assayer.scratch import written

VOCABULARY = "byte_bpe_50k.tiktoken"


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no rule rejects; a NULL text has too few words."""
    judged = quality.judge(docs, quality.cascade(docs), keep=docs.columns, verdict="_kept")
    return judged.where("_kept").select(*docs.columns)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that an earlier document has; those left without any line go."""
    found = lines.dedup(docs)
    emptied = (F.col("n_gone") > 0) & (F.btrim("text", F.lit(SPACES)) == "")
    left = found.where(F.coalesce(~emptied, F.lit(True)))
    if "n_chars" in docs.columns:
        left = left.withColumn("n_chars", F.when(F.col("n_gone") > 0, F.length("text").cast("bigint")).otherwise(F.col("n_chars")))
    return left.select(*docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    found = neardup.near_duplicates(docs)
    gone = written(found.where(~F.col("kept")).select(F.col("doc_id").alias("_id")).distinct(), "near-copies")
    return docs.join(gone, F.col("doc_id") == F.col("_id"), "left_anti").select(*docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix: a document stands in it as often as it is taken. Rows that share a key are taken alike."""
    return mixing.mixed(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, source, n_tokens, ids_sha256, decoded_sha256, ids) of each document of the mix."""
    ranks = bpe.read_ranks(public_tokenizers.path(VOCABULARY))
    return bpe.digests(docs, ranks, public_tokenizers.PATTERN, keep=("doc_id", "source"), with_ids=True)


STAGES = [
    ("quality rules", quality_rules),
    ("line dedup", line_dedup),
    ("near-duplicate dedup", near_dedup),
    ("mixing", mix_sources),
    ("byte-level BPE", tokens),
]

ORACLE_SQL = None  # SQL can state neither the encoding nor the mix


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
