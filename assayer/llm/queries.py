"""The queries of this subpackage: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from assayer.llm import alignment, ann, bpe, centroids, licences, lines, mixing, neardup, oracles, pii, preferences, quality, recurrent, warc
from assayer.llm.common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

VOCABULARY = "byte_bpe_50k.tiktoken"


def query(function: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[function.__name__] = function
    return function


@query
def op1_personal_data(spark: SparkSession, folder: str) -> DataFrame:
    return pii.digest(pii.find(table(spark, folder, "documents")))


@query
def op2_near_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    return neardup.near_duplicates(table(spark, folder, "documents"), words=4)


@query
def op3_mix_sources(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mix(table(spark, folder, "documents"))


def _listed(spans: Column) -> Column:
    return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(":", s["start"].cast("string"), s["end"].cast("string"))))


@query
def op4_licence_scan(spark: SparkSession, folder: str) -> DataFrame:
    found = licences.scan(table(spark, folder, "documents"))
    lists = [F.concat_ws(",", c).alias(c) for c in ("sentences", "licences", "unmatched")]
    return found.select("doc_id", F.size("sentences").cast("bigint").alias("n_sentences"), *lists)


@query
def op5_nearest_neighbours(spark: SparkSession, folder: str) -> DataFrame:
    return ann.neighbours(table(spark, folder, "embeddings"))


@query
def op6_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    found = lines.dedup(table(spark, folder, "documents"))
    return found.select("doc_id", "n_lines", "n_gone", F.concat_ws(",", F.col("gone_lines").cast("array<string>")).alias("gone_lines"))


@query
def op7_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    return quality.judge(docs, quality.cascade(docs), report=quality.REPORTED)


@query
def op8_language_model(spark: SparkSession, folder: str) -> DataFrame:
    return recurrent.score(table(spark, folder, "documents"))


@query
def op9_byte_level_bpe(spark: SparkSession, folder: str) -> DataFrame:
    ranks = bpe.read_ranks(public_tokenizers.path(VOCABULARY))
    return bpe.digests(table(spark, folder, "documents"), ranks, public_tokenizers.PATTERN)


@query
def op10_preference_pairs(spark: SparkSession, folder: str) -> DataFrame:
    pairs = preferences.neighbours(preferences.turns(table(spark, folder, "conversations")))
    masks = [_listed(F.col(c)).alias(c) for c in ("chosen_mask", "rejected_mask")]
    return pairs.select("pair_id", F.col("prompt_turns").cast("bigint").alias("prompt_turns"), "prompt", "chosen", "rejected", *masks)


@query
def op11_web_archive(spark: SparkSession, folder: str) -> DataFrame:
    return warc.archive(table(spark, folder, "pages"))


@query
def op12_token_alignment(spark: SparkSession, folder: str) -> DataFrame:
    first, second = (bpe.read_ranks(public_tokenizers.path(name)) for name in ("byte_bpe_50k.json", "piece_bpe_32k.model"))
    return alignment.align(table(spark, folder, "documents"), first, second, public_tokenizers.PATTERN)


@query
def op13_centroid_clusters(spark: SparkSession, folder: str) -> DataFrame:
    return centroids.cluster(table(spark, folder, "embeddings"))


ORACLES["op7_quality_rules"] = oracles.QUALITY_RULES
ORACLES["op10_preference_pairs"] = oracles.PREFERENCE_PAIRS
ORACLES["op11_web_archive"] = oracles.WEB_ARCHIVE
ORACLES["op13_centroid_clusters"] = oracles.centroid_clusters()
