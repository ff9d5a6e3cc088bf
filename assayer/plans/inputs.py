"""The given tables in the shape the operators expect."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from assayer.functions.text import with_burstiness, with_readability, with_stylometrics
from assayer.sources.audit import Run, with_audit
from assayer.spec import STYLOMETRY

RUN = Run("run-0001", "2024-01-31 00:00:00")

# The text scorers of the original table are not computed here; all other features are.
SPEC = replace(
    STYLOMETRY.without("grammar_errors", "passive_voice_ratio", "predictability_score", "sentiment_score"),
    hashed=("text_content", "content_type", "character_count", "label"),
)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def texts(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents").select(
        F.col("doc_id").alias("_row_key"), F.col("text").alias("text_content"), F.col("lang").alias("content_type")
    )
    return documents


def _labels(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "labels").select(
        F.col("doc_id").alias("_row_key"), F.col("quality").cast("bigint").alias("label")
    )


def labelled_documents(spark: SparkSession, folder: str) -> DataFrame:
    """The texts with their labels and every other column of their documents."""
    documents = table(spark, folder, "documents").withColumnsRenamed({"doc_id": "_row_key", "text": "text_content", "lang": "content_type"})
    joined = documents.join(_labels(spark, folder), "_row_key", "left")
    return joined.select("_row_key", "text_content", "content_type", "label", "source", "n_chars")


def with_features(df: DataFrame) -> DataFrame:
    """All computed stylometric columns; readability is defined for English only."""
    english = F.coalesce(F.col("content_type") == "en", F.lit(False))
    return with_burstiness(with_readability(with_stylometrics(df), english=english))


PARTS = 8  # tasks among which the rows of one key are dealt out


def dealt_with_labels(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """`documents` with their labels, dealt out evenly by the one shuffle that also brings the labels to them.

    A Parquet row group is read by one task, and a file may be a single one; a join with a small table leaves it so. Texts
    cross the network once and are not sorted: the labels, narrow, are copied to each part of a key and looked up by hash.
    """
    part = F.pmod(F.xxhash64(*documents.columns), F.lit(PARTS)).cast("int")
    dealt = documents.withColumn("_part", part).repartition("_row_key", "_part")
    copied = labels.withColumn("_part", F.explode(F.sequence(F.lit(0), F.lit(PARTS - 1))))
    return dealt.join(copied.hint("shuffle_hash"), ["_row_key", "_part"], "left").drop("_part")


def source(spark: SparkSession, folder: str) -> DataFrame:
    """What the original pipeline receives as its source file."""
    return with_features(dealt_with_labels(texts(spark, folder), _labels(spark, folder)))


def raw(spark: SparkSession, folder: str) -> DataFrame:
    return with_audit(source(spark, folder), RUN, source_file="documents.parquet", hashed=SPEC.hashed)


def scored_orders(spark: SparkSession, folder: str) -> DataFrame:
    return score_orders(table(spark, folder, "orders"))


def score_orders(orders: DataFrame, *keep: str) -> DataFrame:
    """Orders scored by three rules: (o_orderkey, keep.., label, classifier, prediction, score).

    One rule has five distinct scores only, the others up to one per row.
    """
    price = F.col("o_totalprice")
    urgency = 6.0 - F.substring("o_orderpriority", 1, 1).cast("double")
    day = F.datediff(F.col("o_orderdate"), F.lit("1995-01-01").cast("date")).cast("double")

    def rule(name: str, prediction: Column, score: Column) -> Column:
        return F.struct(F.lit(name).alias("classifier"), prediction.cast("int").alias("prediction"), score.alias("score"))

    rules = F.array(
        rule("price", price >= 250000, price),
        rule("urgency", urgency >= 3, urgency),
        rule("recency", day >= 1200, day),
    )
    label = (F.col("o_orderstatus") == "F").cast("int").alias("label")
    return orders.select("o_orderkey", *keep, label, F.explode(rules).alias("r")).select("o_orderkey", *keep, "label", "r.*")
