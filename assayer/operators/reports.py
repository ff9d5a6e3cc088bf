"""Reporting views over the staging and metrics tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assayer.functions.numbers import ratio, rounded
from assayer.operators.ranking import competition_rank

# Averaged columns, their names in the view, and decimals.
PROFILE = (
    ("word_count", "avg_words", 2),
    ("lexical_diversity", "avg_lexical_diversity", 4),
    ("avg_sentence_length", "avg_sentence_len", 2),
    ("flesch_reading_ease", "avg_flesch_reading_ease", 2),
    ("gunning_fog_index", "avg_gunning_fog", 2),
    ("predictability_score", "avg_predictability", 4),
    ("burstiness", "avg_burstiness", 4),
    ("sentiment_score", "avg_sentiment", 4),
)


def label_text(label: str = "label") -> Column:
    """A missing label reads like label 0."""
    return F.when(F.col(label) == 1, "AI-Generated").otherwise("Human-Written")


def _mean(column: str, digits: int) -> Column:
    return rounded(F.avg(column), digits)


def stylometrics_by_type(staging: DataFrame, ordered: bool = True) -> DataFrame:
    """Mean profile by content type and label."""
    view = (
        staging.groupBy("content_type", "label")
        .agg(
            F.count(F.lit(1)).alias("total_samples"),
            *[_mean(c, digits).alias(name) for c, name, digits in PROFILE if c in staging.columns],
        )
        .withColumn("label_desc", label_text())
    )
    return view.orderBy(F.asc_nulls_last("content_type"), F.asc_nulls_last("label")) if ordered else view


def readability_contrast(staging: DataFrame) -> DataFrame:
    """Readability of the two kinds of author, with the sample deviation."""
    means = [("passive_voice_ratio", "mean_passive_voice_ratio", 4), ("predictability_score", "mean_predictability", 4)]
    return (
        staging.groupBy("label")
        .agg(
            F.count(F.lit(1)).alias("n_records"),
            _mean("flesch_reading_ease", 2).alias("mean_reading_ease"),
            rounded(F.stddev_samp("flesch_reading_ease"), 2).alias("std_reading_ease"),
            _mean("gunning_fog_index", 2).alias("mean_fog_index"),
            *[_mean(c, digits).alias(name) for c, name, digits in means if c in staging.columns],
        )
        .withColumn("author_type", label_text())
        .drop("label")
    )


def model_leaderboard(model_metrics: DataFrame) -> DataFrame:
    """Models ranked by weighted F1, an unknown one first, as a descending sort puts NULLs."""
    ranked = competition_rank(model_metrics, "f1_weighted")
    return ranked.select(
        "classifier",
        rounded(F.col("accuracy"), 4).alias("test_accuracy"),
        rounded(F.col("f1_weighted"), 4).alias("f1_weighted"),
        rounded(F.col("f1_macro"), 4).alias("f1_macro"),
        rounded(F.col("roc_auc"), 4).alias("roc_auc"),
        *[c for c in ("run_id", "evaluated_at") if c in model_metrics.columns],
        "rank",
    ).orderBy("rank")


def classifier_comparison(metrics: DataFrame) -> DataFrame:
    """Metrics at four decimals, best weighted F1 first."""
    columns = ("accuracy", "f1_weighted", "f1_macro", "roc_auc")
    return metrics.select("classifier", *[rounded(F.col(c), 4).alias(c) for c in columns]).orderBy(
        F.desc("f1_weighted"), "classifier"
    )


def staging_enriched(staging: DataFrame, key: str = "_row_key") -> DataFrame:
    """Staging rows with characters per word and reading ease on a scale of one."""
    kept = [
        "content_type", "label", "word_count", "character_count", "lexical_diversity", "avg_sentence_length",
        "predictability_score", "burstiness", "sentiment_score", "_staged_at_utc",
    ]
    return staging.select(
        key,
        *[c for c in kept if c in staging.columns],
        rounded(ratio(F.col("character_count"), F.col("word_count")), 2).alias("chars_per_word"),
        rounded(F.col("flesch_reading_ease") / 100.0, 4).alias("flesch_normalized"),
    )


def raw_audit(raw: DataFrame) -> DataFrame:
    """Rows per run, batch and source file."""
    return raw.groupBy(
        F.col("_pipeline_run_id").alias("pipeline_run_id"),
        F.col("_batch_id").alias("batch_id"),
        F.col("_source_file").alias("source_file"),
        F.col("_source_checksum").alias("source_checksum"),
    ).agg(F.count(F.lit(1)).alias("row_count"), F.max("_ingested_at_utc").alias("ingested_at_utc"))


def run_log_status(log: DataFrame) -> DataFrame:
    """The current state of each run from an append-only log (run_id, at, seq, stage, status, notes)."""
    latest = F.max_by(F.struct("at", "stage", "status", "notes"), F.struct("at", "seq")).alias("last")
    finished = F.col("last.status").isin("SUCCESS", "FAILED")
    return (
        log.groupBy("run_id")
        .agg(F.min("at").alias("started_at"), latest)
        .select(
            "run_id",
            "started_at",
            F.when(finished, F.col("last.at")).alias("completed_at"),
            F.col("last.status").alias("status"),
            F.col("last.stage").alias("stage"),
            F.col("last.notes").alias("notes"),
        )
    )
