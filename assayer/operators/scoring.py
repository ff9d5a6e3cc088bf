"""Metrics of scored rows: (classifier, label, prediction, score) tables in, metric tables out."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assayer.functions.numbers import ratio_or_zero
from assayer.operators.ranking import running_totals
from assayer.scratch import written

METRICS = ("accuracy", "f1_weighted", "f1_macro", "f1_binary", "roc_auc")


def confusion_matrix(scored: DataFrame, by: Sequence[str] = ("classifier",)) -> DataFrame:
    """(by.., label, prediction, n) over the full grid of the classes that occur in `by`."""
    by = list(by)
    counted = (
        scored.where(F.col("label").isNotNull() & F.col("prediction").isNotNull())
        .groupBy(*by, "label", "prediction")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    # One row per pair of classes, read for the classes and for the counts.
    counts = written(counted, "pairs")
    classes = counts.groupBy(*by).agg(
        F.array_union(F.collect_set("label"), F.collect_set("prediction")).alias("_classes")
    )
    grid = classes.withColumn("label", F.explode("_classes")).withColumn("prediction", F.explode("_classes"))
    zero = F.lit(0).cast("bigint")
    return (
        grid.join(counts, [*by, "label", "prediction"], "left")
        .select(*by, "label", "prediction", F.coalesce("n", zero).alias("n"))
    )


def class_scores(confusion: DataFrame, by: Sequence[str] = ("classifier",)) -> DataFrame:
    """(by.., class, precision, recall, f1, support); 0 where a ratio has no denominator."""
    by = list(by)
    n, zero = F.col("n"), F.lit(0).cast("bigint")
    hit = F.when(F.col("label") == F.col("prediction"), n).otherwise(zero)

    def side(column: str, actual: Column, predicted: Column, hits: Column) -> Column:
        return F.struct(
            F.col(column).alias("class"), actual.alias("actual"), predicted.alias("predicted"), hits.alias("hits")
        )

    # Every pair counts once for its label and once for its prediction.
    sides = confusion.select(
        *by, F.explode(F.array(side("label", n, zero, hit), side("prediction", zero, n, zero))).alias("side")
    )
    totals = sides.groupBy(*by, F.col("side.class").alias("class")).agg(
        F.sum("side.hits").alias("hits"),
        F.sum("side.actual").alias("support"),
        F.sum("side.predicted").alias("predicted"),
    )
    hits, support, predicted = F.col("hits"), F.col("support"), F.col("predicted")
    return totals.select(
        *by,
        "class",
        ratio_or_zero(hits.cast("double"), predicted.cast("double")).alias("precision"),
        ratio_or_zero(hits.cast("double"), support.cast("double")).alias("recall"),
        ratio_or_zero((2 * hits).cast("double"), (predicted + support).cast("double")).alias("f1"),
        "support",
        "hits",
    )


def _weighted(column: str) -> Column:
    return ratio_or_zero(F.sum(F.col(column) * F.col("support")), F.sum("support").cast("double"))


def classification_report(confusion: DataFrame, by: Sequence[str] = ("classifier",)) -> DataFrame:
    """(by.., class, precision, recall, f1, support) with accuracy, macro avg and weighted avg rows."""
    by = list(by)
    scores = class_scores(confusion, by)
    rows = F.sum("support")
    accuracy = ratio_or_zero(F.sum("hits").cast("double"), rows.cast("double"))

    def line(name: str, precision: Column, recall: Column, f1: Column) -> Column:
        return F.struct(
            F.lit(name).alias("class"), precision.alias("precision"), recall.alias("recall"), f1.alias("f1"), rows.alias("support")
        )

    overall = scores.groupBy(*by).agg(
        F.array(
            line("accuracy", accuracy, accuracy, accuracy),
            line("macro avg", F.avg("precision"), F.avg("recall"), F.avg("f1")),
            line("weighted avg", _weighted("precision"), _weighted("recall"), _weighted("f1")),
        ).alias("lines")
    )
    flat = overall.select(*by, F.explode("lines").alias("line")).select(*by, "line.*")
    return scores.drop("hits").withColumn("class", F.col("class").cast("string")).unionByName(flat)


def _curve(scored: DataFrame, by: Sequence[str], positive: int) -> DataFrame:
    """Per distinct score: positives and negatives at it, up to it, and in all."""
    is_positive = F.col("label") == positive
    per_score = (
        scored.where(F.col("label").isNotNull() & F.col("score").isNotNull())
        .groupBy(*by, "score")
        .agg(F.count_if(is_positive).alias("positives"), F.count_if(~is_positive).alias("negatives"))
    )
    return running_totals(
        per_score,
        "score",
        {"positives_upto": "positives", "negatives_upto": "negatives"},
        by,
        {"all_positives": "positives", "all_negatives": "negatives"},
    )


def roc_auc(scored: DataFrame, by: Sequence[str] = ("classifier",), positive: int = 1) -> DataFrame:
    """(by.., roc_auc): the share of (positive, negative) pairs ranked right, ties counting half.

    NULL with one class only.
    """
    by = list(by)
    # Decimals, as pairs of rows outgrow a bigint; twice the pairs, so that a tie is a whole number.
    twice = F.col("positives").cast("decimal(19,0)") * (
        2 * F.col("negatives_upto") - F.col("negatives")
    ).cast("decimal(19,0)")
    curve = _curve(scored, by, positive)
    pairs = F.sum("positives").cast("double") * F.sum("negatives").cast("double")
    return curve.groupBy(*by).agg(
        F.try_divide(F.sum(twice).cast("double") / 2, pairs).alias("roc_auc")
    )


def threshold_sweep(scored: DataFrame, by: Sequence[str] = ("classifier",), positive: int = 1) -> DataFrame:
    """(by.., threshold, true_positives, false_positives, recall_positive, recall_negative).

    A row is predicted positive at `score >= threshold`; every distinct score is a threshold.
    """
    by = list(by)
    kept_out = F.col("negatives_upto") - F.col("negatives")
    found = F.col("all_positives") - F.col("positives_upto") + F.col("positives")
    return _curve(scored, by, positive).select(
        *by,
        F.col("score").alias("threshold"),
        found.alias("true_positives"),
        (F.col("all_negatives") - kept_out).alias("false_positives"),
        ratio_or_zero(found.cast("double"), F.col("all_positives").cast("double")).alias("recall_positive"),
        ratio_or_zero(kept_out.cast("double"), F.col("all_negatives").cast("double")).alias("recall_negative"),
    )


def balanced_threshold(sweep: DataFrame, by: Sequence[str] = ("classifier",)) -> DataFrame:
    """The threshold whose class recalls are closest; the lowest of equals."""
    gap = F.abs(F.col("recall_positive") - F.col("recall_negative"))
    chosen = F.min(F.struct(gap.alias("recall_gap"), "threshold", "recall_positive", "recall_negative")).alias("c")
    return sweep.groupBy(*by).agg(chosen).select(*by, "c.*")


def metrics(
    scored: DataFrame, by: Sequence[str] = ("classifier",), positive: int = 1, wanted: Sequence[str] = METRICS
) -> DataFrame:
    """(by.., accuracy, f1_weighted, f1_macro, f1_binary, roc_auc), one row per classifier; those `wanted`, in this order.

    All but the last come from the confusion matrix; the curve is planned only if it is wanted.
    """
    by = list(by)
    scores = class_scores(confusion_matrix(scored, by), by)
    f1 = scores.groupBy(*by).agg(
        ratio_or_zero(F.sum("hits").cast("double"), F.sum("support").cast("double")).alias("accuracy"),
        _weighted("f1").alias("f1_weighted"),
        F.avg("f1").alias("f1_macro"),
        F.coalesce(F.max(F.when(F.col("class") == positive, F.col("f1"))), F.lit(0.0)).alias("f1_binary"),
    )
    every = f1.join(roc_auc(scored, by, positive), by, "left") if "roc_auc" in wanted else f1
    return every.select(*by, *[m for m in METRICS if m in wanted])


def long_metrics(wide: DataFrame, by: Sequence[str] = ("classifier",)) -> DataFrame:
    """(by.., metric, value)."""
    return wide.unpivot(list(by), [m for m in METRICS if m in wide.columns], "metric", "value")


def cv_summary(per_fold: DataFrame, by: Sequence[str] = ("classifier",)) -> DataFrame:
    """(by.., metric, mean, std) of (by.., fold, metric, value); population deviation."""
    return per_fold.groupBy(*by, "metric").agg(F.avg("value").alias("mean"), F.stddev_pop("value").alias("std"))


def best_model(wide: DataFrame, metric: str = "f1_weighted") -> DataFrame:
    """The row with the highest metric; of equals the first by name. A NULL metric never wins."""
    return wide.where(F.col(metric).isNotNull()).orderBy(F.desc(metric), F.asc("classifier")).limit(1)


def predictions_extract(test: DataFrame, scored: DataFrame, best: DataFrame, key: str) -> DataFrame:
    """The test rows with the prediction of the best classifier, attached by key."""
    winner = scored.join(F.broadcast(best.select("classifier")), "classifier", "left_semi")
    predicted = winner.select(key, F.col("prediction").alias("_predicted_label"), F.col("classifier").alias("_classifier"))
    return test.join(predicted, key)
