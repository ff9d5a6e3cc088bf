"""Metrics of scored rows, leaderboards, the reproducibility gate, and Spark ML."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from assayer.functions.numbers import rounded
from assayer.operators import boosting, checks, models, reports, scoring
from assayer.operators.many_fits import ALL, FOLD
from assayer.operators.curate import stratified_folds, stratified_split
from assayer.plans import inputs, workspace
from assayer.plans.queries_curate import _curated
from assayer.plans.registry import fixed, query, r, with_
from assayer.plans.shared_sql import SCORED, TO_STAGING, all_metrics, auc, class_scores, confusion, curve, ordered_keys, split
from assayer.scratch import written
from assayer.spec import CLASSIFIERS, ModelSpec, Settings

_SETTINGS = Settings()


def _round(df: DataFrame, digits: int, *columns: str) -> DataFrame:
    return df.withColumns({c: rounded(F.col(c), digits) for c in columns})


# ---------------------------------------------------------------------------
# metrics
# ---------------------------------------------------------------------------


@query("confusion_matrix", with_(SCORED, confusion(), select="SELECT classifier, label, prediction, n FROM confusion"))
def confusion_matrix(spark: SparkSession, folder: str) -> DataFrame:
    return scoring.confusion_matrix(inputs.scored_orders(spark, folder))


def _lines(precision: str, recall: str, f1: str, name: str) -> str:
    return f"""SELECT classifier, '{name}' AS class, {r(precision, 6)} AS "precision", {r(recall, 6)} AS recall, {r(f1, 6)} AS f1,
CAST(sum(support) AS BIGINT) AS support FROM class_scores GROUP BY classifier"""


def _mean(c: str) -> str:
    return f"sum({c} * support) / CAST(sum(support) AS DOUBLE)"


_ACCURACY = "CAST(sum(hits) AS DOUBLE) / CAST(sum(support) AS DOUBLE)"


@query(
    "classification_report",
    with_(
        SCORED, confusion(), class_scores(),
        select="\nUNION ALL\n".join(
            [
                f'SELECT classifier, CAST(class AS VARCHAR) AS class, {r(chr(34) + "precision" + chr(34), 6)} AS "precision", '
                f'{r("recall", 6)} AS recall, {r("f1", 6)} AS f1, support FROM class_scores',
                _lines(_ACCURACY, _ACCURACY, _ACCURACY, "accuracy"),
                _lines('avg("precision")', "avg(recall)", "avg(f1)", "macro avg"),
                _lines(_mean('"precision"'), _mean("recall"), _mean("f1"), "weighted avg"),
            ]
        ),
    ),
)
def classification_report(spark: SparkSession, folder: str) -> DataFrame:
    matrix = scoring.confusion_matrix(inputs.scored_orders(spark, folder))
    return _round(scoring.classification_report(matrix), 6, "precision", "recall", "f1")


@query("roc_auc", with_(SCORED, curve(), auc(), select=f"SELECT classifier, {r('roc_auc', 9)} AS roc_auc FROM auc"))
def roc_auc(spark: SparkSession, folder: str) -> DataFrame:
    return _round(scoring.roc_auc(inputs.scored_orders(spark, folder)), 9, "roc_auc")


_SWEEP = """
sweep AS (
  SELECT classifier, score AS threshold, p_all - p_upto + p AS true_positives, n_all - n_upto + n AS false_positives,
         CAST(p_all - p_upto + p AS DOUBLE) / CAST(p_all AS DOUBLE) AS recall_positive,
         CAST(n_upto - n AS DOUBLE) / CAST(n_all AS DOUBLE) AS recall_negative
  FROM curve)
"""


@query("threshold_sweep", with_(SCORED, curve(), _SWEEP, select="SELECT * FROM sweep"))
def threshold_sweep(spark: SparkSession, folder: str) -> DataFrame:
    return scoring.threshold_sweep(inputs.scored_orders(spark, folder))


@query(
    "balanced_threshold",
    with_(
        SCORED, curve(), _SWEEP,
        select=f"""
SELECT classifier, {r("recall_gap", 9)} AS recall_gap, threshold, {r("recall_positive", 9)} AS recall_positive,
       {r("recall_negative", 9)} AS recall_negative
FROM (SELECT *, abs(recall_positive - recall_negative) AS recall_gap,
             row_number() OVER (PARTITION BY classifier ORDER BY abs(recall_positive - recall_negative), threshold) AS rn FROM sweep)
WHERE rn = 1""",
    ),
)
def balanced_threshold(spark: SparkSession, folder: str) -> DataFrame:
    chosen = scoring.balanced_threshold(scoring.threshold_sweep(inputs.scored_orders(spark, folder)))
    return _round(chosen, 9, "recall_gap", "recall_positive", "recall_negative")


_WIDE = ("accuracy", "f1_weighted", "f1_macro", "roc_auc")


@query(
    "classifier_comparison",
    with_(
        SCORED, *all_metrics(),
        select=f"SELECT classifier, {', '.join(f'{r(m, 4)} AS {m}' for m in _WIDE)} FROM metrics",
    ),
)
def classifier_comparison(spark: SparkSession, folder: str) -> DataFrame:
    return reports.classifier_comparison(scoring.metrics(inputs.scored_orders(spark, folder)))


@query(
    "best_model",
    with_(
        SCORED, *all_metrics(),
        select=f"""
SELECT classifier, {r("f1_weighted", 6)} AS f1_weighted, {r("f1_binary", 6)} AS f1_binary FROM metrics
ORDER BY f1_weighted DESC, classifier LIMIT 1""",
    ),
)
def best_model(spark: SparkSession, folder: str) -> DataFrame:
    best = scoring.best_model(scoring.metrics(inputs.scored_orders(spark, folder), wanted=("f1_weighted", "f1_binary")))
    return _round(best.select("classifier", "f1_weighted", "f1_binary"), 6, "f1_weighted", "f1_binary")


@query(
    "predictions_extract",
    with_(
        SCORED, *all_metrics(),
        "best AS (SELECT classifier FROM metrics ORDER BY f1_weighted DESC, classifier LIMIT 1)",
        select="""
SELECT o_orderkey, o_orderstatus, o_totalprice, prediction AS _predicted_label, classifier AS _classifier
FROM orders JOIN scored USING (o_orderkey) JOIN best USING (classifier)""",
    ),
)
def predictions_extract(spark: SparkSession, folder: str) -> DataFrame:
    scored = inputs.scored_orders(spark, folder)
    best = scoring.best_model(scoring.metrics(scored, wanted=("f1_weighted",)))
    orders = inputs.table(spark, folder, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    return scoring.predictions_extract(orders, scored, best, "o_orderkey")


# One run per month of the order date.
_MONTHS = """
months AS (SELECT s.*, strftime(o.o_orderdate, '%Y-%m') AS run_id FROM scored s JOIN orders o USING (o_orderkey))
"""


@query(
    "model_leaderboard",
    with_(
        SCORED, _MONTHS, *all_metrics("classifier, run_id", "months"),
        select=f"""
SELECT classifier, run_id, {r("accuracy", 4)} AS test_accuracy, {r("f1_weighted", 4)} AS f1_weighted,
       {r("f1_macro", 4)} AS f1_macro, {r("roc_auc", 4)} AS roc_auc,
       rank() OVER (ORDER BY {r("f1_weighted", 9)} DESC NULLS FIRST) AS rank
FROM metrics""",
    ),
)
def model_leaderboard(spark: SparkSession, folder: str) -> DataFrame:
    orders = inputs.table(spark, folder, "orders").withColumn("run_id", F.date_format("o_orderdate", "yyyy-MM"))
    scored = written(inputs.score_orders(orders, "run_id").drop("o_orderkey"), "scored")
    # Equal models must tie, so the noise of a parallel sum is rounded away before the ranking.
    per_run = _round(scoring.metrics(scored, ["classifier", "run_id"]), 9, "f1_weighted")
    return reports.model_leaderboard(written(per_run, "model_metrics"))


_FOLDED = f"""
folds AS (
  SELECT o_orderkey, ((rn - 1) * 5) // n AS fold
  FROM (SELECT o_orderkey, count(*) OVER (PARTITION BY o_orderstatus) AS n,
               row_number() OVER (PARTITION BY o_orderstatus ORDER BY {ordered_keys("o_orderkey")}) AS rn FROM orders)),
folded AS (SELECT s.*, f.fold FROM scored s JOIN folds f USING (o_orderkey))
"""


@query(
    "cv_summary",
    with_(
        SCORED, _FOLDED, *all_metrics("classifier, fold", "folded"),
        "long AS (UNPIVOT (SELECT classifier, fold, accuracy, f1_weighted, roc_auc FROM metrics) ON accuracy, f1_weighted, roc_auc "
        "INTO NAME metric VALUE value)",
        select=f"SELECT classifier, metric, {r('avg(value)', 6)} AS mean, {r('stddev_pop(value)', 6)} AS std FROM long GROUP BY ALL",
    ),
)
def cv_summary(spark: SparkSession, folder: str) -> DataFrame:
    folded = stratified_folds(inputs.table(spark, folder, "orders"), "o_orderstatus", "o_orderkey", name="fold")
    by = ["classifier", "fold"]
    per_fold = scoring.metrics(written(inputs.score_orders(folded, "fold").drop("o_orderkey"), "scored"), by)
    long = scoring.long_metrics(per_fold.select(*by, "accuracy", "f1_weighted", "roc_auc"), by)
    return _round(scoring.cv_summary(long), 6, "mean", "std")


_SPLITS = split("orders", "o_orderstatus", "o_orderkey")
_PARTED = "parted AS (SELECT s.*, p._split FROM scored s JOIN split p USING (o_orderkey))"


@query(
    "check_reproducibility",
    with_(
        SCORED, _SPLITS, _PARTED, *all_metrics("classifier, _split", "parted"),
        f"""
pairs AS (
  SELECT b.classifier, a.f1_weighted AS act, CASE WHEN b.classifier = 'urgency' THEN NULL ELSE {r("b.f1_weighted", 4)} END AS expected
  FROM (SELECT * FROM metrics WHERE _split = 'train') b LEFT JOIN (SELECT * FROM metrics WHERE _split = 'test') a USING (classifier))
""",
        select=f"""
SELECT 'reproducibility.' || classifier AS "check",
       CASE WHEN expected IS NULL THEN 'WARN' WHEN CAST(abs(act - expected) AS DECIMAL(30,10)) <= 0.0010 THEN 'PASS' ELSE 'FAIL' END AS status,
       CASE WHEN expected IS NULL THEN 'f1_weighted is not known on both sides'
            ELSE 'f1_weighted ' || {fixed("act", 4)} || ' for ' || {fixed("expected", 4)}
                 || ', apart by ' || {fixed("abs(act - expected)", 4)} || ', 0.001 allowed' END AS details,
       {r("abs(act - expected)", 6)} AS value
FROM pairs""",
    ),
)
def check_reproducibility(spark: SparkSession, folder: str) -> DataFrame:
    """The test split against a baseline from the training split; one baseline value is unknown."""
    split_orders = stratified_split(inputs.table(spark, folder, "orders"), "o_orderstatus", "o_orderkey")
    scored = written(inputs.score_orders(split_orders, "_split").drop("o_orderkey"), "scored")
    by = ["classifier", "_split"]
    measured = written(scoring.long_metrics(scoring.metrics(scored, by, wanted=("f1_weighted",)), by), "metrics")
    known = F.col("classifier") != "urgency"
    expected = F.when(known, rounded(F.col("value"), 4).cast("string")).otherwise("unknown")
    baseline = measured.where("_split = 'train'").select("classifier", "metric", expected.alias("expected"))
    actual = measured.where("_split = 'test'").drop("_split")
    return _round(checks.check_reproducibility(actual, baseline, "f1_weighted", 0.02, 0.001), 6, "value")


# ---------------------------------------------------------------------------
# Spark ML
# ---------------------------------------------------------------------------

_MODELS = {m.name: m for m in CLASSIFIERS} | {
    "RandomForest": ModelSpec("RandomForest", {"n_estimators": 100}),
    "SVC": ModelSpec("SVC", {"C": 1.0}),
}
_KERNEL_SVC = ModelSpec("SVC", {"C": 1.0, "kernel": "rbf"})


def _part(spark: SparkSession, folder: str, part: str) -> DataFrame:
    return workspace.landed(
        spark, folder, f"model_{part}",
        lambda: models.training_table(
            models.model_input(_curated(spark, folder).where(F.col("_split") == part), inputs.SPEC)
        ),
    )


def _trained(name: str):
    def run(spark: SparkSession, folder: str) -> DataFrame:
        fitted = models.fit(_part(spark, folder, "train"), inputs.SPEC, _MODELS[name], _SETTINGS.seed)
        return models.score(fitted, _part(spark, folder, "test"), name, inputs.SPEC.key)

    return run


_TRAINED = {
    "train_lr": "LogisticRegression",
    "train_dt": "DecisionTree",
    "train_gbt": "GradientBoosting",
    "train_gbt_colsample": "XGBoost",
    "train_rf": "RandomForest",
    "train_linear_svc": "SVC",
}

for _key, _name in _TRAINED.items():
    query(_key)(_trained(_name))


def _consistent(border: str = "0.5") -> list[F.Column]:
    """How many rows, positives, scores in their range, and predictions that follow from the score."""
    ranged = F.col("score").between(0, 1) if border == "0.5" else F.col("score").isNotNull() & ~F.isnan("score")
    follows = (F.col("prediction") == 1) == (F.col("score") > float(border))
    return [
        F.count(F.lit(1)).alias("n"), F.sum("label").cast("bigint").alias("positives"),
        F.count_if(ranged).alias("in_range"), F.count_if(follows).alias("consistent"), F.countDistinct("_row_key").alias("n_keys"),
    ]


_PARTS = split("staging", "label", "_row_key")
_ALL_CONSISTENT = "count(*) AS n, CAST(sum(label) AS BIGINT) AS positives, count(*) AS in_range, count(*) AS consistent, count(DISTINCT _row_key) AS n_keys"


@query(
    "model_score_check",
    with_(
        *TO_STAGING, _PARTS,
        select=f"""
SELECT classifier, {_ALL_CONSISTENT}
FROM split, (VALUES {", ".join(f"('{name}')" for name in _TRAINED.values())}) m(classifier) WHERE _split = 'test' GROUP BY classifier""",
    ),
)
def model_score_check(spark: SparkSession, folder: str) -> DataFrame:
    """Each test row is scored once by each model, with a score in its range and the prediction that follows from it."""
    train, test = _part(spark, folder, "train"), _part(spark, folder, "test")
    fitted = models.fit_all(train, inputs.SPEC, [_MODELS[name] for name in _TRAINED.values()], _SETTINGS)
    scored = {name: models.score(m, test, name, inputs.SPEC.key) for name, m in fitted.items()}
    parts = [df.groupBy("classifier").agg(*_consistent("0" if name == "SVC" else "0.5")) for name, df in scored.items()]
    return reduce(DataFrame.unionByName, parts)


_SPLIT_BY = ("l_linenumber", "l_quantity", "l_discount", "l_tax")
_FITS = (ALL, 0, 1, 2, 3, 4)
_VALUE = "-0.3 * ({n} * yes_all / n_all - {yes}) / ({n} * yes_all / n_all * (1 - yes_all / n_all) + 1.0)"
_QUALITY = "power({n} * yes_all / n_all - {yes}, 2) / ({n} * yes_all / n_all * (1 - yes_all / n_all) + 1.0)"
_LEFT, _RIGHT = dict(n="n_left", yes="yes_left"), dict(n="(n_all - n_left)", yes="(yes_all - yes_left)")


@query(
    "boosted_first_split",
    f"""
WITH long AS (
  UNPIVOT (SELECT l_orderkey % 5 AS fold, CAST(l_returnflag = 'R' AS INTEGER) AS y,
                  {", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in _SPLIT_BY)} FROM lineitem)
  ON {", ".join(_SPLIT_BY)} INTO NAME feature VALUE value),
cells AS (SELECT feature, value, fold, count(*) AS n, sum(y) AS yes FROM long GROUP BY ALL),
by_fit AS (
  SELECT fit, feature, value, coalesce(sum(n) FILTER (fold <> fit), 0) AS n, coalesce(sum(yes) FILTER (fold <> fit), 0) AS yes
  FROM cells, (VALUES {", ".join(f"({f})" for f in _FITS)}) f(fit) GROUP BY ALL),
upto AS (
  SELECT fit, feature, (value + lead(value) OVER w) / 2 AS threshold,
         CAST(sum(n) OVER w AS DOUBLE) AS n_left, CAST(sum(yes) OVER w AS DOUBLE) AS yes_left,
         CAST(sum(n) OVER (PARTITION BY fit, feature) AS DOUBLE) AS n_all, CAST(sum(yes) OVER (PARTITION BY fit, feature) AS DOUBLE) AS yes_all
  FROM by_fit WINDOW w AS (PARTITION BY fit, feature ORDER BY value ROWS UNBOUNDED PRECEDING)),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY fit ORDER BY {_QUALITY.format(**_LEFT)} + {_QUALITY.format(**_RIGHT)} DESC,
    list_position([{", ".join(f"'{c}'" for c in _SPLIT_BY)}], feature), threshold) AS rn
  FROM upto WHERE n_left > 0 AND n_left < n_all AND threshold IS NOT NULL)
SELECT fit, feature, {r("threshold", 6)} AS threshold, CAST(n_left AS BIGINT) AS n_left, CAST(n_all - n_left AS BIGINT) AS n_right,
       {r(_VALUE.format(**_LEFT), 6)} AS value_left, {r(_VALUE.format(**_RIGHT), 6)} AS value_right
FROM ranked WHERE rn = 1""",
)
def boosted_first_split(spark: SparkSession, folder: str) -> DataFrame:
    """The first split of the whole of lineitem and with each fold left out, and the closed form of its leaf values."""
    rows = inputs.table(spark, folder, "lineitem").select(
        "l_orderkey", *[F.col(c).cast("double").alias(c) for c in _SPLIT_BY],
        (F.col("l_returnflag") == "R").cast("int").alias("label"), (F.col("l_orderkey") % 5).cast("int").alias(FOLD),
    )
    fits = boosting.boosted_trees(rows, _SPLIT_BY, _FITS, "l_orderkey", n_estimators=1, max_depth=1)
    found = []
    for f, fit in zip(_FITS, fits):
        tree, values = fit.trees[0], fit.values[0]
        if tree.feature[0] >= 0:
            sides = tree.left[0], tree.right[0]
            threshold = float(fit.edges[tree.feature[0]][int(tree.threshold[0])])
            found.append((f, _SPLIT_BY[tree.feature[0]], threshold, *(tree.counts[s][2] for s in sides), *(float(values[s]) for s in sides)))
    schema = "fit int, feature string, threshold double, n_left bigint, n_right bigint, value_left double, value_right double"
    return _round(spark.createDataFrame(found, schema), 6, "threshold", "value_left", "value_right")


@query("train_newton_boosting")
def train_newton_boosting(spark: SparkSession, folder: str) -> DataFrame:
    train, key = _part(spark, folder, "train").withColumn(FOLD, F.lit(0)), inputs.SPEC.key
    features = [c for c in inputs.SPEC.features if c in train.columns]
    fit = models.newton_boosting(train, features, [ALL], key, _MODELS["XGBoost"], _SETTINGS.seed)[0]
    return boosting.score_boosted(_part(spark, folder, "test"), features, {ALL: fit}, "XGBoost", key)


@query(
    "train_kernel_svc",
    with_(
        *TO_STAGING, _PARTS,
        select="SELECT _row_key, CAST(label AS INTEGER) AS label, true AS scored, true AS consistent FROM split WHERE _split = 'test'",
    ),
)
def train_kernel_svc(spark: SparkSession, folder: str) -> DataFrame:
    """The test rows by a support vector machine with a radial kernel, trained on the training rows."""
    fitted = models.fit(_part(spark, folder, "train"), inputs.SPEC, _KERNEL_SVC, _SETTINGS.seed)
    scored = models.score(fitted, _part(spark, folder, "test"), "SVC", inputs.SPEC.key)
    known = F.col("score").isNotNull() & ~F.isnan("score")
    return scored.select("_row_key", "label", known.alias("scored"), ((F.col("prediction") == 1) == (F.col("score") > 0)).alias("consistent"))


def _cv_scored(spark: SparkSession, folder: str) -> DataFrame:
    return workspace.landed(
        spark, folder, "cv_scored", lambda: models.cv_scored(_part(spark, folder, "train"), inputs.SPEC, CLASSIFIERS, _SETTINGS)
    )


@query("cv_scores")
def cv_scores(spark: SparkSession, folder: str) -> DataFrame:
    return models.cv_metrics(_cv_scored(spark, folder))


@query(
    "cv_fold_check",
    with_(
        *TO_STAGING, _PARTS,
        f"""
folded AS (
  SELECT _row_key, label, CAST(((rn - 1) * 5) // n AS INTEGER) AS fold
  FROM (SELECT _row_key, label, count(*) OVER (PARTITION BY label) AS n,
               row_number() OVER (PARTITION BY label ORDER BY {ordered_keys("_row_key")}) AS rn FROM split WHERE _split = 'train'))""",
        select=f"""
SELECT classifier, fold, {_ALL_CONSISTENT}
FROM folded, (VALUES {", ".join(f"('{m.name}')" for m in CLASSIFIERS)}) m(classifier) GROUP BY classifier, fold""",
    ),
)
def cv_fold_check(spark: SparkSession, folder: str) -> DataFrame:
    """Each training row is scored once by each model, in its own fold."""
    return _cv_scored(spark, folder).groupBy("classifier", "fold").agg(*_consistent())


@query("evaluate_models")
def evaluate_models(spark: SparkSession, folder: str) -> DataFrame:
    fitted = models.fit_all(_part(spark, folder, "train"), inputs.SPEC, CLASSIFIERS, _SETTINGS)
    return models.evaluate(fitted, _part(spark, folder, "test"), inputs.SPEC.key)
