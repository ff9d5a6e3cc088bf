"""Classifiers on Spark ML: train, cross-validate, score, persist."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.base import Estimator
from pyspark.ml.classification import (
    DecisionTreeClassifier,
    GBTClassifier,
    LinearSVC,
    LogisticRegression,
    RandomForestClassifier,
)
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from assayer.operators import boosting, many_fits
from assayer.operators.curate import stratified_folds, stratified_split
from assayer.operators.kernels import FourierFeatures, frequencies_for, scale_gamma
from assayer.operators.scoring import balanced_threshold, long_metrics, metrics, threshold_sweep
from assayer.operators.staging import fill_zero
from assayer.scratch import written
from assayer.spec import ModelSpec, Settings, TableSpec

MAX_BINS = 256  # candidate splits per feature

PARALLEL_FITS = 8  # independent fits submitted at a time

_FEATURES = "_features"
_FOURIER = "_fourier"


# ---------------------------------------------------------------------------
# classifiers
# ---------------------------------------------------------------------------


def _logistic_regression(params: dict, rows: int, seed: int) -> Estimator:
    # The penalty is stated per training set (1 / C) there and per row here.
    return LogisticRegression(
        regParam=1.0 / (params.get("C", 1.0) * rows),
        elasticNetParam=0.0,
        standardization=False,
        maxIter=params.get("max_iter", 100),
    )


def _per_child(params: dict) -> int:
    # Spark bounds the rows of a child, not those of the node that is split.
    return max(1, params.get("min_samples_split", 2) // 2)


def _decision_tree(params: dict, rows: int, seed: int) -> Estimator:
    return DecisionTreeClassifier(
        maxDepth=params.get("max_depth", 30),
        minInstancesPerNode=_per_child(params),
        impurity=params.get("criterion", "gini"),
        maxBins=MAX_BINS,
        seed=seed,
    )


def _boosted_trees(params: dict, rows: int, seed: int) -> Estimator:
    return GBTClassifier(
        maxIter=params.get("n_estimators", 100),
        stepSize=params.get("learning_rate", 0.1),
        maxDepth=params.get("max_depth", 3),
        subsamplingRate=params.get("subsample", 1.0),
        featureSubsetStrategy=str(params.get("colsample_bytree", "all")),
        maxBins=MAX_BINS,
        seed=seed,
    )


def _random_forest(params: dict, rows: int, seed: int) -> Estimator:
    return RandomForestClassifier(
        numTrees=params.get("n_estimators", 100),
        maxDepth=params.get("max_depth", 10),
        minInstancesPerNode=_per_child(params),
        maxBins=MAX_BINS,
        seed=seed,
    )


def _linear_svc(params: dict, rows: int, seed: int) -> Estimator:
    return LinearSVC(regParam=1.0 / (params.get("C", 1.0) * rows), maxIter=params.get("max_iter", 100))


_FACTORIES = {
    "LogisticRegression": _logistic_regression,
    "DecisionTree": _decision_tree,
    "GradientBoosting": _boosted_trees,
    "XGBoost": _boosted_trees,
    "RandomForest": _random_forest,
    "LightGBM": _random_forest,
    "SVC": _linear_svc,
}


def build_classifier(spec: ModelSpec, rows: int, seed: int = 42) -> Estimator:
    if spec.name not in _FACTORIES:
        raise ValueError(f"no classifier is called {spec.name}; there are {sorted(_FACTORIES)}")
    if spec.params.get("kernel", "linear") not in ("linear", "rbf"):
        raise ValueError(f"no kernel is called {spec.params['kernel']}; there are linear and rbf")
    estimator = _FACTORIES[spec.name](spec.params, rows, seed)
    return estimator.setFeaturesCol(_FEATURES).setLabelCol("label")


# ---------------------------------------------------------------------------
# fit and score
# ---------------------------------------------------------------------------


def model_input(curated: DataFrame, spec: TableSpec, *keep: str) -> DataFrame:
    """Key, features without NULLs, and an integer label; no other column."""
    features = [c for c in spec.features if c in curated.columns]
    chosen = curated.select(spec.key, *keep, *features, F.col(spec.target).cast("int").alias("label"))
    return fill_zero(chosen, features)


def training_table(rows: DataFrame, name: str = "train", path: str | None = None) -> DataFrame:
    """`rows` written in files of the advisory partition size.

    A fit reads its input once per iteration, so one shuffle that evens out many small files (or a
    few large ones) pays for itself.
    """
    return written(rows.hint("rebalance"), name, path)


def fit(train: DataFrame, spec: TableSpec, model: ModelSpec, seed: int = 42, rows: int | None = None) -> PipelineModel:
    features = [c for c in spec.features if c in train.columns]
    rows = train.count() if rows is None else rows
    stages, classifier = [VectorAssembler(inputCols=features, outputCol=_FEATURES)], build_classifier(model, rows, seed)
    if model.params.get("kernel", "linear") == "rbf":
        gamma = model.params.get("gamma", "scale")
        gamma = scale_gamma(train, features) if gamma == "scale" else float(gamma)
        n = frequencies_for(model.params.get("kernel_error", 0.15), model.params.get("kernel_risk", 0.01))
        stages.append(FourierFeatures(inputCol=_FEATURES, outputCol=_FOURIER, gamma=gamma, frequencies=n, seed=seed))
        classifier = classifier.setFeaturesCol(_FOURIER).setStandardization(False)  # the penalty is the norm in the kernel
    return Pipeline(stages=[*stages, classifier]).fit(train)


def score(fitted: PipelineModel, rows: DataFrame, name: str, key: str, *keep: str) -> DataFrame:
    """(key.., classifier, label, prediction, score); the score is P(1), or the margin of an SVC."""
    scored = fitted.transform(rows)
    vector = "probability" if "probability" in scored.columns else "rawPrediction"
    return scored.select(
        key,
        *keep,
        F.lit(name).alias("classifier"),
        "label",
        F.col("prediction").cast("int").alias("prediction"),
        F.element_at(vector_to_array(F.col(vector)), 2).alias("score"),
    )


def _in_parallel(spark: SparkSession, jobs: Sequence[Callable], parallelism: int) -> list:
    """Fits that do not depend on each other are submitted together, as CrossValidator does."""
    pool = ThreadPool(min(parallelism, len(jobs)) or 1)
    try:
        return pool.map(inheritable_thread_target(spark)(lambda job: job()), jobs)
    finally:
        pool.close()


def fit_all(
    train: DataFrame, spec: TableSpec, models: Sequence[ModelSpec], settings: Settings, parallelism: int = PARALLEL_FITS
) -> dict[str, PipelineModel]:
    """`train` should be a `training_table`: each fit reads it."""
    rows = train.count()
    fitted = _in_parallel(train.sparkSession, [lambda m=m: fit(train, spec, m, settings.seed, rows) for m in models], parallelism)
    return {m.name: f for m, f in zip(models, fitted)}


def score_all(fitted: dict[str, PipelineModel], rows: DataFrame, key: str) -> DataFrame:
    return reduce(DataFrame.unionByName, [score(f, rows, name, key) for name, f in fitted.items()])


def evaluate(fitted: dict[str, PipelineModel], test: DataFrame, key: str) -> DataFrame:
    """One row of metrics per classifier, from one scoring of the test rows."""
    return metrics(written(score_all(fitted, test, key), "scored"))


def _in_one_scan(model: ModelSpec) -> bool:
    """Whether `many_fits` or `boosting` has this model: they fit all folds together."""
    return model.name in ("LogisticRegression", "XGBoost") or model.name == "DecisionTree" and model.params.get("criterion", "gini") == "gini"


def newton_boosting(
    folded: DataFrame, features: Sequence[str], folds: Sequence[int], key: str, model: ModelSpec, seed: int = 42
) -> list[boosting.Boosted]:
    """Second-order boosted trees of all folds together, with the settings of `model` as they are commonly named."""
    p = model.params
    return boosting.boosted_trees(
        folded, features, folds, key, p.get("n_estimators", 100), p.get("learning_rate", 0.3), p.get("max_depth", 6),
        p.get("subsample", 1.0), p.get("colsample_bytree", 1.0), p.get("reg_lambda", 1.0), p.get("min_child_weight", 1.0), seed=seed,
    )


def cv_scored(
    train: DataFrame, spec: TableSpec, models: Sequence[ModelSpec], settings: Settings, parallelism: int = PARALLEL_FITS
) -> DataFrame:
    """(key, classifier, label, prediction, score, fold): every row scored by the fits that left its fold out."""
    folded = training_table(stratified_folds(train, "label", spec.key, settings.seed, settings.folds), "folds")
    sizes = {row[0]: row[1] for row in folded.groupBy("_fold").count().collect()}
    folds, total = sorted(sizes), sum(sizes.values())
    features = [c for c in spec.features if c in train.columns]

    def one(model: ModelSpec, fold: int) -> DataFrame:
        rest = folded.where(F.col("_fold") != fold)
        fitted = fit(rest, spec, model, settings.seed, total - sizes[fold])
        held_out = folded.where(F.col("_fold") == fold)
        return score(fitted, held_out, model.name, spec.key).withColumn("fold", F.lit(fold))

    def together(model: ModelSpec) -> DataFrame:
        params = model.params
        if model.name == "LogisticRegression":
            weights = many_fits.logistic_regressions(folded, features, folds, params.get("C", 1.0), params.get("max_iter", 100))
            return many_fits.score_linear(folded, features, dict(zip(folds, weights)), model.name, spec.key)
        if model.name == "XGBoost":
            fits = newton_boosting(folded, features, folds, spec.key, model, settings.seed)
            return boosting.score_boosted(folded, features, dict(zip(folds, fits)), model.name, spec.key)
        trees = many_fits.decision_trees(folded, features, folds, params.get("max_depth", 30), params.get("min_samples_split", 2))
        return many_fits.score_trees(folded, features, dict(zip(folds, trees)), model.name, spec.key)

    jobs: list[Callable] = [lambda m=m: together(m) for m in models if _in_one_scan(m)]
    jobs += [lambda m=m, f=f: one(m, f) for m in models if not _in_one_scan(m) for f in folds]
    return written(reduce(DataFrame.unionByName, _in_parallel(train.sparkSession, jobs, parallelism)), "cv")


def cv_metrics(scored: DataFrame) -> DataFrame:
    """(classifier, fold, metric, value) of what `cv_scored` gives."""
    by, wanted = ["classifier", "fold"], ["accuracy", "f1_weighted", "roc_auc"]
    return long_metrics(metrics(scored, by, wanted=wanted), by)


def cv_scores(
    train: DataFrame, spec: TableSpec, models: Sequence[ModelSpec], settings: Settings, parallelism: int = PARALLEL_FITS
) -> DataFrame:
    """(classifier, fold, metric, value) of stratified k-fold cross-validation."""
    return cv_metrics(cv_scored(train, spec, models, settings, parallelism))


def calibrate_threshold(
    train: DataFrame, spec: TableSpec, model: ModelSpec, settings: Settings
) -> tuple[PipelineModel, float]:
    """A model of the inner training split, and the threshold that balances its recalls on the rest.

    The inner split has the proportions of the outer one.
    """
    inner = training_table(
        stratified_split(train, "label", spec.key, settings.seed, settings.test_size, name="_inner"), "inner"
    )
    fitted = fit(inner.where(F.col("_inner") == "train"), spec, model, settings.seed)
    validation = score(fitted, inner.where(F.col("_inner") == "test"), model.name, spec.key)
    return fitted, balanced_threshold(threshold_sweep(validation)).first().threshold


def with_threshold(scored: DataFrame, threshold: float) -> DataFrame:
    """Predictions at `score >= threshold` instead of the model's own."""
    return scored.withColumn("prediction", (F.col("score") >= F.lit(threshold)).cast("int"))


# ---------------------------------------------------------------------------
# models as artifacts
# ---------------------------------------------------------------------------


def feature_importances(fitted: PipelineModel) -> list[tuple[str, float]]:
    """(feature, importance) of a tree model, the most important first."""
    names, values = fitted.stages[0].getInputCols(), fitted.stages[-1].featureImportances.toArray()
    return sorted(zip(names, map(float, values)), key=lambda pair: (-pair[1], pair[0]))


def importance_table(spark: SparkSession, fitted: dict[str, PipelineModel]) -> DataFrame:
    """(classifier, feature, importance) of the models that have importances, a row for each feature."""
    trees = {name: m for name, m in fitted.items() if hasattr(m.stages[-1], "featureImportances")}
    rows = [(name, feature, value) for name, m in trees.items() for feature, value in feature_importances(m)]
    return spark.createDataFrame(rows, "classifier string, feature string, importance double")


def save_model(fitted: PipelineModel, folder: str, run_id: str, name: str) -> str:
    path = f"{folder}/{run_id}/{name}"
    fitted.write().overwrite().save(path)
    return path


def load_model(folder: str, run_id: str, name: str) -> PipelineModel:
    return PipelineModel.load(f"{folder}/{run_id}/{name}")
