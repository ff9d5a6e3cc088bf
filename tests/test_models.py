import pytest
from pyspark.sql import functions as F

from assayer.operators import models, scoring
from assayer.spec import CLASSIFIERS, ModelSpec, Settings, TableSpec

SPEC = TableSpec(types={}, numeric=("a", "b"), categorical=("c",), target="label", key="k")
SMALL = {
    "LogisticRegression": {"C": 1.0},
    "DecisionTree": {"max_depth": 4, "min_samples_split": 10},
    "GradientBoosting": {"n_estimators": 5, "max_depth": 2, "learning_rate": 0.3, "subsample": 0.7},
    "XGBoost": {"n_estimators": 5, "max_depth": 2, "learning_rate": 0.3, "colsample_bytree": 0.7},
    "RandomForest": {"n_estimators": 5, "max_depth": 4},
    "LightGBM": {"n_estimators": 5, "max_depth": 4},
    "SVC": {"C": 1.0},
}


@pytest.fixture(scope="module")
def data(spark):
    """Separable but for a little noise; `b` says nothing."""
    noise = F.pmod(F.hash("id"), F.lit(100)) / 100.0
    rows = spark.range(600).select(
        F.col("id").alias("k"),
        (F.col("id") % 2).cast("int").alias("label"),
        ((F.col("id") % 2) * 2.0 + noise).alias("a"),
        F.pmod(F.hash(F.col("id") + 7), F.lit(50)).cast("double").alias("b"),
        F.when(F.col("id") % 5 > 0, F.col("id") % 4).cast("double").alias("c"),
        F.lit(1).alias("_note"),
    )
    return models.training_table(models.model_input(rows, SPEC), "data")


def test_model_input_has_features_only(data):
    assert data.columns == ["k", "a", "b", "c", "label"]
    assert data.where("c is null").isEmpty()


@pytest.mark.parametrize("name", sorted(SMALL))
def test_separable_data_is_learned(data, name):
    train, test = data.where("k % 5 > 0"), data.where("k % 5 = 0")
    fitted = models.fit(train, SPEC, ModelSpec(name, SMALL[name]))
    out = scoring.metrics(models.score(fitted, test, name, "k")).first()
    assert out.classifier == name and out.roc_auc > 0.9 and out.accuracy > 0.9


def test_regularisation_is_scaled_by_the_rows():
    model = models.build_classifier(ModelSpec("LogisticRegression", {"C": 2.0, "max_iter": 77}), rows=1000)
    assert model.getRegParam() == pytest.approx(1 / 2000) and model.getMaxIter() == 77 and not model.getStandardization()


def test_default_classifiers():
    assert [m.name for m in CLASSIFIERS] == ["LogisticRegression", "DecisionTree", "XGBoost", "GradientBoosting"]
    tree = models.build_classifier(CLASSIFIERS[1], rows=10)
    assert (tree.getMaxDepth(), tree.getMinInstancesPerNode(), tree.getImpurity()) == (10, 5, "gini")
    boosted = models.build_classifier(CLASSIFIERS[2], rows=10)
    assert (boosted.getMaxIter(), boosted.getStepSize(), boosted.getSubsamplingRate()) == (100, 0.01, 0.7)
    assert boosted.getFeatureSubsetStrategy() == "0.7"


def test_unknown_classifier():
    with pytest.raises(ValueError, match="no classifier is called KNN"):
        models.build_classifier(ModelSpec("KNN"), rows=1)


def test_importance_and_persistence(spark, data, tmp_path):
    fitted = models.fit(data, SPEC, ModelSpec("DecisionTree", SMALL["DecisionTree"]))
    importance = models.feature_importances(fitted)
    assert importance[0][0] == "a" and sum(v for _, v in importance) == pytest.approx(1.0)
    models.save_model(fitted, str(tmp_path), "run", "DecisionTree")
    again = models.load_model(str(tmp_path), "run", "DecisionTree")
    first, second = (models.score(m, data, "DecisionTree", "k") for m in (fitted, again))
    assert first.exceptAll(second).isEmpty()


def test_cross_validation(data):
    specs = [ModelSpec(n, SMALL[n]) for n in ("LogisticRegression", "DecisionTree")]
    scores = models.cv_scores(data, SPEC, specs, Settings(folds=3)).collect()
    assert len(scores) == 2 * 3 * 3 and {r.metric for r in scores} == {"accuracy", "f1_weighted", "roc_auc"}
    assert all(r.value > 0.8 for r in scores)


def test_evaluation_of_several_models(data):
    specs = [ModelSpec(n, SMALL[n]) for n in ("LogisticRegression", "SVC")]
    fitted = models.fit_all(data, SPEC, specs, Settings())
    out = {r.classifier: r for r in models.evaluate(fitted, data, "k").collect()}
    assert set(out) == {"LogisticRegression", "SVC"} and all(r.roc_auc > 0.9 for r in out.values())


def test_threshold_is_calibrated_on_an_inner_split(data):
    model = ModelSpec("LogisticRegression", SMALL["LogisticRegression"])
    fitted, threshold = models.calibrate_threshold(data, SPEC, model, Settings())
    assert 0.0 < threshold < 1.0
    moved = models.with_threshold(models.score(fitted, data, "LogisticRegression", "k"), threshold)
    assert scoring.metrics(moved).first().accuracy > 0.9
    assert moved.where((F.col("score") >= threshold) != (F.col("prediction") == 1)).isEmpty()
