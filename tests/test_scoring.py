import random

import pytest

from assayer.operators import reports, scoring
from assayer.plans.refinery import read_baseline


def _scored(spark, data, name="m"):
    return spark.createDataFrame([(name, *row) for row in data], "classifier string, label int, prediction int, score double")


def _auc(data):
    pos = [s for y, _, s in data if y == 1]
    neg = [s for y, _, s in data if y == 0]
    return sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg))


def _random(levels, rows=400):
    rng = random.Random(levels)
    return [(y := rng.randrange(2), int((s := rng.randrange(levels) / levels + 0.1 * y) > 0.5), s) for _ in range(rows)]


@pytest.mark.parametrize("levels", [1, 3, 10**6])
def test_auc_equals_all_pairs(spark, levels):
    data = _random(levels)
    assert scoring.roc_auc(_scored(spark, data)).first().roc_auc == pytest.approx(_auc(data), abs=1e-12)


def test_auc_of_perfect_inverted_and_one_class(spark):
    perfect = _scored(spark, [(0, 0, 0.1), (1, 1, 0.9)], "perfect")
    inverted = _scored(spark, [(0, 0, 0.9), (1, 1, 0.1)], "inverted")
    lonely = _scored(spark, [(1, 1, 0.9), (1, 1, 0.1)], "lonely")
    out = {r.classifier: r.roc_auc for r in scoring.roc_auc(perfect.union(inverted).union(lonely)).collect()}
    assert out == {"perfect": 1.0, "inverted": 0.0, "lonely": None}


def test_sweep_equals_counting(spark):
    data = _random(20)
    positives, negatives = sum(y for y, _, _ in data), sum(1 - y for y, _, _ in data)
    sweep = scoring.threshold_sweep(_scored(spark, data))
    for r in sweep.collect():
        assert r.true_positives == sum(y == 1 and s >= r.threshold for y, _, s in data)
        assert r.false_positives == sum(y == 0 and s >= r.threshold for y, _, s in data)
        assert r.recall_negative == pytest.approx(1 - r.false_positives / negatives)
        assert r.recall_positive == pytest.approx(r.true_positives / positives)
    best = scoring.balanced_threshold(sweep).first()
    assert best.recall_gap == min(abs(r.recall_positive - r.recall_negative) for r in sweep.collect())


def test_class_that_is_never_predicted(spark):
    scored = _scored(spark, [(0, 0, 0.1), (1, 0, 0.2), (2, 0, 0.3), (0, 0, 0.4)])
    matrix = scoring.confusion_matrix(scored)
    assert matrix.count() == 9 and matrix.where("prediction > 0 and n > 0").isEmpty()
    report = {r["class"]: r for r in scoring.classification_report(matrix).collect()}
    assert (report["1"].precision, report["1"].recall, report["1"].f1, report["1"].support) == (0.0, 0.0, 0.0, 1)
    assert report["0"].precision == 0.5 and report["0"].recall == 1.0
    assert report["accuracy"].f1 == 0.5 and report["macro avg"].f1 == pytest.approx(2 / 9)
    assert report["weighted avg"].f1 == pytest.approx(1 / 3) and report["weighted avg"].support == 4


def test_metrics_of_many_classifiers(spark):
    scored = _scored(spark, _random(7), "a").union(_scored(spark, [(1, 1, 0.5)] * 3, "b"))
    out = {r.classifier: r for r in scoring.metrics(scored).collect()}
    assert out["b"].accuracy == out["b"].f1_weighted == out["b"].f1_binary == 1.0 and out["b"].roc_auc is None
    data = _random(7)
    assert out["a"].accuracy == pytest.approx(sum(y == p for y, p, _ in data) / len(data))


def test_best_model_takes_the_first_name_of_equals(spark):
    df = spark.createDataFrame([("z", 0.5), ("b", 0.7), ("a", 0.7), ("n", None)], "classifier string, f1_weighted double")
    assert scoring.best_model(df).first().classifier == "a"


def test_leaderboard_and_comparison(spark):
    df = spark.createDataFrame(
        [("a", 0.5, 0.123456, 0.1, 0.5), ("b", 0.6, None, 0.1, None), ("c", 0.7, 0.9, 0.2, 0.0)],
        "classifier string, accuracy double, f1_weighted double, f1_macro double, roc_auc double",
    )
    board = reports.model_leaderboard(df).collect()
    assert [(r.classifier, r["rank"]) for r in board] == [("b", 1), ("c", 2), ("a", 3)]
    table = {r.classifier: r for r in reports.classifier_comparison(df).collect()}
    assert table["a"].f1_weighted == 0.1235 and table["c"].roc_auc == 0.0 and table["b"].roc_auc is None


def test_deviation_of_one_row_is_unknown(spark):
    df = spark.createDataFrame([(1, 50.0, 8.0), (0, 60.0, 9.0), (0, 70.0, 10.0)], "label int, flesch_reading_ease double, gunning_fog_index double")
    out = {r.author_type: r.std_reading_ease for r in reports.readability_contrast(df).collect()}
    assert out == {"AI-Generated": None, "Human-Written": 7.07}


def test_cv_summary_uses_the_population_deviation(spark):
    df = spark.createDataFrame([("a", 0, "acc", 0.4), ("a", 1, "acc", 0.6)], "classifier string, fold int, metric string, value double")
    out = scoring.cv_summary(df).first()
    assert (out["mean"], out["std"]) == (0.5, pytest.approx(0.1))


def test_baseline_file(spark, tmp_path):
    path = tmp_path / "baseline.json"
    path.write_text(
        '{"tolerance": {"metric": "f1_weighted", "threshold": 0}, "classifiers": {'
        '"A": {"reported_metrics": {"f1_weighted": 0.58, "roc_auc": "unknown"}}, "B": {"f1_weighted": 0.4, "notes": {"x": 1}}}}'
    )
    lines, metric, tolerance = read_baseline(spark, str(path))
    assert sorted(tuple(r) for r in lines.collect()) == [("A", "f1_weighted", "0.58"), ("A", "roc_auc", "unknown"), ("B", "f1_weighted", "0.4")]
    assert (metric, tolerance) == ("f1_weighted", 0)


def test_only_what_is_wanted_is_planned(spark):
    scored = spark.createDataFrame([("m", 1, 1, 0.9), ("m", 0, 1, 0.8), ("m", 0, 0, 0.1)], "classifier string, label int, prediction int, score double")
    every = scoring.metrics(scored)
    assert every.columns == ["classifier", *scoring.METRICS]
    some = scoring.metrics(scored, wanted=("f1_weighted", "accuracy"))
    assert some.columns == ["classifier", "accuracy", "f1_weighted"]
    assert some.first() == every.select(*some.columns).first()
    assert "score" not in some._jdf.queryExecution().executedPlan().toString().replace("classifier", "")
