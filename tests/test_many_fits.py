"""All fits of one scan equal the fits made one by one in plain Python."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from assayer.operators import many_fits, models
from assayer.operators.many_fits import ALL
from assayer.spec import ModelSpec, TableSpec

FEATURES = ["a", "b", "c"]


def make(seed, n=240):
    random = np.random.default_rng(seed)
    x = np.column_stack([random.normal(size=n).round(2), random.integers(0, 5, n), np.zeros(n)])
    y = (x[:, 0] + 0.3 * x[:, 1] + random.normal(size=n) > 0.6).astype(int)
    return x, y, random.integers(0, 3, n)


def table(spark, x, y, fold):
    rows = [(i, *map(float, v), int(label), int(f), "x") for i, (v, label, f) in enumerate(zip(x, y, fold))]
    return spark.createDataFrame(rows, "k bigint, a double, b double, c double, label int, _fold int, p string").repartition(5)


def between(x):
    values = [np.unique(x[:, j]) for j in range(x.shape[1])]
    return [(v[1:] + v[:-1]) / 2 for v in values]


def plain_tree(x, y, cuts, max_depth, min_samples_split, depth=0):
    """A tree with the thresholds `cuts`, which lie between the values of all rows."""
    counts = (int((y == 0).sum()), int((y == 1).sum()))
    if depth == max_depth or min(counts) == 0 or len(y) < min_samples_split:
        return counts
    best = None
    for j in range(x.shape[1]):
        for edge in cuts[j]:
            left = x[:, j] <= edge
            if left.all() or not left.any():
                continue
            s = sum(((y[side] == 0).sum() ** 2 + (y[side] == 1).sum() ** 2) / side.sum() for side in (left, ~left))
            if best is None or s > best[0]:
                best = s, j, edge, left
    if best is None:
        return counts
    _, j, edge, left = best
    return j, edge, *(plain_tree(x[s], y[s], cuts, max_depth, min_samples_split, depth + 1) for s in (left, ~left))


def nested(tree, node=0):
    if tree.feature[node] < 0:
        return tuple(tree.counts[node])
    return tree.feature[node], tree.threshold[node], nested(tree, tree.left[node]), nested(tree, tree.right[node])


@pytest.mark.parametrize("seed, depth, least", [(1, 4, 10), (2, 3, 40)])
def test_trees_equal_plain_ones(spark, monkeypatch, seed, depth, least):
    x, y, fold = make(seed)
    monkeypatch.setattr(many_fits, "CELLS", 2 * 3 * 256 * 5)  # five nodes a scan
    trees = many_fits.decision_trees(table(spark, x, y, fold), FEATURES, [ALL, 0, 1, 2], depth, least)
    for tree, left_out in zip(trees, [ALL, 0, 1, 2]):
        rows = fold != left_out
        assert nested(tree) == plain_tree(x[rows], y[rows], between(x), depth, least)


def test_the_parent_is_bounded_not_the_child(spark):
    x = np.column_stack([np.arange(12.0), np.zeros(12), np.zeros(12)])
    y = np.array([1] + [0] * 11)
    tree = many_fits.decision_trees(table(spark, x, y, np.zeros(12, int)), FEATURES, [ALL], 5, 12)[0]
    assert nested(tree) == (0, 0.5, (0, 1), (11, 0))  # a child of one row
    assert nested(many_fits.decision_trees(table(spark, x, y, np.zeros(12, int)), FEATURES, [ALL], 5, 13)[0]) == (11, 1)
    assert tree.importances(FEATURES) == [("a", 1.0), ("b", 0.0), ("c", 0.0)]


def test_many_values_are_binned_by_quantiles(spark):
    x = np.column_stack([np.arange(3000.0), np.zeros(3000), np.zeros(3000)])
    y = (x[:, 0] >= 1500).astype(int)
    df = table(spark, x, y, np.zeros(3000, int))
    edges = many_fits.bin_edges(df, FEATURES)
    assert 200 < len(edges[0]) < 256 and len(edges[1]) == 0
    tree = many_fits.decision_trees(df, FEATURES, [ALL], 2, 2)[0]
    assert abs(tree.threshold[0] - 1500) <= 3000 / 256 + 1


def newton(x, y, c):
    x = np.column_stack([x, np.ones(len(x))])
    penalty, w = np.append(np.full(x.shape[1] - 1, 1 / c), 0), np.zeros(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-x @ w))
        w = w - np.linalg.pinv((x * (p * (1 - p))[:, None]).T @ x + np.diag(penalty)) @ (x.T @ (p - y) + penalty * w)
    return w


def test_regressions_equal_plain_ones(spark):
    x, y, fold = make(3)
    folds, cs = [ALL, 0, 1, 2, ALL], [1.0, 1.0, 1.0, 1.0, 0.01]
    weights = many_fits.logistic_regressions(table(spark, x, y, fold), FEATURES, folds, cs)
    for w, left_out, c in zip(weights, folds, cs):
        rows = fold != left_out
        assert w == pytest.approx(newton(x[rows], y[rows], c), abs=1e-6)


def test_regression_equals_the_one_of_spark(spark):
    x, y, fold = make(4)
    df = table(spark, x, y, fold)
    spec = TableSpec(types={}, numeric=tuple(FEATURES), categorical=(), target="label", key="k")
    fitted = models.fit(df, spec, ModelSpec("LogisticRegression", {"C": 1.0, "max_iter": 1000})).stages[-1]
    weights = many_fits.logistic_regressions(df, FEATURES, [ALL], 1.0)[0]
    assert weights == pytest.approx([*fitted.coefficients.toArray(), fitted.intercept], abs=2e-3)


def test_scores_use_the_fit_that_left_the_row_out(spark):
    x, y, fold = make(5)
    df = table(spark, x, y, fold)
    weights = {f: w for f, w in zip(range(3), many_fits.logistic_regressions(df, FEATURES, range(3)))}
    trees = dict(zip(range(3), many_fits.decision_trees(df, FEATURES, range(3), 3, 10)))
    for out in (many_fits.score_linear(df, FEATURES, weights, "m", "k"), many_fits.score_trees(df, FEATURES, trees, "m", "k")):
        assert out.columns == ["k", "classifier", "label", "prediction", "score", "fold"]
        assert out.where("fold <> 0 and fold <> 1 and fold <> 2 or score < 0 or score > 1 or prediction <> int(score > 0.5)").isEmpty()
    for r in many_fits.score_linear(df, FEATURES, weights, "m", "k").collect():
        assert r.score == pytest.approx(1 / (1 + np.exp(-(np.append(x[r.k], 1) @ weights[fold[r.k]]))))
    for r in many_fits.score_trees(df, FEATURES, trees, "m", "k").collect():
        counts = trees[fold[r.k]].counts[trees[fold[r.k]].leaves(x[r.k : r.k + 1])[0]]
        assert r.score == counts[1] / sum(counts)
    whole = many_fits.score_trees(df.drop("_fold"), FEATURES, {ALL: trees[0]}, "m", "k")
    assert whole.count() == len(x) and whole.where("fold <> -1").isEmpty()


def test_one_label_and_no_rows(spark):
    x, y, fold = make(6, 30)
    df = table(spark, x, np.ones(30, int), fold)
    assert nested(many_fits.decision_trees(df, FEATURES, [ALL], 3, 2)[0]) == (0, 30)
    assert many_fits.logistic_regressions(df, FEATURES, [ALL], max_iter=12)[0][-1] > 5
    none = df.where(F.lit(False))
    assert many_fits.logistic_regressions(none, FEATURES, [ALL, 0]).tolist() == [[0.0] * 4] * 2
    assert nested(many_fits.decision_trees(none, FEATURES, [ALL], 3, 2)[0]) == (0, 0)
    assert many_fits.score_trees(none, FEATURES, {ALL: many_fits.decision_trees(none, FEATURES, [ALL])[0]}, "m", "k").collect() == []
