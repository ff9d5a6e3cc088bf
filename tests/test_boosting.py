"""Boosted trees of all folds equal trees grown one by one in plain Python."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from assayer.operators import boosting
from assayer.operators.many_fits import ALL
from test_many_fits import FEATURES, between, make, table


def plain(x, y, cuts, trees, rate, depth, penalty, least, by_rows=False):
    """Margins of the rows after boosting on all of them."""
    margin = np.full(len(y), np.log(y.sum() / (len(y) - y.sum())))
    added = []

    def grow(rows, g, h, left_depth, out):
        G, H = g[rows].sum(), h[rows].sum()
        best = None
        for j in range(x.shape[1]) if left_depth else []:
            for cut in cuts[j]:
                left = x[rows, j] <= cut
                if left.all() or not left.any():
                    continue
                sides = [rows[left], rows[~left]]
                if min(h[s].sum() for s in sides) < least:
                    continue
                weight = (lambda s: len(s) + penalty) if by_rows else (lambda s: h[s].sum() + penalty)
                gain = sum(g[s].sum() ** 2 / weight(s) for s in sides) - G**2 / weight(rows)
                if gain > 1e-9 and (best is None or gain > best[0] + 1e-9):
                    best = gain, sides
        if best is None:
            out[rows] = -rate * G / (H + penalty)
        else:
            for side in best[1]:
                grow(side, g, h, left_depth - 1, out)

    for _ in range(trees):
        p = 1 / (1 + np.exp(-margin))
        out = np.zeros(len(y))
        grow(np.arange(len(y)), p - y, p * (1 - p), depth, out)
        added.append(out)
        margin = margin + out
    return margin


@pytest.mark.parametrize("penalty, least, by_rows", [(1.0, 1.0, False), (0.0, 0.0, True)])
def test_margins_equal_plain_ones(spark, monkeypatch, penalty, least, by_rows):
    monkeypatch.setattr(boosting, "REFRESH", 2)
    monkeypatch.setattr(boosting, "CELLS", 3 * 256 * 5)  # five nodes a scan
    x, y, fold = make(11)
    fits = boosting.boosted_trees(
        table(spark, x, y, fold), FEATURES, [ALL, 0, 1, 2], "k", 5, 0.3, 2, penalty=penalty, min_child=least, first_order=by_rows
    )
    for fit, left_out in zip(fits, [ALL, 0, 1, 2]):
        rows = fold != left_out
        expected = plain(x[rows], y[rows], between(x), 5, 0.3, 2, penalty, least, by_rows)
        assert fit.base + fit.margin(fit.binned(x[rows])) == pytest.approx(expected, abs=1e-6)


def test_leaf_values_are_the_closed_form(spark):
    x, y, fold = make(12)
    fit = boosting.boosted_trees(table(spark, x, y, fold), FEATURES, [ALL], "k", 1, 0.1, 3, penalty=2.0)[0]
    p, leaves = y.mean(), fit.trees[0].leaves(fit.binned(x))
    assert len(set(leaves)) > 2
    for leaf in set(leaves):
        of = leaves == leaf
        assert fit.values[0][leaf] == pytest.approx(-0.1 * (p - y[of]).sum() / (of.sum() * p * (1 - p) + 2.0), abs=1e-7)
        assert fit.trees[0].counts[leaf][2] == of.sum()


def test_drawn_rows_and_columns(spark):
    x, y, fold = make(13, 2000)
    x[:, 2] = np.arange(2000) % 7
    df = table(spark, x, y, fold)
    one = boosting.boosted_trees(df, FEATURES, [ALL], "k", 12, 0.1, 3, 0.7, 0.7)[0]
    used = [{f for f in t.feature if f >= 0} for t in one.trees]
    assert all(len(u) <= 2 for u in used) and set().union(*used) == {0, 1, 2}  # drawn for each tree
    sizes = [t.counts[0][2] for t in one.trees]
    assert len(set(sizes)) > 1 and all(1300 < n < 1500 for n in sizes)
    # The same trees whatever the partitions.
    other = boosting.boosted_trees(df.repartition(3, "b"), FEATURES, [ALL], "k", 12, 0.1, 3, 0.7, 0.7)[0]
    assert [(t.feature, t.threshold, t.counts) for t in other.trees] == [(t.feature, t.threshold, t.counts) for t in one.trees]
    shares = dict(one.importances(FEATURES))
    assert sum(shares.values()) == pytest.approx(1) and shares["a"] > shares["c"]


def test_scores_use_the_fit_that_left_the_row_out(spark):
    x, y, fold = make(14)
    df = table(spark, x, y, fold)
    fits = dict(zip(range(3), boosting.boosted_trees(df, FEATURES, range(3), "k", 3)))
    out = boosting.score_boosted(df, FEATURES, fits, "m", "k").collect()
    assert len(out) == len(x)
    for r in out:
        fit = fits[fold[r.k]]
        margin = fit.base + fit.margin(fit.binned(x[r.k : r.k + 1]))[0]
        assert r.fold == fold[r.k] and r.score == pytest.approx(1 / (1 + np.exp(-margin))) and r.prediction == int(r.score > 0.5)


def test_one_label_and_no_rows(spark):
    x, y, fold = make(15, 30)
    df = table(spark, x, np.ones(30, int), fold)
    fit = boosting.boosted_trees(df, FEATURES, [ALL], "k", 2)[0]
    assert fit.base == pytest.approx(np.log(60)) and all(t.feature == [-1] for t in fit.trees)
    none = df.where(F.lit(False))
    fit = boosting.boosted_trees(none, FEATURES, [ALL, 0], "k", 2)[1]
    assert fit.base == 0 and [v.tolist() for v in fit.values] == [[0.0], [0.0]]
    assert boosting.score_boosted(none, FEATURES, {ALL: fit}, "m", "k").collect() == []


def test_the_driver_gets_a_row_for_each_node(spark):
    x, y, fold = make(16, 3000)
    rows = table(spark, x, y, fold)
    edges = boosting.bin_edges(rows, FEATURES)
    fits = [boosting.Boosted(0.0, edges) for _ in range(2)]
    binned = boosting._binned_table(rows, FEATURES, "k", fits, 1)
    trees = [boosting.Tree() for _ in fits]
    for tree in trees:
        tree.add((0.0, 0.0, 0), 0)
    sums = boosting._sums(binned, fits, [ALL, 0], 0, trees, [(0, 0), (1, 0)], np.arange(3), 1.0)
    assert sums.count() > 100  # cells, which stay in Spark
    found = boosting._best_splits(sums, 3, 1.0, 1.0, False)
    assert sorted(found) == [0, 1] and found[0][0][2] == 3000 and found[1][0][2] == (fold != 0).sum()
    for at, rows_of in ((0, fold >= 0), (1, fold != 0)):
        g, cells = 0.5 - y[rows_of], boosting._bins(x, edges)[rows_of]
        gains = {
            (j, b): sum(g[s].sum() ** 2 / (s.sum() / 4 + 1) for s in (cells[:, j] <= b, cells[:, j] > b)) - g.sum() ** 2 / (len(g) / 4 + 1)
            for j in range(3) for b in range(len(edges[j]))
        }
        gain, column, cut, left = found[at][1]
        assert gain == pytest.approx(max(gains.values())) and gains[column, cut] == pytest.approx(gain)
        assert left[2] == (cells[:, column] <= cut).sum()
