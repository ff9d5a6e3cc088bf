"""The fits of all folds in one scan a step.

A fit of cross-validation leaves one fold out, so the fits of a model read nearly the same rows. Here a task computes the
sums of all of them from each batch of rows, Spark adds the tasks' sums, and the driver, which sees nothing but
sums, moves all fits one step on:

* logistic regression: loss, gradient and Hessian of every fit, one Newton step a scan;
* decision trees: label counts by node, feature and bin of every fit, one level a scan. A node is split if it has
  `min_samples_split` rows or more, whatever its children have.

Fit -1 leaves no fold out. Features are numbers without NULLs.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ALL = -1  # the fit that leaves no fold out
MAX_BINS = 256
CELLS = 4_000_000  # counts that a task holds for one scan; more nodes take more scans
FOLD = "_fold"


def _columns(batch: pa.RecordBatch, features: Sequence[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(values, label, fold) of the rows of a batch."""
    values = np.column_stack([batch.column(f).to_numpy(zero_copy_only=False).astype(float) for f in features])
    label, fold = (batch.column(c).to_numpy(zero_copy_only=False).astype(int) for c in ("label", FOLD))
    return values, label, fold


# ---------------------------------------------------------------------------
# logistic regression
# ---------------------------------------------------------------------------


def _sums(train: DataFrame, features: Sequence[str], folds: Sequence[int], weights: np.ndarray) -> np.ndarray:
    """Loss, gradient and Hessian of each fit at its weights, without the penalty, as one row of numbers."""
    size = len(features) + 1

    def batches(stream: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((len(folds), 1 + size + size * size))
        for batch in stream:
            values, label, fold = _columns(batch, features)
            x = np.column_stack([values, np.ones(len(values))])
            for i, left_out in enumerate(folds):
                rows = fold != left_out
                xs, y = x[rows], label[rows]
                z = xs @ weights[i]
                p = 0.5 * (1 + np.tanh(z / 2))
                sums[i, 0] += np.logaddexp(0, z).sum() - z[y == 1].sum()
                sums[i, 1 : 1 + size] += xs.T @ (p - y)
                sums[i, 1 + size :] += ((xs * (p * (1 - p))[:, None]).T @ xs).ravel()
        yield pa.RecordBatch.from_arrays([pa.array(range(len(folds)), pa.int32()), pa.array(list(sums), pa.list_(pa.float64()))], ["fit", "sums"])

    partial = train.select(*features, "label", FOLD).mapInArrow(batches, "fit int, sums array<double>")
    flat = partial.select("fit", F.posexplode("sums").alias("at", "s")).groupBy("fit", "at").agg(F.sum("s").alias("s"))
    out = np.zeros((len(folds), 1 + size + size * size))
    for row in flat.collect():  # numbers of the fits, not of the rows
        out[row.fit, row["at"]] = row.s
    return out


def logistic_regressions(
    train: DataFrame, features: Sequence[str], folds: Sequence[int], c: float | Sequence[float] = 1.0, max_iter: int = 100, tolerance: float = 1e-8
) -> np.ndarray:
    """The weights of each fit, the last of them the intercept, which is not penalised.

    Minimises the sum of the losses and |w|^2 / (2 c), as `C` is commonly meant; one `c` for all fits or one for each.
    A step that does not lower the loss is halved. No rows, or a fit without any, give zeros.
    """
    size, n = len(features) + 1, len(folds)
    penalty = np.outer(1 / np.broadcast_to(np.asarray(c, float), n), np.append(np.ones(size - 1), 0))
    weights, step = np.zeros((n, size)), np.zeros((n, size))
    best, going = np.full(n, np.inf), np.ones(n, bool)
    for _ in range(max_iter):
        tried = weights - step
        sums = _sums(train, features, folds, tried)
        loss = sums[:, 0] + 0.5 * (penalty * tried**2).sum(1)
        gradient = sums[:, 1 : 1 + size] + penalty * tried
        lower = going & (loss <= best + 1e-12 * np.abs(loss))
        step[going & ~lower] /= 2
        for i in np.flatnonzero(lower):
            hessian = sums[i, 1 + size :].reshape(size, size) + np.diag(penalty[i])
            done = np.abs(gradient[i]).max() <= tolerance * max(1.0, hessian[-1, -1])
            weights[i], best[i], going[i] = tried[i], loss[i], not done
            step[i] = np.linalg.lstsq(hessian, gradient[i], rcond=None)[0]
        going &= np.abs(step).max(1) > 1e-12
        if not going.any():
            break
    return weights


def score_linear(rows: DataFrame, features: Sequence[str], weights: dict[int, np.ndarray], name: str, key: str) -> DataFrame:
    """(key, classifier, label, prediction, score, fold): each row by the fit that left its fold out, or by fit -1."""
    folds = sorted(weights)
    place = F.lit(1) if folds == [ALL] else F.col(FOLD) + 1

    def weight(j: int) -> F.Column:
        return F.element_at(F.array(*[F.lit(float(weights[f][j])) for f in folds]), place)

    z = weight(len(features))
    for j, f in enumerate(features):
        z = z + F.col(f) * weight(j)
    return _scored(rows, name, key, 1 / (1 + F.exp(-z)), F.lit(ALL) if folds == [ALL] else F.col(FOLD))


def _scored(rows: DataFrame, name: str, key: str, score: F.Column, fold: F.Column) -> DataFrame:
    scored = rows.select(key, F.lit(name).alias("classifier"), "label", score.alias("score"), fold.cast("int").alias("fold"))
    return scored.select(key, "classifier", "label", (F.col("score") > 0.5).cast("int").alias("prediction"), "score", "fold")


# ---------------------------------------------------------------------------
# decision trees
# ---------------------------------------------------------------------------


@dataclass
class Tree:
    """Nodes as parallel lists; a leaf has feature -1. A row goes left at `value <= threshold`."""

    feature: list[int] = field(default_factory=list)
    threshold: list[float] = field(default_factory=list)
    left: list[int] = field(default_factory=list)
    right: list[int] = field(default_factory=list)
    counts: list[tuple[int, int]] = field(default_factory=list)  # rows of label 0 and 1
    depth: list[int] = field(default_factory=list)

    def add(self, counts: tuple[int, int], depth: int) -> int:
        for values, value in zip((self.feature, self.threshold, self.left, self.right, self.counts, self.depth), (-1, 0.0, -1, -1, counts, depth)):
            values.append(value)
        return len(self.feature) - 1

    def leaves(self, values: np.ndarray) -> np.ndarray:
        """The node each row ends in."""
        feature, threshold, left, right = (np.array(x) for x in (self.feature, self.threshold, self.left, self.right))
        at = np.zeros(len(values), int)
        while (inner := feature[at] >= 0).any():
            rows = np.flatnonzero(inner)
            node = at[rows]
            at[rows] = np.where(values[rows, feature[node]] <= threshold[node], left[node], right[node])
        return at

    def importances(self, features: Sequence[str]) -> list[tuple[str, float]]:
        """(feature, share of the impurity that its splits take away), the greatest first."""
        gini = lambda c: sum(c) - (c[0] ** 2 + c[1] ** 2) / sum(c)
        gain = dict.fromkeys(features, 0.0)
        for i, f in enumerate(self.feature):
            if f >= 0:
                gain[features[f]] += gini(self.counts[i]) - gini(self.counts[self.left[i]]) - gini(self.counts[self.right[i]])
        total = sum(gain.values()) or 1.0
        return sorted(((f, g / total) for f, g in gain.items()), key=lambda pair: (-pair[1], pair[0]))


def bin_edges(train: DataFrame, features: Sequence[str], bins: int = MAX_BINS) -> list[np.ndarray]:
    """Candidate thresholds of each feature: between its values if there are at most `bins`, else its quantiles."""
    kinds = train.agg(*[F.approx_count_distinct(f, 0.01).alias(f) for f in features]).first()
    few = [f for f in features if kinds[f] <= 0.9 * bins]  # so that the sets below stay near `bins` values
    sets = train.agg(*[F.collect_set(f).alias(f) for f in few]).first() if few else {}
    many = [f for f in features if f not in few]
    shares = [i / bins for i in range(1, bins)]
    cuts = train.agg(*[F.percentile_approx(f, shares, 100 * bins).alias(f) for f in many]).first() if many else {}
    edges = []
    for f in features:
        if f in few:
            values = np.array(sorted(sets[f]), float)
            edges.append((values[1:] + values[:-1]) / 2)
        else:
            edges.append(np.unique(np.array(cuts[f] or [], float)))
    return edges


def _splits(
    train: DataFrame, features: Sequence[str], edges: list[np.ndarray], trees: list[Tree], folds: Sequence[int], active: list[tuple[int, int]]
) -> dict[tuple[int, int], tuple]:
    """For each active (fit, node): the best split (feature, bin, left counts), from one scan."""
    d, width = len(features), MAX_BINS
    place = {pair: i for i, pair in enumerate(active)}

    def batches(stream: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells = len(active) * d * width
        counts = np.zeros((2, cells), np.int64)
        for batch in stream:
            values, label, fold = _columns(batch, features)
            binned = np.column_stack([np.searchsorted(edges[j], values[:, j], "left") for j in range(d)])
            for i, (tree, left_out) in enumerate(zip(trees, folds)):
                of = np.full(len(tree.feature), -1)
                for (fit, node), at in place.items():
                    if fit == i:
                        of[node] = at
                at = of[tree.leaves(values)]
                rows = (fold != left_out) & (at >= 0)
                code = ((at[rows, None] * d + np.arange(d)) * width + binned[rows]).ravel()
                ones = np.repeat(label[rows] == 1, d)
                for y in (0, 1):
                    counts[y] += np.bincount(code[ones == bool(y)], minlength=cells)
        found = np.flatnonzero(counts.sum(0))
        yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(counts[0, found]), pa.array(counts[1, found])], ["code", "n0", "n1"])

    partial = train.select(*features, "label", FOLD).mapInArrow(batches, "code bigint, n0 bigint, n1 bigint")
    cells = partial.groupBy("code").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1"))
    cells = cells.select(F.expr(f"code div {width}").alias("list"), (F.col("code") % width).alias("bin"), "n0", "n1")
    # At most `width` bins in a window.
    upto = "over (partition by list order by bin)"
    whole = "over (partition by list)"
    left = cells.select("list", "bin", *[F.expr(f"sum(n{y}) {upto}").alias(f"l{y}") for y in (0, 1)], *[F.expr(f"sum(n{y}) {whole}").alias(f"t{y}") for y in (0, 1)])
    left = left.withColumns({"r0": F.col("t0") - F.col("l0"), "r1": F.col("t1") - F.col("l1")}).where("r0 + r1 > 0")
    pure = [(F.col(f"{s}0") * F.col(f"{s}0") + F.col(f"{s}1") * F.col(f"{s}1")).cast("double") / (F.col(f"{s}0") + F.col(f"{s}1")).cast("double") for s in "lr"]
    first = [(-F.expr(f"list % {d}")).alias("f"), (-F.col("bin")).alias("b")]  # the first feature and bin of equals
    best = left.groupBy(F.expr(f"list div {d}").alias("at")).agg(F.max(F.struct((pure[0] + pure[1]).alias("s"), *first, "l0", "l1")).alias("m"))
    return {active[x["at"]]: (-x.m.f, -x.m.b, (x.m.l0, x.m.l1)) for x in best.collect()}  # a row for each active node


def decision_trees(
    train: DataFrame, features: Sequence[str], folds: Sequence[int], max_depth: int = 10, min_samples_split: int = 2
) -> list[Tree]:
    """A Gini tree for each fit.

    Of equal splits the first feature and the lowest threshold win. A node of one label, of fewer than
    `min_samples_split` rows, or whose rows are alike is a leaf. A fit without rows is a leaf without counts.
    """
    edges, trees = bin_edges(train, features), [Tree() for _ in folds]
    sizes = {(row[FOLD], row.label): row["count"] for row in train.groupBy(FOLD, "label").count().collect()}  # by fold and label
    for tree, left_out in zip(trees, folds):
        tree.add(tuple(sum(n for (f, y), n in sizes.items() if f != left_out and y == label) for label in (0, 1)), 0)
    grown = [(i, 0) for i in range(len(trees))]
    at_once = max(1, CELLS // (2 * len(features) * MAX_BINS))
    while grown:
        open_nodes = [(i, n) for i, n in grown if trees[i].depth[n] < max_depth and min(trees[i].counts[n]) > 0 and sum(trees[i].counts[n]) >= min_samples_split]
        grown, found = [], {}
        for start in range(0, len(open_nodes), at_once):
            found |= _splits(train, features, edges, trees, folds, open_nodes[start : start + at_once])
        for (i, node), (f, b, left) in found.items():
            tree, counts = trees[i], trees[i].counts[node]
            tree.feature[node], tree.threshold[node] = f, float(edges[f][b])
            tree.left[node] = tree.add(left, tree.depth[node] + 1)
            tree.right[node] = tree.add((counts[0] - left[0], counts[1] - left[1]), tree.depth[node] + 1)
            grown += [(i, tree.left[node]), (i, tree.right[node])]
    return trees


def score_trees(rows: DataFrame, features: Sequence[str], trees: dict[int, Tree], name: str, key: str) -> DataFrame:
    """(key, classifier, label, prediction, score, fold), the score being the share of label 1 in the leaf (0 in one without rows)."""

    def share(tree: Tree) -> Callable[[np.ndarray], np.ndarray]:
        counts = np.array(tree.counts, float)
        return lambda values: (counts[:, 1] / np.maximum(1, counts.sum(1)))[tree.leaves(values)]

    return _by_fold(rows, features, {f: share(tree) for f, tree in trees.items()}, name, key)


def score_margins(rows: DataFrame, features: Sequence[str], margins: dict[int, Callable], name: str, key: str) -> DataFrame:
    """(key, classifier, label, prediction, score, fold), the score being the logistic function of the margin."""
    fits = {f: lambda values, m=margin: 0.5 * (1 + np.tanh(m(values) / 2)) for f, margin in margins.items()}
    return _by_fold(rows, features, fits, name, key)


def _by_fold(rows: DataFrame, features: Sequence[str], fits: dict[int, Callable], name: str, key: str) -> DataFrame:
    """Rows scored by what `fits` holds for their fold, or by fit -1."""
    whole = sorted(fits) == [ALL]
    schema = f"`{key}` {dict(rows.dtypes)[key]}, label int, p double, fold int"

    def batches(stream: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in stream:
            values, _, fold = _columns(batch, features)
            fold = np.full(len(values), ALL) if whole else fold
            p = np.zeros(len(values))
            for f, scores in fits.items():
                mine = np.flatnonzero(fold == f)
                p[mine] = scores(values[mine])
            yield pa.RecordBatch.from_arrays([batch.column(key), pa.array(batch.column("label")).cast(pa.int32()), pa.array(p), pa.array(fold, pa.int32())], [key, "label", "p", "fold"])

    fold = F.col(FOLD) if FOLD in rows.columns else F.lit(ALL)
    scored = rows.select(key, *features, "label", fold.alias(FOLD)).mapInArrow(batches, schema)
    return _scored(scored, name, key, F.col("p"), F.col("fold"))
