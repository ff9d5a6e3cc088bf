"""Second-order boosted trees, all folds grown together.

A round adds a tree to each fit. A task computes, from each batch of rows, how many rows, which gradient and which Hessian of the
logistic loss fall into each bin of each feature of each open node of all fits; Spark adds the tasks' sums and takes the best split of
each node, and the driver, which gets one row a node, splits it. So a level of the trees of all folds costs one scan.

* Rows are binned once (a byte a feature) and written with the margin of every fit; the margins are written anew every `REFRESH` trees,
  so that a scan never walks more trees than these.
* Sums are whole multiples of 2^-32, so they and the trees are the same however the rows are partitioned.
* A tree draws its columns once, not at each node, and its rows by a hash of their key: equal keys are drawn together.

Features are numbers without NULLs; NaN goes right. Fit -1 leaves no fold out.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assayer.operators.many_fits import ALL, FOLD, MAX_BINS, Tree, bin_edges, score_margins
from assayer.scratch import written

REFRESH = 10  # trees between two writings of the margins
CELLS = 1_000_000  # sums of a kind that a task holds for one scan; more nodes take more scans
_UNIT = 2.0**32
_LEAST_GAIN = 1e-9
_SUMMED = ("n", "g_high", "g_low", "h_high", "h_low")  # a sum is its upper part and its lower 32 bits


@dataclass
class Boosted:
    """Trees whose thresholds are bins of `edges`; a node of a tree adds its value to the margin of the rows that end in it."""

    base: float
    edges: list[np.ndarray]
    trees: list[Tree] = field(default_factory=list)  # counts: (gradient, Hessian, rows)
    values: list[np.ndarray] = field(default_factory=list)
    gains: list[dict[int, float]] = field(default_factory=list)  # of the split nodes of each tree

    def binned(self, values: np.ndarray) -> np.ndarray:
        return _bins(values, self.edges)

    def margin(self, binned: np.ndarray) -> np.ndarray:
        """What the trees add to the base."""
        out = np.zeros(len(binned))
        for tree, value in zip(self.trees, self.values):
            out += value[tree.leaves(binned)]
        return out

    def since(self, first: int) -> Boosted:
        """The trees from `first` on alone, which is all that a scan sends to the tasks."""
        return Boosted(0.0, [], self.trees[first:], self.values[first:])

    def importances(self, features: Sequence[str]) -> list[tuple[str, float]]:
        """(feature, share of the gain of all splits), the greatest first."""
        gain = dict.fromkeys(features, 0.0)
        for tree, gains in zip(self.trees, self.gains):
            for node, g in gains.items():
                gain[features[tree.feature[node]]] += g
        total = sum(gain.values()) or 1.0
        return sorted(((f, g / total) for f, g in gain.items()), key=lambda pair: (-pair[1], pair[0]))


def _bins(values: np.ndarray, edges: list[np.ndarray]) -> np.ndarray:
    return np.column_stack([np.searchsorted(e, values[:, j], "left") for j, e in enumerate(edges)]).astype(np.uint8)


def _share(draw: np.ndarray, number: int) -> np.ndarray:
    """A number in [0, 1) for each row and tree, from the hash of the row's key."""
    mixed = draw.view(np.uint64) + np.uint64((number + 1) * 0x9E3779B97F4A7C15 % 2**64)
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        mixed = (mixed ^ (mixed >> np.uint64(shift))) * np.uint64(factor)
    return ((mixed ^ (mixed >> np.uint64(31))) >> np.uint64(11)) * 2.0**-53


_BINNED = f"bins binary, label int, {FOLD} int, draw bigint, margin array<double>"


def _arrays(batch: pa.RecordBatch, width: int, fits: int) -> tuple[np.ndarray, ...]:
    """(bins, label, fold, draw, margins) of the rows of a batch of the binned table."""
    bins = np.frombuffer(b"".join(batch.column("bins").to_pylist()), np.uint8).reshape(-1, width)
    label, fold, draw = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("label", FOLD, "draw"))
    return bins, label, fold, draw, batch.column("margin").flatten().to_numpy().reshape(-1, fits)


def _record(bins: np.ndarray, label, fold, draw, margin: np.ndarray) -> pa.RecordBatch:
    lists = pa.ListArray.from_arrays(np.arange(len(bins) + 1, dtype=np.int32) * margin.shape[1], margin.ravel())
    columns = [pa.array([b.tobytes() for b in bins], pa.binary()), *(pa.array(c, t) for c, t in ((label, pa.int32()), (fold, pa.int32()), (draw, pa.int64()))), lists]
    return pa.RecordBatch.from_arrays(columns, ["bins", "label", FOLD, "draw", "margin"])


def _binned_table(train: DataFrame, features: Sequence[str], key: str, fits: list[Boosted], seed: int) -> DataFrame:
    bases, edges = np.array([f.base for f in fits]), fits[0].edges

    def batches(stream: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in stream:
            values = np.column_stack([batch.column(i).to_numpy(zero_copy_only=False).astype(float) for i in range(len(edges))])
            rest = (batch.column(len(edges) + i).to_numpy(zero_copy_only=False) for i in range(3))
            yield _record(_bins(values, edges), *rest, np.tile(bases, (len(values), 1)))

    draw = F.xxhash64(F.lit(seed), F.col(key)).alias("draw")
    rows = train.select(*features, F.col("label").cast("int"), F.col(FOLD).cast("int"), draw)
    return written(rows.mapInArrow(batches, _BINNED), "binned")


def _refreshed(rows: DataFrame, fits: list[Boosted], first: int) -> DataFrame:
    """The binned table with what the trees from `first` on add to the margins."""
    width, fits = len(fits[0].edges), [f.since(first) for f in fits]

    def batches(stream: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in stream:
            bins, label, fold, draw, margin = _arrays(batch, width, len(fits))
            yield _record(bins, label, fold, draw, margin + np.column_stack([f.margin(bins) for f in fits]))

    return written(rows.mapInArrow(batches, _BINNED), "margins")


def _sums(
    rows: DataFrame, fits: list[Boosted], folds: Sequence[int], first: int, growing: list[Tree], active: list[tuple[int, int]],
    columns: np.ndarray, subsample: float,
) -> DataFrame:
    """(list, bin, n, g_high, g_low, h_high, h_low): rows, gradient and Hessian by bin, as each task has them. A list is a drawn column of an active node."""
    width, number, fits = len(fits[0].edges), len(fits[0].trees), [f.since(first) for f in fits]
    shape = (len(active), len(columns), MAX_BINS)
    cells = int(np.prod(shape))

    def batches(stream: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((3, cells), np.int64)
        for batch in stream:
            bins, label, fold, draw, margin = _arrays(batch, width, len(fits))
            drawn = _share(draw, number) < subsample
            for i, left_out in enumerate(folds):
                node_place = np.full(len(growing[i].feature), -1)
                for at, (fit, node) in enumerate(active):
                    if fit == i:
                        node_place[node] = at
                mine = np.flatnonzero(drawn & (fold != left_out))
                at = node_place[growing[i].leaves(bins[mine])]
                mine, at = mine[at >= 0], at[at >= 0]
                z = margin[mine, i] + fits[i].margin(bins[mine])
                p = 0.5 * (1 + np.tanh(z / 2))
                code = ((at[:, None] * len(columns) + np.arange(len(columns))) * MAX_BINS + bins[mine][:, columns]).ravel()
                for kind, amount in enumerate((np.ones(len(mine)), np.rint((p - label[mine]) * _UNIT), np.rint(p * (1 - p) * _UNIT))):
                    # Exact: a batch of 10,000 rows stays far below 2^53.
                    sums[kind] += np.bincount(code, np.repeat(amount, len(columns)), cells).astype(np.int64)
        found = np.flatnonzero(sums[0])
        parts = [found // MAX_BINS, found % MAX_BINS, sums[0, found], *(half for kind in (1, 2) for half in (sums[kind, found] >> 32, sums[kind, found] & 0xFFFFFFFF))]
        yield pa.RecordBatch.from_arrays(list(map(pa.array, parts)), names)

    names = ["list", "bin", *_SUMMED]
    return rows.mapInArrow(batches, ", ".join(f"{c} bigint" for c in names))


def _quality(side: str, weight: str) -> str:
    return f"if({weight} > 0, {side}_g * {side}_g / {weight}, 0D)"


def _best_splits(sums: DataFrame, width: int, penalty: float, min_child: float, first_order: bool) -> dict[int, tuple[tuple, tuple | None]]:
    """By place of an active node with rows: ((gradient, Hessian, rows), (gain, column, bin, the same of its left child) or None).

    The driver gets a row for each node, however many columns and bins it has. Text, as columns built one by one take longer than the job.
    """
    # One shuffle serves the sums and the windows, which hold the bins of a list each.
    cells = sums.repartition("list").groupBy("list", "bin").agg(*[F.expr(f"sum({c}) as {c}") for c in _SUMMED])
    windows = (("l", "partition by list order by bin rows unbounded preceding"), ("t", "partition by list"))
    upto = cells.selectExpr("list", "bin", *[f"sum({c}) over ({w}) as {s}_{c}" for s, w in windows for c in _SUMMED])
    real = [f"cast({s}_{k}_high as double) + cast({s}_{k}_low as double) / {_UNIT!r}D as {s}_{k}" for s in "lt" for k in "gh"]
    sides = upto.selectExpr("list", "bin", "l_n", "t_n", *real).selectExpr("*", *[f"t_{c} - l_{c} as r_{c}" for c in "ngh"])
    gain = [_quality(s, f"({s}_{'n' if first_order else 'h'} + {float(penalty)!r}D)") for s in "lrt"]
    allowed = f"l_n > 0 and r_n > 0 and l_h >= {float(min_child)!r}D and r_h >= {float(min_child)!r}D"
    # The first column and bin of equals.
    split = f"struct({gain[0]} + {gain[1]} - {gain[2]} as gain, -(list % {width}) as column, -bin as bin, l_g, l_h, l_n)"
    best = sides.groupBy(F.expr(f"list div {width} as at")).agg(
        F.expr("max(struct(t_g, t_h, t_n)) as total"), F.expr(f"max(if({allowed}, {split}, null)) as best")
    )
    found = {}
    for row in best.collect():  # a row for each active node
        m = row.best
        split = (m.gain, -m["column"], -m.bin, (m.l_g, m.l_h, m.l_n)) if m is not None and m.gain > _LEAST_GAIN else None
        found[row["at"]] = tuple(row.total), split
    return found


def boosted_trees(
    train: DataFrame, features: Sequence[str], folds: Sequence[int], key: str, n_estimators: int = 100, learning_rate: float = 0.3,
    max_depth: int = 3, subsample: float = 1.0, colsample: float = 1.0, penalty: float = 1.0, min_child: float = 1.0,
    first_order: bool = False, seed: int = 42,
) -> list[Boosted]:
    """`n_estimators` trees for each fit; `train` has `features`, `label`, `_fold` and `key`.

    A split is taken for its gain G^2 / (H + penalty), left and right less the node's own, where either child has a Hessian of
    `min_child` or more; `first_order` weighs the gain by rows instead of Hessians. A node adds
    -learning_rate * G / (H + penalty). Of equal splits the first feature and the lowest threshold win. The base is the log odds
    of the label (one label only: as if half a row had the other; a fit without rows: 0).
    """
    if max_depth < 1:
        raise ValueError("a tree needs a depth of 1 or more")
    folds, edges = list(folds), bin_edges(train, features)
    sizes = {(row[FOLD], row.label): row["count"] for row in train.groupBy(FOLD, "label").count().collect()}  # by fold and label
    fits = []
    for left_out in folds:
        no, yes = (sum(n for (f, y), n in sizes.items() if f != left_out and y == label) for label in (0, 1))
        fits.append(Boosted(float(np.log(max(yes, 0.5) / max(no, 0.5))) if no + yes else 0.0, edges))
    rows, first = _binned_table(train, features, key, fits, seed), 0
    taken = max(1, round(colsample * len(features)))
    at_once = max(1, CELLS // (taken * MAX_BINS))
    for number in range(n_estimators):
        columns = np.sort(np.random.default_rng([seed, number]).permutation(len(features))[:taken])
        growing, gains = [Tree() for _ in folds], [{} for _ in folds]
        for tree in growing:
            tree.add((0.0, 0.0, 0), 0)
        level = [(i, 0) for i in range(len(folds))]
        for depth in range(max_depth):
            opened, level = level, []
            for start in range(0, len(opened), at_once):
                active = opened[start : start + at_once]
                sums = _sums(rows, fits, folds, first, growing, active, columns, subsample)
                splits = _best_splits(sums, len(columns), penalty, min_child, first_order)
                for at, (i, node) in enumerate(active):
                    counts, split = splits.get(at, ((0.0, 0.0, 0), None))
                    tree = growing[i]
                    if depth == 0:
                        tree.counts[node] = counts
                    if split:
                        gains[i][node], column, cut, left = split
                        whole = tree.counts[node]
                        tree.feature[node], tree.threshold[node] = int(columns[column]), float(cut)
                        tree.left[node] = tree.add(left, depth + 1)
                        tree.right[node] = tree.add(tuple(a - b for a, b in zip(whole, left)), depth + 1)
                        level += [(i, tree.left[node]), (i, tree.right[node])]
            if not level:
                break
        for fit, tree, gain in zip(fits, growing, gains):
            g, h, _ = np.array(tree.counts, float).T
            fit.values.append(-learning_rate * np.divide(g, h + penalty, out=np.zeros_like(g), where=h + penalty > 0))
            fit.trees.append(tree)
            fit.gains.append(gain)
        if len(fits[0].trees) - first == REFRESH and number + 1 < n_estimators:
            rows, first = _refreshed(rows, fits, first), number + 1
    return fits


def score_boosted(rows: DataFrame, features: Sequence[str], fits: dict[int, Boosted], name: str, key: str) -> DataFrame:
    """(key, classifier, label, prediction, score, fold): P(1) of each row by the fit that left its fold out, or by fit -1."""
    return score_margins(rows, features, {f: lambda values, b=b: b.base + b.margin(b.binned(values)) for f, b in fits.items()}, name, key)
