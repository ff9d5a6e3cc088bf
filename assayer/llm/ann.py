"""Nearest neighbours by a forest of random-projection trees.

Trees are fitted on a bounded sample: a node splits its part of the sample at the median of its projections on the
difference of two random members. Every row of the table is then filed under one leaf of each tree. A query goes down
all trees at once through one priority queue: the node that the query is nearest to being in is
opened next, whichever tree it belongs to, until the leaves reached hold enough of the table. The leaves' rows are scored exactly.

How much of the table is enough is fitted too: sample rows query the sample, and the smallest share that finds the
wanted part of their true neighbours is taken. Equal vectors are one entry with a list of ids, so that no leaf holds copies.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from assayer.scratch import written

TREES = 6
LEAF = 64  # sample rows in a leaf at most
SAMPLE = 10_000  # rows the trees are fitted on; bounds the index that tasks hold
TRIALS = 200  # sample rows that query the sample to fit the share
RECALL = 0.95  # of the neighbours in the sample
BLOCK = 4_096  # rows of a leaf that one task compares at a time
SEED = 11


@dataclass
class Tree:
    """Inner nodes are numbered from 0; a child below 0 is leaf -child - 1."""

    normals: np.ndarray
    offsets: np.ndarray
    children: np.ndarray
    leaves: int

    def leaf_of(self, rows: np.ndarray) -> np.ndarray:
        at = np.zeros(len(rows), np.int64) if len(self.normals) else np.full(len(rows), -1)
        while (inner := np.flatnonzero(at >= 0)).size:
            nodes = at[inner]
            side = np.einsum("ij,ij->i", rows[inner], self.normals[nodes]) > self.offsets[nodes]
            at[inner] = self.children[nodes, side.astype(np.int64)]
        return -at - 1


def grow(rows: np.ndarray, rng: np.random.Generator, leaf: int = LEAF) -> Tree:
    normals, offsets, children, leaves = [], [], [], 0

    def place(part: np.ndarray) -> int:
        nonlocal leaves
        if len(part) > leaf:
            one, two = rows[rng.choice(part, 2, replace=False)]
            normal = one - two
            length = np.linalg.norm(normal)
            normal = normal / length if length else normal
            values = rows[part] @ normal
            offset = np.median(values)
            right = values > offset
            if right.any() and not right.all():
                node = len(normals)
                normals.append(normal)
                offsets.append(offset)
                children.append([0, 0])
                children[node] = [place(part[~right]), place(part[right])]
                return node
        leaves += 1
        return -leaves

    place(np.arange(len(rows)))
    size = rows.shape[1]
    return Tree(np.array(normals).reshape(-1, size), np.array(offsets), np.array(children, np.int64).reshape(-1, 2), leaves)


def search(trees: list[Tree], sizes: list[np.ndarray], query: np.ndarray, enough: float) -> list[tuple[int, int]]:
    """The (tree, leaf) pairs that one queue over all trees reaches until their rows are `enough`.

    A node's priority is the sum of the squared distances of the query from the planes it lies beyond.
    """
    margins = [tree.normals @ query - tree.offsets for tree in trees]
    queue = [(0.0, t, 0 if len(tree.normals) else -1) for t, tree in enumerate(trees)]
    heapq.heapify(queue)
    reached, held = [], 0.0
    while queue and held < enough:
        least, t, node = heapq.heappop(queue)
        while node >= 0:  # down to the leaf on the query's side; the other sides wait
            margin = margins[t][node]
            left, right = trees[t].children[node]
            near, far = (right, left) if margin > 0 else (left, right)
            heapq.heappush(queue, (least + margin * margin, t, far))
            node = near
        reached.append((t, -node - 1))
        held += sizes[t][-node - 1]
    return reached


def fit(sample: np.ndarray, k: int, trees: int = TREES, recall: float = RECALL, seed: int = SEED) -> tuple[list[Tree], float]:
    """The forest, and the share of the table that a query's leaves are to hold, summed over the trees."""
    rng = np.random.default_rng(seed)
    forest = [grow(sample, rng) for _ in range(trees)] if len(sample) else []
    if len(sample) <= 2 * k:
        return forest, float(trees)
    places = [tree.leaf_of(sample) for tree in forest]
    sizes = [np.bincount(place, minlength=tree.leaves) for place, tree in zip(places, forest)]
    needed = []
    for q in rng.choice(len(sample), min(TRIALS, len(sample)), replace=False):
        scores = sample @ sample[q]
        scores[q] = -np.inf
        # Every true neighbour is found when the first of its leaves is; what is held by then is its price.
        best, held = np.argpartition(-scores, k)[:k], 0.0
        price = np.full(k, np.inf)
        for t, leaf in search(forest, sizes, sample[q], np.inf):
            held += sizes[t][leaf]
            price = np.minimum(price, np.where(places[t][best] == leaf, held, np.inf))
        needed.append(price)
    return forest, float(np.quantile(np.concatenate(needed), recall)) / len(sample)


def _vectors(column: pa.Array) -> np.ndarray:
    size = len(column[0]) if len(column) else 0
    return np.array(column.flatten(), np.float64).reshape(len(column), size)


def usable(table: DataFrame, vector: str) -> DataFrame:
    """Rows whose vector is not NULL, empty or zero, and holds neither NULL nor what is not finite."""
    good = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return table.where(F.col(vector).isNotNull() & F.coalesce(good, F.lit(False)) & F.exists(vector, lambda x: x != 0))


def neighbours(
    table: DataFrame, every: int = 20, k: int = 20, key: str = "vec_id", vector: str = "embedding", sample_rows: int = SAMPLE
) -> DataFrame:
    """(query_id, rank, key, score): the `k` rows of largest inner product found for each query, ties to the smaller key.

    Queries are the rows whose key is divisible by `every`; a query's own key is no candidate. Scores are
    exact, in double precision. Vectors that are NULL, empty, zero, or hold a NULL or a number that is not finite take no part,
    nor do NULL keys. Vectors of different length never meet: each length has its own index. Rows that share a key and a vector
    count once. An empty table gives an empty table. Other columns are not read.
    """
    good = usable(table.where(F.col(key).isNotNull()).select(F.col(key).alias("id"), F.col(vector).alias("v")), "v")
    # Entries are different vectors. Only the smallest k + 1 ids of one can be an answer.
    entries = good.select("id", "v", F.xxhash64("v").alias("h")).distinct()
    numbered = written(entries.groupBy("h", "v").agg(F.min("id").alias("entry"), F.count("*").alias("n")).withColumn("size", F.size("v")), "vectors")
    lengths = [r["size"] for r in numbered.groupBy("size").count().select("size").orderBy("size").collect()]
    found = [_search(numbered.where(F.col("size") == n), entries.where(F.size("v") == n), every, k, sample_rows) for n in lengths]
    kind = dict(table.dtypes)[key]
    empty = table.sparkSession.createDataFrame([], f"query_id {kind}, rank int, id {kind}, score double")
    for part in found:
        empty = empty.union(part)
    return empty.select("query_id", "rank", F.col("id").alias(key), "score")


def _search(vectors: DataFrame, entries: DataFrame, every: int, k: int, sample_rows: int) -> DataFrame:
    spark = vectors.sparkSession
    rows = vectors.count()
    # A seeded order picks the sample, so that a rerun fits the same trees.
    picked = vectors.where(F.pmod(F.xxhash64(F.lit(SEED), "h"), F.lit(2**30)) < int(min(1.0, 2 * sample_rows / max(rows, 1)) * 2**30))
    picked = picked.orderBy(F.xxhash64(F.lit(SEED), "h"), "entry").limit(sample_rows).select("v").toArrow()  # bounded by sample_rows
    forest, share = fit(_vectors(picked.column("v").combine_chunks()), k)
    index = spark.sparkContext.broadcast(forest)

    def file(stream: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in stream:
            if batch.num_rows:
                values = _vectors(batch.column("v"))
                places = np.stack([tree.leaf_of(values) for tree in index.value], axis=1).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("entry"), batch.column("v"), pa.array(list(places), pa.list_(pa.int32()))], ["entry", "v", "leaves"]
                )

    element = dict(vectors.dtypes)["v"]
    filed = vectors.select("entry", "v").mapInArrow(file, f"entry bigint, v {element}, leaves array<int>")
    filed = written(filed.select("entry", "v", F.posexplode("leaves").alias("tree", "leaf")), "leaves")
    # One number for each leaf: as many as the sample allows.
    held = {(r.tree, r.leaf): r["count"] for r in filed.groupBy("tree", "leaf").count().collect()}
    sizes = [np.array([held.get((t, leaf), 0) for leaf in range(tree.leaves)], float) for t, tree in enumerate(forest)]
    shared = spark.sparkContext.broadcast(sizes)
    enough = share * rows

    def probe(stream: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in stream:
            for start in range(0, batch.num_rows, 256):
                part = batch.slice(start, 256)
                reached = [search(index.value, shared.value, q, enough) for q in _vectors(part.column("v"))]
                yield pa.RecordBatch.from_arrays(
                    [part.column("query_id"), part.column("v"), pa.array([[{"tree": t, "leaf": n} for t, n in r] for r in reached], _PLACES)],
                    ["query_id", "v", "places"],
                )

    queries = entries.where(F.pmod("id", F.lit(every)) == 0).select(F.col("id").alias("query_id"), "v")
    probes = queries.mapInArrow(probe, f"query_id bigint, v {element}, places array<struct<tree: int, leaf: int>>")
    # A leaf with many rows is cut into blocks, and its queries go to each of them.
    blocks = spark.createDataFrame(
        [(t, n, int(-(-size // BLOCK))) for t, part in enumerate(sizes) for n, size in enumerate(part)] or [(0, 0, 0)], "tree int, leaf int, blocks int"
    )
    cut = filed.join(F.broadcast(blocks), ["tree", "leaf"]).withColumn("block", F.pmod(F.xxhash64("entry"), F.col("blocks")).cast("int"))
    asked = probes.select("query_id", "v", F.explode("places").alias("p")).select("query_id", "v", "p.*").join(F.broadcast(blocks), ["tree", "leaf"])
    asked = asked.where("blocks > 0").select("query_id", "v", "tree", "leaf", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"))
    place = ["tree", "leaf", "block"]

    def score(some: pd.DataFrame, other: pd.DataFrame) -> pd.DataFrame:
        if some.empty or other.empty:
            return pd.DataFrame({"query_id": [], "entry": [], "score": []})
        rows_of, ids = np.stack(other["v"]).astype(np.float64), other["entry"].to_numpy()
        out = []
        for start in range(0, len(some), 1024):
            part = some.iloc[start : start + 1024]
            asks = np.stack(part["v"]).astype(np.float64)
            scores = asks @ rows_of.T
            top = min(k + 1, len(ids))
            # The block's best, with all that are as near to the last of them as rounding may be.
            last = np.partition(scores, len(ids) - top, axis=1)[:, len(ids) - top]
            slack = 1e-9 * (1 + np.abs(last))
            q, e = np.nonzero(scores >= (last - slack)[:, None])
            exact = np.einsum("ij,ij->i", asks[q], rows_of[e])
            out.append(pd.DataFrame({"query_id": part["query_id"].to_numpy()[q], "entry": ids[e], "score": exact}))
        return pd.concat(out)

    scored = asked.groupBy(place).cogroup(cut.select("entry", "v", *[F.col(c).alias(f"_{c}") for c in place]).groupBy(*[f"_{c}" for c in place]))
    scored = scored.applyInPandas(score, "query_id bigint, entry bigint, score double")
    best = _top(scored.groupBy("query_id", "entry").agg(F.max("score").alias("score")), "entry", k + 1)
    best = written(best, "found")
    # The members of an entry, the smallest of its ids first.
    ids = entries.join(vectors.where("n > 1").select("h", "v", "entry"), ["h", "v"]).select("entry", "id")
    order = F.row_number().over(Window.partitionBy("entry").orderBy("id"))
    wanted = best.join(vectors.where("n > 1").select("entry"), "entry", "left_semi").select("entry").distinct()
    ids = ids.join(wanted, "entry").withColumn("n", order).where(F.col("n") <= k + 1).drop("n")
    members = written(ids.groupBy("entry").agg(F.collect_list("id").alias("ids")), "members")
    each = best.join(members, "entry", "left").select("query_id", "score", F.explode(F.coalesce("ids", F.array("entry"))).alias("id"))
    return _top(each.where("id <> query_id"), "id", k)


def _top(scored: DataFrame, tie: str, k: int) -> DataFrame:
    """The `k` best rows of each query; a query has no more rows than its leaves give."""
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), tie)
    return scored.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", tie, "score")


_PLACES = pa.list_(pa.struct([("tree", pa.int32()), ("leaf", pa.int32())]))
