"""Centroid clustering (Lloyd's rounds on integer vectors) with the threshold algorithm.

For each dimension the centroids are sorted by their component. A vector walks each of these lists outward from its own
value, always to the nearer side. A centroid met for the first time is compared in full. The centroids not met yet are
at least as far away, in each dimension, as the next step of the walk; once the sum of these squares strictly exceeds the
best distance, none of them can be nearer, nor as near with a smaller number.

The centroids (`k` rows of `size` numbers) are all that the driver and every task hold. A round reads the
vectors once and sends one row of sums a centroid and task; no vector is shuffled.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assayer.scratch import written

K = 40
SIZE = 64
ROUNDS = 5
SCALE = 256
SEED = 2
LARGEST = 2**27  # of an integer component: the squared distance of two vectors of 64 of them stays below 2^62
AT_ONCE = 1000  # vectors compared together, which bounds a task's memory


class Lists:
    """The sorted lists of some centroids, an array of `k` rows."""

    def __init__(self, centroids: np.ndarray):
        self.centroids = centroids
        self.order = np.argsort(centroids, axis=0, kind="stable")
        # One value on each side, farther than any other, ends a walk.
        ends = np.full((1, centroids.shape[1]), 4 * LARGEST, np.int64)
        self.values = np.vstack([-ends, np.take_along_axis(centroids, self.order, 0), ends])

    def nearest(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """For each row of `vectors`: the number of the nearest centroid (the smallest of several), the
        squared distance, and how many centroids were compared in full."""
        n, k = len(vectors), len(self.centroids)
        best = np.full(n, np.iinfo(np.int64).max)
        number = np.full(n, k, np.int64)
        met = np.zeros((n, k), bool)
        dims = np.arange(vectors.shape[1])
        above = np.empty(vectors.shape, np.int64)
        for d in dims:
            above[:, d] = np.searchsorted(self.values[:, d], vectors[:, d])
        below = above - 1
        rows, x = np.arange(n), vectors
        while len(rows):
            up, down = self.values[above, dims] - x, x - self.values[below, dims]
            upward = up < down
            new = np.zeros((len(rows), k), bool)
            new[np.arange(len(rows))[:, None], self.order[np.where(upward, above, below) - 1, dims]] = True
            new &= ~met[rows]
            met[rows] |= new
            for c in range(k):
                mine = rows[new[:, c]]
                gap = vectors[mine] - self.centroids[c]
                far = np.einsum("ij,ij->i", gap, gap)
                nearer = (far < best[mine]) | ((far == best[mine]) & (c < number[mine]))
                best[mine[nearer]], number[mine[nearer]] = far[nearer], c
            above, below = above + upward, below - ~upward
            # What the next step will meet is the nearest that is left in each dimension.
            frontier = np.minimum(self.values[above, dims] - x, x - self.values[below, dims])
            bound = np.einsum("ij,ij->i", frontier, frontier)
            go = (bound <= best[rows]) & ~met[rows].all(1)
            rows, x, above, below = rows[go], x[go], above[go], below[go]
        return number, best, met.sum(1)


def integers(df: DataFrame, key: str, vector: str, size: int = SIZE, scale: int = SCALE) -> DataFrame:
    """(key, q): the vectors with exactly `size` components, none NULL or non-finite, each as floor(scale * x).

    Raises if an integer is beyond 2^27, as squared distances would no longer fit a long.
    """

    def whole(x: Column) -> Column:
        scaled = F.floor(x.cast("double") * scale)
        return F.when(F.abs(scaled) <= LARGEST, scaled).otherwise(F.raise_error(F.lit(f"a component beyond {LARGEST} / {scale}")))

    def unfit(x: Column) -> Column:
        return x.isNull() | F.isnan(x) | (F.abs(x.cast("double")) == float("inf"))

    fit = (F.size(vector) == size) & ~F.exists(vector, unfit)
    return df.where(fit).select(F.col(key), F.transform(vector, whole).alias("q"))


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _assigned(vectors: DataFrame, key: str, centroids: np.ndarray) -> DataFrame:
    """(key, cluster, distance) of each row."""
    schema = f"`{key}` {dict(vectors.dtypes)[key]}, cluster int, distance bigint"

    def batches(stream: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lists = Lists(centroids)
        for batch in stream:
            for start in range(0, batch.num_rows, AT_ONCE):
                part = batch.slice(start, AT_ONCE)
                number, best, _ = lists.nearest(_matrix(part.column("q")))
                columns = [part.column(key), pa.array(number, pa.int32()), pa.array(best, pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, [key, "cluster", "distance"])

    return vectors.mapInArrow(batches, schema)


def _moved(vectors: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """The centroids after a round: floor(sum / count) of their vectors; one without vectors stays."""
    k, size = centroids.shape

    def batches(stream: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lists, sums, any_row = Lists(centroids), np.zeros((k, size + 1), np.int64), False
        for batch in stream:
            for start in range(0, batch.num_rows, AT_ONCE):
                matrix = _matrix(batch.slice(start, AT_ONCE).column("q"))
                number = lists.nearest(matrix)[0]
                np.add.at(sums, number, np.hstack([matrix, np.ones((len(matrix), 1), np.int64)]))
                any_row = True
        if any_row:
            yield pa.RecordBatch.from_arrays([pa.array(range(k), pa.int32()), pa.array(list(sums), pa.list_(pa.int64()))], ["cluster", "sums"])

    partial = vectors.select("q").mapInArrow(batches, "cluster int, sums array<bigint>")
    flat = partial.select("cluster", F.posexplode("sums").alias("at", "s"))
    totals = flat.groupBy("cluster", "at").agg(F.sum(F.col("s").cast("decimal(20,0)")).alias("s"))
    exact = {(row.cluster, row["at"]): int(row.s) for row in totals.collect()}  # k * (size + 1) numbers
    moved = centroids.copy()
    for c in range(k):
        count = exact.get((c, size), 0)
        if count:
            moved[c] = [exact[c, d] // count for d in range(size)]
    return moved


def cluster(
    df: DataFrame, key: str = "vec_id", vector: str = "embedding", k: int = K, rounds: int = ROUNDS, seed: int = SEED, size: int = SIZE
) -> DataFrame:
    """(key, cluster, distance, cluster_inertia, inertia, centroid_sha256) of each vector that `integers` keeps.

    Centroids 0, 1, ... start as the `k` vectors with the smallest sha256 of `seed:key`, in its order. Rows that repeat a key
    are vectors of their own, equal hashes are ordered by their vectors, and NULL keys come last; with fewer than `k` vectors
    all of them are centroids. Ties go to the smaller number. An empty table gives an empty table; other columns are not
    read, whatever their names.
    """
    spark = df.sparkSession
    vectors = written(integers(df, key, vector, size), "integers")
    at = F.sha2(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string")), 256)
    first = vectors.select(at.alias("_at"), "q").orderBy(F.asc_nulls_last("_at"), "q").limit(k).collect()  # k rows
    centroids = np.array([row.q for row in first], np.int64).reshape(-1, size)
    for _ in range(rounds if len(first) else 0):
        centroids = _moved(vectors, centroids)
    assigned = written(_assigned(vectors, key, centroids), "assigned")
    sums = {row.cluster: row.s for row in assigned.groupBy("cluster").agg(F.sum("distance").alias("s")).collect()}  # k rows
    shas = spark.createDataFrame([(c, ",".join(map(str, row))) for c, row in enumerate(centroids.tolist())], "cluster int, listed string")
    inertia = spark.createDataFrame([(c, s, sum(sums.values())) for c, s in sums.items()], "cluster int, cluster_inertia bigint, inertia bigint")
    of_cluster = inertia.join(F.broadcast(shas), "cluster").select(*inertia.columns, F.sha2("listed", 256).alias("centroid_sha256"))
    return assigned.join(F.broadcast(of_cluster), "cluster").select(key, "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
