"""The walk finds what a comparison with every centroid finds; whole rounds equal plain Python."""

import hashlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from assayer.llm import centroids


def plain(matrix, middle):
    far = ((matrix[:, None, :] - middle[None]) ** 2).sum(2)
    return far.argmin(1), far.min(1)


@settings(max_examples=150, deadline=None)
@given(st.integers(0, 2**32 - 1), st.integers(1, 12), st.integers(1, 6), st.integers(1, 40))
def test_walk_equals_all_distances(seed, k, size, spread):
    random = np.random.default_rng(seed)
    middle = random.integers(-spread, spread + 1, (k, size))  # small numbers, so that ties and equal centroids occur
    matrix = random.integers(-spread, spread + 1, (50, size))
    number, best, _ = centroids.Lists(middle).nearest(matrix)
    for found, expected in zip((number, best), plain(matrix, middle)):
        assert found.tolist() == expected.tolist()


def test_walk_stops_early():
    middle = np.arange(0, 4000, 100)[:, None] * np.ones((1, 8), np.int64)
    number, best, compared = centroids.Lists(middle).nearest(middle[[3, 17]] + 1)
    assert number.tolist() == [3, 17] and best.tolist() == [8, 8] and compared.max() <= 2


def test_largest_components():
    middle = np.array([[centroids.LARGEST] * 64, [-centroids.LARGEST] * 64])
    number, best, _ = centroids.Lists(middle).nearest(-middle)
    assert number.tolist() == [1, 0] and best.tolist() == [0, 0]
    assert centroids.Lists(middle[:1]).nearest(middle[1:])[1].tolist() == [64 * 2**56]


def brute(rows, k, rounds, size):
    kept = []
    for key, vector in rows:
        if vector is not None and len(vector) == size and all(x is not None and np.isfinite(x) for x in vector):
            kept.append((key, [int(np.floor(256 * float(x))) for x in vector]))
    kept.sort(key=lambda r: (r[0] is None, hashlib.sha256(f"2:{r[0]}".encode()).hexdigest(), r[1]))
    matrix = np.array([q for _, q in kept], np.int64).reshape(-1, size)
    middle = matrix[:k].copy()
    for _ in range(rounds):
        number = plain(matrix, middle)[0]
        for c in set(number.tolist()):
            mine = matrix[number == c]
            middle[c] = [int(s) // len(mine) for s in mine.sum(0)]
    number, best = plain(matrix, middle)
    shas = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in middle.tolist()]
    return [(key, int(c), int(b), int(best[number == c].sum()), int(best.sum()), shas[c]) for (key, _), c, b in zip(kept, number, best)]


SCHEMA = "label int, embedding array<float>, vec_id bigint, cluster string, q int, distance int, _at int"


def table(spark, rows):
    return spark.createDataFrame([(1, v, key, "x", 2, 3, 4) for key, v in rows], SCHEMA)


def test_equals_plain_rounds(spark, rows):
    random = np.random.default_rng(5)
    data = [(i, (random.normal(size=4) * (1 + i % 3)).astype(np.float32).tolist()) for i in range(300)]
    data += [(7, data[7][1]), (7, data[8][1]), (None, data[9][1]), (301, [-0.001, 0.0, 0.5, 1e3])]
    data += [(302, None), (303, []), (304, [1.0, 2.0, 3.0]), (305, [1.0, None, 0.0, 0.0]), (306, [float("nan")] * 4), (307, [float("inf")] * 4)]
    data += [(400 + i, [0.25, 0.5, 0.75, 1.0]) for i in range(200)]  # a large group of equal vectors
    found = centroids.cluster(table(spark, data).repartition(5), k=7, size=4)
    assert found.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    expected = sorted(brute(data, 7, 5, 4), key=lambda t: tuple((v is None, str(v)) for v in t))
    assert rows(found) == expected


def test_fewer_vectors_than_centroids_and_none(spark, rows):
    assert rows(centroids.cluster(table(spark, [(1, [1.0, 2.0]), (2, [0.0, 0.0])]), k=5, size=2)) == sorted(
        brute([(1, [1.0, 2.0]), (2, [0.0, 0.0])], 5, 5, 2), key=lambda t: tuple((v is None, str(v)) for v in t)
    )
    assert centroids.cluster(table(spark, []), k=5, size=2).collect() == []
    assert centroids.cluster(table(spark, [(1, None)]), k=5, size=2).collect() == []


def test_refuses_what_a_long_cannot_hold(spark):
    with pytest.raises(Exception, match="component beyond"):
        centroids.cluster(table(spark, [(1, [1e9, 0.0])]), k=1, size=2)
