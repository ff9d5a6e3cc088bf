"""Scores and ranks against all inner products, and how many of the true neighbours are found."""

import math

import numpy as np

from assayer.llm import ann


def truth(vectors, query, k):
    scored = [(-float(np.dot(v, vectors[query])), i) for i, v in vectors.items() if i != query]
    return [i for _, i in sorted(scored)[:k]]


def test_recall_and_scores(spark):
    rng = np.random.default_rng(5)
    centres = rng.standard_normal((12, 24))
    rows = [(i, [float(x) for x in centres[i % 12] + rng.standard_normal(24)], i % 3) for i in range(3000)]
    table = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>, score int").repartition(4)
    vectors = {i: np.array(v, np.float32).astype(float) for i, v, _ in rows}
    found = {}
    for r in ann.neighbours(table, sample_rows=1500).collect():
        found.setdefault(r.query_id, []).append(r)
    assert set(found) == set(range(0, 3000, 20))
    hits = 0
    for q, got in found.items():
        got.sort(key=lambda r: r["rank"])
        assert [r["rank"] for r in got] == list(range(1, 21)) and len({r.vec_id for r in got}) == 20
        assert all(math.isclose(r.score, float(np.dot(vectors[q], vectors[r.vec_id])), rel_tol=1e-12, abs_tol=1e-12) for r in got)
        assert [(r.score, -r.vec_id) for r in got] == sorted(((r.score, -r.vec_id) for r in got), reverse=True)
        hits += len({r.vec_id for r in got} & set(truth(vectors, q, 20)))
    assert hits >= 0.9 * 20 * len(found)


def test_equal_and_unusable_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(i, [1.0, 0.0], "x") for i in range(60)] + [(100, [0.9, 0.5], "x"), (120, [0.0, 1.0], "x")]
    rows += [(140, None, "x"), (160, [0.0, 0.0], "x"), (180, [1.0, None], "x"), (200, [nan, 1.0], "x"), (220, [inf, 1.0], "x"), (240, [], "x")]
    rows += [(None, [1.0, 0.0], "x"), (260, [1.0, 2.0, 3.0], "x"), (261, [1.0, 2.0, 2.0], "x"), (0, [1.0, 0.0], "x")]
    table = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, rank string")
    found = {}
    for r in sorted(ann.neighbours(table).collect(), key=lambda r: (r.query_id, r["rank"])):
        found.setdefault(r.query_id, []).append((r.vec_id, r.score))
    assert set(found) == {0, 20, 40, 100, 120, 260}
    assert found[0] == [(i, 1.0) for i in range(1, 21)]
    assert found[20] == [(i, 1.0) for i in range(20)]
    assert found[40] == [(i, 1.0) for i in range(20)]
    assert found[100][:2] == [(0, 0.9), (1, 0.9)] and len(found[100]) == 20
    assert found[120][:3] == [(100, 0.5), (0, 0.0), (1, 0.0)]
    assert found[260] == [(261, 11.0)]


def test_small_and_empty_tables(spark):
    schema = "vec_id bigint, embedding array<float>"
    assert ann.neighbours(spark.createDataFrame([], schema)).count() == 0
    assert ann.neighbours(spark.createDataFrame([(0, [1.0])], schema)).count() == 0
    two = ann.neighbours(spark.createDataFrame([(0, [1.0, 2.0]), (7, [2.0, 1.0])], schema)).collect()
    assert [tuple(r) for r in two] == [(0, 1, 7, 4.0)]


def test_search_reaches_all_leaves_if_asked():
    rng = np.random.default_rng(1)
    rows = rng.standard_normal((500, 8))
    forest, _ = ann.fit(rows, 5, trees=2)
    sizes = [np.bincount(t.leaf_of(rows), minlength=t.leaves) for t in forest]
    assert all(s.sum() == 500 and s.max() <= ann.LEAF for s in sizes)
    reached = ann.search(forest, sizes, rows[3], np.inf)
    assert len(reached) == len(set(reached)) == sum(t.leaves for t in forest)
    assert reached[0][1] == forest[reached[0][0]].leaf_of(rows[3:4])[0]
