"""Targets against plain filling, flows against all flows of small networks, mixes against their targets."""

import itertools
import re

import pytest
from pyspark.sql import functions as F

from assayer.llm import mixing


def plain_targets(sizes, weights=mixing.WEIGHTS, copies=3):
    order = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    total, capped = sum(sizes.values()), set()
    while True:
        free = [s for s in order if s not in capped]
        left = total - sum(copies * sizes[s] for s in capped)
        share = {s: left * weight[s] / sum(weight[t] for t in free) for s in free}
        over = {s for s in free if share[s] > copies * sizes[s] + 1e-9}
        if not over:
            return {s: float(copies * sizes[s]) if s in capped else share[s] for s in order}
        capped |= over


def docs_of(spark, rows):
    return spark.createDataFrame(rows, "doc_id bigint, text string, source string, target string")


@pytest.fixture(scope="module")
def rows():
    out = []
    for i in range(900):
        source = "hot" if i % 3 == 0 else ["ä", "z", "Z", "b", None, "tiny"][i % 6]
        out.append((i, "w " * ((i * 37) % 90 if source != "tiny" else 1), source, "clash"))
    return [*out, (900, None, "b", None), (901, "", "only empty", None), (None, "a b c", "z", None), (5, out[5][1], out[5][2], None)]


def test_mix_meets_targets(spark, rows):
    found = mixing.mix(docs_of(spark, rows)).collect()
    assert len(found) == len(rows)
    sizes, taken, target = {}, {}, {}
    by_key = {r[0]: r for r in rows}
    for r in found:
        source = by_key[r.doc_id][2]
        assert r.size == len(re.findall(r"[^\x20\x09-\x0D]+", by_key[r.doc_id][1] or ""))
        assert 0 <= r.taken <= 3 * r.size and r.taken == r.copies * r.size
        sizes[source] = sizes.get(source, 0) + r.size
        taken[source] = taken.get(source, 0) + r.taken
        target[source] = r.target
    assert target == pytest.approx(plain_targets(sizes))
    assert {r.source_size for r in found if by_key[r.doc_id][2] == "hot"} == {sizes["hot"]}
    for source, wanted in target.items():
        assert abs(taken[source] - wanted) <= max(3, 0.01 * wanted), source
    assert target["tiny"] == 3 * sizes["tiny"] or target["tiny"] < 3 * sizes["tiny"]


def test_same_rows_same_mix_in_any_partitioning(spark, rows):
    one = mixing.mix(docs_of(spark, rows).coalesce(1))
    many = mixing.mix(docs_of(spark, rows[::-1]).repartition(7))
    key = lambda df: sorted(map(str, df.collect()))
    assert key(one) == key(many)


def cost(used, supply):
    """Convex: the first copy is free, the next costs 1 a word, the one after 2."""
    return sum(level * max(0, min(used - level * supply, supply)) for level in range(3))


@pytest.mark.parametrize("supply", [(2, 3, 2), (1, 1, 4), (3, 1, 1)])
@pytest.mark.parametrize("demand", [(4, 3), (1, 6), (5, 5), (2, 0)])
def test_flow_costs_least(supply, demand):
    patterns = {("a",): supply[0], ("a", "b"): supply[1], ("b",): supply[2]}
    wanted = dict(zip("ab", demand))
    arcs = [(p, s) for p in patterns for s in p]
    best = None
    for amounts in itertools.product(range(7), repeat=len(arcs)):
        used, got = dict.fromkeys(patterns, 0), dict.fromkeys("ab", 0)
        for (p, s), n in zip(arcs, amounts):
            used[p] += n
            got[s] += n
        if any(got[s] > wanted[s] for s in got) or any(used[p] > 3 * patterns[p] for p in patterns):
            continue
        value = (-sum(got.values()), sum(cost(used[p], patterns[p]) for p in patterns))
        best = value if best is None else min(best, value)
    flow = mixing.min_cost_flow(patterns, wanted)
    total = sum(sum(f.values()) for f in flow.values())
    paid = sum(cost(sum(f.values()), patterns[p]) for p, f in flow.items())
    assert (-total, paid) == pytest.approx(best)
    assert all(v >= -1e-9 for f in flow.values() for v in f.values())


def test_overlapping_sources(spark):
    rows = [(i, "w " * 10, ["a"] if i < 20 else ["a", "b"] if i < 40 else ["b"] if i < 45 else ["c"]) for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, sources array<string>")
    sized = mixing.measured(docs, F.col("sources"))
    targets = spark.createDataFrame([("a", 200.0), ("b", 250.0), ("c", 75.0)], "source string, target double")
    patterns = sized.groupBy("pattern").agg(F.sum("size").cast("bigint").alias("supply"))
    flows = {tuple(r.pattern): r.words for r in mixing.route(patterns, targets).collect()}
    assert flows == pytest.approx({("a",): 200, ("a", "b"): 200, ("b",): 50, ("c",): 75})
    chosen = mixing.select(sized, mixing.route(patterns, targets))
    words = {tuple(r.pattern): r.n for r in chosen.groupBy("pattern").agg(F.sum(F.col("size") * F.col("copies")).alias("n")).collect()}
    assert words[("a",)] == 200 and words[("a", "b")] == 200 and abs(words[("c",)] - 75) <= 5


def test_empty_table(spark):
    assert mixing.mix(docs_of(spark, [])).count() == 0
    assert [r.taken for r in mixing.mix(docs_of(spark, [(1, None, None, None)])).collect()] == [0]
