import random

import pytest
from pyspark.sql import functions as F

from assayer import scratch
from assayer.operators import ranking
from assayer.operators.ranking import competition_rank, dense_codes, medians, order_statistics, running_totals


def _values(kind):
    rng = random.Random(7)
    if kind == "spread":
        return [rng.uniform(-1e6, 1e6) for _ in range(5000)]
    if kind == "third is one value":
        return [3.5 if rng.random() < 0.34 else rng.gauss(3.5, 2) for _ in range(5000)]
    if kind == "outliers":
        return [rng.expovariate(1) ** 9 for _ in range(4000)] + [1e300, -1e300]
    return [float(rng.randrange(3)) for _ in range(3000)]


@pytest.mark.parametrize("kind", ["spread", "third is one value", "outliers", "few values"])
def test_order_statistics_equal_a_sort(spark, kind):
    values = _values(kind)
    df = spark.createDataFrame([(v,) for v in values] + [(None,)], "x double").repartition(3)
    n = len(values)
    ranks = [1, 2, n // 3, n // 2, n // 2 + 1, n - 1, n]
    # So narrow that the search has to go on until almost nothing is left.
    found = order_statistics(df, {"x": ranks}, {"x": n}, rows_at_once=5, accuracy=50)
    assert [found["x", r] for r in ranks] == [sorted(values)[r - 1] for r in ranks]


def test_order_statistics_keep_long_values_exact(spark):
    base = 2**60
    df = spark.range(2000).select((F.col("id") + base).alias("x"))
    found = order_statistics(df, {"x": [1, 777, 2000]}, {"x": 2000}, rows_at_once=3, accuracy=20)
    assert [found["x", r] for r in (1, 777, 2000)] == [base, base + 776, base + 1999]


def test_ranks_out_of_range_are_refused(spark):
    with pytest.raises(ValueError, match="rank 4"):
        order_statistics(spark.range(3).toDF("x"), {"x": [4]}, {"x": 3})


def test_medians(spark):
    df = spark.createDataFrame([(1, 1.0, None), (2, 4.0, None), (4, None, None), (7, 2.0, None)], "n bigint, x double, z double")
    assert medians(df, ["n", "x", "z"]) == ({"n": 3.0, "x": 2.0, "z": None}, {"n": 0, "x": 1, "z": 4})


def test_running_totals_equal_a_loop(spark):
    rng = random.Random(1)
    data = sorted({(rng.choice("ab"), rng.randrange(10**6)) for _ in range(3000)})
    table = [(g, v, rng.randrange(5)) for g, v in data]
    df = spark.createDataFrame(table, "g string, v bigint, n bigint").repartition(5)
    out = running_totals(df, "v", {"upto": "n"}, ["g"], {"all": "n"}).collect()
    expected, total = {}, {}
    for g, v, n in table:
        total[g] = total.get(g, 0) + n
        expected[g, v] = total[g]
    assert {(r.g, r.v): r.upto for r in out} == expected
    assert {r.g: r["all"] for r in out} == total


def ranges(spark, monkeypatch, df, by):
    """Rows of each range that `running_totals` cuts `df` into."""
    seen = []
    monkeypatch.setattr(ranking, "written", lambda df, name: seen.append(scratch.written(df, name)) or seen[-1])
    running_totals(df, "v", {"upto": "n"}, by, {"all": "n"}).collect()
    return sorted(r["count"] for r in seen[0].groupBy("_range").count().collect())


def test_groups_that_share_one_score_give_even_ranges(spark, monkeypatch):
    one = spark.range(500).select(F.format_string("g%03d", "id").alias("g"), F.lit(0.5).alias("v"), F.lit(1).alias("n")).repartition(5)
    sizes = ranges(spark, monkeypatch, one, ["g"])
    assert len(sizes) >= 12 and sizes[-1] <= 3 * 500 / len(sizes)


def test_a_heavy_group_takes_several_ranges(spark, monkeypatch):
    group = F.when(F.col("id") < 3000, "heavy").when(F.col("id") < 3010, F.lit(None)).otherwise(F.format_string("g%03d", "id"))
    df = spark.range(3400).select(group.alias("g"), F.col("id").alias("v"), F.lit(1).cast("bigint").alias("n")).repartition(5)
    sizes = ranges(spark, monkeypatch, df, ["g"])
    assert len(sizes) >= 12 and sizes[-1] <= 3 * 3400 / len(sizes)
    out = {(r.g, r.v): (r.upto, r["all"]) for r in running_totals(df, "v", {"upto": "n"}, ["g"], {"all": "n"}).collect()}
    assert len(out) == 3400 and out["heavy", 2999] == (3000, 3000) and out["heavy", 0] == (1, 3000)
    assert out[None, 3004] == (5, 10) and out["g3399", 3399] == (1, 1)


def test_rank_puts_null_first_and_ties_together(spark):
    df = spark.createDataFrame([("a", 0.5), ("b", None), ("c", 0.9), ("d", 0.5), ("e", 0.1), ("f", None)], "name string, f1 double")
    ranks = {r.name: r["rank"] for r in competition_rank(df, "f1").collect()}
    assert ranks == {"b": 1, "f": 1, "c": 3, "a": 4, "d": 4, "e": 6}


def test_codes_follow_the_order_of_the_values(spark):
    names = [f"k{i:05d}" for i in range(2000)]
    df = spark.createDataFrame([(n,) for n in names * 2] + [(None,)], "name string").repartition(6)
    assert {r.name: r.code for r in dense_codes(df, "name").collect()} == {n: i for i, n in enumerate(names)}
