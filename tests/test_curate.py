import math
from collections import Counter
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from assayer.operators import curate
from assayer.spec import Settings, TableSpec


def _labelled(spark, *sizes):
    data = [(c * 10**6 + i, c) for c, n in enumerate(sizes) for i in range(n)]
    return spark.createDataFrame(data, "k bigint, label int")


def _plain_quotas(sizes, test_size):
    rows = sum(sizes.values())
    total = math.ceil(Fraction(test_size) * rows)
    quotas = {c: total * n // rows for c, n in sizes.items()}
    for c in sorted(sizes, key=lambda c: (-(total * sizes[c] % rows), c))[: total - sum(quotas.values())]:
        quotas[c] += 1
    return quotas


def test_published_split_sizes(spark):
    out = curate.stratified_split(_labelled(spark, 684, 683), "label", "k").groupBy("label", "_split").count().collect()
    assert {(r.label, r._split): r["count"] for r in out} == {(0, "test"): 137, (1, "test"): 137, (0, "train"): 547, (1, "train"): 546}


@pytest.mark.parametrize("sizes, test_size", [((10**12, 7, 10**11 + 3), "0.333"), ((5, 5, 5, 1), "0.2"), ((1,), "0.1")])
def test_quotas_are_exact(spark, sizes, test_size):
    table = spark.createDataFrame(list(enumerate(sizes)), "label int, _n bigint")
    found = {r.label: r._quota for r in curate.split_quotas(table, "label", test_size).collect()}
    assert found == _plain_quotas(dict(enumerate(sizes)), test_size)


@pytest.mark.parametrize("sizes", [(1,), (1, 1), (3, 1), (10, 0, 25), (500, 7)])
def test_split_is_complete_and_exact(spark, sizes):
    df = _labelled(spark, *sizes)
    out = curate.stratified_split(df, "label", "k").collect()
    quotas = _plain_quotas({c: n for c, n in enumerate(sizes) if n}, "0.2")
    assert sorted(r.k for r in out) == sorted(r.k for r in df.collect())
    assert Counter(r.label for r in out if r._split == "test") == Counter({c: q for c, q in quotas.items() if q})


def test_split_does_not_depend_on_partitions(spark):
    df = _labelled(spark, 300, 200)
    first = curate.stratified_split(df, "label", "k")
    second = curate.stratified_split(df.repartition(13), "label", "k")
    assert first.exceptAll(second).isEmpty() and second.exceptAll(first).isEmpty()
    other = curate.stratified_split(df, "label", "k", seed=43)
    assert not first.exceptAll(other).isEmpty()


def test_rows_without_target_have_no_split(spark):
    df = spark.createDataFrame([(1, 0), (2, 0), (3, None)], "k bigint, label int")
    assert {r.k: r._split for r in curate.stratified_split(df, "label", "k").collect()}[3] is None


def test_as_many_classes_as_there_are(spark):
    df = spark.range(100_000).selectExpr("id as k", "id % 50000 as label")
    out = curate.stratified_split(df, "label", "k").groupBy("_split").count().collect()
    assert {r._split: r["count"] for r in out} == {"test": 20_000, "train": 80_000}


@pytest.mark.parametrize("sizes, folds", [((103, 57), 5), ((3, 2), 5), ((1,), 4), ((10, 10), 2)])
def test_folds_are_even_within_a_class(spark, sizes, folds):
    out = curate.stratified_folds(_labelled(spark, *sizes), "label", "k", folds=folds).collect()
    assert len(out) == sum(sizes)
    for c, n in enumerate(sizes):
        counts = Counter(r._fold for r in out if r.label == c)
        per_fold = [counts.get(f, 0) for f in range(folds)]
        assert sum(per_fold) == n and max(per_fold) - min(per_fold) <= 1


@pytest.mark.parametrize(
    "rows, sizes",
    [(0, {}), (1, {3: 1}), (2, {3: 2}), (3, {1: 1, 2: 1, 3: 1}), (10, {1: 3, 2: 3, 3: 4}), (1367, {1: 455, 2: 455, 3: 457})],
)
def test_batches_are_contiguous_with_the_rest_in_the_last(spark, rows, sizes):
    df = spark.range(rows).select((F.col("id") * 7 - 3).alias("ord")).repartition(4)
    out = curate.make_batches(df, "ord", 3).orderBy("ord").collect()
    assert Counter(r._batch_id for r in out) == Counter({f"batch_{b:02d}_of_03": n for b, n in sizes.items()})
    assert [r._batch_id for r in out] == sorted(r._batch_id for r in out)


def test_missing_class_is_a_class(spark):
    df = spark.createDataFrame([(1, "b"), (2, None), (3, "a"), (4, "b")], "k int, c string")
    assert {r.k: r.c for r in curate.label_encode(df, "c").collect()} == {1: 2, 2: 0, 3: 1, 4: 2}


def test_unseen_class(spark):
    codes = curate.fit_codes(spark.createDataFrame([("a",)], "c string"), "c")
    later = spark.createDataFrame([(1, "z")], "k int, c string")
    assert curate.apply_codes(later, "c", codes, unseen="null").first().c is None
    with pytest.raises(Exception, match="unseen class z"):
        curate.apply_codes(later, "c", codes).collect()
    with pytest.raises(ValueError):
        curate.apply_codes(later, "c", codes, unseen="drop")


def test_scaler_uses_population_deviation_of_the_training_rows(spark):
    df = spark.createDataFrame([("train", 1.0, 5), ("train", 3.0, 5), ("test", 9.0, 6)], "s string, x double, c bigint")
    out = curate.standard_scale(df, ["x", "c"], fit_on=F.col("s") == "train").collect()
    assert [(r.x, r.c) for r in out] == [(-1.0, 0.0), (1.0, 0.0), (7.0, 1.0)]


def test_curated_table(spark):
    spec = TableSpec(types={}, numeric=("x", "absent"), categorical=("c",), target="label", key="k")
    df = _labelled(spark, 40, 60).withColumn("x", F.col("k") % 17).withColumn("c", F.concat(F.lit("t"), F.col("k") % 3)).withColumn("_note", F.lit(1))
    rows, codes, params = curate.curated(df, spec, Settings(), "2024-01-31 00:00:00")
    assert rows.columns == ["k", "x", "c", "label", "_split", "_curated_at_utc"]
    assert [r["class"] for r in codes["c"].orderBy("code").collect()] == ["t0", "t1", "t2"]
    train = rows.where("_split = 'train'")
    assert train.select(F.round(F.avg("x"), 9), F.round(F.stddev_pop("x"), 9)).first() == (0.0, 1.0)
    manifest = curate.split_manifest(rows, spec, Settings()).first()
    assert (manifest.total_rows, manifest.train_rows, manifest.test_rows, manifest.features) == (100, 80, 20, "x,c")
