"""A verification finds the partitions that changed and reads no other."""

from pyspark.sql import functions as F

from assayer.scratch import written
from assayer.sources import content_ledger as ledger
from assayer.sources.files import replace_partitions

ODD = "a b+c:d%e"


def states(spark, table, kept):
    verified = written(ledger.verify(spark, table, kept), "verified")
    ledger.keep(verified, kept)
    return {r.partition: (r.status, r.row_count) for r in verified.collect()}


def test_a_changed_partition_is_found_and_others_are_not_read(spark, tmp_path, monkeypatch):
    table, kept = str(tmp_path / "t"), str(tmp_path / "kept")
    rows = spark.range(40).select("id", F.when(F.col("id") % 4 == 0, ODD).otherwise((F.col("id") % 4).cast("string")).alias("p"))
    replace_partitions(rows, table, "p")
    first = states(spark, table, kept)
    odd = next(p for p in first if p not in ("p=1", "p=2", "p=3"))
    assert set(first.values()) == {("NEW", 10)} and len(first) == 4

    opened, plain = [], ledger.contents
    monkeypatch.setattr(ledger, "contents", lambda s, path, names: opened.append(names) or plain(s, path, names))
    assert set(states(spark, table, kept).values()) == {("SAME", 10)} and opened == []

    replace_partitions(rows.where("p = '1'").withColumn("id", F.col("id") + F.when(F.col("id") == 5, 1).otherwise(0)), table, "p")
    replace_partitions(rows.where(F.col("p") == ODD).repartition(3).sortWithinPartitions(F.desc("id")), table, "p")
    replace_partitions(spark.createDataFrame([(1, "9")], "id bigint, p string"), table, "p")
    for file in (tmp_path / "t" / "p=3").iterdir():
        file.unlink()
    found = states(spark, table, kept)
    assert found == {"p=1": ("CHANGED", 10), "p=2": ("SAME", 10), odd: ("REWRITTEN", 10), "p=3": ("GONE", None), "p=9": ("NEW", 1)}
    assert opened == [sorted(["p=1", odd, "p=9"])]
    assert {s for s, _ in states(spark, table, kept).values()} == {"SAME"}


def test_a_table_without_partitions_and_one_without_rows(spark, tmp_path):
    table, kept = str(tmp_path / "t"), str(tmp_path / "kept")
    spark.range(3).write.parquet(table)
    assert states(spark, table, kept) == {"": ("NEW", 3)}
    spark.range(3).union(spark.range(1)).write.mode("overwrite").parquet(table)
    assert states(spark, table, kept) == {"": ("CHANGED", 4)}
    spark.range(0).write.mode("overwrite").parquet(table)
    assert states(spark, table, kept) == {"": ("CHANGED", 0)}


def test_paths_are_taken_apart_by_file(spark, tmp_path):
    table = str(tmp_path / "t")
    rows = spark.range(60).select(F.when(F.col("id") % 7 > 0, F.col("id") % 5).alias("id"), F.when(F.col("id") < 30, ODD).otherwise("1").alias("p"))
    replace_partitions(rows.repartition(3), table, "p")
    folders = sorted(p.name for p in (tmp_path / "t").iterdir() if "=" in p.name)
    found = ledger.contents(spark, table, [r.partition for r in ledger.stamps(spark, table).collect()])
    by_row = spark.read.option("basePath", table).parquet(table)
    expected = by_row.groupBy("p").agg(F.sum(ledger.content_number(by_row.columns)).cast("string").alias("f")).collect()
    assert len(folders) == 2 and sorted(r.row_count for r in found.collect()) == [30, 30]
    assert sorted(r.fingerprint for r in found.collect()) == sorted(r.f for r in expected)
    # The first aggregate is by file, so no row's path is taken apart.
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "Aggregate [_file#" in plan
