"""The index holds what the ledger makes visible, and arrivals read a part of it that does not grow."""

import os

import pytest
from pyspark.sql import functions as F

from assayer.sources import files, ledger
from assayer.sources.audit import Run, with_audit
from assayer.sources.hash_index import HashIndex
from assayer.sources.landing import PARTITIONS, Landing, ingest_full
from assayer.streaming.increments import ingest_arrivals


@pytest.fixture
def landing(tmp_path):
    return Landing(str(tmp_path / "raw"), str(tmp_path / "ledger"))


def land(spark, landing, first, last, batch, run="r1", commit=True):
    rows = with_audit(spark.range(first, last), Run(run, "2024-01-31 00:00:00"), batch, "f", hashed=["id"])
    files.replace_partitions(rows, landing.raw, *PARTITIONS)
    if commit:
        entry = spark.createDataFrame([(batch, "f", last - first)], "batch_id string, source_file string, rows bigint")
        ledger.commit(entry, landing.ledger, "stream", Run(run, f"2024-02-{int(run[1:]):02d} 00:00:00"))


def fresh(spark, index, first, last):
    batch = with_audit(spark.range(first, last), Run("x", "2024-01-31 00:00:00"), "b", "f", hashed=["id"])
    return sorted(r.id for r in index.new_rows(batch).select("id").collect())


def test_nothing_landed(spark, landing):
    index = HashIndex(landing.hashes)
    assert index.runs(spark) == [] and fresh(spark, index, 0, 3) == [0, 1, 2]
    index.refresh(spark, landing)
    assert index.runs(spark) == []


def test_batches_are_added_and_merged(spark, landing):
    index = HashIndex(landing.hashes, per_part=20, fan=3)
    for i in range(10):
        land(spark, landing, 30 * i, 30 * i + 30, f"b{i}")
        index.refresh(spark, landing)
    levels = sorted(run.level for run in index.runs(spark))
    assert levels == [0, 2] and sum(run.rows for run in index.runs(spark)) == 300
    assert sorted(os.listdir(f"{landing.hashes}/runs")) == sorted(run.name for run in index.runs(spark))
    assert fresh(spark, index, 250, 320) == list(range(300, 320))
    index.refresh(spark, landing)  # nothing to do
    assert sorted(run.level for run in index.runs(spark)) == levels


def test_only_what_is_committed_counts(spark, landing):
    index = HashIndex(landing.hashes)
    land(spark, landing, 0, 10, "b0")
    land(spark, landing, 10, 20, "b1", commit=False)
    index.refresh(spark, landing)
    assert fresh(spark, index, 0, 20) == list(range(10, 20))
    # Other stages use the ledger, too.
    entry = spark.createDataFrame([("r1", "x", 5)], "batch_id string, source_file string, rows bigint")
    ledger.commit(entry, landing.ledger, "staging", Run("r1", "2024-03-01 00:00:00"))
    index.refresh(spark, landing)
    assert len(index.runs(spark)) == 1


def test_a_batch_that_another_run_replaces(spark, landing):
    index = HashIndex(landing.hashes, fan=2)
    land(spark, landing, 0, 10, "b0")
    index.refresh(spark, landing)
    land(spark, landing, 10, 20, "b1")
    index.refresh(spark, landing)  # both are one run now
    land(spark, landing, 5, 8, "b0", run="r2")
    index.refresh(spark, landing)
    assert fresh(spark, index, 0, 21) == [0, 1, 2, 3, 4, 8, 9, 20]
    assert [run.rows for run in index.runs(spark)] == [13]


def test_the_same_run_lands_a_batch_anew(spark, landing):
    index, run = HashIndex(landing.hashes), Run("r1", "2024-01-31 00:00:00")
    ingest_full(spark.range(5), landing, run)
    index.refresh(spark, landing)
    ingest_full(spark.range(2, 9), landing, run, force=True)
    index.refresh(spark, landing)
    assert fresh(spark, index, 0, 10) == [0, 1, 9]


def test_a_crash_before_the_catalog_leaves_nothing(spark, landing, monkeypatch):
    index = HashIndex(landing.hashes)
    land(spark, landing, 0, 10, "b0")

    def crash(*_):
        raise RuntimeError("lost the driver")

    with monkeypatch.context() as m:
        m.setattr(HashIndex, "_commit", crash)
        with pytest.raises(RuntimeError):
            index.refresh(spark, landing)
    assert index.runs(spark) == [] and fresh(spark, index, 0, 2) == [0, 1]
    index.refresh(spark, landing)
    assert fresh(spark, index, 0, 12) == [10, 11]


def test_bytes_read_stay_level(spark, landing):
    """Twenty batches of 500 rows: what a hash reads of a run is bounded, whatever has landed."""
    index, read, held = HashIndex(landing.hashes, per_part=500, fan=4), [], []
    probe = with_audit(spark.range(-1, 0), Run("x", "2024-01-31 00:00:00"), "b", "f", hashed=["id"]).select("_row_hash")
    for i in range(20):
        land(spark, landing, 500 * i, 500 * i + 500, f"b{i:02d}")
        index.refresh(spark, landing)
        scan = index.scan(spark, probe)
        read.append(sum(os.path.getsize(f.removeprefix("file://")) for f in scan.inputFiles()) / len(index.runs(spark)))
        held.append(sum(run.rows for run in index.runs(spark)))
        assert all("/raw-hashes/" in f for f in scan.inputFiles())  # and no history
        assert scan.count() <= 2 * 500 * len(index.runs(spark))
    assert held[-1] == 20 * 500 and max(read[10:]) <= 1.5 * max(read[:3])
    assert len(index.runs(spark)) <= 3 * 3


def test_arrivals_with_repeated_rows(spark, landing, tmp_path):
    source, checkpoint = str(tmp_path / "in"), str(tmp_path / "checkpoint")
    for i in range(6):  # each repeats the half of the one before
        spark.range(10 * i, 10 * i + 20).coalesce(1).write.mode("append").parquet(source)
        ingest_arrivals(spark, source, spark.range(1).schema, landing, Run(f"r{i}", f"2024-02-{i + 1:02d} 00:00:00"), checkpoint, new_rows_by="id")
    landed = landing.visible(spark)
    assert sorted(r.id for r in landed.select("id").collect()) == list(range(70))
    assert landed.groupBy("_batch_id").agg(F.count("*").alias("n")).where("n > 20").isEmpty()
