import pytest
from pyspark.sql import functions as F

from assayer.plans import queries_ingest
from assayer.sources import files, ledger
from assayer.sources.audit import Run, with_audit
from assayer.sources.landing import PARTITIONS, Landing
from assayer.streaming import increments
from assayer.streaming.increments import ingest_arrivals

RUN = Run("r1", "2024-01-31 00:00:00")


@pytest.fixture
def stage(spark, tmp_path):
    """arrive(first, last): rows arrive as files; ingest(): one run of the stream; seen(): visible ids."""

    class Stage:
        landing = Landing(str(tmp_path / "raw"), str(tmp_path / "ledger"))
        source, checkpoint = str(tmp_path / "in"), str(tmp_path / "checkpoint")

        def arrive(self, first, last, part=2):
            self.frame(first, last).repartition(part).write.mode("append").parquet(self.source)

        def frame(self, first, last):
            return spark.range(first, last).select("id", (F.col("id") % 3).alias("kind"))

        def ingest(self, run=RUN, checkpoint=None, **how):
            ingest_arrivals(spark, self.source, self.frame(0, 1).schema, self.landing, run, checkpoint or self.checkpoint, **how)

        def seen(self):
            return sorted(r.id for r in self.landing.visible(spark).collect())

    return Stage()


def test_arrivals_are_landed_once(stage, tmp_path):
    stage.arrive(0, 10)
    stage.ingest()
    stage.ingest()
    assert stage.seen() == list(range(10))
    stage.arrive(10, 15)
    stage.ingest(Run("r2", "2024-02-01 00:00:00"))
    assert stage.seen() == list(range(15))
    # All files come again without the checkpoint; the ledger knows them.
    stage.ingest(checkpoint=str(tmp_path / "fresh"))
    assert stage.seen() == list(range(15))


def test_small_batches(spark, stage):
    stage.arrive(0, 12, part=5)
    stage.ingest(max_files=2)
    assert stage.seen() == list(range(12))
    files_per_batch = stage.landing.entries(spark).groupBy("batch_id").count().collect()
    assert len(files_per_batch) > 1 and max(r["count"] for r in files_per_batch) == 2


@pytest.mark.parametrize("lost_checkpoint", [False, True])
def test_crash_between_write_and_commit(spark, stage, tmp_path, monkeypatch, lost_checkpoint):
    stage.arrive(0, 10)

    def crash(*_):
        raise RuntimeError("lost the driver")

    with monkeypatch.context() as m:
        m.setattr(increments.ledger, "commit", crash)
        with pytest.raises(Exception, match="lost the driver"):
            stage.ingest()
    assert stage.landing.rows(spark).count() == 10  # written, but not visible
    assert stage.landing.entries(spark).isEmpty()
    stage.ingest(Run("r2", "2024-02-01 00:00:00"), str(tmp_path / "fresh") if lost_checkpoint else None)
    assert stage.seen() == list(range(10))


def test_rows_that_landed_before_are_dropped(spark, stage):
    full = with_audit(stage.frame(0, 5), RUN, "full", "f")
    files.replace_partitions(full, stage.landing.raw, *PARTITIONS)
    counts = full.groupBy(F.col("_batch_id").alias("batch_id"), F.col("_source_file").alias("source_file")).agg(F.count("*").alias("rows"))
    ledger.commit(counts, stage.landing.ledger, "full", RUN)
    stage.arrive(0, 8)
    stage.arrive(4, 9)
    stage.ingest(new_rows_by="id")
    assert stage.seen() == list(range(9))


def test_events_sent_again_with_another_value_or_time_are_new_rows(spark, tmp_path):
    rows = [(1, "2024-01-10 10:00:00", 7, "click", 1.0, "{}"), (1, "2024-01-10 10:00:00", 7, "click", 2.0, "{}")]
    rows += [(1, "2024-01-10 10:00:01", 7, "click", 1.0, "{}"), (2, "2024-01-20 10:00:00", 8, "view", None, "{}"), rows[0]]
    schema = "event_id bigint, ts string, user_id bigint, event_type string, value double, props string"
    spark.createDataFrame(rows, schema).withColumn("ts", F.col("ts").cast("timestamp")).write.parquet(f"{tmp_path}/events.parquet")
    found = queries_ingest.stream_new_rows(spark, str(tmp_path)).collect()
    assert sorted((r.day, r.n) for r in found) == [("2024-01-10", 3), ("2024-01-20", 1)]


def test_batches_are_landed_with_all_columns(spark, tmp_path, monkeypatch):
    spark.createDataFrame([(i, i * 2, 0.5 * i, "p") for i in range(9)], "event_id bigint, user_id bigint, value double, props string").withColumns(
        {"ts": F.lit("2024-01-10").cast("timestamp"), "event_type": F.lit("view")}
    ).write.parquet(f"{tmp_path}/events.parquet")
    seen = []
    monkeypatch.setattr(queries_ingest.reports, "raw_audit", lambda raw: seen.append(raw.columns) or raw.withColumn("ingested_at_utc", F.col("_ingested_at_utc")))
    queries_ingest.raw_audit(spark, str(tmp_path))
    assert {"event_id", "ts", "user_id", "event_type", "value", "props"} <= set(seen[0])
