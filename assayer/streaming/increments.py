"""Incremental ingestion with Structured Streaming: every arriving file is landed exactly once.

The stream processes whatever has arrived and stops. A micro-batch is written to a partition of its
own and committed with the list of its files, so

* a crash before the commit leaves rows nobody reads, and the replay overwrites them;
* a crash after the commit is recognised by the batch id;
* with a lost checkpoint all files come again, and those in the ledger are skipped.

Rows that landed before are found in an index of hashes (`sources.hash_index`), of which a micro-batch reads the
partitions of its own hashes.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from assayer.operators.staging import keep_first
from assayer.scratch import written
from assayer.sources import ledger
from assayer.sources.audit import Run, with_audit
from assayer.sources.files import replace_partitions
from assayer.sources.hash_index import HashIndex
from assayer.sources.landing import PARTITIONS, Landing

KIND = "stream"


def _land_batch(
    batch: DataFrame, epoch: int, landing: Landing, run: Run, hashed: Sequence[str] | None, order: str | None
) -> None:
    spark = batch.sparkSession
    query = spark.sparkContext.getLocalProperty("sql.streaming.queryId")
    batch_id = f"{KIND}_{query}_{epoch:09d}"
    entries = landing.entries(spark)
    if ledger.is_committed(entries, KIND, batch_id=batch_id):
        return
    done = entries.where(F.col("kind") == KIND).select("source_file")
    counts = batch.groupBy(F.col("_source_file").alias("source_file")).agg(F.count(F.lit(1)).alias("rows"))
    files = written(counts.join(done, "source_file", "left_anti"), "files")
    if files.isEmpty():
        return
    # At most as many names as files in a micro-batch, which the source bounds.
    names = F.broadcast(files.select(F.col("source_file").alias("_source_file")))
    fresh = batch.join(names, "_source_file", "left_semi")
    audited = with_audit(fresh, run, batch_id, F.col("_source_file"), hashed=hashed)
    if order is not None:
        audited = keep_first(audited, "_row_hash", order)
        if not entries.isEmpty():
            index = HashIndex(landing.hashes)
            index.refresh(spark, landing)
            audited = index.new_rows(audited)
    replace_partitions(audited, landing.raw, *PARTITIONS)
    ledger.commit(files.withColumn("batch_id", F.lit(batch_id)), landing.ledger, KIND, run)


def ingest_arrivals(
    spark: SparkSession,
    source: str,
    schema: T.StructType,
    landing: Landing,
    run: Run,
    checkpoint: str,
    fmt: str = "parquet",
    hashed: Sequence[str] | None = None,
    new_rows_by: str | None = None,
    max_files: int = 1000,
    **options: str,
) -> None:
    """Lands all files that arrived in `source` and returns.

    `new_rows_by` names a unique ordering column; with it, a row that landed before is dropped.
    `max_files` bounds a micro-batch, and with it the file list of one commit.
    """
    arrivals = (
        spark.readStream.schema(schema)
        .format(fmt)
        .options(maxFilesPerTrigger=max_files, **options)
        .load(source)
        .select("*", F.col("_metadata.file_path").alias("_source_file"))
    )
    query = (
        arrivals.writeStream.foreachBatch(
            lambda batch, epoch: _land_batch(batch, epoch, landing, run, hashed, new_rows_by)
        )
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
