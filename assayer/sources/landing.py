"""Full and batched ingestion into the raw table, partitioned by run and batch."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from assayer.operators.curate import batch_ids, make_batches
from assayer.scratch import written
from assayer.sources import ledger
from assayer.sources.audit import Run, with_audit
from assayer.sources.files import replace_partitions

PARTITIONS = ("_pipeline_run_id", "_batch_id")


@dataclass(frozen=True)
class Landing:
    """Where raw rows and the ledger of their batches live."""

    raw: str
    ledger: str

    @property
    def hashes(self) -> str:
        """Where the index of landed row hashes lives."""
        return f"{self.raw.rstrip('/')}-hashes"

    def rows(self, spark: SparkSession) -> DataFrame:
        # Partition values are read as text: a run id may be made of digits, with leading zeros.
        inferred = spark.read.parquet(self.raw).schema
        text = [T.StructField(f.name, T.StringType()) if f.name in PARTITIONS else f for f in inferred]
        return spark.read.schema(T.StructType(text)).parquet(self.raw)

    def entries(self, spark: SparkSession) -> DataFrame:
        return ledger.read(spark, self.ledger)

    def visible(self, spark: SparkSession) -> DataFrame:
        return ledger.visible(self.rows(spark), self.entries(spark))


def _land(audited: DataFrame, landing: Landing, run: Run, kind: str, identity: str | None = None) -> list[str]:
    """Writes the batches, then commits what was written, and names it."""
    spark = audited.sparkSession
    replace_partitions(audited, landing.raw, *PARTITIONS)
    mine = landing.rows(spark).where(F.col("_pipeline_run_id") == run.run_id)
    mine = mine.where(F.col("_batch_id") == "full" if kind == "full" else F.col("_batch_id") != "full")
    counts = mine.groupBy(F.col("_batch_id").alias("batch_id"), F.col("_source_file").alias("source_file"))
    entries = written(counts.agg(F.count(F.lit(1)).alias("rows")).withColumn("identity", F.lit(identity).cast("string")), "entries")
    ledger.commit(entries, landing.ledger, kind, run)
    return sorted(row[0] for row in entries.select("batch_id").distinct().collect())


def source_identity(source: DataFrame) -> str:
    """The same for tables with the same columns and rows, in any order."""
    total = F.sum(F.xxhash64(*[F.col(f"`{c}`") for c in sorted(source.columns)]).cast("decimal(20,0)"))
    rows, content = source.agg(F.count(F.lit(1)), total).first()
    return f"{rows}:{content}"


def ingest_full(
    source: DataFrame,
    landing: Landing,
    run: Run,
    force: bool = False,
    source_file: str | Column | None = None,
    checksum: str | Column | None = None,
    hashed: Sequence[str] | None = None,
) -> DataFrame:
    """Lands a whole source as one run. A run that is committed is left alone unless forced."""
    spark = source.sparkSession
    if force or not ledger.is_committed(landing.entries(spark), "full", run_id=run.run_id):
        _land(with_audit(source, run, "full", source_file, checksum, hashed), landing, run, "full")
    return landing.rows(spark).where((F.col("_pipeline_run_id") == run.run_id) & (F.col("_batch_id") == "full"))


def ingest_batches(
    source: DataFrame,
    ordinal: str,
    n_batches: int,
    landing: Landing,
    run: Run,
    force: bool = False,
    source_file: str | Column | None = None,
    checksum: str | Column | None = None,
    hashed: Sequence[str] | None = None,
) -> list[str]:
    """Lands the batches of a source that are not committed yet, and names them.

    A batch belongs to the content of its source: a source that has changed is landed anew, and its batches
    take the place of those of the same name. Batches of the same run that an earlier attempt committed are named and
    committed once more, which changes nothing for a reader.
    """
    spark = source.sparkSession
    identity = source_identity(source)
    committed = landing.entries(spark).where(F.col("kind") == "incremental").groupBy("batch_id")
    newest = committed.agg(F.max_by(F.struct("identity"), F.struct("committed_at", "run_id"))["identity"].alias("identity"))
    done = newest.where(F.col("identity") == identity).select("batch_id")
    if not force and {row[0] for row in done.collect()} >= set(batch_ids(n_batches)):
        return []
    batched = make_batches(source, ordinal, n_batches, "_batch_id")
    if not force:
        batched = ledger.uncommitted(batched, done)
    audited = with_audit(batched, run, F.col("_batch_id"), source_file, checksum, hashed)
    return [] if audited.isEmpty() else _land(audited, landing, run, "incremental", identity)
