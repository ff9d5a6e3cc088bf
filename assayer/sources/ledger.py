"""The ledger of committed batches.

Rows become visible when their batch is in the ledger: a crash between writing a batch and
committing it leaves rows that no reader sees and that the next attempt replaces.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from assayer.sources.audit import Run
from assayer.sources.tables import table_exists

SCHEMA = "kind string, batch_id string, run_id string, source_file string, rows bigint, committed_at timestamp, identity string"


def read(spark: SparkSession, path: str) -> DataFrame:
    if not table_exists(spark, path):
        return spark.createDataFrame([], SCHEMA)
    return spark.read.schema(SCHEMA).parquet(path)


def commit(entries: DataFrame, path: str, kind: str, run: Run) -> None:
    """Appends (batch_id, source_file, rows[, identity]) entries as one file, so that all appear or none.

    There is one entry per batch and source file of a single commit.
    """
    stamped = entries.select(
        F.lit(kind).alias("kind"),
        "batch_id",
        F.lit(run.run_id).alias("run_id"),
        F.col("source_file").cast("string").alias("source_file"),
        F.col("rows").cast("bigint").alias("rows"),
        F.lit(run.at).cast("timestamp").alias("committed_at"),
        (F.col("identity") if "identity" in entries.columns else F.lit(None)).cast("string").alias("identity"),
    )
    stamped.coalesce(1).write.mode("append").parquet(path)


def is_committed(ledger: DataFrame, kind: str, run_id: str | None = None, batch_id: str | None = None) -> bool:
    found = ledger.where(F.col("kind") == kind)
    if run_id is not None:
        found = found.where(F.col("run_id") == run_id)
    if batch_id is not None:
        found = found.where(F.col("batch_id") == batch_id)
    return not found.isEmpty()


def uncommitted(df: DataFrame, committed: DataFrame) -> DataFrame:
    """Rows of batches that are not in `committed` (batch_id)."""
    done = committed.select(F.col("batch_id").alias("_batch_id")).distinct()
    return df.join(done, "_batch_id", "left_anti")


def visible(landed: DataFrame, ledger: DataFrame) -> DataFrame:
    """The landed rows of committed batches; of a batch committed by several runs, the newest."""
    at = F.struct("committed_at", "run_id")
    newest = ledger.groupBy(F.col("batch_id").alias("_batch_id")).agg(F.max_by("run_id", at).alias("_pipeline_run_id"))
    return landed.join(newest, ["_batch_id", "_pipeline_run_id"], "left_semi")


def latest_run(ledger: DataFrame, kind: str = "full") -> DataFrame:
    """(run_id, committed_at) of the newest commit; by ledger, not by file time."""
    newest = ledger.where(F.col("kind") == kind).select("run_id", "committed_at")
    return newest.orderBy(F.desc("committed_at"), F.desc("run_id")).limit(1)


def latest_snapshot(landed: DataFrame, ledger: DataFrame, kind: str = "full") -> DataFrame:
    """The rows of the newest committed run; its id is looked up first, so only its partition is read."""
    newest = latest_run(ledger, kind).first()
    if newest is None:
        raise LookupError(f"no committed {kind} run")
    return landed.where(F.col("_pipeline_run_id") == newest.run_id)
