"""Fingerprints of a partitioned Parquet table kept by partition, so that a verification reads only what may have changed.

A partition is a folder below the table's (``a=1/b=2``; '' where there is none). Its stamp is made from the names, lengths and
times of its files, which a listing gives without opening one. Only partitions whose stamp differs from the kept one
are read, and only their contents tell whether they have changed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from assayer.functions.hashing import content_number
from assayer.scratch import written
from assayer.sources.tables import table_exists

_KEPT = "partition string, stamp string, row_count bigint, fingerprint string"
_FOLDERS = r"((?:[^/]+=[^/]*/)*)[^/]+$"


def _partition(path: Column) -> Column:
    return F.rtrim(F.regexp_extract(path, _FOLDERS, 1), F.lit("/"))


def stamps(spark: SparkSession, path: str) -> DataFrame:
    """(partition, stamp) of each partition, from a listing alone."""
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.parquet").load(path)
    each = F.xxhash64(F.element_at(F.split("path", "/"), -1), "length", F.unix_micros("modificationTime")).cast("decimal(20,0)")
    files = listed.select(_partition(F.col("path")).alias("partition"), each.alias("file"))
    return files.groupBy("partition").agg(F.concat_ws(":", F.count(F.lit(1)), F.sum("file")).alias("stamp"))


def contents(spark: SparkSession, path: str, partitions: list[str]) -> DataFrame:
    """(partition, row_count, fingerprint) of the named partitions; no file of another one is opened."""
    root = path.rstrip("/")
    rows = spark.read.option("basePath", root).parquet(*[f"{root}/{_literal(p)}".rstrip("/") for p in partitions])
    columns = rows.columns
    numbered = rows.select(F.col("_metadata.file_path").alias("_file"), content_number(columns).alias("_number"))
    # By file first: to take a path apart costs more than the rest of a row's work.
    files = numbered.groupBy("_file").agg(F.count(F.lit(1)).alias("_rows"), F.sum("_number").alias("_sum"))
    # The path of a row's file is given in URL form.
    path = F.url_decode(F.replace(F.col("_file"), F.lit("+"), F.lit("%2B")))
    return files.groupBy(_partition(path).alias("partition")).agg(
        F.sum("_rows").alias("row_count"), F.sum("_sum").cast("string").alias("fingerprint")
    )


def _literal(partition: str) -> str:
    """The folder as a path in which nothing is a pattern."""
    return "".join(f"\\{c}" if c in "*?[]{}\\" else c for c in partition)


def read(spark: SparkSession, ledger: str) -> DataFrame:
    return spark.read.schema(_KEPT).parquet(ledger) if table_exists(spark, ledger) else spark.createDataFrame([], _KEPT)


def verify(spark: SparkSession, path: str, ledger: str) -> DataFrame:
    """(partition, status, stamp, row_count, fingerprint), one row for each partition there is or was.

    SAME (its files are those of the kept entry, which are not read), REWRITTEN (other files, the same rows in any order), CHANGED, NEW or
    GONE; counts and fingerprints are the present ones, NULL where it is gone. A partition of files without rows has 0 and '0'.
    A file that is replaced by one of the same name, length and time is taken for the same.
    """
    kept = read(spark, ledger).select("partition", *[F.col(c).alias(f"kept_{c}") for c in ("stamp", "row_count", "fingerprint")])
    state = written(stamps(spark, path).join(kept, "partition", "full_outer"), "partitions")
    stale = state.where(F.col("stamp").isNotNull() & ~F.col("stamp").eqNullSafe(F.col("kept_stamp")))
    names = sorted(r.partition for r in stale.select("partition").collect())  # folders that changed, not rows
    found = contents(spark, path, names) if names else spark.createDataFrame([], "partition string, row_count bigint, fingerprint string")
    joined = state.join(found, "partition", "left").withColumn("_read", F.col("partition").isin(names) if names else F.lit(False))
    unread = F.col("stamp").isNotNull() & ~F.col("_read")
    count, total = F.coalesce("row_count", F.lit(0)), F.coalesce("fingerprint", F.lit("0"))
    equal = count.eqNullSafe(F.col("kept_row_count")) & total.eqNullSafe(F.col("kept_fingerprint"))
    status = (
        F.when(F.col("stamp").isNull(), "GONE").when(unread, "SAME").when(F.col("kept_stamp").isNull(), "NEW")
        .when(equal, "REWRITTEN").otherwise("CHANGED")
    )
    present = [F.when(unread, F.col(f"kept_{c}")).when(F.col("stamp").isNotNull(), now).alias(c) for c, now in (("row_count", count), ("fingerprint", total))]
    return joined.select("partition", status.alias("status"), "stamp", *present)


def keep(verified: DataFrame, ledger: str) -> None:
    """Makes the present state, as `verify` gives it, the kept one. `verified` should be a written table."""
    rows = verified.where("status <> 'GONE'").select("partition", "stamp", "row_count", "fingerprint")
    written(rows, "ledger").coalesce(1).write.mode("overwrite").parquet(ledger)
