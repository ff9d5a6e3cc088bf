"""File sources and sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from assayer.sources.audit import public_columns

# A CSV file with line breaks inside quotes cannot be split, so files are kept small enough
# to be read by one task each.
ROWS_PER_CSV_FILE = 50_000

CSV_OPTIONS = {
    "header": True,
    "quote": '"',
    "escape": '"',
    "ignoreLeadingWhiteSpace": False,
    "ignoreTrailingWhiteSpace": False,
    "encoding": "UTF-8",
}


def read_csv(spark: SparkSession, path: str, columns: list[str], position: str | None = None) -> DataFrame:
    """All columns as text, by position, of files that this library wrote; casts come later (`cast_declared`). Free text may
    span lines. Files of others are read by `csv_files.read_arrived`.

    `position` names an ordinal to be added: unique, and ascending in reading order. Positions
    depend on how files are packed into tasks, so they are fixed by landing the rows; where a
    key must not depend on the files at all, the row hash is one.
    """
    schema = T.StructType([T.StructField(c, T.StringType()) for c in columns])
    rows = spark.read.schema(schema).options(**CSV_OPTIONS, multiLine=True, mode="FAILFAST").csv(path)
    return rows if position is None else rows.withColumn(position, F.monotonically_increasing_id())


def read_jsonl(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(schema).json(path)


def export_parquet(df: DataFrame, path: str, mode: str = "overwrite") -> str:
    df.write.mode(mode).parquet(path)
    return path


def export_csv(df: DataFrame, path: str, mode: str = "overwrite") -> str:
    df.write.mode(mode).options(**CSV_OPTIONS, maxRecordsPerFile=ROWS_PER_CSV_FILE).csv(path)
    return path


def export_jsonl(df: DataFrame, path: str, mode: str = "overwrite") -> str:
    """JSON lines; a NULL is written, not left out."""
    df.write.mode(mode).option("ignoreNullFields", False).json(path)
    return path


def publish(df: DataFrame, folder: str, name: str = "curated_published") -> dict[str, str]:
    """The public columns in three formats. `df` should be a written table: each format reads it."""
    public = df.select(*public_columns(df))
    return {
        "parquet": export_parquet(public, f"{folder}/{name}.parquet"),
        "csv": export_csv(public, f"{folder}/{name}.csv"),
        "jsonl": export_jsonl(public, f"{folder}/{name}.jsonl"),
    }


def export_partitioned(df: DataFrame, column: str, path: str) -> str | None:
    """Hive-partitioned Parquet; a rerun replaces the partitions it writes and adds no rows.

    Rows of one value are brought together but a hot value is spread over several tasks and files,
    which is what the rebalance hint asks for.
    """
    if column not in df.columns:
        return None
    balanced = df.select(*public_columns(df)).hint("rebalance", column)
    replace_partitions(balanced, path, column)
    return path


def replace_partitions(df: DataFrame, path: str, *columns: str) -> None:
    """Overwrites exactly the partitions that occur in `df`."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*columns).parquet(path)
