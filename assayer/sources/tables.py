"""Bulk load of result tables: catalog-free Parquet tables, or a database through JDBC."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame

IF_EXISTS = {"replace": "overwrite", "append": "append", "fail": "errorifexists"}

JDBC_ROWS_PER_INSERT = 500
JDBC_CONNECTIONS = 16


def _mode(if_exists: str) -> str:
    if if_exists not in IF_EXISTS:
        raise ValueError(f"if_exists must be one of {sorted(IF_EXISTS)}, not {if_exists!r}")
    return IF_EXISTS[if_exists]


def load_table(df: DataFrame, path: str, if_exists: str = "replace") -> None:
    df.write.mode(_mode(if_exists)).parquet(path)


def load_jdbc(df: DataFrame, url: str, table: str, if_exists: str = "replace", **properties: str) -> None:
    """Inserts in batches over at most JDBC_CONNECTIONS connections, as a database allows only so many.

    `df` should be a written table, so that nothing but the inserts runs on those few tasks.
    """
    options = {
        "url": url,
        "dbtable": table,
        "batchsize": JDBC_ROWS_PER_INSERT,
        "numPartitions": JDBC_CONNECTIONS,
        "truncate": "true",
    }
    df.write.format("jdbc").mode(_mode(if_exists)).options(**{**options, **properties}).save()


def load_curated(curated: DataFrame, folder: str, if_exists: str = "replace") -> list[str]:
    """curated_full, curated_train and curated_test from the one curated table."""
    parts = {
        "curated_full": curated,
        "curated_train": curated.where("_split = 'train'"),
        "curated_test": curated.where("_split = 'test'"),
    }
    for name, rows in parts.items():
        load_table(rows, f"{folder}/{name}", if_exists)
    return list(parts)


def table_exists(spark, path: str) -> bool:
    try:
        spark.read.parquet(path)
    except AnalysisException as problem:
        if "PATH_NOT_FOUND" in str(problem) or "UNABLE_TO_INFER_SCHEMA" in str(problem):
            return False
        raise
    return True
