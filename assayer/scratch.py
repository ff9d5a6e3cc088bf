"""Tables an operator needs more than once are written to the shared folder and read back.

A written table survives the loss of any executor, is read column-pruned by every later pass,
and cuts the lineage.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_SETTING = "spark.checkpoint.dir"
_LOCAL: dict[str, str] = {}  # the folder of each local application that names none


def shared_folder(spark: SparkSession) -> str:
    """The folder named by `spark.checkpoint.dir`; a temporary one only in local mode."""
    configured = spark.conf.get(_SETTING, None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(f"set {_SETTING} to a folder that every executor can reach")
    application = spark.sparkContext.applicationId
    if application not in _LOCAL:
        _LOCAL[application] = tempfile.mkdtemp(prefix="assayer-")
    return _LOCAL[application]


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex[:12]}"


def written(df: DataFrame, name: str, path: str | None = None) -> DataFrame:
    """`df` as a Parquet table in the shared folder."""
    spark = df.sparkSession
    path = path or new_path(spark, name)
    df.write.mode("overwrite").parquet(path)
    return spark.read.schema(df.schema).parquet(path)
