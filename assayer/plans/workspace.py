"""Landed tables that several queries read, built once per session and input folder."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from assayer.plans import inputs
from assayer.plans.refinery import to_staging
from assayer.scratch import new_path
from assayer.spec import Settings

_LANDED: dict[tuple[str, str, str], str] = {}


def landed(spark: SparkSession, folder: str, name: str, build: Callable[[], DataFrame]) -> DataFrame:
    key = (spark.sparkContext.applicationId, folder, name)
    if key not in _LANDED:
        path = new_path(spark, name)
        build().write.parquet(path)
        _LANDED[key] = path
    return spark.read.parquet(_LANDED[key])


def forget() -> None:
    """Lets every landed table be built again."""
    _LANDED.clear()


def raw(spark: SparkSession, folder: str) -> DataFrame:
    return landed(spark, folder, "raw", lambda: inputs.raw(spark, folder))


def staging(spark: SparkSession, folder: str) -> DataFrame:
    return landed(
        spark, folder, "staging", lambda: to_staging(raw(spark, folder), inputs.SPEC, Settings(), inputs.RUN)[0]
    )
