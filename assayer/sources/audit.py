"""Audit columns of landed rows."""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assayer.functions.hashing import row_hash


def public_columns(df: DataFrame) -> list[str]:
    return [c for c in df.columns if not c.startswith("_")]


@dataclass(frozen=True)
class Run:
    """Identity and time of a run, fixed once on the driver so that a retried task writes the same."""

    run_id: str
    at: str

    @staticmethod
    def new() -> "Run":
        return Run(uuid.uuid4().hex[:12], datetime.now(timezone.utc).strftime("%Y-%m-%d %H:%M:%S"))


def with_audit(
    df: DataFrame,
    run: Run,
    batch_id: str | Column = "full",
    source_file: str | Column | None = None,
    checksum: str | Column | None = None,
    hashed: Sequence[str] | None = None,
) -> DataFrame:
    """Adds run, time, source, batch and row hash; the hash covers the source columns only."""

    def column(value: str | Column | None) -> Column:
        return value if isinstance(value, Column) else F.lit(value).cast("string")

    return df.withColumns(
        {
            "_pipeline_run_id": F.lit(run.run_id),
            "_ingested_at_utc": F.lit(run.at).cast("timestamp"),
            "_source_file": column(source_file),
            "_source_checksum": column(checksum),
            "_batch_id": column(batch_id),
            "_row_hash": row_hash(list(hashed or public_columns(df))),
        }
    )
