"""All registered queries."""

from assayer.plans import queries_curate, queries_ingest, queries_quality, queries_scoring, queries_staging  # noqa: F401
from assayer.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
