"""Reproducible tabular pipelines on Spark."""

from assayer.plans.refinery import Refinery, Warehouse, read_baseline, to_staging
from assayer.session import build_session
from assayer.sources.audit import Run
from assayer.sources.landing import Landing
from assayer.spec import ModelSpec, Rule, Settings, TableSpec

__all__ = [
    "Landing",
    "ModelSpec",
    "Refinery",
    "Rule",
    "Run",
    "Settings",
    "TableSpec",
    "Warehouse",
    "build_session",
    "read_baseline",
    "to_staging",
]
