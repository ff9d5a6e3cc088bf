"""Numeric expressions whose results do not depend on the order in which a sum was taken."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def rounded(value: Column, digits: int) -> Column:
    """`value` rounded half-up at `digits`, through a decimal, as a double.

    The decimal has ten places, so noise in the last bits of a parallel sum is gone before the
    final rounding.
    """
    return F.round(value.cast("decimal(30,10)"), digits).cast("double")


def fixed_point(value: Column, digits: int) -> Column:
    """`value` as text with exactly `digits` decimals."""
    return F.round(value.cast("decimal(30,10)"), digits).cast(f"decimal(30,{digits})").cast("string")


def ratio(part: Column, whole: Column) -> Column:
    """`part / whole`, NULL where `whole` is zero."""
    return part / F.nullif(whole, F.lit(0))


def ratio_or_zero(part: Column, whole: Column) -> Column:
    return F.coalesce(F.try_divide(part, whole), F.lit(0.0))


def nan_to_null(value: Column) -> Column:
    return F.when(~F.isnan(value), value)

