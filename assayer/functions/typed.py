"""Casts that turn bad text into NULL instead of failing."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from assayer.spec import DOUBLE, LONG

# The texts a CSV reader of the original pipeline takes for a missing value.
MISSING_TEXTS = (
    "",
    "#N/A",
    "#N/A N/A",
    "#NA",
    "-1.#IND",
    "-1.#QNAN",
    "-NaN",
    "-nan",
    "1.#IND",
    "1.#QNAN",
    "<NA>",
    "N/A",
    "NA",
    "NULL",
    "NaN",
    "None",
    "n/a",
    "nan",
    "null",
)

# Text is matched before it is parsed. Spark's own cast to double also takes Java spellings such as
# 1d, 2f or 0x1p3, and a try_cast that fails costs many times one that succeeds.
_DIGITS = r"^\s*[+-]?\d+\s*$"
_NUMBER = r"^\s*[+-]?((\d+\.?\d*|\.\d+)([eE][+-]?\d+)?|[iI][nN][fF]([iI][nN][iI][tT][yY])?)\s*$"


def present(text: Column) -> Column:
    """`text`, NULL where it spells a missing value."""
    return F.when(~text.isin(*MISSING_TEXTS), text)


def to_double(text: Column) -> Column:
    return F.when(text.rlike(_NUMBER), text.try_cast(DOUBLE))


def whole(number: Column) -> Column:
    """A double as a bigint, NULL where it is not whole or too large."""
    return F.when(number == F.floor(number), number.try_cast(LONG))


def to_long(text: Column, number: Column) -> Column:
    """Whole numbers in any spelling (`3`, `3.0`, `3e2`); plain digits stay exact above 2**53.

    `number` is the text as a double.
    """
    return F.coalesce(F.when(text.rlike(_DIGITS), text.try_cast(LONG)), whole(number))
