"""Raw to staging: typed, deduplicated, imputed, quarantined."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assayer.functions.numbers import nan_to_null
from assayer.functions.typed import present, to_double, to_long, whole
from assayer.operators.ranking import medians
from assayer.scratch import written
from assayer.spec import DOUBLE, LONG


def _present_columns(df: DataFrame, names: Sequence[str]) -> list[str]:
    return [c for c in names if c in df.columns]


_INTEGERS = ("tinyint", "smallint", "int", "bigint")
_FLOATS = ("float", "double")


def _typed(df: DataFrame, types: dict[str, str]) -> tuple[DataFrame, dict[str, Column]]:
    """(`df` with helper columns, the typed column of each declared one).

    Text is searched for missing values, and parsed, in projections of their own, so that no value
    is parsed twice. Columns that are numbers already are not turned into text.
    """
    columns = _present_columns(df, list(types))
    kinds = dict(df.dtypes)
    numbers = {c for c in columns if kinds[c] in _INTEGERS + _FLOATS}
    texts = [c for c in columns if c not in numbers]
    staged = df.withColumns({f"_text_{c}": present(F.col(c).cast("string")) for c in texts})
    staged = staged.withColumns(
        {f"_number_{c}": to_double(F.col(f"_text_{c}")) for c in texts}
        | {f"_number_{c}": nan_to_null(F.col(c).cast(DOUBLE)) for c in numbers}
    )
    typed = {}
    for c in columns:
        number = F.col(f"_number_{c}")
        if types[c] == DOUBLE:
            typed[c] = number
        elif kinds[c] in _INTEGERS:
            typed[c] = F.col(c).cast(LONG)
        else:
            typed[c] = whole(number) if c in numbers else to_long(F.col(f"_text_{c}"), number)
    return staged, typed


def cast_declared(df: DataFrame, types: dict[str, str]) -> DataFrame:
    """Columns in their declared types, bad values NULL; columns that are absent are skipped."""
    staged, typed = _typed(df, types)
    return staged.select(*[typed[c].alias(c) if c in typed else F.col(c) for c in df.columns])


def cast_failures(df: DataFrame, types: dict[str, str]) -> DataFrame:
    """Per column, how many values were present but did not fit the declared type."""
    staged, typed = _typed(df, types)
    given = {c: F.col(f"_text_{c}" if f"_text_{c}" in staged.columns else f"_number_{c}") for c in typed}
    failed = [F.count_if(given[c].isNotNull() & typed[c].isNull()).alias(c) for c in typed]
    return staged.agg(*failed).unpivot([], list(typed), "column_name", "failures")


def keep_first(df: DataFrame, key: str, order: str | Sequence[str]) -> DataFrame:
    """The first row of each `key` by `order`, which must be unique within the key.

    Only rows whose key occurs more than once are shuffled whole, and a hot key is reduced to one row per task before;
    all others stay where they are. `df` should be a written table: it is read to find the repeated keys and for the rows.
    """
    orders = [order] if isinstance(order, str) else list(order)
    coded = df.withColumn("_key_code", F.xxhash64(key))  # of 8 bytes; two keys that share one are told apart below
    counted = coded.groupBy("_key_code").agg(F.count(F.lit(1)).alias("_n"))
    repeated = written(counted.where("_n > 1").select("_key_code"), "repeated-keys")
    alone = coded.join(repeated, "_key_code", "left_anti").select(*df.columns)
    several = coded.join(repeated, "_key_code", "left_semi").select(*df.columns)
    first = F.min_by(F.struct(*df.columns), F.struct(*orders)).alias("_row")
    return alone.union(several.groupBy(F.col(key).alias("_key")).agg(first).select("_row.*"))


def keep_distinct(df: DataFrame, order: str) -> DataFrame:
    """Rows equal in every column but `order` are kept once, with the lowest `order`."""
    others = [c for c in df.columns if c != order]
    return df.groupBy(*others).agg(F.min(order).alias(order)).select(*df.columns)


def deduplicate(df: DataFrame, order: str | Sequence[str], row_hash: str = "_row_hash") -> DataFrame:
    """By row hash where there is one, else by the full row."""
    if row_hash in df.columns:
        return keep_first(df, row_hash, order)
    return keep_distinct(df, order if isinstance(order, str) else order[0])


def split_on_target(df: DataFrame, target: str) -> tuple[DataFrame, DataFrame]:
    """(rows with a target, quarantined rows with the reason)."""
    missing = F.col(target).isNull()
    return df.where(~missing), df.where(missing).withColumn("_quarantine_reason", F.lit("null_target"))


def quarantine_log(quarantined: DataFrame, day: Column) -> DataFrame:
    """Quarantined rows as (quarantine_date, reason, source_file, raw_data); the row itself as JSON."""
    source = F.col("_source_file") if "_source_file" in quarantined.columns else F.lit(None).cast("string")
    row = [c for c in quarantined.columns if c != "_quarantine_reason"]
    return quarantined.select(
        day.cast("date").alias("quarantine_date"),
        F.col("_quarantine_reason").alias("reason"),
        source.alias("source_file"),
        F.to_json(F.struct(*row), {"ignoreNullFields": "false"}).alias("raw_data"),
    )


def fit_medians(
    df: DataFrame, columns: Sequence[str], fit_on: DataFrame | None = None, **limits: int
) -> dict[str, float]:
    """Medians, over the rows of `fit_on`, of the columns of `df` that have NULLs to fill.

    A column without any value has no median.
    """
    columns = _present_columns(df, columns)
    if not columns:
        return {}
    if fit_on is None:
        values, missing = medians(df, columns, **limits)
        gaps = [c for c in columns if missing[c]]
    else:
        counted = df.agg(*[F.count_if(F.col(c).isNull()) for c in columns]).first()
        gaps = [c for c, n in zip(columns, counted) if n]
        values = medians(fit_on, gaps, **limits)[0] if gaps else {}
    return {c: values[c] for c in gaps if values[c] is not None}


def fill_medians(df: DataFrame, values: dict[str, float]) -> DataFrame:
    """NULLs replaced by the medians. A whole-number column becomes a double: its median need not be whole."""
    return df.withColumns({c: F.coalesce(F.col(c).cast("double"), F.lit(float(v))) for c, v in values.items()})


def impute_median(df: DataFrame, columns: Sequence[str], fit_on: DataFrame | None = None, **limits: int) -> DataFrame:
    """Fit and fill. `fit_on` narrows the rows the medians come from, say to a training split.

    `df` should be a written table: it is read to fit and to fill.
    """
    return fill_medians(df, fit_medians(df, columns, fit_on, **limits))


def fill_zero(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Model input: no NULL features."""
    return df.fillna(0, subset=_present_columns(df, columns))

