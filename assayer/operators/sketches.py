"""Approximate medians from states kept by batch, so that an increment reads only itself.

A state is a KLL quantile sketch: a few kilobytes whatever the rows, and states of batches merge into one of all of them. The exact
medians of `ranking` stay the default; these are for tables whose history is too long to read at each increment.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from assayer.sources.files import replace_partitions

SIZE = 2_000  # the sketch's parameter k
_STATES = "column_name string, n bigint, state binary, batch string"


def rank_error(size: int = SIZE) -> float:
    """How far, as a share of the rows, the rank of a sketched median is from the middle, in 99 of 100 cases."""
    return 2.296 / size**0.9021


def _present(c: str) -> Column:
    value = F.col(c).cast("double")
    return F.when(~F.isnan(value), value)


def quantile_states(rows: DataFrame, columns: Sequence[str], batch: str, size: int = SIZE) -> DataFrame:
    """(column_name, n, state, batch): one state for each batch and column, from one scan combined on the map side.

    NULL and NaN are not counted; a column without any other value in a batch has no state there. A NULL batch is
    a batch of its own, called ''.
    """
    names = list(columns)
    chosen = rows.select(F.coalesce(F.col(batch).cast("string"), F.lit("")).alias("_batch"), *[_present(c).alias(f"c{i}") for i, c in enumerate(names)])
    sums = [f(f"c{i}").alias(f"{k}{i}") for i in range(len(names)) for k, f in (("n", F.count), ("s", lambda c: F.kll_sketch_agg_double(c, F.lit(size))))]
    wide = chosen.groupBy("_batch").agg(*sums)
    each = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(f"n{i}").alias("n"), F.col(f"s{i}").alias("state")) for i, c in enumerate(names)])
    long = wide.select(F.explode(each).alias("e"), F.col("_batch").alias("batch"))
    return long.select("e.*", "batch").where("n > 0")


def keep_states(states: DataFrame, path: str) -> DataFrame:
    """The states written by batch: those of a batch that comes again take the place of its earlier ones."""
    replace_partitions(states, path, "batch")
    return read_states(states.sparkSession, path)


def read_states(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(_STATES).parquet(path)


def sketched_medians(states: DataFrame) -> DataFrame:
    """(column_name, batches, n, median) over all batches; no row of the table itself is read."""
    merged = states.groupBy("column_name").agg(
        F.count(F.lit(1)).alias("batches"), F.sum("n").alias("n"), F.kll_merge_agg_double("state").alias("state")
    )
    return merged.select("column_name", "batches", "n", F.kll_sketch_get_quantile_double("state", F.lit(0.5)).alias("median"))


def median_values(states: DataFrame) -> dict[str, float]:
    """The medians as `staging.fill_medians` takes them."""
    return {r.column_name: r.median for r in sketched_medians(states).collect()}  # a row for each column
