"""What several operators of this subpackage share."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# A word is a run of characters other than these six: space, \t, \n, \v, \f, \r.
SPACE = r"\x20\x09-\x0D"
SPACES = " \t\n\x0b\x0c\r"

WORD_SIZE = 5  # words in a shingle
SIMILARITY = 0.8


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def word_count(text: Column) -> Column:
    """The number of words of a text; 0 for NULL."""
    trimmed = F.btrim(F.coalesce(text, F.lit("")), F.lit(SPACES))
    words = F.size(F.split(trimmed, f"[{SPACE}]+"))
    return F.when(trimmed == "", F.lit(0)).otherwise(words).cast("bigint")


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """`use(value)`, with the value computed once: what a lambda refers to is computed for each element."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


FILTER_BITS = 2**24  # 2 MB when packed, whatever the number of keys; more bits let fewer others through


def perhaps_in(df: DataFrame, column: str, keys: DataFrame, bits: int = FILTER_BITS, how: str = "left_semi") -> DataFrame:
    """The rows of `df` whose `column` is among `keys` (one column), and a few others; with `left_anti`, all but these.

    Keys are hashed into a bitmap of a fixed size, which every task can hold, so that a join that
    follows need not shuffle what has no partner. More keys than bits only make it let more through.
    """
    spot = lambda c: F.pmod(F.xxhash64(c), F.lit(bits))
    spots = keys.select(spot(F.col(keys.columns[0])).alias("_spot"))
    words = spots.groupBy(F.expr("_spot div 64").alias("_word")).agg(
        F.expr("bit_or(shiftleft(1L, cast(_spot % 64 as int)))").alias("_bits")
    )
    # At most bits / 64 rows of two numbers are broadcast.
    marked = df.withColumn("_at", spot(F.col(column)))
    hit = F.expr("_at div 64 = _word and shiftright(_bits, cast(_at % 64 as int)) & 1 = 1")
    return marked.join(F.broadcast(words), hit, how).drop("_at")
