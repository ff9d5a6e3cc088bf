"""Exact ranks without sorting a table in one task.

Three tools, by what is asked for:

* `order_statistics` - the values at given ranks of numeric columns (medians, batch borders);
* `rows_at_ranks`    - the rows at given ranks of a random order inside each group (splits, folds);
* `running_totals`   - cumulative sums along a whole ordered table (curves, global ranks, codes).
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from assayer.scratch import written

# ---------------------------------------------------------------------------
# values at given ranks
# ---------------------------------------------------------------------------


@dataclass
class _Search:
    """Where the value at `rank` (1-based) can still be: strictly between `low` and `high`."""

    column: str
    rank: int
    inside: int  # rows in the bracket
    low: object = None
    high: object = None
    below: int = 0  # rows at or under `low`
    narrowing: bool = True
    answer: object = None

    @property
    def bracket(self) -> tuple:
        return self.column, self.low, self.high, self.below

    def value(self) -> Column:
        """The column where it is inside the bracket, else NULL."""
        column, inside = F.col(self.column), F.lit(True)
        if self.low is not None:
            inside = inside & (column > F.lit(self.low))
        if self.high is not None:
            inside = inside & (column < F.lit(self.high))
        return F.when(inside, column)

    def settle(self, value: object) -> None:
        self.answer, self.narrowing = value, False

    def shrink(self, low: object, high: object, below: int, inside: int) -> None:
        self.narrowing = inside < self.inside  # no progress: what is left is few distinct values
        self.low, self.high, self.below, self.inside = low, high, below, inside


def order_statistics(
    df: DataFrame,
    ranks: dict[str, Sequence[int]],
    counts: dict[str, int],
    rows_at_once: int = 1_000_000,
    accuracy: int = 1_000,
) -> dict[tuple[str, int], object]:
    """The exact value at each 1-based rank of each column, NULLs left out.

    A bracket around every rank is narrowed by approximate percentiles and verified by exact
    counts until it holds at most `rows_at_once` rows; those are then counted by value. A round is
    two aggregates over all columns together and shrinks a bracket about `accuracy / 3` times, so
    10**11 rows take two rounds. A value shared by very many rows is settled by its count. The
    accuracy is modest because one task merges the percentile sketches of all others.
    `counts` holds the number of non-NULL rows of each column.
    """
    searches = [_Search(c, r, counts[c]) for c, wanted in ranks.items() for r in sorted(set(wanted))]
    for s in searches:
        if not 1 <= s.rank <= s.inside:
            raise ValueError(f"rank {s.rank} of {s.column}: the column has {s.inside} values")

    while wide := [s for s in searches if s.narrowing and s.inside > rows_at_once]:
        _narrow(df, wide, accuracy)

    types = dict(df.dtypes)
    for declared in sorted({types[s.column] for s in searches if s.answer is None}):
        _finish(df, [s for s in searches if s.answer is None and types[s.column] == declared])
    return {(s.column, s.rank): s.answer for s in searches}


def _by_bracket(searches: list[_Search]) -> list[list[_Search]]:
    brackets: dict[tuple, list[_Search]] = {}
    for s in searches:
        brackets.setdefault(s.bracket, []).append(s)
    return list(brackets.values())


def _narrow(df: DataFrame, searches: list[_Search], accuracy: int) -> None:
    """One approximate and one exact aggregate over every bracket that is still wide."""
    groups, slack = _by_bracket(searches), 1.5 / accuracy

    def around(group: list[_Search]) -> Column:
        middles = [(s.rank - s.below - 0.5) / s.inside for s in group]
        shares = [F.lit(share) for m in middles for share in (max(0.0, m - slack), min(1.0, m + slack))]
        return F.percentile_approx(group[0].value(), F.array(*shares), accuracy)

    guesses = df.agg(*[around(group).alias(f"g{i}") for i, group in enumerate(groups)]).first()
    bounds = [sorted(set(guess)) for guess in guesses]
    counted = [
        F.count_if(compare(group[0].value(), F.lit(bound)))
        for group, values in zip(groups, bounds)
        for bound in values
        for compare in (Column.__lt__, Column.__le__)
    ]
    counts = iter(df.agg(*[c.alias(f"c{i}") for i, c in enumerate(counted)]).first())
    for group, guess, values in zip(groups, guesses, bounds):
        ahead = {bound: (next(counts), next(counts)) for bound in values}
        for i, s in enumerate(group):
            _place(s, *[(bound, *ahead[bound]) for bound in guess[2 * i : 2 * i + 2]])


def _place(s: _Search, low: tuple[object, int, int], high: tuple[object, int, int]) -> None:
    """Moves a search by two values, each with the rows under it and the rows up to it."""
    (lo, under_lo, upto_lo), (hi, under_hi, upto_hi) = low, high
    rank = s.rank - s.below
    if rank <= under_lo:
        s.shrink(s.low, lo, s.below, under_lo)
    elif rank <= upto_lo:
        s.settle(lo)
    elif rank <= under_hi:
        s.shrink(lo, hi, s.below + upto_lo, under_hi - upto_lo)
    elif rank <= upto_hi:
        s.settle(hi)
    else:
        s.shrink(hi, s.high, s.below + upto_hi, s.inside - upto_hi)


def _finish(df: DataFrame, searches: list[_Search]) -> None:
    """Counts what is left in the brackets by value, and reads the ranks off the running counts."""
    groups = _by_bracket(searches)
    values = [group[0].value() for group in groups]
    entries = [F.struct(F.lit(i).alias("bracket"), value.alias("value")) for i, value in enumerate(values)]
    by_value = (
        df.where(reduce(Column.__or__, [value.isNotNull() for value in values]))
        .select(F.explode(F.array(*entries)).alias("entry"))
        .select("entry.*")
        .where(F.col("value").isNotNull())
        .groupBy("bracket", "value")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    # One window group per bracket; each holds at most the distinct values of `rows_at_once` rows.
    spans = by_value.withColumn("upto", F.sum("n").over(Window.partitionBy("bracket").orderBy("value")))
    wanted = [
        (F.col("bracket") == i) & (F.col("upto") - F.col("n") < s.rank - s.below) & (F.col("upto") >= s.rank - s.below)
        for i, group in enumerate(groups)
        for s in group
    ]
    for row in spans.where(reduce(Column.__or__, wanted)).collect():
        for s in groups[row.bracket]:
            if row.upto - row.n < s.rank - s.below <= row.upto:
                s.settle(row.value)


def medians(df: DataFrame, columns: Sequence[str], **limits: int) -> tuple[dict[str, float | None], dict[str, int]]:
    """Exact interpolated medians, and the number of NULLs, of each column."""
    counted = df.agg(F.count(F.lit(1)), *[F.count(c) for c in columns]).first()
    counts = dict(zip(columns, counted[1:]))
    middle = {c: [(n + 1) // 2, n // 2 + 1] for c, n in counts.items() if n}
    found = order_statistics(df, middle, counts, **limits) if middle else {}
    result = {c: (found[c, middle[c][0]] + found[c, middle[c][1]]) / 2 if c in middle else None for c in columns}
    return result, {c: counted[0] - n for c, n in counts.items()}


# ---------------------------------------------------------------------------
# rows at given ranks of a random order
# ---------------------------------------------------------------------------


def rows_at_ranks(df: DataFrame, group: str, code: str, key: str, ranks: DataFrame, digits: int = 3) -> DataFrame:
    """The `code` and `key` of the rows at the wanted ranks of the order (code, key) in each group.

    `ranks` has the columns (group, _rank) and one row per wanted rank. Codes are uniform (`seeded_code`), so a histogram of their leading
    digits tells in which bucket a rank falls, and only the rows of those buckets, one part in
    16**digits of the group each, are numbered.
    """
    buckets = df.select(group, code, key, F.substring(code, 1, digits).alias("_bucket"))
    upto = F.sum("_n").over(Window.partitionBy(group).orderBy("_bucket"))
    spans = (
        buckets.groupBy(group, "_bucket")
        .agg(F.count(F.lit(1)).alias("_n"))
        .withColumn("_before", upto - F.col("_n"))
    )
    wanted = spans.join(ranks, group).where(
        (F.col("_rank") > F.col("_before")) & (F.col("_rank") <= F.col("_before") + F.col("_n"))
    )
    hit = wanted.groupBy(group, "_bucket", "_before").agg(F.collect_set("_rank").alias("_ranks"))
    number = F.row_number().over(Window.partitionBy(group, "_bucket").orderBy(code, key)) + F.col("_before")
    return (
        buckets.join(written(hit, "rank-buckets"), [group, "_bucket"])
        .withColumn("_rank", number.cast("bigint"))
        .where(F.array_contains("_ranks", F.col("_rank")))
        .select(group, "_rank", code, key)
    )


# ---------------------------------------------------------------------------
# totals along a whole table
# ---------------------------------------------------------------------------


def running_totals(
    df: DataFrame, order: str, totals: dict[str, str], by: Sequence[str] = (), overall: dict[str, str] | None = None
) -> DataFrame:
    """Adds inclusive running sums `{new: summed}` along `order` within `by`, and `overall` sums of `by`.

    `df` has one row per (by, order). The table is range-partitioned by group and order together, so a heavy group
    takes several ranges, many groups that share an order value do not share a range for it, and NULL groups are a
    group. It is written with its range number; sums by group and range give the offset at which the window inside a
    range starts, so no task ever holds more than one range, and most groups have offsets in one range only.
    """
    by, overall = list(by), overall or {}
    # More ranges than tasks, so that ranges of unequal weight even out.
    ranges = 4 * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = written(df.repartitionByRange(ranges, *by, order).withColumn("_range", F.spark_partition_id()), "ranged")

    zero, summed = F.lit(0).cast("bigint"), sorted({*totals.values(), *overall.values()})
    ahead = Window.partitionBy(*by).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        ranged.groupBy(*by, "_range")
        .agg(*[F.sum(c).alias(f"_sum_{c}") for c in summed])
        .select(
            *by,
            "_range",
            *[F.coalesce(F.sum(f"_sum_{c}").over(ahead), zero).alias(f"_from_{new}") for new, c in totals.items()],
            *[F.sum(f"_sum_{c}").over(Window.partitionBy(*by)).alias(new) for new, c in overall.items()],
        )
    )
    along = Window.partitionBy(*by, "_range").orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    # The window comes first: its partitioning and order serve the join as well.
    inside = ranged.withColumns({f"_in_{new}": F.sum(c).over(along) for new, c in totals.items()})
    running = [(F.col(f"_in_{new}") + F.col(f"_from_{new}")).alias(new) for new in totals]
    near = offsets.select(*[F.col(c).alias(f"_of_{c}") for c in by], F.col("_range").alias("_of_range"), *[f"_from_{n}" for n in totals], *overall)
    same = [F.col(c).eqNullSafe(F.col(f"_of_{c}")) for c in by] + [F.col("_range") == F.col("_of_range")]
    return inside.join(near, reduce(Column.__and__, same)).select(*df.columns, *running, *overall)


def competition_rank(df: DataFrame, value: str, name: str = "rank") -> DataFrame:
    """RANK() over the whole table by `value` descending, NULLs first.

    Only values are ranked; the ranks are written before they are joined back, so that they are broadcast if they are few, and
    a value that very many rows share can be split if not.
    """
    falling = "_falling"
    counted = (
        df.where(F.col(value).isNotNull())
        .groupBy((-F.col(value)).alias(falling))
        .agg(F.count(F.lit(1)).alias("_n"))
    )
    standing = written(running_totals(counted, falling, {"_upto": "_n"}), "standing")
    missing = df.where(F.col(value).isNull()).count()
    ahead = F.col("_upto") - F.col("_n") + F.lit(missing)
    return (
        df.withColumn(falling, -F.col(value))
        .join(standing, falling, "left")
        .withColumn(name, F.when(F.col(value).isNull(), F.lit(1).cast("bigint")).otherwise(ahead + 1))
        .drop(falling, "_upto", "_n")
    )


def dense_codes(df: DataFrame, column: str, code: str = "code") -> DataFrame:
    """The distinct non-NULL values of `column`, numbered from 0 in ascending order."""
    classes = df.select(column).where(F.col(column).isNotNull()).distinct()
    one = classes.withColumn("_one", F.lit(1).cast("bigint"))
    return running_totals(one, column, {"_upto": "_one"}).select(column, (F.col("_upto") - 1).alias(code))
