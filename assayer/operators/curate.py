"""Staging to curated: encode, split, scale, assemble."""

from __future__ import annotations

from collections.abc import Sequence
from decimal import ROUND_CEILING, Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assayer.functions.hashing import seeded_code
from assayer.operators.ranking import dense_codes, order_statistics, rows_at_ranks, running_totals
from assayer.scratch import written
from assayer.spec import Settings, TableSpec

_CODE = "_code"


# ---------------------------------------------------------------------------
# encode
# ---------------------------------------------------------------------------


def class_text(column: str) -> Column:
    """The class a value belongs to; a missing value is a class of its own."""
    return F.coalesce(F.col(column).cast("string"), F.lit("<NA>"))


def fit_codes(df: DataFrame, column: str) -> DataFrame:
    """(class, code): the sorted classes of `column`, numbered from 0.

    Written, so that the join in `apply_codes` is planned by its real size.
    """
    return written(dense_codes(df.select(class_text(column).alias("class")), "class"), "codes")


def apply_codes(df: DataFrame, column: str, codes: DataFrame, unseen: str = "error") -> DataFrame:
    """`column` replaced by its code. A class without a code raises, or is NULL with `unseen="null"`."""
    if unseen not in ("error", "null"):
        raise ValueError(f"unseen must be 'error' or 'null', not {unseen!r}")
    known = codes.select(F.col("class").alias("_class"), F.col("code").alias("_class_code"))
    joined = df.withColumn("_class", class_text(column)).join(known, "_class", "left")
    code = F.col("_class_code")
    if unseen == "error":
        problem = F.raise_error(F.concat(F.lit(f"{column}: unseen class "), F.col("_class"))).cast("bigint")
        code = F.when(code.isNotNull(), code).otherwise(problem)
    return joined.withColumn(column, code).select(*df.columns)


def restore_classes(df: DataFrame, column: str, codes: DataFrame) -> DataFrame:
    """Codes replaced by their classes, say to partition a published table by readable names."""
    known = codes.select(F.col("code").alias("_code_of_class"), F.col("class").alias("_class"))
    joined = df.join(known, F.col(column) == F.col("_code_of_class"), "left")
    return joined.withColumn(column, F.col("_class")).select(*df.columns)


def label_encode(df: DataFrame, column: str) -> DataFrame:
    return apply_codes(df, column, fit_codes(df, column))


# ---------------------------------------------------------------------------
# split and folds
# ---------------------------------------------------------------------------


def class_sizes(df: DataFrame, target: str) -> DataFrame:
    """(target, _n) of each class; written, as quotas and borders both read it."""
    return written(df.where(F.col(target).isNotNull()).groupBy(target).agg(F.count(F.lit(1)).alias("_n")), "class-sizes")


def split_quotas(sizes: DataFrame, target: str, test_size: str) -> DataFrame:
    """(target, _quota): rows of each class that go to the test split, ceil(test_size * N) by largest remainder."""
    rows = int(sizes.agg(F.coalesce(F.sum("_n"), F.lit(0))).first()[0])
    total = int((Decimal(test_size) * rows).to_integral_value(ROUND_CEILING))
    if not rows:
        return sizes.select(target, F.lit(0).cast("bigint").alias("_quota"))
    product = F.lit(total).cast("decimal(19,0)") * F.col("_n").cast("decimal(19,0)")
    whole = (product - product % rows) / rows
    parts = sizes.select(target, whole.cast("bigint").alias("_whole"), (product % rows).cast("bigint").alias("_rest"))
    parts = written(parts, "quota-parts")
    left = total - int(parts.agg(F.sum("_whole")).first()[0])
    one = parts.select(target, "_whole", F.struct((-F.col("_rest")).alias("rest"), F.col(target).alias("class")).alias("_turn"))
    ranked = running_totals(one.withColumn("_one", F.lit(1).cast("bigint")), "_turn", {"_rank": "_one"})
    return ranked.select(target, (F.col("_whole") + (F.col("_rank") <= left).cast("bigint")).alias("_quota"))


def _ordered(df: DataFrame, key: str, seed: int) -> DataFrame:
    return df.withColumn(_CODE, seeded_code(seed, F.col(key)))


def _borders(df: DataFrame, target: str, key: str, seed: int, ranks: DataFrame) -> DataFrame:
    """(target, _borders): per class, the (code, key) of the rows at the wanted ranks (target, _rank), ascending.

    One row per class with a few borders, written, so that Spark sees its size when it plans the join.
    """
    at = rows_at_ranks(_ordered(df, key, seed), target, _CODE, key, ranks.distinct())
    each = ranks.join(written(at, "border-rows"), [target, "_rank"])
    return written(each.groupBy(target).agg(F.array_sort(F.collect_list(F.struct(_CODE, key))).alias("_borders")), "borders")


def stratified_split(
    df: DataFrame, target: str, key: str, seed: int = 42, test_size: str = "0.2", name: str = "_split"
) -> DataFrame:
    """Adds `_split`, 'test' for the first rows of each class in a seeded order of `key`.

    The rows themselves are not ranked: one histogram finds the border row of every class, and
    each row is compared with the border of its class. Rows without a target get no split.
    """
    quotas = written(split_quotas(class_sizes(df, target), target, test_size), "quotas")
    ranks = quotas.where("_quota > 0").select(target, F.col("_quota").alias("_rank"))
    placed = _ordered(df, key, seed).join(_borders(df, target, key, seed, ranks), target, "left")
    in_test = F.struct(_CODE, key) <= F.get("_borders", F.lit(0))
    split = F.when(F.col(target).isNull(), F.lit(None).cast("string")).when(in_test, "test").otherwise("train")
    return placed.withColumn(name, split).select(*df.columns, name)


def stratified_folds(
    df: DataFrame, target: str, key: str, seed: int = 42, folds: int = 5, name: str = "_fold"
) -> DataFrame:
    """Adds `_fold` 0..k-1; the folds of a class differ by at most one row."""
    # Rank r (from 1) is in fold (r - 1) * k // n, so fold f ends at rank ceil(n * f / k).
    ends = F.explode(F.array(*[F.expr(f"(_n * {f} + {folds - 1}) div {folds}") for f in range(1, folds)]).cast("array<bigint>"))
    ranks = class_sizes(df, target).select(target, ends.alias("_rank"))
    placed = _ordered(df, key, seed).join(_borders(df, target, key, seed, ranks), target, "left")
    here = F.struct(_CODE, key)
    passed = F.coalesce(F.size(F.filter("_borders", lambda border: border < here)), F.lit(0))
    return placed.withColumn(name, F.when(F.col(target).isNotNull(), passed)).select(*df.columns, name)


# ---------------------------------------------------------------------------
# batches
# ---------------------------------------------------------------------------


def batch_ids(n_batches: int) -> list[str]:
    return [f"batch_{i:02d}_of_{n_batches:02d}" for i in range(1, n_batches + 1)]


def batch_borders(df: DataFrame, ordinal: str, n_batches: int) -> list:
    """The last ordinal of every batch but the last; all batches but the last have N div n rows."""
    rows = df.agg(F.count(ordinal)).first()[0]
    size = rows // n_batches
    if size == 0 or n_batches == 1:
        return []
    ranks = [i * size for i in range(1, n_batches)]
    found = order_statistics(df, {ordinal: ranks}, {ordinal: rows})
    return [found[ordinal, r] for r in ranks]


def make_batches(df: DataFrame, ordinal: str, n_batches: int, name: str = "_batch_id") -> DataFrame:
    """Adds the id of one of `n_batches` contiguous, disjoint batches along the unique `ordinal`.

    With fewer rows than batches, all rows are in the last batch.
    """
    borders = batch_borders(df, ordinal, n_batches)
    if borders:
        number = sum((F.when(F.col(ordinal) > F.lit(b), 1).otherwise(0) for b in borders), F.lit(1))
    else:
        number = F.lit(n_batches)
    return df.withColumn(name, F.format_string("batch_%02d_of_%02d", number, F.lit(n_batches)))


# ---------------------------------------------------------------------------
# scale
# ---------------------------------------------------------------------------


def scaler_params(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(feature, mean, std): population deviation, 1 where a feature does not vary."""
    stats = [
        F.struct(
            F.lit(c).alias("feature"),
            F.avg(F.col(c).cast("double")).alias("mean"),
            F.stddev_pop(F.col(c).cast("double")).alias("std"),
        )
        for c in columns
    ]
    flat = df.agg(F.array(*stats).alias("params")).select(F.explode("params").alias("p")).select("p.*")
    return flat.withColumn("std", F.when(F.col("std") == 0, 1.0).otherwise(F.col("std")))


def apply_scaler(df: DataFrame, params: Sequence[tuple[str, float, float]]) -> DataFrame:
    """Columns replaced by (x - mean) / std; `params` is one row per feature, from the training rows."""
    scaled = {
        f: (F.col(f).cast("double") - F.lit(mean)) / F.lit(std) for f, mean, std in params if mean is not None
    }
    return df.withColumns(scaled)


def standard_scale(df: DataFrame, columns: Sequence[str], fit_on: Column | None = None) -> DataFrame:
    train = df if fit_on is None else df.where(fit_on)
    return apply_scaler(df, [tuple(row) for row in scaler_params(train, columns).collect()])


# ---------------------------------------------------------------------------
# assemble
# ---------------------------------------------------------------------------


def feature_projection(df: DataFrame, spec: TableSpec, *also: str) -> DataFrame:
    """Features, target and key; features that are absent are skipped."""
    return df.select(*[c for c in [spec.key, *also, *spec.required] if c in df.columns])


def split_features(df: DataFrame, spec: TableSpec, settings: Settings) -> DataFrame:
    """The projected features with their split: the first half of `curated`."""
    return stratified_split(
        feature_projection(df, spec), spec.target, spec.key, settings.seed, settings.test_size
    )


def assemble(train: DataFrame, test: DataFrame) -> DataFrame:
    """The full curated table: the rows of both splits."""
    return train.unionByName(test)


def curated(
    df: DataFrame, spec: TableSpec, settings: Settings, curated_at: str
) -> tuple[DataFrame, dict[str, DataFrame], list[tuple[str, float, float]]]:
    """(curated rows, class codes per categorical column, scaler parameters).

    Codes are fitted on all rows, the scaler on the training rows only. `df` should be a written
    table, as it is read once per fit and once for the result.
    """
    split = split_features(df, spec, settings)
    numeric = [c for c in spec.numeric if c in df.columns]
    is_train = F.col("_split") == "train"
    params = [tuple(row) for row in scaler_params(split.where(is_train), numeric).collect()]
    codes = {c: fit_codes(df, c) for c in spec.categorical if c in df.columns}
    result = apply_scaler(split, params)
    for column, table in codes.items():
        result = apply_codes(result, column, table)
    stamped = result.withColumn("_curated_at_utc", F.lit(curated_at).cast("timestamp"))
    return stamped, codes, params


def split_manifest(split: DataFrame, spec: TableSpec, settings: Settings) -> DataFrame:
    """One row that describes a split; the row-level part is the key-to-split table itself."""
    return split.agg(
        F.lit(settings.seed).alias("random_seed"),
        F.lit(settings.test_size).cast("double").alias("test_size"),
        F.lit(True).alias("stratified"),
        F.count(F.lit(1)).alias("total_rows"),
        F.count_if(F.col("_split") == "train").alias("train_rows"),
        F.count_if(F.col("_split") == "test").alias("test_rows"),
        F.lit(",".join(c for c in spec.features if c in split.columns)).alias("features"),
        F.lit(spec.target).alias("target"),
    )


def lineage(curated_rows: DataFrame, staging: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """Curated keys and splits with columns of the staging rows they came from."""
    return curated_rows.select(key, "_split").join(staging.select(key, *columns), key)
