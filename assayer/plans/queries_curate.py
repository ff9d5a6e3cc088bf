"""Encoding, splits, folds, scaling, the curated table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from assayer.functions.numbers import rounded
from assayer.operators import curate as ops
from assayer.plans import inputs, workspace
from assayer.plans.registry import query, r, with_
from assayer.plans.shared_sql import TO_STAGING, ordered_keys, scaled, split
from assayer.spec import Settings

_SETTINGS = Settings()
_NUMERIC = inputs.SPEC.numeric


def _scaled_sql(c: str) -> str:
    return f"{r(f'({c} - mu_{c}) / CASE WHEN sd_{c} = 0 THEN 1 ELSE sd_{c} END', 6)} AS {c}"


@query(
    "label_encode",
    """
SELECT doc_id, lang, c.code AS source FROM documents
JOIN (SELECT source, row_number() OVER (ORDER BY source) - 1 AS code FROM (SELECT DISTINCT source FROM documents)) c USING (source)""",
)
def label_encode(spark: SparkSession, folder: str) -> DataFrame:
    documents = inputs.table(spark, folder, "documents").select("doc_id", "lang", "source")
    return ops.label_encode(documents, "source")


@query("label_decode", "SELECT doc_id, lang, source FROM documents")
def label_decode(spark: SparkSession, folder: str) -> DataFrame:
    documents = inputs.table(spark, folder, "documents").select("doc_id", "lang", "source")
    codes = ops.fit_codes(documents, "source")
    return ops.restore_classes(ops.apply_codes(documents, "source", codes), "source", codes)


@query(
    "stratified_split",
    with_(split("orders", "o_orderstatus", "o_orderkey"), select="SELECT o_orderkey, o_orderstatus, _split FROM split"),
)
def stratified_split(spark: SparkSession, folder: str) -> DataFrame:
    orders = inputs.table(spark, folder, "orders").select("o_orderkey", "o_orderstatus")
    return ops.stratified_split(orders, "o_orderstatus", "o_orderkey")


@query(
    "stratified_folds",
    f"""
SELECT o_orderkey, o_orderstatus, CAST(((rn - 1) * 5) // n AS INTEGER) AS _fold
FROM (SELECT o_orderkey, o_orderstatus, count(*) OVER (PARTITION BY o_orderstatus) AS n,
             row_number() OVER (PARTITION BY o_orderstatus ORDER BY {ordered_keys("o_orderkey")}) AS rn FROM orders)""",
)
def stratified_folds(spark: SparkSession, folder: str) -> DataFrame:
    orders = inputs.table(spark, folder, "orders").select("o_orderkey", "o_orderstatus")
    return ops.stratified_folds(orders, "o_orderstatus", "o_orderkey")


_SPLIT = split("staging", "label", "_row_key")


@query(
    "scaler_params",
    with_(
        *TO_STAGING, _SPLIT,
        select="\nUNION ALL\n".join(
            f"""SELECT '{c}' AS feature, {r(f"avg({c})", 6)} AS mean,
{r(f"CASE WHEN stddev_pop({c}) = 0 THEN 1 ELSE stddev_pop({c}) END", 6)} AS std FROM split WHERE _split = 'train'"""
            for c in _NUMERIC
        ),
    ),
)
def scaler_params(spark: SparkSession, folder: str) -> DataFrame:
    rows = ops.split_features(workspace.staging(spark, folder), inputs.SPEC, _SETTINGS)
    params = ops.scaler_params(rows.where(F.col("_split") == "train"), _NUMERIC)
    return params.select("feature", rounded(F.col("mean"), 6).alias("mean"), rounded(F.col("std"), 6).alias("std"))


_MEASURES = ("l_quantity", "l_extendedprice", "l_discount")


@query(
    "standard_scale",
    f"""
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, {", ".join(_scaled_sql(c) for c in _MEASURES)}
FROM lineitem, (SELECT {", ".join(f"avg({c}) AS mu_{c}, stddev_pop({c}) AS sd_{c}" for c in _MEASURES)}
                FROM lineitem WHERE l_returnflag <> 'R')""",
)
def standard_scale(spark: SparkSession, folder: str) -> DataFrame:
    lines = inputs.table(spark, folder, "lineitem")
    scaled_lines = ops.standard_scale(lines, _MEASURES, fit_on=F.col("l_returnflag") != "R")
    return scaled_lines.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", *[rounded(F.col(c), 6).alias(c) for c in _MEASURES]
    )


_CODES = """
codes AS (SELECT content_type, row_number() OVER (ORDER BY content_type) - 1 AS code
          FROM (SELECT DISTINCT content_type FROM staging))
"""


def _curated(spark: SparkSession, folder: str) -> DataFrame:
    return workspace.landed(
        spark, folder, "curated",
        lambda: ops.curated(workspace.staging(spark, folder), inputs.SPEC, _SETTINGS, inputs.RUN.at)[0],
    )


@query(
    "curated_full",
    with_(
        *TO_STAGING, _SPLIT, scaled(), _CODES,
        select=f"""
SELECT _row_key, {", ".join(_scaled_sql(c) for c in _NUMERIC)}, code AS content_type, label, _split,
       '2024-01-31 00:00:00' AS curated_at
FROM split JOIN codes USING (content_type), scaler""",
    ),
)
def curated_full(spark: SparkSession, folder: str) -> DataFrame:
    rows = _curated(spark, folder)
    full = ops.assemble(rows.where(F.col("_split") == "train"), rows.where(F.col("_split") == "test"))
    return full.select(
        "_row_key", *[rounded(F.col(c), 6).alias(c) for c in _NUMERIC], "content_type", "label", "_split",
        F.date_format("_curated_at_utc", "yyyy-MM-dd HH:mm:ss").alias("curated_at"),
    )


@query(
    "curated_lineage",
    with_(*TO_STAGING, _SPLIT, select="SELECT _row_key, _split, _row_hash, word_count FROM split"),
)
def curated_lineage(spark: SparkSession, folder: str) -> DataFrame:
    return ops.lineage(_curated(spark, folder), workspace.staging(spark, folder), "_row_key", ["_row_hash", "word_count"])


@query(
    "split_manifest",
    with_(
        *TO_STAGING, _SPLIT,
        select=f"""
SELECT 42 AS random_seed, CAST(0.2 AS DOUBLE) AS test_size, true AS stratified, count(*) AS total_rows,
       count(*) FILTER (WHERE _split = 'train') AS train_rows, count(*) FILTER (WHERE _split = 'test') AS test_rows,
       '{",".join(inputs.SPEC.features)}' AS features, 'label' AS target
FROM split""",
    ),
)
def split_manifest(spark: SparkSession, folder: str) -> DataFrame:
    return ops.split_manifest(_curated(spark, folder), inputs.SPEC, _SETTINGS)
