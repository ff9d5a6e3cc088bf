"""Text features, typing, deduplication, imputation, quarantine, reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from assayer.functions.numbers import rounded
from assayer.functions.text import with_burstiness, with_readability, with_stylometrics
from assayer.operators import reports, sketches
from assayer.operators import staging as ops
from assayer.operators.curate import feature_projection as project
from assayer.operators.ranking import medians
from assayer.plans import inputs, workspace
from assayer.plans.registry import query, r, with_
from assayer.plans.shared_sql import LABELLED, LABELLED_DOCUMENTS, RAW, SOURCE, TO_RAW, TO_STAGING, UNIQUE
from assayer.scratch import new_path, written
from assayer.spec import DOUBLE, LONG

_COUNTS = "word_count, character_count, sentence_count"
_STYLE = f"{_COUNTS}, lexical_diversity, avg_sentence_length, avg_word_length, punctuation_ratio"
_FEATURES = ", ".join(inputs.SPEC.numeric)

# ---------------------------------------------------------------------------
# text features
# ---------------------------------------------------------------------------


@query("stylometrics", with_(LABELLED, SOURCE, select=f"SELECT _row_key, {_STYLE} FROM source"))
def stylometrics(spark: SparkSession, folder: str) -> DataFrame:
    return with_stylometrics(inputs.texts(spark, folder)).drop("text_content", "content_type")


@query(
    "readability",
    with_(LABELLED, SOURCE, select="SELECT _row_key, flesch_reading_ease, gunning_fog_index FROM source"),
)
def readability(spark: SparkSession, folder: str) -> DataFrame:
    english = F.coalesce(F.col("content_type") == "en", F.lit(False))
    scored = with_readability(with_stylometrics(inputs.texts(spark, folder)), english=english)
    return scored.select("_row_key", "flesch_reading_ease", "gunning_fog_index")


@query("burstiness", with_(LABELLED, SOURCE, select="SELECT _row_key, burstiness FROM source"))
def burstiness(spark: SparkSession, folder: str) -> DataFrame:
    return with_burstiness(inputs.texts(spark, folder)).select("_row_key", "burstiness")


# ---------------------------------------------------------------------------
# staging steps
# ---------------------------------------------------------------------------

_EVENT_TEXT = """
typed AS (
  SELECT event_id, CAST(user_id AS VARCHAR) AS u, CAST(value AS VARCHAR) AS v, event_type AS t,
         CAST(json_extract(props, '$.k') AS VARCHAR) || '.0' AS k FROM events)
"""
_WHOLE = "CASE WHEN TRY_CAST({0} AS DOUBLE) = floor(TRY_CAST({0} AS DOUBLE)) THEN CAST(TRY_CAST({0} AS DOUBLE) AS BIGINT) END"


def _event_texts(spark: SparkSession, folder: str) -> DataFrame:
    """Events as a text file would give them."""
    return inputs.table(spark, folder, "events").select(
        "event_id",
        F.col("user_id").cast("string").alias("user_long"),
        F.col("value").cast("string").alias("value_long"),
        F.col("value").cast("string").alias("value_double"),
        F.col("event_type").alias("type_double"),
        F.concat(F.get_json_object("props", "$.k"), F.lit(".0")).alias("k_long"),
    )


_EVENT_TYPES = {"user_long": LONG, "value_long": LONG, "value_double": DOUBLE, "type_double": DOUBLE, "k_long": LONG}


@query(
    "cast_types",
    with_(
        _EVENT_TEXT,
        select=f"""
SELECT event_id, CAST(u AS BIGINT) AS user_long, {_WHOLE.format("v")} AS value_long, CAST(v AS DOUBLE) AS value_double,
       TRY_CAST(t AS DOUBLE) AS type_double, {_WHOLE.format("k")} AS k_long
FROM typed""",
    ),
)
def cast_types(spark: SparkSession, folder: str) -> DataFrame:
    return ops.cast_declared(_event_texts(spark, folder), _EVENT_TYPES)


@query(
    "cast_failures",
    with_(
        _EVENT_TEXT,
        select=f"""
SELECT 'user_long' AS column_name, count(*) FILTER (WHERE TRY_CAST(u AS BIGINT) IS NULL) AS failures FROM typed
UNION ALL SELECT 'value_long', count(*) FILTER (WHERE {_WHOLE.format("v")} IS NULL) FROM typed
UNION ALL SELECT 'value_double', count(*) FILTER (WHERE TRY_CAST(v AS DOUBLE) IS NULL) FROM typed
UNION ALL SELECT 'type_double', count(*) FILTER (WHERE TRY_CAST(t AS DOUBLE) IS NULL) FROM typed
UNION ALL SELECT 'k_long', count(*) FILTER (WHERE {_WHOLE.format("k")} IS NULL) FROM typed""",
    ),
)
def cast_failures(spark: SparkSession, folder: str) -> DataFrame:
    return ops.cast_failures(_event_texts(spark, folder), _EVENT_TYPES)


@query(
    "deduplicate",
    with_(
        LABELLED, SOURCE, RAW, UNIQUE,
        select="SELECT _row_key, content_type, label, character_count, _row_hash FROM uniq",
    ),
)
def deduplicate(spark: SparkSession, folder: str) -> DataFrame:
    unique = ops.deduplicate(workspace.raw(spark, folder), "_row_key")
    return unique.select("_row_key", "content_type", "label", "character_count", "_row_hash")


@query(
    "quarantine_null_target",
    with_(
        *TO_RAW, UNIQUE,
        select="SELECT _row_key, content_type, 'null_target' AS _quarantine_reason FROM uniq WHERE label IS NULL",
    ),
)
def quarantine_null_target(spark: SparkSession, folder: str) -> DataFrame:
    _, quarantined = ops.split_on_target(ops.deduplicate(workspace.raw(spark, folder), "_row_key"), "label")
    return quarantined.select("_row_key", "content_type", "_quarantine_reason")


@query(
    "quarantine_json",
    with_(
        LABELLED_DOCUMENTS,
        select="""
SELECT '2024-01-31' AS quarantine_date, 'null_target' AS reason, 'documents.parquet' AS source_file,
       CAST(json_object('_row_key', _row_key, 'text_content', text_content, 'content_type', content_type, 'label', label,
                        'source', source, 'n_chars', n_chars, '_source_file', 'documents.parquet') AS VARCHAR) AS raw_data
FROM labelled WHERE label IS NULL""",
    ),
)
def quarantine_json(spark: SparkSession, folder: str) -> DataFrame:
    rows = inputs.labelled_documents(spark, folder).withColumn("_source_file", F.lit("documents.parquet"))
    _, quarantined = ops.split_on_target(rows, "label")
    log = ops.quarantine_log(quarantined, F.lit("2024-01-31"))
    return log.withColumn("quarantine_date", F.date_format("quarantine_date", "yyyy-MM-dd"))


@query(
    "impute_median",
    with_(
        *TO_STAGING,
        select=f"""
SELECT _row_key, {r("flesch_reading_ease", 6)} AS flesch_reading_ease, {r("gunning_fog_index", 6)} AS gunning_fog_index
FROM staging""",
    ),
)
def impute_median(spark: SparkSession, folder: str) -> DataFrame:
    unique = ops.deduplicate(workspace.raw(spark, folder), "_row_key")
    clean, _ = ops.split_on_target(unique, "label")
    columns = ["flesch_reading_ease", "gunning_fog_index"]
    filled = ops.impute_median(written(clean.select("_row_key", *columns), "clean"), columns)
    return filled.select("_row_key", *[rounded(F.col(c), 6).alias(c) for c in columns])


_MEASURES = ("l_quantity", "l_extendedprice", "l_discount", "l_tax")


@query(
    "column_medians",
    "\nUNION ALL\n".join(
        f"SELECT '{c}' AS column_name, {r(f'median({c})', 6)} AS median, count(*) - count({c}) AS missing FROM lineitem"
        for c in _MEASURES
    ),
)
def column_medians(spark: SparkSession, folder: str) -> DataFrame:
    # A low limit, so that the bracket search runs at any table size.
    values, missing = medians(
        inputs.table(spark, folder, "lineitem").select(*_MEASURES), list(_MEASURES), rows_at_once=20_000
    )
    found = spark.createDataFrame([(c, float(values[c]), missing[c]) for c in _MEASURES], "column_name string, median double, missing bigint")
    return found.withColumn("median", rounded(F.col("median"), 6))


@query(
    "sketched_medians",
    "\nUNION ALL\n".join(
        f"SELECT '{c}' AS column_name, count(DISTINCT l_orderkey % 5) AS batches, count({c}) AS n, true AS within FROM lineitem" for c in _MEASURES
    ),
)
def sketched_medians(spark: SparkSession, folder: str) -> DataFrame:
    """Medians of lineitem from states landed in two increments, and whether their exact ranks are within the bound."""
    rows, path = inputs.table(spark, folder, "lineitem").withColumn("_batch", F.col("l_orderkey") % 5), new_path(spark, "states")
    for increment in (F.col("_batch") < 3, F.col("_batch") >= 3):
        states = sketches.keep_states(sketches.quantile_states(rows.where(increment), _MEASURES, "_batch"), path)
    found = written(sketches.sketched_medians(states), "sketched")
    middle = {x.column_name: x["median"] for x in found.collect()}
    ranks = [F.struct(F.lit(c).alias("column_name"), F.count_if(F.col(c) < m).alias("below"), F.count_if(F.col(c) <= m).alias("upto")) for c, m in middle.items()]
    counted = rows.agg(F.array(*ranks).alias("r")).select(F.inline("r"))
    error = sketches.rank_error()
    within = (F.col("below") <= (0.5 + error) * F.col("n")) & (F.col("upto") >= (0.5 - error) * F.col("n"))
    return found.join(counted, "column_name").select("column_name", "batches", "n", within.alias("within"))


_ROUNDED = ", ".join(f"{r(c, 6)} AS {c}" if inputs.SPEC.types[c] == DOUBLE else c for c in inputs.SPEC.numeric)


@query(
    "staging",
    with_(
        *TO_STAGING,
        select=f"""
SELECT _row_key, content_type, label, {_ROUNDED}, _row_hash, '2024-01-31 00:00:00' AS staged_at, '1.0' AS _staging_version
FROM staging""",
    ),
)
def staging(spark: SparkSession, folder: str) -> DataFrame:
    features = [
        rounded(F.col(c), 6).alias(c) if inputs.SPEC.types[c] == DOUBLE else F.col(c) for c in inputs.SPEC.numeric
    ]
    return workspace.staging(spark, folder).select(
        "_row_key", "content_type", "label", *features, "_row_hash",
        F.date_format("_staged_at_utc", "yyyy-MM-dd HH:mm:ss").alias("staged_at"), "_staging_version",
    )


@query(
    "feature_projection",
    with_(*TO_STAGING, select=f"SELECT _row_key, {_COUNTS}, {r('burstiness', 6)} AS burstiness, content_type, label FROM staging"),
)
def feature_projection(spark: SparkSession, folder: str) -> DataFrame:
    chosen = inputs.SPEC.without("lexical_diversity", "avg_sentence_length", "avg_word_length", "punctuation_ratio",
                                 "flesch_reading_ease", "gunning_fog_index")
    return project(workspace.staging(spark, folder), chosen).withColumn("burstiness", rounded(F.col("burstiness"), 6))


@query(
    "fill_zero",
    with_(
        LABELLED, SOURCE,
        select="""
SELECT _row_key, label, coalesce(flesch_reading_ease, 0) AS flesch_reading_ease, coalesce(gunning_fog_index, 0) AS gunning_fog_index
FROM source""",
    ),
)
def fill_zero(spark: SparkSession, folder: str) -> DataFrame:
    columns = ["flesch_reading_ease", "gunning_fog_index"]
    return ops.fill_zero(workspace.raw(spark, folder).select("_row_key", "label", *columns), columns)


# ---------------------------------------------------------------------------
# reports
# ---------------------------------------------------------------------------

_LABEL_TEXT = "CASE WHEN label = 1 THEN 'AI-Generated' ELSE 'Human-Written' END"

STYLOMETRICS_BY_TYPE = with_(
    *TO_STAGING,
    select=f"""
SELECT content_type, label, {_LABEL_TEXT} AS label_desc, count(*) AS total_samples,
       {r("avg(word_count)", 2)} AS avg_words, {r("avg(lexical_diversity)", 4)} AS avg_lexical_diversity,
       {r("avg(avg_sentence_length)", 2)} AS avg_sentence_len, {r("avg(flesch_reading_ease)", 2)} AS avg_flesch_reading_ease,
       {r("avg(gunning_fog_index)", 2)} AS avg_gunning_fog, {r("avg(burstiness)", 4)} AS avg_burstiness
FROM staging GROUP BY content_type, label""",
)


@query("stylometrics_by_type", STYLOMETRICS_BY_TYPE)
def stylometrics_by_type(spark: SparkSession, folder: str) -> DataFrame:
    return reports.stylometrics_by_type(workspace.staging(spark, folder))


@query(
    "readability_contrast",
    with_(
        *TO_STAGING,
        select=f"""
SELECT {_LABEL_TEXT} AS author_type, count(*) AS n_records, {r("avg(flesch_reading_ease)", 2)} AS mean_reading_ease,
       {r("stddev_samp(flesch_reading_ease)", 2)} AS std_reading_ease, {r("avg(gunning_fog_index)", 2)} AS mean_fog_index
FROM staging GROUP BY label""",
    ),
)
def readability_contrast(spark: SparkSession, folder: str) -> DataFrame:
    return reports.readability_contrast(workspace.staging(spark, folder))


@query(
    "price_contrast",
    f"""
SELECT l_returnflag, count(*) AS n, {r("avg(l_extendedprice)", 2)} AS mean_price, {r("stddev_samp(l_extendedprice)", 2)} AS std_price,
       {r("avg(l_discount)", 4)} AS mean_discount
FROM lineitem GROUP BY l_returnflag""",
)
def price_contrast(spark: SparkSession, folder: str) -> DataFrame:
    """The contrast view on a table of size."""
    return inputs.table(spark, folder, "lineitem").groupBy("l_returnflag").agg(
        F.count(F.lit(1)).alias("n"),
        rounded(F.avg("l_extendedprice"), 2).alias("mean_price"),
        rounded(F.stddev_samp("l_extendedprice"), 2).alias("std_price"),
        rounded(F.avg("l_discount"), 4).alias("mean_discount"),
    )


@query(
    "staging_enriched",
    with_(
        *TO_STAGING,
        select=f"""
SELECT _row_key, content_type, label, word_count, character_count,
       {r("character_count / nullif(CAST(word_count AS DOUBLE), 0)", 2)} AS chars_per_word,
       {r("flesch_reading_ease / CAST(100 AS DOUBLE)", 4)} AS flesch_normalized
FROM staging""",
    ),
)
def staging_enriched(spark: SparkSession, folder: str) -> DataFrame:
    return reports.staging_enriched(workspace.staging(spark, folder)).select(
        "_row_key", "content_type", "label", "word_count", "character_count", "chars_per_word", "flesch_normalized"
    )
