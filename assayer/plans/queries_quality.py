"""Quality checks and the data contract."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from assayer.functions.numbers import rounded
from assayer.operators import checks, contract
from assayer.plans import inputs, workspace
from assayer.plans.registry import fixed, query, r, with_
from assayer.plans.shared_sql import TO_RAW, TO_STAGING
from assayer.spec import CONTRACT_RULES, RANGE_RULES, Settings

_SETTINGS = Settings()
_AS_OF = "2024-01-31 00:00:00"
_FEATURES = set(inputs.SPEC.required) | {"text_content"}
_RANGES = [rule for rule in RANGE_RULES if rule.column in _FEATURES]
_RULES = [rule for rule in CONTRACT_RULES if rule.column in _FEATURES]


def _six(report: DataFrame) -> DataFrame:
    return report.withColumn("value", rounded(F.col("value"), 6))


# ---------------------------------------------------------------------------
# SQL of the single checks, for any table
# ---------------------------------------------------------------------------


def _completeness_sql(table: str) -> str:
    return "\nUNION ALL\n".join(
        f"""SELECT 'completeness.{c}' AS "check", CASE WHEN rate <= 0.10 THEN 'PASS' ELSE 'WARN' END AS status,
  'missing ' || coalesce({fixed("rate * 100", 2)}, 'nan') || '%, 10% allowed' AS details, {r("rate", 6)} AS value
FROM (SELECT avg(CAST({c} IS NULL AS INTEGER)) AS rate FROM {table})"""
        for c in inputs.SPEC.required
    )


def _validity_sql(table: str) -> str:
    return "\nUNION ALL\n".join(
        f"""SELECT 'validity.{rule.column}', CASE WHEN n = 0 THEN 'PASS' ELSE 'WARN' END,
  'outside {rule.minimum} to {rule.maximum}: ' || CAST(n AS VARCHAR), CAST(n AS DOUBLE)
FROM (SELECT count(*) AS n FROM {table} WHERE {rule.column} < {rule.minimum} OR {rule.column} > {rule.maximum})"""
        for rule in _RANGES
    )


def _domain_sql(table: str) -> str:
    return f"""SELECT 'validity.label', CASE WHEN n = 0 THEN 'PASS' ELSE 'FAIL' END,
  'not among [0, 1]: ' || CAST(n AS VARCHAR), CAST(n AS DOUBLE)
FROM (SELECT count(*) AS n FROM {table} WHERE NOT coalesce(label IN (0, 1), false))"""


def _row_count_sql(table: str) -> str:
    return f"""SELECT 'row_count', CASE WHEN n >= 1200 THEN 'PASS' ELSE 'FAIL' END,
  'rows: ' || CAST(n AS VARCHAR) || ', at least 1200 wanted', CAST(n AS DOUBLE) FROM (SELECT count(*) AS n FROM {table})"""


def _uniqueness_sql(table: str) -> str:
    return f"""SELECT 'uniqueness', CASE WHEN n = 0 THEN 'PASS' ELSE 'FAIL' END,
  'rows that repeat a _row_hash: ' || CAST(n AS VARCHAR), CAST(n AS DOUBLE)
FROM (SELECT coalesce(sum(c - 1), 0) AS n FROM (SELECT count(*) AS c FROM {table} GROUP BY _row_hash))"""


def _balance_sql(table: str) -> str:
    return f"""SELECT 'class_balance', CASE WHEN k >= 2 AND lo / CAST(hi AS DOUBLE) >= 0.25 THEN 'PASS' ELSE 'WARN' END,
  CASE WHEN k < 2 THEN 'two classes needed, there: ' || CAST(k AS VARCHAR)
       ELSE CAST(k AS VARCHAR) || ' classes of ' || CAST(lo AS VARCHAR) || ' to ' || CAST(hi AS VARCHAR)
            || ' rows, share ' || {fixed("lo / CAST(hi AS DOUBLE)", 3)} END,
  CASE WHEN k >= 2 THEN {r("lo / CAST(hi AS DOUBLE)", 6)} END
FROM (SELECT count(*) AS k, min(c) AS lo, max(c) AS hi FROM (SELECT count(*) AS c FROM {table} WHERE label IS NOT NULL GROUP BY label))"""


def _freshness_sql(table: str, column: str) -> str:
    age = f"date_diff('microsecond', latest, TIMESTAMP '{_AS_OF}') / CAST(3600000000 AS DOUBLE)"
    return f"""SELECT 'freshness', CASE WHEN {age} <= 24 THEN 'PASS' ELSE 'WARN' END,
  'newest row ' || strftime(latest, '%Y-%m-%d %H:%M:%S') || ', hours since: ' || {fixed(age, 1)}, {r(age, 6)}
FROM (SELECT max({column}) AS latest FROM {table})"""


_NAMES = 'SELECT \'\' AS "check", \'\' AS status, \'\' AS details, CAST(NULL AS DOUBLE) AS value WHERE false\nUNION ALL\n'
_SCHEMA_SQL = (
    f"SELECT 'schema', 'PASS', 'has all {len(inputs.SPEC.required)} columns', CAST(NULL AS DOUBLE)"
)


def _report_sql(table: str) -> str:
    parts = [
        _SCHEMA_SQL, _completeness_sql(table), _validity_sql(table), _domain_sql(table),
        _freshness_sql(f"(SELECT TIMESTAMP '{_AS_OF}' AS staged)", "staged"), _row_count_sql(table), _uniqueness_sql(table), _balance_sql(table),
    ]
    return _NAMES + "\nUNION ALL\n".join(parts)


# ---------------------------------------------------------------------------
# single checks, on raw rows: duplicates and missing labels are still there
# ---------------------------------------------------------------------------


@query("check_completeness", with_(*TO_RAW, select=_NAMES + _completeness_sql("raw")))
def check_completeness(spark: SparkSession, folder: str) -> DataFrame:
    raw = workspace.raw(spark, folder)
    return _six(checks.evaluate(raw, checks.completeness(raw, inputs.SPEC.required, _SETTINGS.max_null_rate)))


@query("check_uniqueness", with_(*TO_RAW, select=_NAMES + _uniqueness_sql("raw")))
def check_uniqueness(spark: SparkSession, folder: str) -> DataFrame:
    return checks.check_uniqueness(workspace.raw(spark, folder))


@query("check_validity", with_(*TO_RAW, select=_NAMES + _validity_sql("raw")))
def check_validity(spark: SparkSession, folder: str) -> DataFrame:
    raw = workspace.raw(spark, folder)
    return checks.evaluate(raw, checks.validity(raw, RANGE_RULES))


@query("check_domain", with_(*TO_RAW, select=_NAMES + _domain_sql("raw")))
def check_domain(spark: SparkSession, folder: str) -> DataFrame:
    raw = workspace.raw(spark, folder)
    return checks.evaluate(raw, checks.domain(raw, "label", _SETTINGS.target_classes))


@query("check_freshness", _NAMES + _freshness_sql("events", "ts"))
def check_freshness(spark: SparkSession, folder: str) -> DataFrame:
    events = inputs.table(spark, folder, "events").withColumnRenamed("ts", "_ingested_at_utc")
    return _six(checks.evaluate(events, checks.freshness(events, _AS_OF, _SETTINGS.max_age_hours)))


@query("check_class_balance", with_(*TO_RAW, select=_NAMES + _balance_sql("raw")))
def check_class_balance(spark: SparkSession, folder: str) -> DataFrame:
    return _six(checks.check_class_balance(workspace.raw(spark, folder), "label", _SETTINGS.min_class_ratio))


@query("check_row_count", _NAMES + _row_count_sql("lineitem"))
def check_row_count(spark: SparkSession, folder: str) -> DataFrame:
    return checks.evaluate(inputs.table(spark, folder, "lineitem"), checks.row_count(_SETTINGS.min_rows))


# ---------------------------------------------------------------------------
# reports on staging
# ---------------------------------------------------------------------------


def _staging_report(spark: SparkSession, folder: str) -> DataFrame:
    return checks.quality_report(workspace.staging(spark, folder), inputs.SPEC, _SETTINGS, _RANGES, _AS_OF)


@query("quality_report", with_(*TO_STAGING, select=_report_sql("staging")))
def quality_report(spark: SparkSession, folder: str) -> DataFrame:
    return _six(_staging_report(spark, folder))


@query(
    "quality_summary",
    with_(
        *TO_STAGING,
        f"report AS ({_report_sql('staging')})",
        select="""
SELECT s.status, count(report.status) AS n FROM (VALUES ('PASS'), ('WARN'), ('FAIL')) s(status)
LEFT JOIN report ON report.status = s.status GROUP BY s.status""",
    ),
)
def quality_summary(spark: SparkSession, folder: str) -> DataFrame:
    return checks.quality_summary(_staging_report(spark, folder))


# ---------------------------------------------------------------------------
# contract
# ---------------------------------------------------------------------------


def _clause_sql() -> list[tuple[str, str, str, str]]:
    """(column, clause, violated, action)."""
    found = []
    for rule in _RULES:
        c = rule.column
        if not rule.nullable:
            found.append((c, "not_null", f"{c} IS NULL", rule.on_null or rule.on_violation))
        if rule.minimum is not None:
            found.append((c, "range", f"coalesce({c} < {rule.minimum} OR {c} > {rule.maximum}, false)", rule.on_violation))
        if rule.allowed is not None:
            values = ", ".join(repr(v) for v in rule.allowed)
            found.append((c, "allowed_values", f"coalesce({c} NOT IN ({values}), false)", rule.on_violation))
    return found


_LINES = [
    f"""SELECT '{c}' AS column_name, '{clause}' AS clause, count(*) FILTER (WHERE {bad}) AS violations,
  CASE WHEN count(*) FILTER (WHERE {bad}) = 0 THEN 'PASS' ELSE '{"FAIL" if action == "fail" else "WARN"}' END AS status,
  '{action}' AS action FROM raw"""
    for c, clause, bad, action in _clause_sql()
] + [
    f"""SELECT '{rule.column}', 'max_null_rate', count(*) FILTER (WHERE {rule.column} IS NULL),
  CASE WHEN count(*) FILTER (WHERE {rule.column} IS NULL) <= {rule.max_null_rate} * count(*) THEN 'PASS' ELSE 'WARN' END,
  '{rule.on_violation}' FROM raw"""
    for rule in _RULES
    if rule.max_null_rate is not None
]


@query("contract_report", with_(*TO_RAW, select="\nUNION ALL\n".join(_LINES)))
def contract_report(spark: SparkSession, folder: str) -> DataFrame:
    return contract.contract_report(workspace.raw(spark, folder), CONTRACT_RULES)


_MARKS = ", ".join(f"CASE WHEN {bad} THEN '{c}:{clause}' END" for c, clause, bad, _ in _clause_sql())


@query(
    "contract_row_violations",
    with_(*TO_RAW, select=f"SELECT _row_key, concat_ws(',', {_MARKS}) AS violations FROM raw"),
)
def contract_row_violations(spark: SparkSession, folder: str) -> DataFrame:
    marked = contract.with_violations(workspace.raw(spark, folder), CONTRACT_RULES)
    return marked.select("_row_key", F.array_join("_violations", ",").alias("violations"))


# A stricter contract than the published one, so that there are rows to reject.
_STRICT = [
    replace(rule, on_violation="quarantine", on_null=None)
    for rule in _RULES
    if rule.column in ("burstiness", "avg_sentence_length", "word_count")
]
_STRICT_MARKS = ", ".join(
    f"CASE WHEN {c} IS NULL THEN '{c}:not_null' END, CASE WHEN {c} < {lo} OR {c} > {hi} THEN '{c}:range' END"
    for c, lo, hi in [(rule.column, rule.minimum, rule.maximum) for rule in _STRICT]
)


@query(
    "contract_quarantine",
    with_(
        *TO_RAW,
        select=f"""
SELECT * FROM (SELECT _row_key, concat_ws(',', {_STRICT_MARKS}) AS _quarantine_reason FROM raw) WHERE _quarantine_reason <> ''""",
    ),
)
def contract_quarantine(spark: SparkSession, folder: str) -> DataFrame:
    _, rejected = contract.split_by_contract(workspace.raw(spark, folder), _STRICT)
    return rejected.select("_row_key", "_quarantine_reason")
