"""A data contract: rules as data, checked in one pass, and row by row."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assayer.operators.checks import FAIL, PASS, WARN, missing, outside
from assayer.spec import Rule


def _clauses(df: DataFrame, rules: Sequence[Rule]) -> Iterator[tuple[Rule, str, Column, str]]:
    """(rule, clause, whether a row violates it, what to do then) of the columns that exist."""
    for rule in rules:
        if rule.column not in df.columns:
            continue
        column = F.col(rule.column)
        if not rule.nullable:
            yield rule, "not_null", missing(df, rule.column), rule.on_null or rule.on_violation
        if rule.minimum is not None or rule.maximum is not None:
            yield rule, "range", outside(column, rule) & ~missing(df, rule.column), rule.on_violation
        if rule.allowed is not None:
            yield rule, "allowed_values", F.coalesce(~column.isin(*rule.allowed), F.lit(False)), rule.on_violation


def contract_report(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """(column_name, clause, violations, status, action): every clause from one aggregation."""
    lines = [(r.column, clause, F.count_if(bad), F.lit(0.0), action) for r, clause, bad, action in _clauses(df, rules)]
    rows = F.count(F.lit(1))
    for r in rules:
        if r.max_null_rate is not None and r.column in df.columns:
            allowance = F.lit(r.max_null_rate) * rows
            lines.append((r.column, "max_null_rate", F.count_if(missing(df, r.column)), allowance, r.on_violation))
    structs = []
    for column, clause, violations, allowance, action in lines:
        bad = FAIL if action == "fail" else WARN
        structs.append(
            F.struct(
                F.lit(column).alias("column_name"),
                F.lit(clause).alias("clause"),
                violations.alias("violations"),
                F.when(violations <= allowance, PASS).otherwise(bad).alias("status"),
                F.lit(action).alias("action"),
            )
        )
    return df.agg(F.array(*structs).alias("lines")).select(F.explode("lines").alias("line")).select("line.*")


def with_violations(df: DataFrame, rules: Sequence[Rule], name: str = "_violations") -> DataFrame:
    """Adds the clauses a row violates, as `column:clause` in contract order."""
    marks = [F.when(bad, F.lit(f"{r.column}:{clause}")) for r, clause, bad, _ in _clauses(df, rules)]
    empty = F.array().cast("array<string>")
    return df.withColumn(name, F.filter(F.array(*marks), lambda m: m.isNotNull()) if marks else empty)


def split_by_contract(df: DataFrame, rules: Sequence[Rule]) -> tuple[DataFrame, DataFrame]:
    """(accepted rows, rows that a `quarantine` clause rejects, with the clauses as the reason)."""
    marks = [F.when(bad, F.lit(f"{r.column}:{clause}")) for r, clause, bad, action in _clauses(df, rules) if action == "quarantine"]
    if not marks:
        return df, df.where(F.lit(False)).withColumn("_quarantine_reason", F.lit(None).cast("string"))
    reason = F.concat_ws(",", *marks)
    marked = df.withColumn("_quarantine_reason", reason)
    return marked.where(reason == "").drop("_quarantine_reason"), marked.where(reason != "")
