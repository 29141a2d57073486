"""Data-quality report: every anomaly counted, one aggregation per table."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulsemart.config import EMPLOYEE_SIZES, VALID_ROLES
from pulsemart.functions import flag, is_not_in, sql_text, tidy, to_day, to_instant
from pulsemart.operators.cleaning import first_per_tenant
from pulsemart.sources.schemas import EXTRA, MALFORMED, TABLES

# Texts of the report, here and in the rules below.
NULL_ISSUE = ("null values", "retained -- handled downstream")

Check = tuple[str, str, str, Column]  # column, issue, action, counted expression


def _hits(condition: Column) -> Column:
    return F.count_if(F.coalesce(condition, F.lit(False)))


def null_checks(raw: DataFrame) -> list[Check]:
    return [
        (c, *NULL_ISSUE, F.count_if(F.col(c).isNull())) for c in raw.columns if c not in EXTRA
    ]


def format_checks(raw: DataFrame) -> list[Check]:
    """Of tables read from CSV: rows that do not fit the header."""
    if MALFORMED not in raw.columns:
        return []
    return [("*", "more or fewer values than columns", "retained -- missing values are null", _hits(F.col(MALFORMED)))]


def rule_checks(table: str) -> list[Check]:
    """Row-level rules of a raw table; those of tenants look at ids, see `_tenant_rules`."""
    if table == "subscriptions":
        churned, ended = flag("churned"), to_day("churn_date")
        return [
            (
                "churn_date",
                "churned=True but churn_date is NULL",
                "set churn_date = renewal_date as proxy",
                _hits(churned & ended.isNull()),
            ),
            (
                "churned",
                "churned=False but churn_date is populated",
                "set churned=True to match churn_date",
                _hits(~churned & ended.isNotNull()),
            ),
            ("arr", "ARR <= 0", "retained -- flagged", _hits(F.col("arr") <= 0)),
        ]
    if table == "users":
        return [
            (
                "last_seen_at",
                "last_seen_at < registered_at",
                "retained -- flagged as date_order_suspect",
                _hits(to_day("last_seen_at") < to_day("registered_at")),
            ),
            (
                "role",
                "unexpected role values",
                "replaced with 'member'",
                _hits(is_not_in(tidy("role"), VALID_ROLES)),
            ),
        ]
    if table == "events":
        time = to_instant("event_time")
        return [
            (
                "event_time",
                "unparseable timestamp",
                "rows dropped -- unusable without timestamp",
                _hits(time.isNull()),
            ),
            (
                "event_count",
                "event_count < 1",
                "set to 1 -- minimum meaningful count",
                _hits(time.isNotNull() & (F.col("event_count") < 1)),
            ),
        ]
    if table == "crm_activities":
        return [
            (
                "days_to_renewal",
                "negative values (activity after renewal date)",
                "retained -- expected per data spec",
                _hits(F.col("days_to_renewal") < 0),
            )
        ]
    return []


def _tenant_rules() -> list[Check]:
    """Over one row per id: sizes are checked after duplicates are gone."""
    return [
        (
            "tenant_id",
            "duplicate IDs",
            "kept first occurrence",
            F.coalesce(F.sum(F.col("copies") - 1), F.lit(0)),
        ),
        (
            "employee_size",
            "unexpected values",
            "replaced with NaN",
            _hits(is_not_in(F.col("employee_size"), EMPLOYEE_SIZES)),
        ),
    ]


def _count(df: DataFrame, table: str, checks: list[Check]) -> DataFrame:
    """Run all checks in one aggregation; keep those that hit."""
    counts = df.agg(*[expression.alias(f"n{i}") for i, (_, _, _, expression) in enumerate(checks)])
    lines = [
        f"struct({sql_text(table)} AS table, {sql_text(column)} AS column, {sql_text(issue)} AS issue, "
        f"cast(n{i} AS BIGINT) AS affected_rows, {sql_text(action)} AS action)"
        for i, (column, issue, action, _) in enumerate(checks)
    ]
    return counts.selectExpr(f"inline(array({', '.join(lines)}))").where("affected_rows > 0")


def _union(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def dq_null_summary(raw: Mapping[str, DataFrame]) -> DataFrame:
    return _union([_count(raw[t], t, null_checks(raw[t])) for t in TABLES if t in raw])


def dq_rule_checks(raw: Mapping[str, DataFrame]) -> DataFrame:
    parts = []
    for table in TABLES:
        if table not in raw:
            continue
        if table == "tenants":
            parts.append(_count(first_per_tenant(raw[table]), table, _tenant_rules()))
        checks = format_checks(raw[table]) + rule_checks(table)
        if checks:
            parts.append(_count(raw[table], table, checks))
    return _union(parts)


def dq_report(raw: Mapping[str, DataFrame]) -> DataFrame:
    """Null and rule counts together: one scan per table, a second one for tenants."""
    parts = [
        _count(raw[t], t, null_checks(raw[t]) + format_checks(raw[t]) + rule_checks(t)) for t in TABLES if t in raw
    ]
    if "tenants" in raw:
        parts.append(_count(first_per_tenant(raw["tenants"]), "tenants", _tenant_rules()))
    return _union(parts).orderBy("table", "column", "issue")
