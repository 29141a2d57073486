"""Usage trends: the weekly mart under the tenants left by the filters."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsemart.config import TIERS
from pulsemart.functions import tier_rank, whole
from pulsemart.plans.reports.executive import active


def weekly_totals(weekly: DataFrame, mart: DataFrame) -> DataFrame:
    """The weekly mart has one row per tenant and week, so counting rows counts tenants."""
    return (
        weekly.join(mart.select("tenant_id"), "tenant_id", "left_semi")
        .groupBy("week_start")
        .agg(
            F.sum("event_count").alias("total_events"),
            F.sum("hv_event_count").alias("hv_events"),
            F.sum("active_users").alias("active_users"),
            F.count("*").alias("active_tenants"),
        )
        .withColumn("hv_pct", F.try_divide("hv_events", "total_events"))
        .orderBy("week_start")
    )


def _weekly_by(weekly: DataFrame, mart: DataFrame, attribute: str) -> DataFrame:
    """An inner join both applies the filter and brings the attribute in."""
    owners = mart.select("tenant_id", attribute).distinct()
    return (
        weekly.select("tenant_id", "week_start", "event_count")
        .join(owners, "tenant_id")
        .where(F.col(attribute).isNotNull())
        .groupBy("week_start", attribute)
        .agg(F.sum("event_count").alias("event_count"))
    )


def weekly_by_plan(weekly: DataFrame, mart: DataFrame) -> DataFrame:
    return _weekly_by(weekly, mart, "plan").orderBy("week_start", "plan")


def weekly_by_tier(weekly: DataFrame, mart: DataFrame, tiers: Sequence[str] = TIERS[:-1]) -> DataFrame:
    """Tiers off the axis (Churned) show up as NULL, after the others."""
    tier = F.col("health_tier")
    return (
        _weekly_by(weekly, mart, "health_tier")
        .withColumn("tier_order", tier_rank(tier, tiers))
        .withColumn("health_tier", F.when(F.col("tier_order").isNotNull(), tier))
        .orderBy(F.col("tier_order").asc_nulls_last(), "week_start")
    )


def declining_tenants(mart: DataFrame, below: float = 0.6) -> DataFrame:
    return (
        active(mart)
        .where(F.col("usage_trend_ratio") < below)
        .orderBy("usage_trend_ratio", "tenant_id")
        .select(
            "company_name",
            "plan",
            "region",
            "csm_assigned",
            "health_tier",
            "health_score",
            whole(F.col("arr")).alias("arr"),
            F.bround("usage_trend_ratio", 3).alias("usage_trend_ratio"),
            "total_events_recent_4w",
            "total_events_prior_4w",
        )
    )
