"""At-risk tenants, renewals and blind spots."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsemart.functions import whole
from pulsemart.plans.reports.executive import AT_RISK_TIERS, active, arr_where


def at_risk_kpis(mart: DataFrame, renewals: DataFrame) -> DataFrame:
    """The renewal count is over all renewals, whatever filter ``mart`` went through."""
    in_danger = ~F.col("churned") & F.col("health_tier").isin(*AT_RISK_TIERS)
    nothing = F.lit(0).cast("bigint")
    tenants = mart.agg(
        F.count_if(in_danger).alias("at_risk_tenants"),
        arr_where(in_danger).alias("arr_at_risk"),
        F.first(nothing).alias("renewals"),
    )
    due = renewals.agg(
        F.first(nothing).alias("at_risk_tenants"),
        F.first(F.lit(0.0)).alias("arr_at_risk"),
        F.count("*").alias("renewals"),
    )
    names = ("at_risk_tenants", "arr_at_risk", "renewals")
    return tenants.unionByName(due).agg(*[F.sum(c).alias(c) for c in names])


def at_risk_list(mart: DataFrame) -> DataFrame:
    return (
        active(mart)
        .where(F.col("health_tier").isin(*AT_RISK_TIERS))
        .orderBy("health_score", "tenant_id")
        .select(
            "company_name",
            "plan",
            "region",
            "csm_assigned",
            "health_tier",
            F.bround("health_score", 1).alias("health_score"),
            whole(F.col("arr")).alias("arr"),
            "renewal_date",
            "days_since_cs_touch",
            "total_events_30d",
            F.bround(F.col("active_user_pct") * 100, 1).alias("active_user_pct"),
            "cs_blind_spot",
        )
    )


def renewal_table(renewals: DataFrame) -> DataFrame:
    return renewals.orderBy("days_to_renewal", "tenant_id").select(
        "company_name",
        "plan",
        "csm_assigned",
        whole(F.col("arr")).alias("arr"),
        "days_to_renewal",
        "renewal_date",
        "health_tier",
        F.bround("health_score", 1).alias("health_score"),
        "total_events_30d",
        "days_since_cs_touch",
    )


def blind_spot_detail(mart: DataFrame) -> DataFrame:
    return mart.where("cs_blind_spot").select(
        "company_name",
        "plan",
        "region",
        whole(F.col("arr")).alias("arr"),
        "churn_date",
        "total_events_30d",
        "total_events_90d",
    )


def blind_spot_arr_lost(mart: DataFrame) -> DataFrame:
    """ARR is rounded per tenant before it is added up, as in the detail table."""
    return blind_spot_detail(mart).agg(
        F.count("*").alias("blind_spots"), F.coalesce(F.sum("arr"), F.lit(0)).alias("arr_lost")
    )
