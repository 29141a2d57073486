"""Executive overview."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from pulsemart.config import TIERS
from pulsemart.functions import money_sum, tier_rank

AT_RISK_TIERS = ("At Risk", "Red Alert")


def active(mart: DataFrame) -> DataFrame:
    return mart.where(~F.col("churned"))


def arr_where(condition: Column) -> Column:
    return money_sum(F.when(condition, F.col("arr")))


def exec_kpis(mart: DataFrame) -> DataFrame:
    stays = ~F.col("churned")
    return mart.agg(
        F.count_if(stays).alias("active_tenants"),
        arr_where(stays).alias("active_arr"),
        F.try_divide(F.count_if("churned"), F.count("*")).alias("churn_rate"),
        arr_where(F.col("health_tier").isin(*AT_RISK_TIERS)).alias("arr_at_risk"),
    )


def tier_distribution(mart: DataFrame, tiers: Sequence[str] = TIERS) -> DataFrame:
    """The window runs over one row per tier."""
    return (
        mart.groupBy(F.col("health_tier").alias("tier"))
        .agg(F.count("*").alias("tenants"))
        .withColumn("share", F.col("tenants") / F.sum("tenants").over(W.partitionBy()))
        .withColumn("tier_order", tier_rank(F.col("tier"), tiers))
        .orderBy("tier_order")
    )


def arr_by_tier(mart: DataFrame, tiers: Sequence[str] = TIERS) -> DataFrame:
    return (
        mart.groupBy("health_tier")
        .agg(money_sum(F.col("arr")).alias("arr"))
        .withColumn("tier_order", tier_rank(F.col("health_tier"), tiers))
        .orderBy("tier_order")
    )


def _active_arr_by(mart: DataFrame, dimension: str) -> DataFrame:
    return (
        active(mart)
        .where(F.col(dimension).isNotNull())
        .groupBy(dimension)
        .agg(money_sum(F.col("arr")).alias("arr"))
        .orderBy(F.col("arr").desc(), dimension)
    )


def arr_by_plan(mart: DataFrame) -> DataFrame:
    return _active_arr_by(mart, "plan")


def arr_by_region(mart: DataFrame) -> DataFrame:
    return _active_arr_by(mart, "region")


def exec_findings(mart: DataFrame) -> DataFrame:
    in_danger = ~F.col("churned") & F.col("health_tier").isin(*AT_RISK_TIERS)
    return mart.agg(
        F.count_if("cs_blind_spot").alias("blind_spots"),
        F.count_if("expansion_candidate").alias("expansion_candidates"),
        F.count_if(in_danger).alias("at_risk_tenants"),
        arr_where(in_danger).alias("at_risk_arr"),
    )
