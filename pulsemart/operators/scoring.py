"""Health score, tier and expansion flag: row-wise expressions over the tenant base."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulsemart.config import HealthConfig
from pulsemart.functions import clip, ratio_or_zero, steps

COMPONENTS = (
    "score_active_users",
    "score_event_volume",
    "score_hv_share",
    "score_trend",
    "score_cs_touch",
)


def health_components(base: DataFrame, cfg: HealthConfig = HealthConfig()) -> DataFrame:
    daily_30 = F.col("total_events_30d") / 30
    daily_90 = F.col("total_events_90d") / 90
    volume = clip(ratio_or_zero(daily_30, daily_90), 0.0, cfg.volume_ratio_cap)
    share = clip(F.col("hv_share_30d") / cfg.hv_share_full, 0.0, 1.0)
    trend, touch = F.col("usage_trend_ratio"), F.col("days_since_cs_touch")
    return base.withColumns(
        {
            "score_active_users": clip(F.col("active_user_pct"), 0.0, 1.0) * cfg.points_active_users,
            "score_event_volume": (volume / cfg.volume_ratio_cap) * cfg.points_event_volume,
            "score_hv_share": share * cfg.points_hv_share,
            "score_trend": steps([(trend >= cut, points) for cut, points in cfg.trend_steps], 0.0),
            "score_cs_touch": steps([(touch <= days, points) for days, points in cfg.touch_steps], 0.0),
        }
    )


def tier_of(score: Column, churned: Column, cfg: HealthConfig) -> Column:
    """From the rounded score; churned tenants have a tier of their own."""
    return steps(
        [(churned, cfg.tier_churned), *[(score >= cut, tier) for cut, tier in cfg.tier_cuts]],
        cfg.tier_floor,
    )


def health_score(components: DataFrame, cfg: HealthConfig = HealthConfig()) -> DataFrame:
    total = F.lit(0.0)
    for c in COMPONENTS:
        total = total + F.coalesce(F.col(c), F.lit(0.0))
    scored = components.withColumn("health_score", F.bround(total, 1))
    return scored.withColumn("health_tier", tier_of(F.col("health_score"), F.col("churned"), cfg))


def expansion_candidate(cfg: HealthConfig = HealthConfig()) -> Column:
    """A NULL plan counts as "not enterprise"."""
    return (
        ~F.col("plan").eqNullSafe("enterprise")
        & F.col("health_tier").isin("Healthy", "Neutral")
        & (F.col("pp_growing") | (F.col("active_users") >= cfg.expansion_min_users))
        & ~F.col("churned")
    )
