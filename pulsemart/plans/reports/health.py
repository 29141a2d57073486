"""Customer health page."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsemart.functions import whole
from pulsemart.plans.reports.executive import active

# Labels of the score components.
COMPONENT_LABELS = {
    "score_active_users": "Active Users (25)",
    "score_event_volume": "Event Volume (20)",
    "score_hv_share": "HV Events (20)",
    "score_trend": "Usage Trend (20)",
    "score_cs_touch": "CS Touch (15)",
}


def _in_range(mart: DataFrame, low: float, high: float) -> DataFrame:
    return active(mart).where(F.col("health_score").between(low, high))


def health_score_range(mart: DataFrame, low: float = 0, high: float = 100) -> DataFrame:
    return _in_range(mart, low, high).select(
        "tenant_id",
        "company_name",
        "plan",
        "region",
        "csm_assigned",
        "health_score",
        "arr",
        "health_tier",
        "active_users",
        "renewal_date",
        "days_since_cs_touch",
    )


def bottom_n_components(mart: DataFrame, n: int = 20, low: float = 0, high: float = 100) -> DataFrame:
    """The n lowest scores, one row per tenant and component."""
    lowest = (
        _in_range(mart, low, high)
        .orderBy("health_score", "tenant_id")
        .limit(n)
        .select(
            "tenant_id",
            "company_name",
            "health_score",
            *[F.col(c).alias(label) for c, label in COMPONENT_LABELS.items()],
        )
    )
    return lowest.unpivot(
        ["tenant_id", "company_name", "health_score"],
        list(COMPONENT_LABELS.values()),
        "component",
        "score",
    )


def health_scorecard(mart: DataFrame, low: float = 0, high: float = 100) -> DataFrame:
    return _in_range(mart, low, high).select(
        "company_name",
        "plan",
        "region",
        "csm_assigned",
        "health_tier",
        F.bround("health_score", 1).alias("health_score"),
        whole(F.col("arr")).alias("arr"),
        F.bround(F.col("active_user_pct") * 100, 1).alias("active_user_pct"),
        "total_events_30d",
        "days_since_cs_touch",
        "renewal_date",
    )
