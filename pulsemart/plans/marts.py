"""The tenant health mart and the five marts derived from it.

All builders are lazy: they return one plan from the clean tables to the mart.
Every join is on ``tenant_id`` after its side has been aggregated to one row per
tenant; whether a side is broadcast is left to Spark, which checks its size.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from pulsemart.config import HealthConfig
from pulsemart.functions import day_literal, days_between, money_avg, money_sum
from pulsemart.operators.cleaning import CLEANERS, clean_events
from pulsemart.operators.crm import contact_history, is_blind_spot, metrics_of
from pulsemart.operators.scoring import COMPONENTS, expansion_candidate, health_components, health_score
from pulsemart.operators.usage import (
    tenant_usage,
    user_metrics,
    weekly_activity,
    window_columns,
    with_usage_ratios,
)

TENANT_COLUMNS = [
    "tenant_id",
    "company_name",
    "plan",
    "region",
    "industry",
    "employee_size",
    "csm_assigned",
]
SUBSCRIPTION_COLUMNS = ["arr", "contract_start_date", "renewal_date", "churned", "churn_date"]
COMPANY_COLUMNS = ["lifecycle_stage", "acquisition_source", "pov_started"]
USER_COLUMNS = ["total_users", "active_users", "admin_count", "active_user_pct"]
CRM_COLUMNS = [
    "last_cs_touch_date",
    "cs_touches_90d",
    "negative_outcomes_90d",
    "no_response_90d",
    "days_since_cs_touch",
]
# Names of the funnel stages.
FUNNEL_STAGES = (
    "Trial-Sourced Accounts",
    "POV Started",
    "Converted to Paying (ARR > 0)",
    "Retained Paying (Not Churned)",
    "Healthy Retained (Healthy/Neutral)",
)
HEALTHY_TIERS = ("Healthy", "Neutral")


class CleanTables:
    """Clean tables as attributes; each is planned when it is first used."""

    tenants: DataFrame
    subscriptions: DataFrame
    users: DataFrame
    events: DataFrame
    crm_companies: DataFrame
    crm_activities: DataFrame

    def __init__(self, load: Callable[[str], DataFrame]):
        self._load = load

    def __getattr__(self, table: str) -> DataFrame:
        if table not in CLEANERS:
            raise AttributeError(table)
        df = self._load(table)
        setattr(self, table, df)
        return df

    @classmethod
    def from_raw(cls, raw: Mapping[str, DataFrame], cfg: HealthConfig = HealthConfig()) -> "CleanTables":
        def load(table: str) -> DataFrame:
            return clean_events(raw[table], cfg) if table == "events" else CLEANERS[table](raw[table])

        return cls(load)


BASE_FILLS = {"total_users": "0", "active_users": "0", "active_user_pct": "0D", "cs_touches_90d": "0"}


def _base_columns(cfg: HealthConfig) -> list[str]:
    return [
        *TENANT_COLUMNS,
        *SUBSCRIPTION_COLUMNS,
        *COMPANY_COLUMNS,
        *USER_COLUMNS,
        *window_columns(cfg),
        "last_event_date",
        "usage_trend_ratio",
        "hv_share_30d",
        *CRM_COLUMNS,
    ]


def _base(t: CleanTables, cfg: HealthConfig) -> DataFrame:
    """Tenants with everything known about them, the expansion trend in ``pp_growing`` and the
    mask of ``contact_days``. Every clean table is read once."""
    usage = with_usage_ratios(tenant_usage(t.events, cfg).drop("in_base"))
    joined = (
        t.tenants.select(*TENANT_COLUMNS)
        .join(t.subscriptions.select("tenant_id", *SUBSCRIPTION_COLUMNS), "tenant_id", "left")
        .join(t.crm_companies.select("tenant_id", *COMPANY_COLUMNS), "tenant_id", "left")
        .join(user_metrics(t.users), "tenant_id", "left")
        .join(usage, "tenant_id", "left")
        .join(metrics_of(contact_history(t.crm_activities, cfg), cfg), "tenant_id", "left")
    )
    fills = {
        **BASE_FILLS,
        **{c: "0" for c in window_columns(cfg)},
        "usage_trend_ratio": "0D",
        "hv_share_30d": "0D",
        "days_since_cs_touch": str(cfg.never_touched_days),
        "churned": "false",
        "pp_growing": "false",
    }
    return joined.selectExpr(
        *[f"coalesce({c}, {fills[c]}) AS {c}" if c in fills else c for c in [*_base_columns(cfg), "pp_growing", "contact_days"]]
    )


def tenant_base(t: CleanTables, cfg: HealthConfig = HealthConfig()) -> DataFrame:
    return _base(t, cfg).drop("pp_growing", "contact_days")


def mart_tenant_health(t: CleanTables, cfg: HealthConfig = HealthConfig()) -> DataFrame:
    """One row per tenant. Unsorted: order is a matter of presentation, see `by_health`."""
    scored = health_score(health_components(_base(t, cfg), cfg), cfg)
    # A tenant is a blind spot if any of its subscriptions is; its rows are together after the joins.
    blind = F.max(is_blind_spot(cfg)).over(W.partitionBy("tenant_id"))
    return scored.select(
        *_base_columns(cfg),
        *COMPONENTS,
        "health_score",
        "health_tier",
        "pp_growing",
        F.coalesce(expansion_candidate(cfg), F.lit(False)).alias("expansion_candidate"),
        F.coalesce(F.col("tenant_id").isNotNull() & blind, F.lit(False)).alias("cs_blind_spot"),
    )


def by_health(mart: DataFrame) -> DataFrame:
    return mart.orderBy(F.col("health_score").desc(), "tenant_id")


def mart_weekly_activity(t: CleanTables, cfg: HealthConfig = HealthConfig()) -> DataFrame:
    return weekly_activity(t.events, cfg)


def mart_channel_performance(mart: DataFrame) -> DataFrame:
    tenants = F.col("total_tenants")
    return (
        mart.where(F.col("acquisition_source").isNotNull())
        .groupBy("acquisition_source")
        .agg(
            F.count("tenant_id").alias("total_tenants"),
            F.count_if("churned").alias("churned_tenants"),
            money_sum(F.col("arr")).alias("total_arr"),
            money_avg(F.col("arr")).alias("avg_arr"),
            F.avg("health_score").alias("avg_health_score"),
            F.count_if("expansion_candidate").alias("expansion_candidates"),
            F.count_if(F.col("health_tier") == "Healthy").alias("healthy_count"),
            F.count_if(F.col("health_tier") == "At Risk").alias("at_risk_count"),
        )
        .withColumn("churn_rate", F.try_divide("churned_tenants", tenants))
        .withColumn("pct_healthy", F.try_divide("healthy_count", tenants))
    )


def mart_renewal_pipeline(
    mart: DataFrame, cfg: HealthConfig = HealthConfig(), min_days: int | None = None
) -> DataFrame:
    """Renewals up to 90 days ahead. Overdue ones stay in unless ``min_days`` is set."""
    due = days_between(F.col("renewal_date"), day_literal(cfg.snapshot))
    out = mart.where(~F.col("churned") & (due <= cfg.renewal_days))
    if min_days is not None:
        out = out.where(due >= min_days)
    return out.select(
        "tenant_id",
        "company_name",
        "plan",
        "region",
        "csm_assigned",
        "arr",
        "renewal_date",
        due.alias("days_to_renewal"),
        "health_score",
        "health_tier",
        "total_events_30d",
        "active_user_pct",
        "last_cs_touch_date",
        "days_since_cs_touch",
        "expansion_candidate",
    )


def by_renewal(renewals: DataFrame) -> DataFrame:
    return renewals.orderBy("days_to_renewal", "tenant_id")


def _stage_counts(scope: Column) -> list[Column]:
    """Tenants per stage among those in ``scope``. Stages are not nested in each other."""
    healthy = F.col("health_tier").isin(*HEALTHY_TIERS)
    stages = [
        F.lit(True),
        F.col("pov_started"),
        F.col("arr") > 0,
        ~F.col("churned"),
        ~F.col("churned") & healthy,
    ]
    return [
        F.count_if(F.coalesce(scope & stage, F.lit(False))).alias(f"stage_{i}")
        for i, stage in enumerate(stages, start=1)
    ]


def _conversion(position: int) -> Column:
    """Share of the previous stage; 0/0 is 1 and n/0 is infinite."""
    if position == 1:
        return F.lit(1.0)
    now, before = F.col(f"stage_{position}"), F.col(f"stage_{position - 1}")
    on_empty = F.when(now == 0, 1.0).otherwise(F.lit(float("inf")))
    return F.when(before == 0, on_empty).otherwise(F.try_divide(now, before))


def mart_trial_funnel(mart: DataFrame) -> DataFrame:
    """Five rows out of one aggregate; the previous stage is a column of the same row."""
    counts = mart.where(F.col("acquisition_source") == "trial").agg(*_stage_counts(F.lit(True)))
    start = F.greatest(F.col("stage_1"), F.lit(1))
    rows = F.array(
        *[
            F.struct(
                F.lit(i).alias("stage_order"),
                F.lit(stage).alias("stage"),
                F.col(f"stage_{i}").alias("tenants"),
                _conversion(i).alias("conversion_from_prev"),
                (F.lit(1.0) - _conversion(i)).alias("drop_from_prev"),
                (F.col(f"stage_{i}") / start).alias("conversion_from_start"),
            )
            for i, stage in enumerate(FUNNEL_STAGES, start=1)
        ]
    )
    return counts.select(F.inline(rows))


def mart_trial_funnel_diagnostics(mart: DataFrame) -> DataFrame:
    accounts = F.greatest(F.col("trial_accounts"), F.lit(1))
    return (
        mart.where(
            (F.col("acquisition_source") == "trial")
            & F.col("region").isNotNull()
            & F.col("plan").isNotNull()
        )
        .groupBy("region", "plan")
        .agg(
            F.count("tenant_id").alias("trial_accounts"),
            F.count_if("pov_started").alias("pov_started"),
            F.count_if(~F.col("churned")).alias("retained_paid"),
            F.count_if(F.col("health_tier").isin(*HEALTHY_TIERS)).alias("healthy_retained"),
            F.avg("health_score").alias("avg_health_score"),
            money_avg(F.col("arr")).alias("avg_arr"),
        )
        .withColumn("retained_paid_rate", F.col("retained_paid") / accounts)
        .withColumn("healthy_retained_rate", F.col("healthy_retained") / accounts)
    )


def mart_summary(mart: DataFrame, cfg: HealthConfig = HealthConfig()) -> DataFrame:
    """Totals over the health mart and the largest funnel drop, in one pass."""
    active, tier = ~F.col("churned"), F.col("health_tier")
    trial = F.col("acquisition_source") == "trial"
    totals = mart.agg(
        F.count("*").alias("total_tenants"),
        F.count_if("churned").alias("churned_tenants"),
        money_sum(F.when(active, F.col("arr"))).alias("active_arr"),
        *[F.count_if(tier == t).alias(f"tier_{t.lower().replace(' ', '_')}") for t in cfg.tiers],
        F.count_if("expansion_candidate").alias("expansion_candidates"),
        F.count_if("cs_blind_spot").alias("cs_blind_spots"),
        F.avg(F.when(active, F.col("health_score"))).alias("avg_active_health_score"),
        *_stage_counts(trial),
    )
    # On equal drops the earlier stage is the larger struct.
    drops = F.array_max(
        F.array(
            *[
                F.struct(
                    (F.lit(1.0) - _conversion(i)).alias("drop"),
                    F.lit(-i).alias("rank"),
                    F.lit(stage).alias("stage"),
                )
                for i, stage in enumerate(FUNNEL_STAGES, start=1)
                if i > 1
            ]
        )
    )
    return (
        totals.withColumn("churn_rate", F.try_divide("churned_tenants", "total_tenants"))
        .withColumn("biggest_drop_stage", drops["stage"])
        .withColumn("biggest_drop", drops["drop"])
        .drop(*[f"stage_{i}" for i in range(1, len(FUNNEL_STAGES) + 1)])
    )
