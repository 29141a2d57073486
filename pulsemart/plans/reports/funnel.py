"""Trial funnel page, over the five-row funnel mart and its region x plan diagnostics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def funnel_kpis(funnel: DataFrame) -> DataFrame:
    def tenants(stage_order: int) -> Column:
        return F.max(F.when(F.col("stage_order") == stage_order, F.col("tenants")))

    start = F.greatest(F.col("trial_accounts"), F.lit(1))
    return funnel.agg(
        tenants(1).alias("trial_accounts"),
        tenants(4).alias("retained_paying"),
        tenants(5).alias("healthy_retained"),
    ).select(
        "*",
        (F.col("retained_paying") / start).alias("retained_share"),
        (F.col("healthy_retained") / start).alias("healthy_share"),
    )


def _drop_pct() -> Column:
    return F.bround(F.col("drop_from_prev") * 100, 1).alias("drop_pct")


def funnel_biggest_drop(funnel: DataFrame) -> DataFrame:
    return (
        funnel.where(F.col("stage_order") > 1)
        .orderBy(F.col("drop_from_prev").desc(), "stage_order")
        .limit(1)
        .select("stage", "drop_from_prev", _drop_pct())
    )


def funnel_table(funnel: DataFrame) -> DataFrame:
    return funnel.select(
        "stage_order",
        "stage",
        "tenants",
        "conversion_from_prev",
        "drop_from_prev",
        "conversion_from_start",
        _drop_pct(),
    ).orderBy("stage_order")


def _outcomes(diagnostics: DataFrame, dimension: str) -> DataFrame:
    accounts = F.greatest(F.col("trial_accounts"), F.lit(1))
    return (
        diagnostics.groupBy(dimension)
        .agg(*[F.sum(c).alias(c) for c in ("trial_accounts", "retained_paid", "healthy_retained")])
        .withColumn("retained_rate", F.col("retained_paid") / accounts)
        .withColumn("healthy_rate", F.col("healthy_retained") / accounts)
    )


def funnel_by_plan(diagnostics: DataFrame) -> DataFrame:
    return _outcomes(diagnostics, "plan").unpivot(
        ["plan"], ["retained_rate", "healthy_rate"], "metric", "rate"
    )


def funnel_by_region(diagnostics: DataFrame) -> DataFrame:
    return (
        _outcomes(diagnostics, "region")
        .drop("healthy_rate")
        .orderBy(F.col("retained_rate").desc(), "region")
    )
