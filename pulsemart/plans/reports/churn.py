"""Churn prediction page, over the predictions table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsemart.functions import percent_text, whole
from pulsemart.plans.reports.executive import active, arr_where

DEFAULT_THRESHOLD = 0.35


def churn_threshold_flags(predictions: DataFrame, threshold: float = DEFAULT_THRESHOLD) -> DataFrame:
    """Flag again on the stored, rounded probability."""
    return predictions.withColumn("churn_flag", (F.col("churn_probability") >= threshold).cast("int"))


def churn_kpis(predictions: DataFrame, threshold: float = DEFAULT_THRESHOLD) -> DataFrame:
    flagged = F.col("churn_flag") == 1
    return active(churn_threshold_flags(predictions, threshold)).agg(
        F.count_if(flagged).alias("high_risk_tenants"),
        arr_where(flagged).alias("high_risk_arr"),
        F.avg("churn_probability").alias("avg_probability"),
    )


def churn_histogram(
    predictions: DataFrame, threshold: float = DEFAULT_THRESHOLD, bins: int = 30
) -> DataFrame:
    """Equal bins on [0, 1]; 1.0 belongs to the last one."""
    place = F.least(F.width_bucket(F.col("churn_probability"), F.lit(0.0), F.lit(1.0), F.lit(bins)), F.lit(bins))
    return (
        active(churn_threshold_flags(predictions, threshold))
        .where(F.col("churn_probability").isNotNull())
        .groupBy("churn_flag", place.cast("int").alias("bin"))
        .agg(F.count("*").alias("tenants"))
        .withColumn("bin_start", (F.col("bin") - 1) / bins)
    )


def churn_scatter(predictions: DataFrame) -> DataFrame:
    return active(predictions).select(
        "tenant_id", "company_name", "plan", "churn_probability", "arr", "health_tier"
    )


def churn_high_risk_table(
    predictions: DataFrame, mart: DataFrame, threshold: float = DEFAULT_THRESHOLD
) -> DataFrame:
    """All flagged tenants: churned ones validate the model, active ones can be saved."""
    details = mart.select("tenant_id", "region", "csm_assigned", "days_since_cs_touch", "usage_trend_ratio")
    return (
        churn_threshold_flags(predictions, threshold)
        .where(F.col("churn_flag") == 1)
        .join(details, "tenant_id", "left")
        .orderBy(F.col("churn_probability").desc(), "tenant_id")
        .select(
            F.when(F.col("churned"), "Churned").otherwise("Active").alias("status"),
            "company_name",
            "plan",
            "region",
            "csm_assigned",
            whole(F.col("arr")).alias("arr"),
            percent_text(F.col("churn_probability")).alias("churn_probability"),
            "health_tier",
            "health_score",
            "days_since_cs_touch",
            "usage_trend_ratio",
        )
    )


def feature_importance_topn(importance: DataFrame, n: int = 15) -> DataFrame:
    return importance.orderBy(F.col("importance").desc(), "feature").limit(n)


def model_metrics_summary(metrics: DataFrame) -> DataFrame:
    return metrics.limit(1).select(
        "cv_roc_auc_mean", "cv_roc_auc_std", "cv_avg_precision_mean", "decision_threshold"
    )


def high_risk_summary(predictions: DataFrame) -> DataFrame:
    """Over all tenants, with the flags as stored."""
    flagged = F.col("churn_flag") == 1
    return predictions.agg(
        F.count_if(flagged).alias("flagged_tenants"), arr_where(flagged).alias("arr_at_risk")
    )
