"""Channel pages. Inputs are the channel mart: one row per acquisition source."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from pulsemart.functions import percent_text, title, whole

HIGH_CHURN = 0.25


def _first(metric: str, descending: bool) -> Column:
    """Row with the largest or smallest metric; equal values go to the first source by name."""
    value = -F.col(metric) if descending else F.col(metric)
    return F.min(
        F.when(
            F.col(metric).isNotNull(),
            F.struct(value.alias("key"), "acquisition_source", "pct_healthy", "avg_arr", "churn_rate"),
        )
    )


def channel_best(channel: DataFrame) -> DataFrame:
    def name(metric: str, descending: bool) -> Column:
        return title(_first(metric, descending)["acquisition_source"])

    return channel.agg(
        name("pct_healthy", True).alias("best_retention_channel"),
        name("churn_rate", False).alias("lowest_churn_channel"),
        name("avg_arr", True).alias("highest_arr_channel"),
    )


def channel_rankings(channel: DataFrame) -> DataFrame:
    def rank(order: Column) -> Column:
        return F.row_number().over(W.orderBy(order, "acquisition_source"))

    return channel.select(
        "acquisition_source",
        "churn_rate",
        "avg_arr",
        "pct_healthy",
        "total_tenants",
        rank(F.col("churn_rate").asc_nulls_last()).alias("churn_order"),
        rank(F.col("avg_arr").desc_nulls_last()).alias("arr_order"),
        rank(F.col("pct_healthy").desc_nulls_last()).alias("healthy_order"),
        (F.col("churn_rate") > HIGH_CHURN).alias("high_churn"),
    )


def channel_matrix(channel: DataFrame) -> DataFrame:
    return channel.select("acquisition_source", "pct_healthy", "avg_arr", "total_tenants", "churn_rate")


def channel_recommendation(channel: DataFrame) -> DataFrame:
    """One row for the channel to grow and one for the channel to review."""
    picks = channel.agg(
        _first("pct_healthy", True).alias("increase"), _first("churn_rate", True).alias("review")
    )
    return picks.select(
        F.inline(
            F.array(
                *[
                    F.struct(
                        F.lit(action).alias("recommendation"),
                        title(F.col(f"{action}.acquisition_source")).alias("channel"),
                        F.col(f"{action}.pct_healthy").alias("pct_healthy"),
                        F.col(f"{action}.avg_arr").alias("avg_arr"),
                        F.col(f"{action}.churn_rate").alias("churn_rate"),
                    )
                    for action in ("increase", "review")
                ]
            )
        )
    )


def channel_detail_table(channel: DataFrame) -> DataFrame:
    return channel.select(
        "acquisition_source",
        "total_tenants",
        "churned_tenants",
        percent_text(F.col("churn_rate")).alias("churn_rate"),
        whole(F.col("avg_arr")).alias("avg_arr"),
        whole(F.col("total_arr")).alias("total_arr"),
        percent_text(F.col("pct_healthy")).alias("pct_healthy"),
        "expansion_candidates",
    )
