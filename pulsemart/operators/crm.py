"""CRM aggregates and the search for churned tenants nobody had contacted.

The days on which a tenant was contacted are bits of a calendar mask, so one pass over the
activities answers both what the last months held and whether any day of a window did.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulsemart.config import HealthConfig
from pulsemart.functions import day_literal, days_between

# Days of the calendar in a word of a mask: below 63, so every word stays positive.
WORD_DAYS = 62

HISTORY = ("recent_rows", "cs_touches_90d", "negative", "no_response")


def contact_history(activities: DataFrame, cfg: HealthConfig = HealthConfig()) -> DataFrame:
    """A row per tenant: last contact, figures of the recent window, and ``contact_days``, a map from words of the calendar to bits.

    First a row per tenant and word, combined before its shuffle, so a tenant with a third of
    the activities is spread over the calendar; a map holds at most a word for every 62 days.
    """
    recent = F.col("activity_date") >= day_literal(cfg.day(cfg.crm_days))

    def outcome(value: str) -> Column:
        return F.count_if(recent & (F.col("outcome") == value))

    day = F.unix_date("activity_date")
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(day, F.lit(WORD_DAYS)))
    by_word = (
        activities.where(F.col("tenant_id").isNotNull())
        .groupBy("tenant_id", F.floor(day / WORD_DAYS).cast("int").alias("word"))
        .agg(
            F.max("activity_date").alias("last_cs_touch_date"),
            F.count_if(recent).alias("recent_rows"),
            F.count(F.when(recent, F.col("activity_id"))).alias("cs_touches_90d"),
            outcome("negative").alias("negative"),
            outcome("no_response").alias("no_response"),
            F.bit_or(bit).alias("bits"),
        )
    )
    words = F.collect_list(F.when(F.col("word").isNotNull(), F.struct("word", "bits")))
    return by_word.groupBy("tenant_id").agg(
        F.max("last_cs_touch_date").alias("last_cs_touch_date"),
        *[F.sum(c).alias(c) for c in HISTORY],
        F.map_from_entries(words).alias("contact_days"),
    )


def contacted_between(first: Column, last: Column) -> Column:
    """Whether ``contact_days`` has a day from ``first`` to ``last``, both included; false without a mask or dates."""
    begin, end = F.unix_date(first), F.unix_date(last)

    def any_bit(word: Column) -> Column:
        low = F.greatest(begin - word * WORD_DAYS, F.lit(0))
        high = F.least(end - word * WORD_DAYS, F.lit(WORD_DAYS - 1))
        one = F.lit(1).cast("long")
        wanted = F.call_function("shiftleft", one, high + 1) - F.call_function("shiftleft", one, low)
        return F.coalesce(F.try_element_at("contact_days", word).bitwiseAND(wanted) != 0, F.lit(False))

    words = F.sequence(F.floor(begin / WORD_DAYS).cast("int"), F.floor(end / WORD_DAYS).cast("int"))
    return F.coalesce(F.exists(words, any_bit), F.lit(False))


def metrics_of(history: DataFrame, cfg: HealthConfig = HealthConfig()) -> DataFrame:
    any_recent = F.col("recent_rows") > 0
    return history.select(
        "tenant_id",
        "last_cs_touch_date",
        "cs_touches_90d",
        F.when(any_recent, F.col("negative")).alias("negative_outcomes_90d"),
        F.when(any_recent, F.col("no_response")).alias("no_response_90d"),
        F.coalesce(
            days_between(day_literal(cfg.snapshot), F.col("last_cs_touch_date")),
            F.lit(cfg.never_touched_days),
        ).alias("days_since_cs_touch"),
        "contact_days",
    )


def crm_metrics(activities: DataFrame, cfg: HealthConfig = HealthConfig()) -> DataFrame:
    """Outcome counts stay NULL for tenants without a touch in the window."""
    return metrics_of(contact_history(activities, cfg), cfg).drop("contact_days")


def is_blind_spot(cfg: HealthConfig = HealthConfig()) -> Column:
    """Churned, and no contact in the 60 days up to the churn date."""
    window = F.date_sub("churn_date", cfg.blind_spot_days), F.col("churn_date")
    return F.col("churned") & F.col("churn_date").isNotNull() & ~contacted_between(*window)


def cs_blind_spots(
    subscriptions: DataFrame, activities: DataFrame, cfg: HealthConfig = HealthConfig()
) -> DataFrame:
    """Churned tenants without any CRM activity in the 60 days up to their churn date.

    Every activity becomes a bit of its tenant's mask before anything is joined.
    """
    churned = subscriptions.where(F.col("churned") & F.col("churn_date").isNotNull())
    masks = contact_history(activities, cfg).select("tenant_id", "contact_days")
    return churned.join(masks, "tenant_id", "left").where(is_blind_spot(cfg)).select("tenant_id", "churn_date")
