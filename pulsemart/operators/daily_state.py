"""Usage by tenant, user and day, kept from run to run and advanced by the events that came since.

A row of the state stands for all events of a user on a day that count alike: with the same
flags, and either at midnight or later, because windows end at midnight. It has the columns of
clean events that usage is computed from, with counts added up, so every operator of `usage`
takes the state for events. Rows of several batches may share a key: they are sums and maxima,
so adding a batch never reads what is there, and a late event changes the days it belongs to.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pulsemart.config import HealthConfig
from pulsemart.functions import instant_literal
from pulsemart.sources.versions import add_batch, read_table, replace_table

MONTH = "event_month"
KEY = ("tenant_id", "user_id", "event_date", "at_midnight", "is_high_value", "is_expansion")


def daily_usage(events: DataFrame, cfg: HealthConfig = HealthConfig()) -> DataFrame:
    """Clean events, or states, as a state: combined before the shuffle, which is keyed by user and day too.

    Rows without a tenant are left out, as everywhere in `usage`; a null user is a user of its own.
    """
    midnight = F.col("event_time") == F.col("event_date").cast("timestamp_ntz")
    expansion = F.coalesce(F.col("event_name").isin(*cfg.expansion_events), F.lit(False))
    rows = F.col("event_rows") if "event_rows" in events.columns else F.lit(1)
    # A state has one name for all its events; hash aggregates have no minimum of texts.
    return (
        events.where(F.col("tenant_id").isNotNull())
        .withColumns({"at_midnight": midnight, "is_expansion": expansion})
        .groupBy(*KEY)
        .agg(
            F.max("event_time").alias("event_time"),
            F.sum("event_count").alias("event_count"),
            F.sum(rows).alias("event_rows"),
        )
        .select(
            "tenant_id",
            "user_id",
            F.when(F.col("is_expansion"), F.lit(cfg.expansion_events[0])).alias("event_name"),
            "event_time",
            "event_count",
            "event_date",
            "is_high_value",
            "event_rows",
            F.date_format("event_date", "yyyy-MM").alias(MONTH),
        )
    )


def advance(path: str, events: DataFrame, batch: int, cfg: HealthConfig = HealthConfig()) -> bool:
    """Add a batch of clean events, new days and late ones alike; false if this batch was added before.

    Only the batch is aggregated and written. Batches have rising numbers, so a job that is run
    again after a failure, before or after its batch was published, adds it once.
    """
    return add_batch(daily_usage(events, cfg), path, batch, (MONTH,))


def compact(spark: SparkSession, path: str, cfg: HealthConfig = HealthConfig()) -> None:
    """One row per key again, after many batches; what the state says stays the same."""
    replace_table(daily_usage(read_table(spark, path), cfg), path, (MONTH,))


def usage_state(spark: SparkSession, path: str, since: date | None = None) -> DataFrame:
    """The state from ``since`` on, in place of events; older months are not read."""
    state = read_table(spark, path)
    if since is None:
        return state
    recent = F.col(MONTH) >= F.lit(since.strftime("%Y-%m"))
    return state.where(recent & (F.col("event_time") >= instant_literal(since)))
