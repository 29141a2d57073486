"""Raw table -> clean table. Only events without a usable time lose rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from pulsemart.config import EMPLOYEE_SIZES, VALID_ROLES, HealthConfig
from pulsemart.functions import flag, is_not_in, tidy, tier_rank, to_day, to_instant
from pulsemart.sources.schemas import EXTRA, SEQUENCE


def first_per_tenant(raw: DataFrame) -> DataFrame:
    """The first row of every tenant_id, with the number of rows it had.

    With a numeric ``ingest_seq``, which is distinct within an id, only that number is
    aggregated, by hash, and the row is fetched by it. A position of several parts, or
    none ("first" is then the smallest row), needs whole rows compared. Either way rows
    are combined before the shuffle, so an id that holds a large part of them costs one
    row per task, where a ranking window would sort all its copies in one task.
    """
    others = [c for c in raw.columns if c not in ("tenant_id", *EXTRA)]
    kind = raw.schema[SEQUENCE].dataType if SEQUENCE in raw.columns else None
    if isinstance(kind, NumericType):
        first = raw.groupBy(F.col("tenant_id").alias("first_id")).agg(
            F.min(SEQUENCE).alias("first_seq"), F.count("*").alias("copies")
        )
        same = F.col("tenant_id").eqNullSafe(F.col("first_id")) & F.col(SEQUENCE).eqNullSafe(F.col("first_seq"))
        return raw.join(first, same).select("tenant_id", *others, "copies")
    order = [SEQUENCE] if kind is not None else []
    return (
        raw.groupBy("tenant_id")
        .agg(F.min(F.struct(*order, *others)).alias("row"), F.count("*").alias("copies"))
        .select("tenant_id", *[F.col(f"row.{c}").alias(c) for c in others], "copies")
    )


def clean_tenants(raw: DataFrame) -> DataFrame:
    size = F.col("employee_size")
    known = F.when(size.isin(*EMPLOYEE_SIZES), size)
    return first_per_tenant(raw).select(
        "tenant_id",
        "company_name",
        tidy("plan").alias("plan"),
        "region",
        "industry",
        known.alias("employee_size"),
        "csm_assigned",
        tier_rank(size, EMPLOYEE_SIZES).alias("employee_size_rank"),
    )


def clean_subscriptions(raw: DataFrame) -> DataFrame:
    churned, ended = F.col("churned"), F.col("churn_date")
    parsed = raw.select(
        "subscription_id",
        "tenant_id",
        "plan",
        "arr",
        to_day("contract_start_date").alias("contract_start_date"),
        to_day("renewal_date").alias("renewal_date"),
        flag("churned").alias("churned"),
        to_day("churn_date").alias("churn_date"),
    )
    # Both repairs look at the values as parsed, so they cannot feed each other.
    return parsed.select(
        "subscription_id",
        "tenant_id",
        "plan",
        "arr",
        "contract_start_date",
        "renewal_date",
        (churned | ended.isNotNull()).alias("churned"),
        F.when(churned & ended.isNull(), F.col("renewal_date")).otherwise(ended).alias("churn_date"),
        F.coalesce(F.col("arr") <= 0, F.lit(False)).alias("arr_suspect"),
    )


def clean_users(raw: DataFrame) -> DataFrame:
    registered, seen, role = to_day("registered_at"), to_day("last_seen_at"), tidy("role")
    return raw.select(
        "user_id",
        "tenant_id",
        F.when(is_not_in(role, VALID_ROLES), "member").otherwise(role).alias("role"),
        registered.alias("registered_at"),
        seen.alias("last_seen_at"),
        flag("is_active").alias("is_active"),
        F.coalesce(seen < registered, F.lit(False)).alias("date_order_suspect"),
    )


def clean_events(raw: DataFrame, cfg: HealthConfig = HealthConfig()) -> DataFrame:
    count = F.col("event_count")
    return (
        raw.withColumn("event_time", to_instant("event_time"))
        .where(F.col("event_time").isNotNull())
        .select(
            "event_id",
            "tenant_id",
            "user_id",
            "event_name",
            "event_time",
            F.when(count < 1, F.lit(1).cast("bigint")).otherwise(count).alias("event_count"),
            "properties",
            F.to_date("event_time").alias("event_date"),
            F.coalesce(F.col("event_name").isin(*cfg.high_value_events), F.lit(False)).alias("is_high_value"),
        )
    )


def clean_crm_companies(raw: DataFrame) -> DataFrame:
    return raw.select(
        "company_id",
        "tenant_id",
        tidy("lifecycle_stage").alias("lifecycle_stage"),
        tidy("acquisition_source").alias("acquisition_source"),
        flag("pov_started").alias("pov_started"),
        to_day("created_at").alias("created_at"),
        "region",
        "industry",
    )


def clean_crm_activities(raw: DataFrame) -> DataFrame:
    return raw.select(
        "activity_id",
        "tenant_id",
        tidy("activity_type").alias("activity_type"),
        to_day("activity_date").alias("activity_date"),
        tidy("outcome").alias("outcome"),
        "days_to_renewal",
    )


CLEANERS = {
    "tenants": clean_tenants,
    "subscriptions": clean_subscriptions,
    "users": clean_users,
    "events": clean_events,
    "crm_companies": clean_crm_companies,
    "crm_activities": clean_crm_activities,
}
