"""The three batch jobs: clean the source tables, build the marts, train the churn model.

Each reads what the one before wrote, so a job can be repeated on its own and
no plan spans more than one of them.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import partial

from pyspark.sql import DataFrame, SparkSession

from pulsemart.config import HealthConfig
from pulsemart.ml import model_store, training
from pulsemart.operators import daily_state
from pulsemart.operators.cleaning import CLEANERS, clean_events
from pulsemart.operators.quality import dq_report
from pulsemart.plans import marts
from pulsemart.session import side_by_side, temporary_tables
from pulsemart.sources import (
    scan_events,
    scan_optional_csv,
    scan_optional_parquet,
    scan_parquet,
    sink_csv_report,
    sink_parquet,
)
from pulsemart.sources.schemas import IMPORTANCE_SCHEMA, METRICS_SCHEMA, PREDICTIONS_SCHEMA
from pulsemart.sources.versions import replace_bucketed

DQ_REPORT = "data_quality_report"
USAGE_STATE = "usage_state"
BY_TENANT = ("tenants", "subscriptions", "crm_companies")
MARTS = (
    "mart_tenant_health",
    "mart_weekly_activity",
    "mart_channel_performance",
    "mart_renewal_pipeline",
    "mart_trial_funnel",
    "mart_trial_funnel_diagnostics",
)


def clean_path(out: str, table: str) -> str:
    return f"{out.rstrip('/')}/{table}_clean"


def mart_path(out: str, mart: str) -> str:
    return f"{out.rstrip('/')}/{mart}"


def clean_job(
    raw: Mapping[str, DataFrame], out: str, cfg: HealthConfig = HealthConfig(), buckets: int | None = None
) -> None:
    """Clean tables and the quality report.

    With ``buckets`` the tables of tenants' own facts are stored by tenant, for marts that join
    them without a shuffle. Users, events and activities are not: a tenant may hold a third of
    them, and their aggregates spread it.
    """

    def write(table: str) -> None:
        if table == "events":
            sink_parquet(clean_events(raw[table], cfg), clean_path(out, table), by_month_of="event_time")
        elif buckets and table in BY_TENANT:
            replace_bucketed(CLEANERS[table](raw[table]), clean_path(out, table), "tenant_id", buckets)
        else:
            sink_parquet(CLEANERS[table](raw[table]), clean_path(out, table))

    def report() -> None:
        sink_csv_report(dq_report(raw), mart_path(out, DQ_REPORT), order_by=["table", "column", "issue"])

    spark = raw["tenants"].sparkSession
    side_by_side(spark, [report, *[partial(write, table) for table in CLEANERS]])


def usage_job(events: DataFrame, out: str, batch: int, cfg: HealthConfig = HealthConfig()) -> bool:
    """Bring the stored usage state forward by raw events that came since; false if the batch was there already."""
    return daily_state.advance(mart_path(out, USAGE_STATE), clean_events(events, cfg), batch, cfg)


def clean_tables(
    spark: SparkSession, out: str, cfg: HealthConfig = HealthConfig(), from_state: bool = False
) -> marts.CleanTables:
    """Clean tables for the marts, which never look further back than their oldest window.

    With ``from_state`` the usage state of `usage_job` stands for the events.
    """
    oldest = cfg.day(max(cfg.longest_window, cfg.expansion_prior_days, 7 * cfg.weekly_weeks))

    def load(table: str) -> DataFrame:
        if table == "events" and from_state:
            return daily_state.usage_state(spark, mart_path(out, USAGE_STATE), oldest)
        path = clean_path(out, table)
        return scan_events(spark, path, oldest) if table == "events" else scan_parquet(spark, path)

    return marts.CleanTables(load)


def mart_job(
    spark: SparkSession, out: str, cfg: HealthConfig = HealthConfig(), from_state: bool = False
) -> None:
    """The health mart is written first; four of the others are read from it."""
    tables = clean_tables(spark, out, cfg, from_state)
    place = partial(mart_path, out)
    side_by_side(
        spark,
        [
            lambda: sink_parquet(marts.mart_tenant_health(tables, cfg), place("mart_tenant_health")),
            lambda: sink_parquet(marts.mart_weekly_activity(tables, cfg), place("mart_weekly_activity")),
        ],
    )
    health = scan_parquet(spark, place("mart_tenant_health"))
    derived = {
        "mart_channel_performance": marts.mart_channel_performance(health),
        "mart_renewal_pipeline": marts.mart_renewal_pipeline(health, cfg),
        "mart_trial_funnel": marts.mart_trial_funnel(health),
        "mart_trial_funnel_diagnostics": marts.mart_trial_funnel_diagnostics(health),
    }
    side_by_side(spark, [partial(sink_parquet, df, place(mart)) for mart, df in derived.items()])


def model_job(
    spark: SparkSession,
    out: str,
    cfg: HealthConfig = HealthConfig(),
    params: training.TreeParams = training.TreeParams(),
) -> None:
    with temporary_tables():
        health = scan_parquet(spark, mart_path(out, "mart_tenant_health"))
        data = training.training_set(health, cfg)
        validation, model = side_by_side(
            spark,
            [
                lambda: training.cross_validate_churn(data, cfg, params),
                lambda: training.train_churn_model(data, params),
            ],
        )
        sink_parquet(training.churn_predictions(model, data, cfg), mart_path(out, "churn_predictions"))
        sink_csv_report(
            training.feature_importance(model, data.names, spark), mart_path(out, "feature_importance")
        )
        sink_csv_report(
            training.model_metrics(model, data, validation, cfg), mart_path(out, "churn_model_metrics")
        )
        model_store.save_model(model_store.churn_model(model, data, cfg), mart_path(out, "churn_model"))


def report_tables(spark: SparkSession, out: str) -> dict[str, DataFrame]:
    """Everything the report pages read. Model outputs are empty until the model job has run."""
    return {
        **{mart: scan_parquet(spark, mart_path(out, mart)) for mart in MARTS},
        "churn_predictions": scan_optional_parquet(
            spark, mart_path(out, "churn_predictions"), PREDICTIONS_SCHEMA
        ),
        "feature_importance": scan_optional_csv(spark, mart_path(out, "feature_importance"), IMPORTANCE_SCHEMA),
        "churn_model_metrics": scan_optional_csv(spark, mart_path(out, "churn_model_metrics"), METRICS_SCHEMA),
    }
