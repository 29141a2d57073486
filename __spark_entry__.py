
from __future__ import annotations

import os
import sys
from collections.abc import Callable
from functools import cached_property

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from oracle import marts as oracle_marts
from oracle import model as oracle_model
from oracle import reports as oracle_reports
from oracle import tables as oracle_tables
from pulsemart import HealthConfig
from pulsemart.ml import checks, features, metrics, model_store, training
from pulsemart.operators import crm, daily_state, quality, scoring, usage
from pulsemart.operators.profile import column_profile
from pulsemart.plans import marts, sql_scripts
from pulsemart.plans.reports import churn, executive, filters, funnel, health, marketing, renewals, trends
from pulsemart.session import cut_lineage, new_table_path, side_by_side
from pulsemart.sources import (
    scan_csv_tables,
    scan_optional_parquet,
    scan_parquet,
    scan_sql_table,
    sink_csv_report,
    sink_parquet,
)
from pulsemart.sources.driver_tables import SCHEMAS as DRIVER_SCHEMAS
from pulsemart.sources.driver_tables import RawTables
from pulsemart.sources.schemas import EXTRA, METRICS_SCHEMA, PREDICTIONS_SCHEMA, SEQUENCE, TABLES

LLM_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
LLM_ORACLES: dict[str, str] = {}
try:
    import corpus_pipeline
    from pulsemart.llm import oracle as llm_oracle
    from pulsemart.llm import queries as llm_queries
except ModuleNotFoundError as missing:
    # Only the absence of the package itself is passed over.
    if (missing.name or "") != "corpus_pipeline" and not (missing.name or "").startswith("pulsemart.llm"):
        raise
else:
    LLM_QUERIES = {**llm_queries.QUERIES, "pipeline": corpus_pipeline.run}
    LLM_ORACLES = dict(llm_oracle.ORACLES)
    if corpus_pipeline.ORACLE_SQL:
        LLM_ORACLES["pipeline"] = corpus_pipeline.ORACLE_SQL

CFG = HealthConfig()
# What a stored usage state must say like the events themselves.
FROM_STATE = {
    "event_windows_from_state": "event_windows",
    "last_event_from_state": "last_event",
    "weekly_activity_from_state": "mart_weekly_activity",
}
FLAGSHIP_DIR = "/root/testdata/sf0.001"
Query = Callable[[SparkSession, str], DataFrame]


_STORED: dict[tuple, DataFrame] = {}


def data_state(spark: SparkSession, sf_dir: str) -> tuple:
    """Changes with the session and with any file of the mapped tables."""
    paths = [f"{sf_dir.rstrip('/')}/{table}.parquet" for table in DRIVER_SCHEMAS]
    files = spark.read.format("binaryFile").load(paths).select("path", "modificationTime", "length")
    return (spark.sparkContext.applicationId, *sorted(map(tuple, files.collect())))


class Inputs:
    """Lazy tables over one data directory; a query touches only what it names."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    @cached_property
    def raw(self) -> RawTables:
        return RawTables(self.spark, self.sf_dir)

    def declared(self, table: str) -> DataFrame:
        """A raw table with the declared columns only, as an export would hold it."""
        return self.raw[table].drop(SEQUENCE)

    @cached_property
    def clean(self) -> marts.CleanTables:
        return marts.CleanTables.from_raw(self.raw, CFG)

    @cached_property
    def mart(self) -> DataFrame:
        return marts.mart_tenant_health(self.clean, CFG)

    @cached_property
    def stored_mart(self) -> DataFrame:
        """Written once per session and state of the files, as the mart job does: its readers scan no fact table."""
        key = data_state(self.spark, self.sf_dir)
        if key not in _STORED:
            _STORED[key] = cut_lineage(marts.mart_tenant_health(self.clean, CFG), "mart")
        return _STORED[key]

    @cached_property
    def weekly(self) -> DataFrame:
        return marts.mart_weekly_activity(self.clean, CFG)

    @cached_property
    def channel(self) -> DataFrame:
        return marts.mart_channel_performance(self.mart)

    @cached_property
    def renewals(self) -> DataFrame:
        return marts.mart_renewal_pipeline(self.mart, CFG)

    @cached_property
    def funnel(self) -> DataFrame:
        return marts.mart_trial_funnel(self.mart)

    @cached_property
    def diagnostics(self) -> DataFrame:
        return marts.mart_trial_funnel_diagnostics(self.mart)

    @cached_property
    def predictions(self) -> DataFrame:
        return predictions_from(self.mart)

    @cached_property
    def scored(self) -> DataFrame:
        return self.mart.select(
            F.col("churned").cast("int").alias("label"),
            (F.lit(1.0) - F.col("health_score") / 100).alias("score"),
            "arr",
        )


class Pages(Inputs):
    """What report pages and the evaluation read: everything from the stored mart."""

    @cached_property
    def mart(self) -> DataFrame:
        return self.stored_mart


def predictions_from(mart: DataFrame) -> DataFrame:
    """Predictions from a score SQL can compute too: the lower the health, the higher the risk."""
    risk = F.lit(1.0) - F.col("health_score") / 100
    return features.churn_features(mart, CFG).select(
        *training.KEEP,
        F.bround(risk, 4).alias("churn_probability"),
        (risk >= CFG.churn_threshold).cast("int").alias("churn_flag"),
    )


class Fitted:
    """One training run per session and state of the data, shared by the model queries."""

    _runs: dict[tuple, "Fitted"] = {}

    def __init__(self, x: Inputs):
        self.mart = x.stored_mart
        self.data = training.training_set(self.mart, CFG)

    @classmethod
    def of(cls, spark: SparkSession, sf_dir: str) -> "Fitted":
        """A run is used again only while the files it came from are the same."""
        key = data_state(spark, sf_dir)
        if key not in cls._runs:
            cls._runs[key] = cls(Inputs(spark, sf_dir))
        return cls._runs[key]

    @cached_property
    def model(self):
        return training.train_churn_model(self.data)

    @cached_property
    def validation(self) -> DataFrame:
        return training.cross_validate_churn(self.data, CFG)


def _stable(df: DataFrame) -> DataFrame:
    """Doubles to six decimals: the order of a floating-point sum is not fixed. Sums of money are exact."""

    def shown(field):
        column = F.col(f"`{field.name}`")
        if not isinstance(field.dataType, DoubleType) or "arr" in field.name.split("_"):
            return column
        return F.round(column, 6).alias(field.name)

    return df.select(*[shown(f) for f in df.schema])


def _over(build: Callable[[Inputs], DataFrame]) -> Query:
    return lambda spark, sf_dir: _stable(build(Inputs(spark, sf_dir)))


def _page(build: Callable[[Inputs], DataFrame]) -> Query:
    return lambda spark, sf_dir: _stable(build(Pages(spark, sf_dir)))


def _with_model(build: Callable[[Fitted, SparkSession], DataFrame]) -> Query:
    return lambda spark, sf_dir: _stable(build(Fitted.of(spark, sf_dir), spark))


def _profiles(tables: dict[str, DataFrame]) -> DataFrame:
    out = None
    for name, df in tables.items():
        part = column_profile(df, name)
        out = part if out is None else out.unionByName(part)
    return out


def _csv_round_trip(x: Inputs) -> DataFrame:
    """Export the source tables as CSV, then load them into Parquet the way a user would."""
    folder, target = new_table_path(x.spark, "csv"), new_table_path(x.spark, "loaded")
    for table in TABLES:
        x.declared(table).write.option("header", True).option("escape", '"').option(
            "ignoreLeadingWhiteSpace", False
        ).option("ignoreTrailingWhiteSpace", False).csv(f"{folder}/{table}.csv")
    loaded = scan_csv_tables(x.spark, folder, target)
    return _profiles({table: df.drop(*EXTRA) for table, df in loaded.items()})


def _usage_state(x: Inputs) -> DataFrame:
    """The state after three batches: the first months, the rest, and events of all months that came late."""
    path = new_table_path(x.spark, "usage")
    late = F.pmod(F.xxhash64("event_id"), F.lit(7)) == 0
    first = F.col("event_date") < F.lit(CFG.day(60))
    for batch, part in enumerate((first & ~late, ~first & ~late, late)):
        daily_state.advance(path, x.clean.events.where(part), batch, CFG)
    return daily_state.usage_state(x.spark, path)


def _sql_table(x: Inputs) -> DataFrame:
    x.declared("events").createOrReplaceTempView("raw_product_events")
    return scan_sql_table(x.spark, "raw_product_events")


def _clean_events_by_month(x: Inputs) -> str:
    path = new_table_path(x.spark, "events")
    sink_parquet(x.clean.events, path, by_month_of="event_time")
    return path


def _whole_scan(x: Inputs) -> DataFrame:
    return scan_parquet(x.spark, _clean_events_by_month(x)).select(*x.clean.events.columns)


def _parquet_round_trip(x: Inputs) -> DataFrame:
    folder = new_table_path(x.spark, "clean")
    back = {}
    for table in TABLES:
        path = f"{folder}/{table}"
        df = getattr(x.clean, table)
        sink_parquet(df, path, by_month_of="event_time" if table == "events" else None)
        back[table] = scan_parquet(x.spark, path).select(*df.columns)
    return _profiles(back)


def _csv_report(x: Inputs) -> DataFrame:
    path = new_table_path(x.spark, "report")
    report = quality.dq_report(x.raw)
    sink_csv_report(report, path, order_by=["table", "column", "issue"])
    return x.spark.read.schema(report.schema).option("header", True).csv(path)


def _optional_scan(x: Inputs) -> DataFrame:
    """A predictions table that exists, together with one that was never written."""
    path = new_table_path(x.spark, "predictions")
    sink_parquet(x.predictions, path)
    there = scan_optional_parquet(x.spark, path, PREDICTIONS_SCHEMA)
    absent = scan_optional_parquet(x.spark, f"{path}-absent", PREDICTIONS_SCHEMA)
    return there.unionByName(absent)


def _one_hot(x: Inputs) -> DataFrame:
    sources = list(features.ONE_HOT.values())
    return features.one_hot_features(x.stored_mart.select("tenant_id", *sources)).drop(*sources)


def _feature_values(x: Inputs) -> DataFrame:
    pairs = features.categories(x.stored_mart)
    names = F.array(*[F.lit(n) for n in features.feature_names(pairs)])
    vector = features.feature_selection(features.churn_features(x.stored_mart, CFG), pairs)
    return vector.select(
        "tenant_id", F.inline(F.arrays_zip(names.alias("feature"), vector_to_array("features").alias("value")))
    )


def _fold_sizes(x: Inputs) -> DataFrame:
    labelled = x.mart.select("tenant_id", F.col("churned").cast("int").alias("label"))
    folds = training.stratified_folds(labelled, CFG)
    return folds.groupBy("label", "fold").agg(F.count("*").alias("tenants"))


def _model_shape(f: Fitted, spark: SparkSession) -> DataFrame:
    model = f.model
    return spark.createDataFrame(
        [(model.getNumTrees, model.numFeatures, model.totalNumNodes >= model.getNumTrees)],
        "trees INT, features INT, grown BOOLEAN",
    )


def _stored_model(f: Fitted, spark: SparkSession) -> DataFrame:
    path = new_table_path(spark, "model")
    model_store.save_model(model_store.churn_model(f.model, f.data, CFG), path)
    reloaded = model_store.score_mart(model_store.load_model(path), f.mart, CFG)
    return checks.checked_predictions(reloaded, CFG)


def _metrics(f: Fitted) -> DataFrame:
    model, validation = side_by_side(f.data.rows.sparkSession, [lambda: f.model, lambda: f.validation])
    return training.model_metrics(model, f.data, validation, CFG)


def _leak(f: Fitted, spark: SparkSession) -> DataFrame:
    leaky, clean = side_by_side(spark, [lambda: training.leakage_check(f.mart, CFG), lambda: f.validation])
    return checks.checked_leak(leaky, clean)


def _metrics_summary(f: Fitted, spark: SparkSession) -> DataFrame:
    path = new_table_path(spark, "metrics")
    sink_csv_report(_metrics(f), path)
    stored = spark.read.schema(METRICS_SCHEMA).option("header", True).csv(path)
    return checks.checked_summary(churn.model_metrics_summary(stored))


def _importance(f: Fitted, spark: SparkSession) -> DataFrame:
    return training.feature_importance(f.model, f.data.names, spark)


def entry(spark: SparkSession) -> DataFrame:
    """The tenant health mart on the smallest data set."""
    return marts.by_health(Inputs(spark, FLAGSHIP_DIR).mart)


def queries() -> dict[str, Query]:
    """One entry per operator."""
    engineered = [
        "days_to_renewal",
        "contract_age_months",
        "plan_encoded",
        "employee_size_encoded",
        "lifecycle_encoded",
        "pov_started",
    ]
    return {
        # Scans and sinks
        "scan_csv_tables": _over(_csv_round_trip),
        "scan_sql_table": _over(_sql_table),
        "scan_parquet": _over(_whole_scan),
        "scan_optional_parquet": _over(_optional_scan),
        "sink_parquet": _over(_parquet_round_trip),
        "sink_csv_report": _over(_csv_report),
        "model_store": _with_model(_stored_model),
        # Cleaning and data quality
        "dq_null_summary": _over(lambda x: quality.dq_null_summary(x.raw)),
        "clean_tenants": _over(lambda x: x.clean.tenants),
        "clean_subscriptions": _over(lambda x: x.clean.subscriptions),
        "clean_users": _over(lambda x: x.clean.users),
        "clean_events": _over(lambda x: x.clean.events),
        "clean_crm_companies": _over(lambda x: x.clean.crm_companies),
        "clean_crm_activities": _over(lambda x: x.clean.crm_activities),
        "dq_rule_checks": _over(lambda x: quality.dq_rule_checks(x.raw)),
        "dq_report": _over(lambda x: quality.dq_report(x.raw)),
        # Mart building blocks
        "user_metrics": _over(lambda x: usage.user_metrics(x.clean.users)),
        "event_windows": _over(lambda x: usage.event_windows(x.clean.events, CFG)),
        "last_event": _over(lambda x: usage.last_event(x.clean.events)),
        "event_windows_from_state": _over(lambda x: usage.event_windows(_usage_state(x), CFG)),
        "last_event_from_state": _over(lambda x: usage.last_event(_usage_state(x))),
        "weekly_activity_from_state": _over(lambda x: usage.weekly_activity(_usage_state(x), CFG)),
        "event_metrics": _over(lambda x: usage.event_metrics(x.clean.events, CFG)),
        "crm_metrics": _over(lambda x: crm.crm_metrics(x.clean.crm_activities, CFG)),
        "tenant_base": _over(lambda x: marts.tenant_base(x.clean, CFG)),
        "health_components": _over(
            lambda x: scoring.health_components(marts.tenant_base(x.clean, CFG), CFG).select(
                "tenant_id", *scoring.COMPONENTS
            )
        ),
        "health_score": _over(
            lambda x: scoring.health_score(
                scoring.health_components(marts.tenant_base(x.clean, CFG), CFG), CFG
            ).select("tenant_id", "health_score", "health_tier")
        ),
        "pp_trend": _over(lambda x: usage.pp_trend(x.clean.events, CFG)),
        "expansion_candidates": _over(
            lambda x: x.mart.where("expansion_candidate").select(
                "tenant_id", "plan", "health_tier", "active_users", "pp_growing"
            )
        ),
        "cs_blind_spots": _over(
            lambda x: crm.cs_blind_spots(x.clean.subscriptions, x.clean.crm_activities, CFG)
        ),
        # Marts
        "mart_tenant_health": _over(lambda x: marts.by_health(x.mart)),
        "mart_weekly_activity": _over(lambda x: x.weekly),
        "mart_channel_performance": _over(lambda x: x.channel),
        "mart_renewal_pipeline": _over(lambda x: marts.by_renewal(x.renewals)),
        "mart_trial_funnel": _over(lambda x: x.funnel),
        "mart_trial_funnel_diagnostics": _over(lambda x: x.diagnostics),
        "mart_summary": _over(lambda x: marts.mart_summary(x.mart, CFG)),
        "pipeline_summary": _over(lambda x: marts.mart_summary(x.mart, CFG)),
        # SQL over the raw tables
        "sql_tenant_health_summary": _over(
            lambda x: sql_scripts.sql_tenant_health_summary(x.spark, x.raw, CFG)
        ),
        "sql_channel_performance": _over(lambda x: sql_scripts.sql_channel_performance(x.spark, x.raw)),
        "sql_weekly_usage_trends": _over(
            lambda x: sql_scripts.sql_weekly_usage_trends(x.spark, x.raw, CFG)
        ),
        "sql_at_risk_tenants": _over(lambda x: sql_scripts.sql_at_risk_tenants(x.spark, x.raw, CFG)),
        # Report pages
        "filter_options": _page(lambda x: filters.filter_options(x.mart)),
        "apply_filters": _page(
            lambda x: filters.apply_filters(
                x.mart,
                plans=["starter", "business"],
                regions=["ASIA", "EUROPE"],
                tiers=["Healthy", "Neutral", "At Risk"],
            ).select("tenant_id", "plan", "region", "csm_assigned", "health_tier")
        ),
        "exec_kpis": _page(lambda x: executive.exec_kpis(x.mart)),
        "tier_distribution": _page(lambda x: executive.tier_distribution(x.mart)),
        "arr_by_tier": _page(lambda x: executive.arr_by_tier(x.mart)),
        "arr_by_plan": _page(lambda x: executive.arr_by_plan(x.mart)),
        "arr_by_region": _page(lambda x: executive.arr_by_region(x.mart)),
        "exec_findings": _page(lambda x: executive.exec_findings(x.mart)),
        "health_score_range": _page(lambda x: health.health_score_range(x.mart)),
        "bottom_n_components": _page(lambda x: health.bottom_n_components(x.mart)),
        "health_scorecard": _page(lambda x: health.health_scorecard(x.mart)),
        "at_risk_kpis": _page(
            lambda x: renewals.at_risk_kpis(x.stored_mart, marts.mart_renewal_pipeline(x.stored_mart, CFG))
        ),
        "at_risk_list": _page(lambda x: renewals.at_risk_list(x.mart)),
        "renewal_table": _page(lambda x: renewals.renewal_table(x.renewals)),
        "blind_spot_detail": _page(lambda x: renewals.blind_spot_detail(x.mart)),
        "blind_spot_arr_lost": _page(lambda x: renewals.blind_spot_arr_lost(x.mart)),
        "weekly_totals": _page(lambda x: trends.weekly_totals(x.weekly, x.mart)),
        "weekly_by_plan": _page(lambda x: trends.weekly_by_plan(x.weekly, x.mart)),
        "weekly_by_tier": _page(lambda x: trends.weekly_by_tier(x.weekly, x.mart)),
        "declining_tenants": _page(lambda x: trends.declining_tenants(x.mart)),
        "channel_best": _page(lambda x: marketing.channel_best(x.channel)),
        "channel_rankings": _page(lambda x: marketing.channel_rankings(x.channel)),
        "channel_matrix": _page(lambda x: marketing.channel_matrix(x.channel)),
        "channel_recommendation": _page(lambda x: marketing.channel_recommendation(x.channel)),
        "channel_detail_table": _page(lambda x: marketing.channel_detail_table(x.channel)),
        "funnel_kpis": _page(lambda x: funnel.funnel_kpis(x.funnel)),
        "funnel_biggest_drop": _page(lambda x: funnel.funnel_biggest_drop(x.funnel)),
        "funnel_table": _page(lambda x: funnel.funnel_table(x.funnel)),
        "funnel_by_plan": _page(lambda x: funnel.funnel_by_plan(x.diagnostics)),
        "funnel_by_region": _page(lambda x: funnel.funnel_by_region(x.diagnostics)),
        "churn_threshold_flags": _page(lambda x: churn.churn_threshold_flags(x.predictions)),
        "churn_kpis": _page(lambda x: churn.churn_kpis(x.predictions)),
        "churn_histogram": _page(lambda x: churn.churn_histogram(x.predictions)),
        "churn_scatter": _page(lambda x: churn.churn_scatter(x.predictions)),
        "churn_high_risk_table": _page(
            lambda x: churn.churn_high_risk_table(predictions_from(x.stored_mart), x.stored_mart)
        ),
        "high_risk_summary": _page(lambda x: churn.high_risk_summary(x.predictions)),
        "feature_importance_topn": _with_model(
            lambda f, spark: checks.checked_ranking(churn.feature_importance_topn(_importance(f, spark)))
        ),
        "model_metrics_summary": _with_model(_metrics_summary),
        # Model: features, training, evaluation
        "churn_features": _page(
            lambda x: features.churn_features(x.mart, CFG).select("tenant_id", *engineered)
        ),
        "one_hot_features": _page(_one_hot),
        "feature_selection": _page(_feature_values),
        "class_balance": _page(lambda x: metrics.class_balance(x.scored)),
        "stratified_folds": _page(_fold_sizes),
        "train_churn_model": _with_model(_model_shape),
        "cross_validate_churn": _with_model(lambda f, spark: checks.checked_validation(f.validation)),
        "leakage_check": _with_model(_leak),
        "churn_predictions": _with_model(
            lambda f, spark: checks.checked_predictions(training.churn_predictions(f.model, f.data, CFG), CFG)
        ),
        "confusion_matrix": _page(lambda x: metrics.confusion_matrix(x.scored, CFG.churn_threshold)),
        "arr_by_outcome": _page(lambda x: metrics.arr_by_outcome(x.scored, CFG.churn_threshold)),
        "classification_report": _page(
            lambda x: metrics.classification_report(x.scored, CFG.churn_threshold)
        ),
        "roc_curve": _page(lambda x: metrics.roc_curve(x.scored)),
        "roc_auc": _page(lambda x: metrics.roc_auc(x.scored)),
        "pr_curve": _page(lambda x: metrics.pr_curve(x.scored)),
        "average_precision": _page(lambda x: metrics.average_precision(x.scored)),
        "feature_importance": _with_model(lambda f, spark: checks.checked_importance(_importance(f, spark))),
        "model_metrics": _with_model(lambda f, spark: checks.checked_metrics(_metrics(f))),
        **LLM_QUERIES,
    }


def oracle_sql() -> dict[str, str]:
    """DuckDB SQL per query; for outputs of the trained model, of what must hold for any learner."""
    own = {**oracle_tables.QUERIES, **oracle_marts.QUERIES, **oracle_reports.QUERIES, **oracle_model.QUERIES}
    return {**own, **{name: own[of] for name, of in FROM_STATE.items()}, **LLM_ORACLES}
