"""Hand-computed edge cases: window ends, NULLs, rounding, repairs."""

import math
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from pulsemart import HealthConfig
from pulsemart.functions import week_key, week_start
from pulsemart.ml import features, metrics
from pulsemart.operators import cleaning, crm, quality, scoring, usage
from pulsemart.plans import marts, sql_scripts
from pulsemart.plans.reports import churn, filters, funnel
from pulsemart.sources.schemas import RAW_SCHEMAS

CFG = HealthConfig()


def raw(spark, table, rows):
    return spark.createDataFrame(rows, RAW_SCHEMAS[table])


def events(spark, rows):
    """(tenant, user, name, time, count) -> clean events."""
    full = [(f"e{i}", t, u, n, when, c, None) for i, (t, u, n, when, c) in enumerate(rows)]
    return cleaning.clean_events(raw(spark, "events", full))


def one(df):
    rows = df.collect()
    assert len(rows) == 1
    return rows[0]


def test_snapshot_day_ends_at_midnight_in_marts_but_not_in_sql(spark):
    rows = [
        ("t", "u", "x", "2024-06-30T00:00:00", 3),
        ("t", "u", "x", "2024-06-30T09:00:00", 5),
    ]
    clean = events(spark, rows)
    got = one(usage.event_windows(clean))
    assert (got.total_events_30d, got.active_days_30d, got.active_users_30d) == (3, 1, 1)
    tables = {
        "tenants": raw(spark, "tenants", [("t", "c", "p", "r", "i", "1-50", "m")]),
        "subscriptions": raw(spark, "subscriptions", [("s", "t", "p", 1.0, None, None, 0, None)]),
        "users": raw(spark, "users", [("u", "t", "Admin", None, None, 1)]),
        "events": raw(spark, "events", [(str(i), *r[:3], r[3], r[4], None) for i, r in enumerate(rows)]),
        "crm_companies": raw(spark, "crm_companies", [("c", "t", "active", "trial", 1, None, "r", "i")]),
        "crm_activities": raw(spark, "crm_activities", []),
    }
    got = one(sql_scripts.sql_tenant_health_summary(spark, tables))
    assert (got.total_events_30d, got.days_since_cs_touch, got.active_user_pct) == (8, 999, 1.0)
    assert one(sql_scripts.sql_at_risk_tenants(spark, tables)).risk_signal == "At Risk (low usage + no CS touch)"


def test_instant_28_days_back_is_in_both_four_week_windows(spark):
    got = one(
        usage.event_windows(
            events(
                spark,
                [
                    ("t", "a", "policy_created", "2024-06-02T00:00:00", 2),
                    ("t", "b", "x", "2024-06-02T00:00:01", 7),
                ],
            )
        )
    )
    assert (got.total_events_recent_4w, got.total_events_prior_4w) == (9, 2)
    assert (got.active_days_recent_4w, got.active_days_prior_4w) == (1, 1)
    assert (got.active_users_recent_4w, got.active_users_prior_4w) == (2, 1)
    assert (got.hv_events_prior_4w, got.hv_events_recent_4w) == (2, 2)


def test_later_on_the_last_day_does_not_count_as_a_day_of_the_prior_window(spark):
    got = one(
        usage.event_windows(
            events(spark, [("t", "a", "x", "2024-06-02T10:00:00", 2), ("t", "a", "x", "2024-05-20T10:00:00", 1)])
        )
    )
    assert (got.active_days_prior_4w, got.total_events_prior_4w) == (1, 1)


def test_tenant_without_recent_events_loses_all_windows(spark):
    clean = events(spark, [("t", "u", "x", "2024-05-01T10:00:00", 4)])
    assert usage.event_metrics(clean).count() == 0
    assert one(usage.event_windows(clean)).total_events_90d == 4
    tables = empty_tables(spark, events=clean, tenants=[("t", "c", "p", "r", "i", "1-50", "m")])
    got = one(marts.mart_tenant_health(tables))
    assert (got.total_events_90d, got.usage_trend_ratio, got.last_event_date, got.score_trend) == (0, 0.0, None, 0.0)


def test_last_event_may_lie_after_the_snapshot(spark):
    clean = events(spark, [("t", "u", "x", "2024-06-20T10:00:00", 4), ("t", "u", "x", "2024-07-02T10:00:00", 1)])
    assert one(usage.event_metrics(clean)).last_event_date == datetime(2024, 7, 2, 10)
    assert one(usage.last_event(clean)).last_event_date == datetime(2024, 7, 2, 10)


def test_expansion_windows(spark):
    clean = events(
        spark,
        [
            ("recent", "u", "pp_sync_started", "2024-05-31T00:00:00", 1),
            ("prior", "u", "pp_sync_completed", "2024-05-01T00:00:00", 1),
            ("later", "u", "pp_sync_completed", "2024-07-03T00:00:00", 1),
            ("old", "u", "pp_sync_completed", "2024-04-30T23:59:59", 1),
            ("other", "u", "report_generated", "2024-06-03T00:00:00", 1),
        ],
    )
    got = {r.tenant_id: r for r in usage.pp_trend(clean).collect()}
    assert set(got) == {"recent", "prior", "later"}
    assert (got["recent"].pp_events_30d, got["recent"].pp_events_prior_30d) == (1, 0)
    assert (got["prior"].pp_events_30d, got["prior"].pp_growing) == (0, False)
    assert got["later"].pp_growing is True
    tables = empty_tables(
        spark, events=clean, tenants=[(t, "c", "p", "r", "i", None, "m") for t in ("recent", "prior", "later")]
    )
    growing = {r.tenant_id: r.pp_growing for r in marts.mart_tenant_health(tables).collect()}
    assert growing == {"recent": True, "prior": False, "later": True}


def test_thirteen_weeks_with_the_first_holding_a_sunday(spark):
    clean = events(
        spark,
        [
            ("t", "u", "x", "2024-04-07T00:00:00", 1),
            ("t", "u", "x", "2024-04-06T23:59:59", 9),
            ("t", None, "x", "2024-04-08T01:00:00", 2),
            ("t", "v", "policy_created", "2024-04-10T01:00:00", None),
        ],
    )
    got = {str(r.week_start): r for r in usage.weekly_activity(clean).collect()}
    assert set(got) == {"2024-04-01", "2024-04-08"}
    assert got["2024-04-01"].event_count == 1
    second = got["2024-04-08"]
    assert (second.event_count, second.hv_event_count, second.active_users, second.active_days) == (2, 0, 1, 2)


def test_touch_after_the_snapshot_scores_full_points(spark):
    acts = cleaning.clean_crm_activities(
        raw(spark, "crm_activities", [("a", "t", "call", "2024-07-05", "Negative ", 1)])
    )
    got = one(crm.crm_metrics(acts))
    assert (got.days_since_cs_touch, got.cs_touches_90d, got.negative_outcomes_90d) == (-5, 1, 1)


def test_outcomes_are_null_without_a_recent_touch(spark):
    acts = cleaning.clean_crm_activities(
        raw(spark, "crm_activities", [("a", "t", "call", "2023-07-05", "negative", 1), ("b", "u", "c", None, "x", 1)])
    )
    got = {r.tenant_id: r for r in crm.crm_metrics(acts).collect()}
    assert (got["t"].cs_touches_90d, got["t"].negative_outcomes_90d, got["t"].no_response_90d) == (0, None, None)
    assert (got["u"].last_cs_touch_date, got["u"].days_since_cs_touch) == (None, 999)


def test_blind_spot_window_is_closed(spark):
    subs = cleaning.clean_subscriptions(
        raw(
            spark,
            "subscriptions",
            [(t, t, "p", 1.0, None, None, 1, "2024-06-20") for t in ("edge", "early", "none", "after")]
            + [("kept", "kept", "p", 1.0, None, None, 0, None), ("nodate", "nodate", "p", 1.0, None, None, 1, None)],
        )
    )
    acts = cleaning.clean_crm_activities(
        raw(
            spark,
            "crm_activities",
            [
                ("1", "edge", "c", "2024-04-21", "x", 0),
                ("2", "early", "c", "2024-04-20", "x", 0),
                ("3", "after", "c", "2024-06-21", "x", 0),
            ],
        )
    )
    got = {r.tenant_id for r in crm.cs_blind_spots(subs, acts).collect()}
    assert got == {"early", "none", "after"}


def test_week_functions(spark):
    days = spark.createDataFrame([(date(2023, 1, 1),), (date(2024, 1, 1),), (date(2024, 12, 31),)], "d DATE")
    got = [tuple(r) for r in days.select(week_key(F.col("d")), week_start(F.col("d")).cast("string")).collect()]
    assert got == [("2023-00", "2022-12-26"), ("2024-01", "2024-01-01"), ("2024-53", "2024-12-30")]


def test_week_key_follows_strftime(spark):
    days = spark.range(3000).selectExpr("date_add(DATE'2018-01-01', cast(id AS INT)) AS d")
    for r in days.select("d", week_key(F.col("d")).alias("k")).collect():
        assert r.k == r.d.strftime("%Y-%W")


@pytest.mark.parametrize(
    "parts,score,tier",
    [
        ((25.0, 20.0, 19.95, 10.0, 5.0), 80.0, "Healthy"),
        ((25.0, 20.0, 19.85, 10.0, 5.0), 79.8, "Neutral"),
        ((2.25, 0.0, 0.0, 0.0, 0.0), 2.2, "Red Alert"),
        ((20.0, 20.0, 0.0, 0.0, 0.0), 40.0, "At Risk"),
        ((None, 20.0, 20.0, 20.0, None), 60.0, "Neutral"),
    ],
)
def test_score_is_rounded_half_even_before_the_tier(spark, parts, score, tier):
    schema = ", ".join(f"{c} DOUBLE" for c in scoring.COMPONENTS) + ", churned BOOLEAN"
    got = one(scoring.health_score(spark.createDataFrame([(*parts, False)], schema)))
    assert (got.health_score, got.health_tier) == (score, tier)
    gone = one(scoring.health_score(spark.createDataFrame([(*parts, True)], schema)))
    assert gone.health_tier == "Churned"


@pytest.mark.parametrize(
    "trend,days,expected",
    [(1.2, 30, (20, 15)), (0.8, 31, (10, 10)), (0.79, 60, (0, 10)), (0.0, 61, (0, 5)), (9.0, 90, (20, 5)),
     (1.19, 91, (10, 0)), (1.0, 999, (10, 0)), (1.0, -5, (10, 15))],
)
def test_trend_and_touch_steps(spark, trend, days, expected):
    base = spark.createDataFrame(
        [(2.0, 10, 10, 0.9, trend, days)],
        "active_user_pct DOUBLE, total_events_30d BIGINT, total_events_90d BIGINT, hv_share_30d DOUBLE, "
        "usage_trend_ratio DOUBLE, days_since_cs_touch INT",
    )
    got = one(scoring.health_components(base))
    assert (got.score_trend, got.score_cs_touch) == expected
    assert (got.score_active_users, got.score_event_volume, got.score_hv_share) == (25.0, 20.0, 20.0)


def test_null_plan_can_be_an_expansion_candidate(spark):
    rows = [(None, "Healthy", False, 4, False), ("enterprise", "Healthy", True, 9, False),
            ("starter", "Neutral", True, 0, False), ("starter", "At Risk", True, 9, False),
            ("starter", "Healthy", False, 3, False), ("starter", "Healthy", True, 9, True)]
    df = spark.createDataFrame(
        rows, "plan STRING, health_tier STRING, pp_growing BOOLEAN, active_users BIGINT, churned BOOLEAN"
    )
    got = [r[0] for r in df.select(scoring.expansion_candidate(CFG)).collect()]
    assert got == [True, False, True, False, False, False]


def test_null_role_and_size(spark):
    users = raw(
        spark,
        "users",
        [("1", "t", None, "2024-01-02", "2024-01-01", 1), ("2", "t", " ADMIN ", "bad", "2024-01-01", None),
         ("3", "t", "owner", None, None, 0)],
    )
    got = cleaning.clean_users(users).orderBy("user_id").collect()
    assert [r.role for r in got] == ["member", "admin", "member"]
    assert [r.date_order_suspect for r in got] == [True, False, False]
    assert [r.is_active for r in got] == [True, False, False]
    tenants = raw(spark, "tenants", [("a", "c", " Pro ", "r", "i", None, "m"), ("b", "c", None, "r", "i", "1000+", "m")])
    clean = {r.tenant_id: r for r in cleaning.clean_tenants(tenants).collect()}
    assert (clean["a"].employee_size, clean["a"].employee_size_rank, clean["a"].plan) == (None, None, "pro")
    assert (clean["b"].employee_size_rank, clean["b"].plan) == (4, None)
    report = {(r.table, r.column, r.issue): r.affected_rows for r in quality.dq_report({"tenants": tenants, "users": users}).collect()}
    assert report[("tenants", "employee_size", "unexpected values")] == 1
    assert report[("users", "role", "unexpected role values")] == 2
    assert report[("users", "role", "null values")] == 1


def test_first_listing_of_a_tenant_wins(spark):
    rows = [("t", f"name{i}", "p", "r", "i", size, "m", i) for i, size in enumerate(["unknown", "1-50", "1-50"])]
    tenants = spark.createDataFrame(rows[::-1], RAW_SCHEMAS["tenants"] + ", ingest_seq INT")
    got = one(cleaning.clean_tenants(tenants))
    assert (got.company_name, got.employee_size) == ("name0", None)
    report = {r.column: r.affected_rows for r in quality.dq_rule_checks({"tenants": tenants}).collect()}
    assert report == {"tenant_id": 2, "employee_size": 1}


def test_subscription_repairs_do_not_feed_each_other(spark):
    subs = raw(
        spark,
        "subscriptions",
        [("1", "a", "p", 0.0, "2024-01-01", "2024-09-01", 1, None), ("2", "b", "p", -1.0, None, None, 1, None),
         ("3", "c", "p", None, "x", "2024-09-01", 0, "2024-05-05"), ("4", "d", "p", 5.0, None, None, None, None)],
    )
    got = {r.tenant_id: r for r in cleaning.clean_subscriptions(subs).collect()}
    assert (got["a"].churned, got["a"].churn_date, got["a"].arr_suspect) == (True, date(2024, 9, 1), True)
    assert (got["b"].churned, got["b"].churn_date) == (True, None)
    assert (got["c"].churned, got["c"].churn_date, got["c"].arr_suspect) == (True, date(2024, 5, 5), False)
    assert got["d"].churned is False
    report = {(r.column, r.issue): r.affected_rows for r in quality.dq_rule_checks({"subscriptions": subs}).collect()}
    assert report == {
        ("churn_date", "churned=True but churn_date is NULL"): 2,
        ("churned", "churned=False but churn_date is populated"): 1,
        ("arr", "ARR <= 0"): 2,
    }


def test_event_counts_below_one(spark):
    rows = [("e1", "t", "u", "x", "2024-06-01", 0, None), ("e2", "t", "u", "x", "2024-06-01", -3, "{}"),
            ("e3", "t", "u", "x", "2024-06-01T10:00:00", None, None), ("e4", "t", "u", "x", "nope", 0, None),
            ("e5", "t", "u", "x", None, 1, None)]
    raw_events = raw(spark, "events", rows)
    got = {r.event_id: r for r in cleaning.clean_events(raw_events).collect()}
    assert {k: r.event_count for k, r in got.items()} == {"e1": 1, "e2": 1, "e3": None}
    report = {(r.column, r.issue): r.affected_rows for r in quality.dq_report({"events": raw_events}).collect()}
    assert report[("event_time", "unparseable timestamp")] == 2
    assert report[("event_count", "event_count < 1")] == 2
    assert report[("event_time", "null values")] == 1


def empty_tables(spark, events=None, **rows):
    def load(table):
        if table == "events" and events is not None:
            return events
        return cleaning.CLEANERS[table](raw(spark, table, rows.get(table, [])))

    return marts.CleanTables(load)


def test_tenant_without_subscription(spark):
    mart = marts.mart_tenant_health(empty_tables(spark, tenants=[("t", "c", "p", "r", "i", "1-50", "m")]))
    got = one(mart)
    assert (got.churned, got.arr, got.health_tier, got.cs_blind_spot) == (False, None, "Red Alert", False)
    assert (got.total_users, got.admin_count, got.days_since_cs_touch, got.active_user_pct) == (0, None, 999, 0.0)
    assert marts.mart_renewal_pipeline(mart).count() == 0


def test_overdue_renewals_stay(spark):
    mart = marts.mart_tenant_health(
        empty_tables(
            spark,
            tenants=[(t, "c", "p", "r", "i", "1-50", "m") for t in ("late", "edge", "far", "gone")],
            subscriptions=[
                ("1", "late", "p", 1.0, None, "2024-06-01", 0, None),
                ("2", "edge", "p", 1.0, None, "2024-09-28", 0, None),
                ("3", "far", "p", 1.0, None, "2024-09-29", 0, None),
                ("4", "gone", "p", 1.0, None, "2024-07-01", 1, "2024-06-01"),
            ],
        )
    )
    got = [(r.tenant_id, r.days_to_renewal) for r in marts.by_renewal(marts.mart_renewal_pipeline(mart)).collect()]
    assert got == [("late", -29), ("edge", 90)]
    assert marts.mart_renewal_pipeline(mart, min_days=0).count() == 1


MART = (
    "tenant_id STRING, acquisition_source STRING, pov_started BOOLEAN, arr DOUBLE, churned BOOLEAN, "
    "health_tier STRING, health_score DOUBLE, region STRING, plan STRING, expansion_candidate BOOLEAN"
)


def test_funnel_with_empty_stages(spark):
    none = spark.createDataFrame([], MART)
    assert [r.conversion_from_prev for r in marts.mart_trial_funnel(none).orderBy("stage_order").collect()] == [1.0] * 5
    paying = spark.createDataFrame([("t", "trial", False, 5.0, False, "Healthy", 90.0, "r", "p", False)], MART)
    rows = marts.mart_trial_funnel(paying).orderBy("stage_order").collect()
    assert [r.tenants for r in rows] == [1, 0, 1, 1, 1]
    assert rows[1].conversion_from_prev == 0.0 and rows[2].conversion_from_prev == math.inf
    assert rows[2].drop_from_prev == -math.inf
    assert one(funnel.funnel_biggest_drop(marts.mart_trial_funnel(paying))).stage == "POV Started"


def test_unknown_source_is_no_channel_but_a_feature(spark):
    mart = spark.createDataFrame(
        [("t", None, None, 5.0, False, "Healthy", 90.0, None, "p", False),
         ("u", "trial", True, None, True, "Churned", 10.0, "EMEA", "p", False)],
        MART,
    ).withColumn("industry", F.lit("x.y z"))
    got = one(marts.mart_channel_performance(mart))
    assert (got.acquisition_source, got.total_tenants, got.total_arr, got.avg_arr) == ("trial", 1, 0.0, None)
    hot = {r.tenant_id: r.asDict() for r in features.one_hot_features(mart).collect()}
    assert (hot["t"]["src_unknown"], hot["t"]["src_trial"], hot["t"]["rgn_unknown"], hot["t"]["ind_x.y z"]) == (1, 0, 1, 1)
    assert (hot["u"]["src_unknown"], hot["u"]["src_trial"]) == (0, 1)


def test_ranking_metrics_with_ties(spark):
    df = spark.createDataFrame([(1, 0.9, 1.0), (0, 0.8, 2.0), (1, 0.8, 4.0), (0, 0.1, 8.0)], "label INT, score DOUBLE, arr DOUBLE")
    assert one(metrics.roc_auc(df)).roc_auc == pytest.approx(0.875)
    assert one(metrics.average_precision(df)).average_precision == pytest.approx(5 / 6)
    assert tuple(one(metrics.confusion_matrix(df, 0.35))) == (1, 1, 0, 2)
    assert tuple(one(metrics.arr_by_outcome(df, 0.85))) == (1.0, 4.0)
    curve = [(r.threshold, r.fpr, r.tpr) for r in metrics.roc_curve(df).collect()]
    assert curve == [(math.inf, 0.0, 0.0), (0.9, 0.0, 0.5), (0.8, 0.5, 1.0), (0.1, 1.0, 1.0)]


def test_report_of_a_class_that_never_occurs(spark):
    df = spark.createDataFrame([(0, 0.1, 1.0), (0, 0.2, 1.0)], "label INT, score DOUBLE, arr DOUBLE")
    got = {r.name: r for r in metrics.classification_report(df).collect()}
    assert (got["Churned"].precision, got["Churned"].recall, got["Churned"].f1, got["Churned"].support) == (0, 0, 0, 0)
    assert (got["accuracy"].f1, got["macro avg"].f1, got["weighted avg"].f1) == (1.0, 0.5, 1.0)
    assert one(metrics.class_balance(df)).scale_pos_weight is None
    assert one(metrics.roc_auc(df)).roc_auc is None


def test_threshold_is_inclusive_on_the_stored_probability(spark):
    preds = spark.createDataFrame(
        [("a", False, 1.0, 0.35), ("b", False, 1.0, 0.3499), ("c", True, 1.0, 1.0), ("d", False, None, 1.0)],
        "tenant_id STRING, churned BOOLEAN, arr DOUBLE, churn_probability DOUBLE",
    )
    flags = {r.tenant_id: r.churn_flag for r in churn.churn_threshold_flags(preds).collect()}
    assert flags == {"a": 1, "b": 0, "c": 1, "d": 1}
    assert tuple(one(churn.churn_kpis(preds)))[:2] == (2, 1.0)
    bins = {(r.churn_flag, r.bin): r.tenants for r in churn.churn_histogram(preds).collect()}
    assert bins == {(1, 11): 1, (0, 11): 1, (1, 30): 1}


def test_empty_selection_filters_nothing_and_null_never_matches(spark):
    mart = spark.createDataFrame(
        [("a", "starter", "ASIA", "m", "Healthy"), ("b", None, "ASIA", "m", "Churned")],
        "tenant_id STRING, plan STRING, region STRING, csm_assigned STRING, health_tier STRING",
    )
    assert filters.apply_filters(mart).count() == 2
    assert filters.apply_filters(mart, plans=["starter", "business"]).count() == 1
    assert filters.apply_filters(mart, regions=["ASIA"], tiers=["Churned"]).count() == 1
    options = {(r.dimension, r.value) for r in filters.filter_options(mart).collect()}
    assert ("plan", "starter") in options and ("plan", None) not in options and ("tier", "Red Alert") in options
