"""Report pages behind filters, and the two independent routes to tenant health."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from pulsemart.plans.reports import executive, filters, health, renewals, trends
from pulsemart.session import cut_lineage
from tests.compare import connect, duck_rows, spark_rows

SELECTED = {"plans": ["starter", "enterprise"], "regions": ["ASIA", "AFRICA", "EUROPE"], "tiers": ["At Risk", "Red Alert", "Churned", "Neutral"]}
CONDITION = (
    "plan IN ('starter', 'enterprise') AND region IN ('ASIA', 'AFRICA', 'EUROPE') "
    "AND health_tier IN ('At Risk', 'Red Alert', 'Churned', 'Neutral')"
)
PAGES = {
    "exec_kpis": lambda x, m: executive.exec_kpis(m),
    "tier_distribution": lambda x, m: executive.tier_distribution(m),
    "arr_by_tier": lambda x, m: executive.arr_by_tier(m),
    "arr_by_plan": lambda x, m: executive.arr_by_plan(m),
    "arr_by_region": lambda x, m: executive.arr_by_region(m),
    "exec_findings": lambda x, m: executive.exec_findings(m),
    "health_score_range": lambda x, m: health.health_score_range(m),
    "bottom_n_components": lambda x, m: health.bottom_n_components(m),
    "health_scorecard": lambda x, m: health.health_scorecard(m),
    "at_risk_kpis": lambda x, m: renewals.at_risk_kpis(m, x.renewals),
    "at_risk_list": lambda x, m: renewals.at_risk_list(m),
    "blind_spot_detail": lambda x, m: renewals.blind_spot_detail(m),
    "blind_spot_arr_lost": lambda x, m: renewals.blind_spot_arr_lost(m),
    "weekly_totals": lambda x, m: trends.weekly_totals(x.weekly, m),
    "weekly_by_plan": lambda x, m: trends.weekly_by_plan(x.weekly, m),
    "weekly_by_tier": lambda x, m: trends.weekly_by_tier(x.weekly, m),
    "declining_tenants": lambda x, m: trends.declining_tenants(m),
}


@pytest.fixture(scope="module")
def inputs(spark, sf_dir):
    x = entry.Inputs(spark, sf_dir)
    x.__dict__["mart"] = cut_lineage(x.mart)
    x.__dict__["weekly"] = cut_lineage(x.weekly)
    return x


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


def filtered_sql(name):
    """The page's SQL with the final part reading the filtered mart; CTEs stay as they are."""
    text = entry.oracle_sql()[name]
    split = text.index("FROM trial WHERE region IS NOT NULL")
    head, page = text[:split], text[split:]
    return head + page.replace("FROM mart", f"FROM (SELECT * FROM mart WHERE {CONDITION})")


@pytest.mark.parametrize("name", sorted(PAGES))
def test_filtered_page(inputs, con, name):
    mart = filters.apply_filters(inputs.mart, **SELECTED)
    got = spark_rows(entry._stable(PAGES[name](inputs, mart)))
    assert got == duck_rows(con, filtered_sql(name))
    assert got[1] and got != spark_rows(entry._stable(PAGES[name](inputs, inputs.mart)))


def test_score_range_and_bottom_n_parameters(inputs):
    within = health.health_score_range(inputs.mart, 40, 60).select("health_score").toPandas().health_score
    assert len(within) and within.between(40, 60).all()
    few = health.bottom_n_components(inputs.mart, n=3, low=50)
    assert few.count() == 15 and few.agg(F.min("health_score")).first()[0] >= 50


def test_mart_and_sql_script_agree(inputs, spark, sf_dir):
    """They may differ only where their windows do; the mapped events avoid those instants."""
    sql = entry.queries()["sql_tenant_health_summary"](spark, sf_dir).dropDuplicates(["tenant_id"])
    columns = ["total_users", "active_users", "active_user_pct", "total_events_30d", "hv_events_30d", "days_since_cs_touch"]
    pair = inputs.mart.alias("m").join(sql.alias("s"), "tenant_id")
    assert pair.count() == inputs.mart.count()
    for c in columns:
        if "events" in c:
            continue
        assert pair.where(F.abs(F.col(f"m.{c}") - F.col(f"s.{c}")) > 1e-6).count() == 0, c
    # The script keeps counts of 0 that cleaning raises to 1, so its sums are never larger.
    for c in ("total_events_30d", "hv_events_30d"):
        assert pair.where(F.col(f"m.{c}") < F.col(f"s.{c}")).count() == 0, c
