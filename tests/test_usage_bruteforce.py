"""Window and weekly aggregates against a row-by-row computation, with a hot tenant and a hot user."""

import random
from collections import defaultdict
from datetime import datetime, timedelta

import pytest

from pulsemart import HealthConfig
from pulsemart.config import EXPANSION_EVENTS, HIGH_VALUE_EVENTS, Window
from pulsemart.operators import cleaning, usage
from pulsemart.sources.schemas import RAW_SCHEMAS

NAMES = [*HIGH_VALUE_EVENTS, *EXPANSION_EVENTS, "report_generated"]
SNAPSHOT = datetime(2024, 6, 30)


def make_events(seed, n=3000):
    """A third of the rows belong to one tenant, a third of those to one user; many at midnight."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        hot = rng.random() < 0.34
        tenant = "hot" if hot else rng.choice([f"t{k}" for k in range(25)] + [None])
        user = "hot-user" if hot and rng.random() < 0.34 else rng.choice([f"u{k}" for k in range(40)] + [None])
        when = SNAPSHOT - timedelta(days=rng.randint(-3, 130))
        if rng.random() < 0.6:
            when += timedelta(seconds=rng.randint(1, 86399))
        count = rng.choice([None, 0, 1, 2, 5, 40])
        rows.append((f"e{i}", tenant, user, rng.choice(NAMES), when.isoformat(), count, None))
    return rows


def clean(rows):
    out = []
    for _, tenant, user, name, when, count, _ in rows:
        t = datetime.fromisoformat(when)
        out.append((tenant, user, name, t, 1 if count is not None and count < 1 else count))
    return [r for r in out if r[0] is not None]


def window(rows, w):
    lo, hi = SNAPSHOT - timedelta(days=w.start_days), SNAPSHOT - timedelta(days=w.end_days)
    groups = defaultdict(list)
    for r in rows:
        if lo <= r[3] <= hi:
            groups[r[0]].append(r)
    return {
        tenant: (
            sum(r[4] or 0 for r in rs),
            sum(r[4] or 0 for r in rs if r[2] in HIGH_VALUE_EVENTS),
            len({r[3].date() for r in rs}),
            len({r[1] for r in rs if r[1] is not None}),
        )
        for tenant, rs in groups.items()
    }


@pytest.mark.parametrize(
    "cfg",
    [
        HealthConfig(),
        HealthConfig(
            windows=(Window("30d", 7), Window("60d", 20, 3), Window("90d", 124), Window("recent_4w", 62),
                     Window("prior_4w", 125, 61))
        ),
    ],
    ids=["default", "custom windows"],
)
def test_windows(spark, cfg):
    rows = make_events(7)
    events = cleaning.clean_events(spark.createDataFrame(rows, RAW_SCHEMAS["events"]).repartition(6))
    expected = [window(clean(rows), w) for w in cfg.windows]
    tenants = set().union(*expected)

    got = {r.tenant_id: r for r in usage.event_windows(events, cfg).collect()}
    assert set(got) == tenants
    for w, per_tenant in zip(cfg.windows, expected):
        for tenant in tenants:
            r = got[tenant]
            measured = tuple(
                r[f"{m}_{w.suffix}"] for m in ("total_events", "hv_events", "active_days", "active_users")
            )
            assert measured == per_tenant.get(tenant, (0, 0, 0, 0)), (tenant, w)

    metrics = {r.tenant_id: r for r in usage.event_metrics(events, cfg).collect()}
    assert set(metrics) == set(expected[0])
    last = defaultdict(lambda: datetime.min)
    for r in clean(rows):
        last[r[0]] = max(last[r[0]], r[3])
    for tenant, r in metrics.items():
        assert r.last_event_date == last[tenant]
        recent, prior = expected[3].get(tenant, (0,))[0], expected[4].get(tenant, (0,))[0]
        assert r.usage_trend_ratio == pytest.approx(recent / prior if prior else 0.0)


def test_weeks(spark):
    rows = make_events(11)
    events = cleaning.clean_events(spark.createDataFrame(rows, RAW_SCHEMAS["events"]).repartition(6))
    groups = defaultdict(list)
    for r in clean(rows):
        if r[3] >= SNAPSHOT - timedelta(weeks=12):
            groups[r[0], (r[3] - timedelta(days=r[3].weekday())).date()].append(r)
    expected = {
        key: (
            sum(r[4] or 0 for r in rs),
            sum(r[4] or 0 for r in rs if r[2] in HIGH_VALUE_EVENTS),
            len({r[1] for r in rs if r[1] is not None}),
            len({r[3].date() for r in rs}),
        )
        for key, rs in groups.items()
    }
    got = {
        (r.tenant_id, r.week_start): (r.event_count, r.hv_event_count, r.active_users, r.active_days)
        for r in usage.weekly_activity(events).collect()
    }
    assert got == expected


def test_hot_tenant_is_spread_over_its_users(spark):
    """The large shuffle is keyed by tenant and user; only per-task totals go to the tenant."""
    events = cleaning.clean_events(spark.createDataFrame(make_events(3), RAW_SCHEMAS["events"]))
    for df in (usage.event_windows(events), usage.weekly_activity(events)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        exchanges = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]
        assert len(exchanges) == 2
        assert "user_id" in exchanges[1] and "user_id" not in exchanges[0]
        assert plan.count("partial_") > 0 and "Expand" not in plan and "Window" not in plan
