"""CRM aggregates, blind spots and deduplication on random data with one hot tenant."""

import random
from collections import defaultdict
from datetime import date, timedelta

from pulsemart.operators import cleaning, crm, quality, usage
from pulsemart.sources.schemas import RAW_SCHEMAS

SNAPSHOT = date(2024, 6, 30)


def tenant_of(rng):
    return "hot" if rng.random() < 0.34 else f"t{rng.randint(0, 60)}"


def make_activities(seed, n=2500):
    rng = random.Random(seed)
    return [
        (
            f"a{i}",
            None if rng.random() < 0.02 else tenant_of(rng),
            rng.choice(["Call ", "email"]),
            rng.choice([None, "bad"]) if rng.random() < 0.05 else str(SNAPSHOT - timedelta(days=rng.randint(-5, 400))),
            rng.choice(["negative", " No_Response", "positive", None]),
            rng.randint(-20, 50),
        )
        for i in range(n)
    ]


def parsed(rows):
    return [(t, None if d in (None, "bad") else date.fromisoformat(d), o) for _, t, _, d, o, _ in rows if t]


def test_blind_spots(spark):
    rng = random.Random(2)
    activities = make_activities(1)
    # Sparse ones too, so that some churned tenants have activity only outside the window.
    activities += [(f"s{i}", f"s{i}", "x", str(SNAPSHOT - timedelta(days=rng.randint(0, 200))), "x", 0) for i in range(80)]
    tenants = ["hot", *[f"t{k}" for k in range(61)], *[f"s{i}" for i in range(80)], *[f"none{i}" for i in range(5)]]
    churn = {t: SNAPSHOT - timedelta(days=rng.randint(0, 300)) for t in tenants if rng.random() < 0.8}
    subs = [(t, t, "p", 1.0, None, None, int(t in churn), str(churn[t]) if t in churn else None) for t in tenants]

    days = defaultdict(set)
    for tenant, day, _ in parsed(activities):
        days[tenant].add(day)
    expected = {
        (t, d) for t, d in churn.items()
        if not any(x and d - timedelta(days=60) <= x <= d for x in days.get(t, ()))
    }
    assert 5 < len(expected) < len(churn)
    got = crm.cs_blind_spots(
        cleaning.clean_subscriptions(spark.createDataFrame(subs, RAW_SCHEMAS["subscriptions"])),
        cleaning.clean_crm_activities(spark.createDataFrame(activities, RAW_SCHEMAS["crm_activities"])),
    )
    assert {tuple(r) for r in got.collect()} == expected


def test_crm_metrics(spark):
    activities = make_activities(4)
    groups = defaultdict(list)
    for tenant, day, outcome in parsed(activities):
        groups[tenant].append((day, (outcome or "").strip().lower()))
    clean = cleaning.clean_crm_activities(spark.createDataFrame(activities, RAW_SCHEMAS["crm_activities"]))
    got = {r.tenant_id: r for r in crm.crm_metrics(clean).collect()}
    assert set(got) == set(groups)
    for tenant, rows in groups.items():
        days = [d for d, _ in rows if d]
        recent = [o for d, o in rows if d and d >= SNAPSHOT - timedelta(days=90)]
        r = got[tenant]
        assert r.last_cs_touch_date == (max(days) if days else None)
        assert r.days_since_cs_touch == ((SNAPSHOT - max(days)).days if days else 999)
        assert r.cs_touches_90d == len(recent)
        assert r.negative_outcomes_90d == (recent.count("negative") if recent else None)
        assert r.no_response_90d == (recent.count("no_response") if recent else None)


def test_first_listing_wins_among_many_copies(spark):
    rng = random.Random(6)
    rows = [
        (tenant_of(rng), f"name{i}", rng.choice([None, " Pro", "BASIC"]), "r", "i", rng.choice(["1-50", "odd", None]), "m", i)
        for i in range(1500)
    ]
    first, copies = {}, 0
    for r in rows:
        copies += r[0] in first
        first.setdefault(r[0], r)
    shuffled = spark.createDataFrame(rng.sample(rows, len(rows)), RAW_SCHEMAS["tenants"] + ", ingest_seq INT").repartition(5)
    clean = cleaning.clean_tenants(shuffled)
    assert "Window" not in clean._jdf.queryExecution().executedPlan().toString()
    got = {r.tenant_id: (r.company_name, r.plan, r.employee_size) for r in clean.collect()}
    assert got == {
        t: (r[1], r[2].strip().lower() if r[2] else None, "1-50" if r[5] == "1-50" else None) for t, r in first.items()
    }
    report = {r.column: r.affected_rows for r in quality.dq_rule_checks({"tenants": shuffled}).collect()}
    odd = sum(r[5] != "1-50" for r in first.values())
    assert report == {"tenant_id": copies, "employee_size": odd}


def test_user_metrics(spark):
    rng = random.Random(8)
    rows = [
        (None if rng.random() < 0.05 else f"u{i}", tenant_of(rng), rng.choice(["Admin", "member ", None, "owner"]),
         "2024-01-01", "2024-01-02", rng.choice([0, 1, None]))
        for i in range(800)
    ]
    got = {r.tenant_id: r for r in usage.user_metrics(cleaning.clean_users(spark.createDataFrame(rows, RAW_SCHEMAS["users"]))).collect()}
    for tenant in {r[1] for r in rows}:
        mine = [r for r in rows if r[1] == tenant]
        total, active = sum(r[0] is not None for r in mine), sum(r[5] == 1 for r in mine)
        r = got[tenant]
        assert (r.total_users, r.active_users, r.admin_count) == (total, active, sum(x[2] == "Admin" for x in mine))
        assert r.active_user_pct == active / max(total, 1)


def test_null_counts(spark):
    rng = random.Random(10)
    columns = ["user_id", "tenant_id", "role", "registered_at", "last_seen_at"]
    rows = [tuple(None if rng.random() < 0.1 * k else "x" for k in range(5)) + (1,) for _ in range(400)]
    report = quality.dq_null_summary({"users": spark.createDataFrame(rows, RAW_SCHEMAS["users"])})
    expected = {c: sum(r[i] is None for r in rows) for i, c in enumerate(columns)}
    assert {r.column: r.affected_rows for r in report.collect()} == {c: n for c, n in expected.items() if n}
