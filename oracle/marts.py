"""Metrics, the health mart and the marts derived from it."""

from oracle.tables import CLEAN, DAY, HV, RAW, with_raw

WINDOWS = {"30d": (30, 0), "60d": (60, 0), "90d": (90, 0), "recent_4w": (28, 0), "prior_4w": (56, 28)}


def instant(days: int) -> str:
    return f"CAST({DAY} - {days} AS TIMESTAMP)"


def _window(suffix: str, start: int, end: int) -> str:
    return f"""e_{suffix} AS (
  SELECT tenant_id,
         CAST(coalesce(sum(event_count), 0) AS BIGINT) AS total_events_{suffix},
         CAST(coalesce(sum(event_count) FILTER (is_high_value), 0) AS BIGINT) AS hv_events_{suffix},
         count(DISTINCT event_date) AS active_days_{suffix},
         count(DISTINCT user_id) AS active_users_{suffix}
  FROM clean_events
  WHERE event_time >= {instant(start)} AND event_time <= {instant(end)} AND tenant_id IS NOT NULL
  GROUP BY tenant_id
)"""


WINDOW_COLUMNS = [
    f"{m}_{s}" for s in WINDOWS for m in ("total_events", "hv_events", "active_days", "active_users")
]
ZERO_FILLED = ", ".join(f"coalesce({c}, 0) AS {c}" for c in WINDOW_COLUMNS)

METRICS = f"""
user_metrics AS (
  SELECT tenant_id, count(user_id) AS total_users,
         count(*) FILTER (is_active) AS active_users,
         count(*) FILTER (role = 'admin') AS admin_count,
         count(*) FILTER (is_active) / greatest(count(user_id), 1) AS active_user_pct
  FROM clean_users WHERE tenant_id IS NOT NULL GROUP BY tenant_id
),
{",".join(_window(s, *w) for s, w in WINDOWS.items())},
last_event AS (
  SELECT tenant_id, max(event_time) AS last_event_date
  FROM clean_events WHERE tenant_id IS NOT NULL GROUP BY tenant_id
),
event_metrics AS (
  SELECT *,
         CASE WHEN total_events_prior_4w = 0 THEN 0.0::DOUBLE
              ELSE total_events_recent_4w / total_events_prior_4w END AS usage_trend_ratio,
         CASE WHEN total_events_30d = 0 THEN 0.0::DOUBLE
              ELSE hv_events_30d / total_events_30d END AS hv_share_30d
  FROM (
    SELECT tenant_id, {ZERO_FILLED}, last_event_date
    FROM e_30d
    LEFT JOIN e_60d USING (tenant_id)
    LEFT JOIN e_90d USING (tenant_id)
    LEFT JOIN e_recent_4w USING (tenant_id)
    LEFT JOIN e_prior_4w USING (tenant_id)
    LEFT JOIN last_event USING (tenant_id)
  )
),
crm_recent AS (
  SELECT tenant_id, count(activity_id) AS cs_touches_90d,
         count(*) FILTER (outcome = 'negative') AS negative_outcomes_90d,
         count(*) FILTER (outcome = 'no_response') AS no_response_90d
  FROM clean_crm_activities
  WHERE activity_date >= {DAY} - 90 AND tenant_id IS NOT NULL
  GROUP BY tenant_id
),
crm_last AS (
  SELECT tenant_id, max(activity_date) AS last_cs_touch_date
  FROM clean_crm_activities WHERE tenant_id IS NOT NULL GROUP BY tenant_id
),
crm_metrics AS (
  SELECT l.tenant_id, l.last_cs_touch_date, coalesce(r.cs_touches_90d, 0) AS cs_touches_90d,
         r.negative_outcomes_90d, r.no_response_90d,
         CAST(coalesce({DAY} - l.last_cs_touch_date, 999) AS INTEGER) AS days_since_cs_touch
  FROM crm_last l LEFT JOIN crm_recent r USING (tenant_id)
),
pp_trend AS (
  SELECT tenant_id, coalesce(a.n, 0) AS pp_events_30d, coalesce(b.n, 0) AS pp_events_prior_30d,
         coalesce(a.n, 0) > coalesce(b.n, 0) AS pp_growing
  FROM (
    SELECT tenant_id, CAST(sum(event_count) AS BIGINT) AS n FROM clean_events
    WHERE event_name IN ('pp_sync_completed', 'pp_sync_started') AND event_time >= {instant(30)}
      AND tenant_id IS NOT NULL
    GROUP BY 1
  ) a FULL JOIN (
    SELECT tenant_id, CAST(sum(event_count) AS BIGINT) AS n FROM clean_events
    WHERE event_name IN ('pp_sync_completed', 'pp_sync_started')
      AND event_time >= {instant(60)} AND event_time < {instant(30)} AND tenant_id IS NOT NULL
    GROUP BY 1
  ) b USING (tenant_id)
),
blind AS (
  SELECT s.tenant_id, s.churn_date
  FROM clean_subscriptions s
  WHERE s.churned AND s.churn_date IS NOT NULL AND NOT EXISTS (
    SELECT 1 FROM clean_crm_activities a
    WHERE a.tenant_id = s.tenant_id AND a.activity_date BETWEEN s.churn_date - 60 AND s.churn_date
  )
)"""

BASE_COLUMNS = f"""
t.tenant_id, t.company_name, t.plan, t.region, t.industry, t.employee_size, t.csm_assigned,
s.arr, s.contract_start_date, s.renewal_date, coalesce(s.churned, false) AS churned, s.churn_date,
c.lifecycle_stage, c.acquisition_source, c.pov_started,
coalesce(u.total_users, 0) AS total_users, coalesce(u.active_users, 0) AS active_users,
u.admin_count, coalesce(u.active_user_pct, 0) AS active_user_pct,
{ZERO_FILLED}, e.last_event_date,
coalesce(e.usage_trend_ratio, 0) AS usage_trend_ratio, coalesce(e.hv_share_30d, 0) AS hv_share_30d,
m.last_cs_touch_date, coalesce(m.cs_touches_90d, 0) AS cs_touches_90d,
m.negative_outcomes_90d, m.no_response_90d,
coalesce(m.days_since_cs_touch, 999) AS days_since_cs_touch"""

MART = f"""
base AS (
  SELECT {BASE_COLUMNS}
  FROM clean_tenants t
  LEFT JOIN clean_subscriptions s USING (tenant_id)
  LEFT JOIN clean_crm_companies c USING (tenant_id)
  LEFT JOIN user_metrics u USING (tenant_id)
  LEFT JOIN event_metrics e USING (tenant_id)
  LEFT JOIN crm_metrics m USING (tenant_id)
),
components AS (
  SELECT *,
    least(greatest(active_user_pct, 0.0::DOUBLE), 1.0::DOUBLE) * 25.0::DOUBLE AS score_active_users,
    CASE WHEN total_events_90d = 0 THEN 0.0::DOUBLE
         ELSE least(greatest((total_events_30d / 30) / (total_events_90d / 90), 0.0::DOUBLE), 2.0::DOUBLE)
              / 2.0::DOUBLE * 20.0::DOUBLE END AS score_event_volume,
    least(greatest(hv_share_30d / 0.40::DOUBLE, 0.0::DOUBLE), 1.0::DOUBLE) * 20.0::DOUBLE AS score_hv_share,
    CASE WHEN usage_trend_ratio >= 1.2::DOUBLE THEN 20.0::DOUBLE
         WHEN usage_trend_ratio >= 0.8::DOUBLE THEN 10.0::DOUBLE ELSE 0.0::DOUBLE END AS score_trend,
    CASE WHEN days_since_cs_touch <= 30 THEN 15.0::DOUBLE WHEN days_since_cs_touch <= 60 THEN 10.0::DOUBLE
         WHEN days_since_cs_touch <= 90 THEN 5.0::DOUBLE ELSE 0.0::DOUBLE END AS score_cs_touch
  FROM base
),
scored AS (
  SELECT *, CASE WHEN churned THEN 'Churned' WHEN health_score >= 80 THEN 'Healthy'
                 WHEN health_score >= 60 THEN 'Neutral' WHEN health_score >= 40 THEN 'At Risk'
                 ELSE 'Red Alert' END AS health_tier
  FROM (
    SELECT *, round_even(score_active_users + score_event_volume + score_hv_share
                         + score_trend + score_cs_touch, 1) AS health_score
    FROM components
  )
),
mart AS (
  SELECT s.*, coalesce(p.pp_growing, false) AS pp_growing,
         s.plan IS DISTINCT FROM 'enterprise' AND s.health_tier IN ('Healthy', 'Neutral')
           AND (coalesce(p.pp_growing, false) OR s.active_users >= 4) AND NOT s.churned
           AS expansion_candidate,
         s.tenant_id IN (SELECT tenant_id FROM blind) AS cs_blind_spot
  FROM scored s LEFT JOIN pp_trend p USING (tenant_id)
),
weekly AS (
  SELECT tenant_id, CAST(date_trunc('week', event_time) AS DATE) AS week_start,
         CAST(coalesce(sum(event_count), 0) AS BIGINT) AS event_count,
         CAST(coalesce(sum(event_count) FILTER (is_high_value), 0) AS BIGINT) AS hv_event_count,
         count(DISTINCT user_id) AS active_users,
         count(DISTINCT event_date) AS active_days
  FROM clean_events
  WHERE event_time >= {instant(84)} AND tenant_id IS NOT NULL
  GROUP BY 1, 2
),
channel AS (
  SELECT acquisition_source, count(tenant_id) AS total_tenants,
         count(*) FILTER (churned) AS churned_tenants,
         coalesce(sum(arr::DECIMAL(28,6))::DOUBLE, 0) AS total_arr, sum(arr::DECIMAL(28,6))::DOUBLE / count(arr) AS avg_arr, avg(health_score) AS avg_health_score,
         count(*) FILTER (expansion_candidate) AS expansion_candidates,
         count(*) FILTER (health_tier = 'Healthy') AS healthy_count,
         count(*) FILTER (health_tier = 'At Risk') AS at_risk_count,
         count(*) FILTER (churned) / count(tenant_id) AS churn_rate,
         count(*) FILTER (health_tier = 'Healthy') / count(tenant_id) AS pct_healthy
  FROM mart WHERE acquisition_source IS NOT NULL GROUP BY 1
),
renewals AS (
  SELECT tenant_id, company_name, plan, region, csm_assigned, arr, renewal_date,
         CAST(renewal_date - {DAY} AS INTEGER) AS days_to_renewal, health_score, health_tier,
         total_events_30d, active_user_pct, last_cs_touch_date, days_since_cs_touch, expansion_candidate
  FROM mart WHERE NOT churned AND renewal_date <= {DAY} + 90
),
trial AS (SELECT * FROM mart WHERE acquisition_source = 'trial'),
stages AS (
  SELECT 1 AS stage_order, 'Trial-Sourced Accounts' AS stage, count(*) AS tenants FROM trial
  UNION ALL SELECT 2, 'POV Started', count(*) FROM trial WHERE pov_started
  UNION ALL SELECT 3, 'Converted to Paying (ARR > 0)', count(*) FROM trial WHERE arr > 0
  UNION ALL SELECT 4, 'Retained Paying (Not Churned)', count(*) FROM trial WHERE NOT churned
  UNION ALL SELECT 5, 'Healthy Retained (Healthy/Neutral)', count(*) FROM trial
    WHERE NOT churned AND health_tier IN ('Healthy', 'Neutral')
),
funnel AS (
  SELECT stage_order, stage, tenants, conversion AS conversion_from_prev,
         1 - conversion AS drop_from_prev,
         tenants / greatest(first_value(tenants) OVER (ORDER BY stage_order), 1) AS conversion_from_start
  FROM (
    SELECT *, CASE WHEN stage_order = 1 THEN 1.0::DOUBLE
                   WHEN prev = 0 AND tenants = 0 THEN 1.0::DOUBLE
                   WHEN prev = 0 THEN 'inf'::DOUBLE ELSE tenants / prev END AS conversion
    FROM (SELECT *, lag(tenants) OVER (ORDER BY stage_order) AS prev FROM stages)
  )
),
diagnostics AS (
  SELECT region, plan, count(tenant_id) AS trial_accounts,
         count(*) FILTER (pov_started) AS pov_started,
         count(*) FILTER (NOT churned) AS retained_paid,
         count(*) FILTER (health_tier IN ('Healthy', 'Neutral')) AS healthy_retained,
         avg(health_score) AS avg_health_score, sum(arr::DECIMAL(28,6))::DOUBLE / count(arr) AS avg_arr,
         count(*) FILTER (NOT churned) / greatest(count(tenant_id), 1) AS retained_paid_rate,
         count(*) FILTER (health_tier IN ('Healthy', 'Neutral')) / greatest(count(tenant_id), 1)
           AS healthy_retained_rate
  FROM trial WHERE region IS NOT NULL AND plan IS NOT NULL GROUP BY 1, 2
)"""


def with_metrics(query: str) -> str:
    return f"WITH {RAW},{CLEAN},{METRICS}\n{query}"


def with_mart(query: str) -> str:
    return f"WITH {RAW},{CLEAN},{METRICS},{MART}\n{query}"


def rounded(query: str, *columns: str) -> str:
    """Six decimals: the order of a floating-point sum differs between engines. Money is exact."""
    replaced = ", ".join(f"round({c}, 6) AS {c}" for c in columns if "arr" not in c.split("_"))
    return f"SELECT * REPLACE ({replaced}) FROM ({query})" if replaced else query


SCORES = ["score_active_users", "score_event_volume", "score_hv_share", "score_trend", "score_cs_touch"]
BASE_DOUBLES = ["arr", "active_user_pct", "usage_trend_ratio", "hv_share_30d"]
TENANT = "tenant_id"
EVENT_WINDOW_ROWS = f"""
SELECT tenant_id, {ZERO_FILLED}
FROM e_90d
LEFT JOIN e_60d USING (tenant_id)
LEFT JOIN e_30d USING (tenant_id)
LEFT JOIN e_recent_4w USING (tenant_id)
LEFT JOIN e_prior_4w USING (tenant_id)
"""

QUERIES = {
    "user_metrics": with_metrics(rounded("SELECT * FROM user_metrics", "active_user_pct")),
    "event_windows": with_metrics(EVENT_WINDOW_ROWS),
    "last_event": with_metrics("SELECT * FROM last_event"),
    "event_metrics": with_metrics(rounded("SELECT * FROM event_metrics", "usage_trend_ratio", "hv_share_30d")),
    "crm_metrics": with_metrics("SELECT * FROM crm_metrics"),
    "tenant_base": with_mart(rounded("SELECT * FROM base", *BASE_DOUBLES)),
    "health_components": with_mart(rounded(f"SELECT tenant_id, {', '.join(SCORES)} FROM components", *SCORES)),
    "health_score": with_mart(rounded("SELECT tenant_id, health_score, health_tier FROM scored", "health_score")),
    "pp_trend": with_metrics("SELECT * FROM pp_trend"),
    "expansion_candidates": with_mart(
        "SELECT tenant_id, plan, health_tier, active_users, pp_growing FROM mart WHERE expansion_candidate"
    ),
    "cs_blind_spots": with_metrics("SELECT tenant_id, churn_date FROM blind"),
    "mart_tenant_health": with_mart(rounded("SELECT * FROM mart", *BASE_DOUBLES, *SCORES, "health_score")),
    "mart_weekly_activity": with_mart("SELECT * FROM weekly"),
    "mart_channel_performance": with_mart(
        rounded(
            "SELECT * FROM channel", "total_arr", "avg_arr", "avg_health_score", "churn_rate", "pct_healthy"
        )
    ),
    "mart_renewal_pipeline": with_mart(rounded("SELECT * FROM renewals", "arr", "health_score", "active_user_pct")),
    "mart_trial_funnel": with_mart(
        rounded("SELECT * FROM funnel", "conversion_from_prev", "drop_from_prev", "conversion_from_start")
    ),
    "mart_trial_funnel_diagnostics": with_mart(
        rounded(
            "SELECT * FROM diagnostics",
            "avg_health_score",
            "avg_arr",
            "retained_paid_rate",
            "healthy_retained_rate",
        )
    ),
    "mart_summary": with_mart(
        rounded(
            """SELECT count(*) AS total_tenants, count(*) FILTER (churned) AS churned_tenants,
       count(*) FILTER (churned) / count(*) AS churn_rate,
       coalesce((sum(arr::DECIMAL(28,6)) FILTER (NOT churned))::DOUBLE, 0) AS active_arr,
       count(*) FILTER (health_tier = 'Healthy') AS tier_healthy,
       count(*) FILTER (health_tier = 'Neutral') AS tier_neutral,
       count(*) FILTER (health_tier = 'At Risk') AS tier_at_risk,
       count(*) FILTER (health_tier = 'Red Alert') AS tier_red_alert,
       count(*) FILTER (health_tier = 'Churned') AS tier_churned,
       count(*) FILTER (expansion_candidate) AS expansion_candidates,
       count(*) FILTER (cs_blind_spot) AS cs_blind_spots,
       avg(health_score) FILTER (NOT churned) AS avg_active_health_score,
       (SELECT stage FROM funnel WHERE stage_order > 1 ORDER BY drop_from_prev DESC, stage_order LIMIT 1)
         AS biggest_drop_stage,
       (SELECT max(drop_from_prev) FROM funnel WHERE stage_order > 1) AS biggest_drop
FROM mart""",
            "churn_rate",
            "active_arr",
            "avg_active_health_score",
            "biggest_drop",
        )
    ),
    "sql_tenant_health_summary": with_raw(
        rounded(
            f"""SELECT t.tenant_id, t.company_name, t.plan, t.region, s.arr, s.churned, s.renewal_date,
       coalesce(um.total_users, 0) AS total_users, coalesce(um.active_users, 0) AS active_users,
       CASE WHEN um.total_users > 0 THEN um.active_users / um.total_users ELSE 0.0::DOUBLE END
         AS active_user_pct,
       coalesce(e.total_events_30d, 0) AS total_events_30d, coalesce(e.hv_events_30d, 0) AS hv_events_30d,
       l.last_cs_touch_date,
       CAST(coalesce({DAY} - try_cast(l.last_cs_touch_date AS DATE), 999) AS INTEGER) AS days_since_cs_touch,
       cc.acquisition_source, cc.lifecycle_stage
FROM raw_tenants t
LEFT JOIN raw_subscriptions s ON s.tenant_id = t.tenant_id
LEFT JOIN raw_crm_companies cc ON cc.tenant_id = t.tenant_id
LEFT JOIN (SELECT tenant_id, count(*) AS total_users, count(*) FILTER (is_active = 1) AS active_users
           FROM raw_users GROUP BY 1) um ON um.tenant_id = t.tenant_id
LEFT JOIN (SELECT tenant_id, CAST(sum(event_count) AS BIGINT) AS total_events_30d,
                  CAST(coalesce(sum(event_count) FILTER (event_name IN {HV}), 0) AS BIGINT) AS hv_events_30d
           FROM raw_events
           WHERE try_cast(event_time AS TIMESTAMP)::DATE >= {DAY} - 30
             AND try_cast(event_time AS TIMESTAMP)::DATE <= {DAY}
           GROUP BY 1) e ON e.tenant_id = t.tenant_id
LEFT JOIN (SELECT tenant_id, max(activity_date) AS last_cs_touch_date
           FROM raw_crm_activities GROUP BY 1) l ON l.tenant_id = t.tenant_id""",
            "arr",
            "active_user_pct",
        )
    ),
    "sql_channel_performance": with_raw(
        """SELECT cc.acquisition_source, count(*) AS total_tenants,
       CAST(sum(CASE WHEN s.churned = 1 THEN 1 ELSE 0 END) AS BIGINT) AS churned_tenants,
       round(sum(CASE WHEN s.churned = 1 THEN 1 ELSE 0 END) / count(*), 4) AS churn_rate,
       round(sum(s.arr::DECIMAL(28,6))::DOUBLE / count(s.arr), 2) AS avg_arr, round(sum(s.arr::DECIMAL(28,6))::DOUBLE, 2) AS total_arr,
       CAST(sum(CASE WHEN cc.lifecycle_stage = 'active' AND s.churned = 0 THEN 1 ELSE 0 END) AS BIGINT)
         AS active_healthy_count
FROM raw_tenants t
LEFT JOIN raw_subscriptions s ON s.tenant_id = t.tenant_id
LEFT JOIN raw_crm_companies cc ON cc.tenant_id = t.tenant_id
WHERE cc.acquisition_source IS NOT NULL
GROUP BY 1"""
    ),
    "sql_weekly_usage_trends": with_raw(
        f"""SELECT tenant_id, strftime(d, '%Y-%W') AS week_key, CAST(sum(event_count) AS BIGINT) AS event_count,
       count(DISTINCT d) AS active_days, count(DISTINCT user_id) AS active_users
FROM (SELECT *, try_cast(event_time AS TIMESTAMP)::DATE AS d FROM raw_events)
WHERE d >= {DAY} - 84 AND d <= {DAY}
GROUP BY 1, 2"""
    ),
    "sql_at_risk_tenants": with_raw(
        f"""SELECT t.tenant_id, t.company_name, t.plan, t.region, t.csm_assigned, s.arr, s.renewal_date, s.churned,
       coalesce(e.n, 0) AS total_events_30d, CAST({DAY} - lc.d AS INTEGER) AS days_since_cs_touch,
       CASE WHEN s.churned = 1 THEN 'Churned'
            WHEN coalesce(e.n, 0) < 10 AND coalesce({DAY} - lc.d, 999) > 60
              THEN 'At Risk (low usage + no CS touch)'
            WHEN coalesce(e.n, 0) < 10 THEN 'At Risk (low usage)'
            WHEN lc.d IS NULL OR {DAY} - lc.d > 90 THEN 'At Risk (no CS touch 90+ days)'
            ELSE 'Monitor' END AS risk_signal
FROM raw_tenants t
JOIN raw_subscriptions s ON s.tenant_id = t.tenant_id
LEFT JOIN (SELECT tenant_id, CAST(sum(event_count) AS BIGINT) AS n FROM raw_events
           WHERE try_cast(event_time AS TIMESTAMP)::DATE >= {DAY} - 30 GROUP BY 1) e
  ON e.tenant_id = t.tenant_id
LEFT JOIN (SELECT tenant_id, max(activity_date)::DATE AS d FROM raw_crm_activities GROUP BY 1) lc
  ON lc.tenant_id = t.tenant_id
WHERE s.churned = 1 OR coalesce(e.n, 0) < 10 OR lc.d IS NULL OR {DAY} - lc.d > 60"""
    ),
}

QUERIES["pipeline_summary"] = QUERIES["mart_summary"]
