"""Ad-hoc SQL over the raw tables: text dates, categories as typed, duplicates included.

Table names in braces are filled with the DataFrames passed to ``spark.sql``; the
snapshot is a named parameter.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from pulsemart.config import HealthConfig

TENANT_HEALTH = """
WITH adoption AS (
  SELECT tenant_id,
         count(*) AS n_users,
         count_if(is_active = 1) AS n_active
  FROM {users}
  GROUP BY tenant_id
), month_events AS (
  SELECT tenant_id,
         sum(event_count) AS n_events,
         sum(CASE WHEN array_contains(:high_value, event_name) THEN event_count ELSE 0 END) AS n_hv
  FROM {events}
  WHERE try_cast(event_time AS DATE) BETWEEN date_sub(:snapshot, 30) AND :snapshot
  GROUP BY tenant_id
), touch AS (
  SELECT tenant_id, max(activity_date) AS touched_on
  FROM {crm_activities}
  GROUP BY tenant_id
)
SELECT t.tenant_id, t.company_name, t.plan, t.region,
       s.arr, s.churned, s.renewal_date,
       coalesce(a.n_users, 0) AS total_users,
       coalesce(a.n_active, 0) AS active_users,
       coalesce(try_divide(a.n_active, a.n_users), 0D) AS active_user_pct,
       coalesce(m.n_events, 0) AS total_events_30d,
       coalesce(m.n_hv, 0) AS hv_events_30d,
       x.touched_on AS last_cs_touch_date,
       coalesce(datediff(:snapshot, try_cast(x.touched_on AS DATE)), :never) AS days_since_cs_touch,
       c.acquisition_source, c.lifecycle_stage
FROM {tenants} t
LEFT JOIN {subscriptions} s USING (tenant_id)
LEFT JOIN {crm_companies} c USING (tenant_id)
LEFT JOIN adoption a USING (tenant_id)
LEFT JOIN month_events m USING (tenant_id)
LEFT JOIN touch x USING (tenant_id)
ORDER BY coalesce(s.arr, 0) DESC, t.tenant_id
"""

CHANNELS = """
SELECT c.acquisition_source,
       count(*) AS total_tenants,
       count_if(s.churned = 1) AS churned_tenants,
       round(count_if(s.churned = 1) / count(*), 4) AS churn_rate,
       round(cast(sum(cast(s.arr AS DECIMAL(28, 6))) AS DOUBLE) / nullif(count(s.arr), 0), 2) AS avg_arr,
       round(cast(sum(cast(s.arr AS DECIMAL(28, 6))) AS DOUBLE), 2) AS total_arr,
       count_if(c.lifecycle_stage = 'active' AND s.churned = 0) AS active_healthy_count
FROM {tenants} t
JOIN {crm_companies} c ON c.tenant_id = t.tenant_id AND c.acquisition_source IS NOT NULL
LEFT JOIN {subscriptions} s ON s.tenant_id = t.tenant_id
GROUP BY c.acquisition_source
ORDER BY churn_rate, avg_arr DESC
"""

# Days are kept as bits of the week (bit = weekday), so one distinct count is left.
WEEKS = """
WITH daily AS (
  SELECT tenant_id, user_id, event_count, try_cast(event_time AS DATE) AS day
  FROM {events}
  WHERE try_cast(event_time AS DATE) BETWEEN date_sub(:snapshot, 84) AND :snapshot
), per_user AS (
  SELECT tenant_id, user_id,
         concat(year(day), '-',
                lpad(cast(floor((dayofyear(day) + 6 - weekday(day)) / 7) AS INT), 2, '0')) AS week_key,
         sum(event_count) AS n,
         bit_or(shiftleft(1, weekday(day))) AS days
  FROM daily
  GROUP BY ALL
)
SELECT tenant_id, week_key,
       sum(n) AS event_count,
       cast(bit_count(bit_or(days)) AS BIGINT) AS active_days,
       count(user_id) AS active_users
FROM per_user
GROUP BY tenant_id, week_key
ORDER BY tenant_id, week_key
"""

# The labels are fixed values of the result.
AT_RISK = """
WITH month_events AS (
  SELECT tenant_id, sum(event_count) AS n_events
  FROM {events}
  WHERE try_cast(event_time AS DATE) >= date_sub(:snapshot, 30)
  GROUP BY tenant_id
), touch AS (
  SELECT tenant_id,
         max(activity_date) AS touched_on,
         datediff(:snapshot, try_cast(max(activity_date) AS DATE)) AS days_ago
  FROM {crm_activities}
  GROUP BY tenant_id
), facts AS (
  SELECT t.tenant_id, t.company_name, t.plan, t.region, t.csm_assigned,
         s.arr, s.renewal_date, s.churned,
         coalesce(m.n_events, 0) AS total_events_30d,
         x.days_ago AS days_since_cs_touch,
         x.touched_on IS NULL AS untouched
  FROM {tenants} t
  JOIN {subscriptions} s USING (tenant_id)
  LEFT JOIN month_events m USING (tenant_id)
  LEFT JOIN touch x USING (tenant_id)
)
SELECT tenant_id, company_name, plan, region, csm_assigned, arr, renewal_date, churned,
       total_events_30d, days_since_cs_touch,
       CASE
         WHEN churned = 1 THEN 'Churned'
         WHEN total_events_30d < 10 AND coalesce(days_since_cs_touch, :never) > 60
           THEN 'At Risk (low usage + no CS touch)'
         WHEN total_events_30d < 10 THEN 'At Risk (low usage)'
         WHEN untouched OR days_since_cs_touch > 90 THEN 'At Risk (no CS touch 90+ days)'
         ELSE 'Monitor'
       END AS risk_signal
FROM facts
WHERE churned = 1 OR total_events_30d < 10 OR untouched OR days_since_cs_touch > 60
ORDER BY churned DESC, arr DESC, tenant_id
"""


def _run(spark: SparkSession, text: str, raw: Mapping[str, DataFrame], tables: list[str], args: dict) -> DataFrame:
    return spark.sql(text, args=args, **{t: raw[t] for t in tables})


def sql_tenant_health_summary(
    spark: SparkSession, raw: Mapping[str, DataFrame], cfg: HealthConfig = HealthConfig()
) -> DataFrame:
    tables = ["tenants", "subscriptions", "users", "events", "crm_companies", "crm_activities"]
    args = {
        "snapshot": cfg.snapshot,
        "never": cfg.never_touched_days,
        "high_value": list(cfg.high_value_events),
    }
    return _run(spark, TENANT_HEALTH, raw, tables, args)


def sql_channel_performance(spark: SparkSession, raw: Mapping[str, DataFrame]) -> DataFrame:
    return _run(spark, CHANNELS, raw, ["tenants", "subscriptions", "crm_companies"], {})


def sql_weekly_usage_trends(
    spark: SparkSession, raw: Mapping[str, DataFrame], cfg: HealthConfig = HealthConfig()
) -> DataFrame:
    return _run(spark, WEEKS, raw, ["events"], {"snapshot": cfg.snapshot})


def sql_at_risk_tenants(
    spark: SparkSession, raw: Mapping[str, DataFrame], cfg: HealthConfig = HealthConfig()
) -> DataFrame:
    tables = ["tenants", "subscriptions", "events", "crm_activities"]
    return _run(spark, AT_RISK, raw, tables, {"snapshot": cfg.snapshot, "never": cfg.never_touched_days})
