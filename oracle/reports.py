"""Report pages, over the marts; default settings unless the name says otherwise."""

from oracle.marts import rounded, with_mart

TIER_ORDER = (
    "CASE health_tier WHEN 'Healthy' THEN 1 WHEN 'Neutral' THEN 2 WHEN 'At Risk' THEN 3 "
    "WHEN 'Red Alert' THEN 4 WHEN 'Churned' THEN 5 END"
)
DANGER = "health_tier IN ('At Risk', 'Red Alert')"
# Capitals after anything that is no letter.
TITLE = (
    "array_to_string(list_transform(regexp_extract_all(lower(acquisition_source), '\\p{L}+|\\P{L}+'), "
    "lambda p: upper(p[1]) || p[2:]), '')"
)
WHOLE_ARR = "CAST(round_even(arr, 0) AS BIGINT) AS arr"

# Predictions from a score both engines can compute: the lower the health, the higher the risk.
PREDICTIONS = """predictions AS (
  SELECT tenant_id, company_name, plan, arr, churned, renewal_date,
         CAST(coalesce(renewal_date - DATE '2024-06-30', 999) AS INTEGER) AS days_to_renewal,
         health_score, health_tier,
         round_even(1 - health_score / 100.0::DOUBLE, 4) AS churn_probability,
         CAST(1 - health_score / 100.0::DOUBLE >= 0.35::DOUBLE AS INTEGER) AS churn_flag
  FROM mart
),
flagged AS (
  SELECT * REPLACE (CAST(churn_probability >= 0.35::DOUBLE AS INTEGER) AS churn_flag) FROM predictions
)"""


def with_predictions(query: str) -> str:
    """The predictions CTE goes after the marts."""
    return with_mart("").rstrip() + f",\n{PREDICTIONS}\n{query}"


def _active_arr(dimension: str) -> str:
    return with_mart(
        rounded(
            f"SELECT {dimension}, coalesce(sum(arr::DECIMAL(28,6))::DOUBLE, 0) AS arr FROM mart "
            f"WHERE NOT churned AND {dimension} IS NOT NULL GROUP BY 1",
            "arr",
        )
    )


def _bars(metric: str, order: str) -> str:
    return f"row_number() OVER (ORDER BY {metric} {order} NULLS LAST, acquisition_source)"


COMPONENTS = {
    "Active Users (25)": "score_active_users",
    "Event Volume (20)": "score_event_volume",
    "HV Events (20)": "score_hv_share",
    "Usage Trend (20)": "score_trend",
    "CS Touch (15)": "score_cs_touch",
}
LOWEST = "(SELECT * FROM mart WHERE NOT churned ORDER BY health_score, tenant_id LIMIT 20)"

QUERIES = {
    "filter_options": with_mart(
        """SELECT DISTINCT 'plan' AS dimension, plan AS value FROM mart WHERE plan IS NOT NULL
UNION ALL SELECT DISTINCT 'region', region FROM mart WHERE region IS NOT NULL
UNION ALL SELECT DISTINCT 'csm', csm_assigned FROM mart WHERE csm_assigned IS NOT NULL
UNION ALL SELECT 'tier', unnest(['Healthy', 'Neutral', 'At Risk', 'Red Alert', 'Churned'])"""
    ),
    "apply_filters": with_mart(
        """SELECT tenant_id, plan, region, csm_assigned, health_tier FROM mart
WHERE plan IN ('starter', 'business') AND region IN ('ASIA', 'EUROPE')
  AND health_tier IN ('Healthy', 'Neutral', 'At Risk')"""
    ),
    "exec_kpis": with_mart(
        rounded(
            f"""SELECT count(*) FILTER (NOT churned) AS active_tenants,
       coalesce((sum(arr::DECIMAL(28,6)) FILTER (NOT churned))::DOUBLE, 0) AS active_arr,
       count(*) FILTER (churned) / count(*) AS churn_rate,
       coalesce((sum(arr::DECIMAL(28,6)) FILTER ({DANGER}))::DOUBLE, 0) AS arr_at_risk FROM mart""",
            "active_arr",
            "churn_rate",
            "arr_at_risk",
        )
    ),
    "tier_distribution": with_mart(
        rounded(
            f"""SELECT health_tier AS tier, count(*) AS tenants,
       count(*) / (SELECT count(*) FROM mart) AS share, {TIER_ORDER} AS tier_order
FROM mart GROUP BY health_tier""",
            "share",
        )
    ),
    "arr_by_tier": with_mart(
        rounded(
            f"SELECT health_tier, coalesce(sum(arr::DECIMAL(28,6))::DOUBLE, 0) AS arr, {TIER_ORDER} AS tier_order "
            "FROM mart GROUP BY health_tier",
            "arr",
        )
    ),
    "arr_by_plan": _active_arr("plan"),
    "arr_by_region": _active_arr("region"),
    "exec_findings": with_mart(
        rounded(
            f"""SELECT count(*) FILTER (cs_blind_spot) AS blind_spots,
       count(*) FILTER (expansion_candidate) AS expansion_candidates,
       count(*) FILTER (NOT churned AND {DANGER}) AS at_risk_tenants,
       coalesce((sum(arr::DECIMAL(28,6)) FILTER (NOT churned AND {DANGER}))::DOUBLE, 0) AS at_risk_arr FROM mart""",
            "at_risk_arr",
        )
    ),
    "health_score_range": with_mart(
        rounded(
            """SELECT tenant_id, company_name, plan, region, csm_assigned, health_score, arr, health_tier,
       active_users, renewal_date, days_since_cs_touch
FROM mart WHERE NOT churned AND health_score >= 0 AND health_score <= 100""",
            "arr",
            "health_score",
        )
    ),
    "bottom_n_components": with_mart(
        rounded(
            " UNION ALL ".join(
                f"SELECT tenant_id, company_name, health_score, '{label}' AS component, {c} AS score FROM {LOWEST}"
                for label, c in COMPONENTS.items()
            ),
            "health_score",
            "score",
        )
    ),
    "health_scorecard": with_mart(
        f"""SELECT company_name, plan, region, csm_assigned, health_tier,
       round_even(health_score, 1) AS health_score, {WHOLE_ARR},
       round_even(active_user_pct * 100, 1) AS active_user_pct,
       total_events_30d, days_since_cs_touch, renewal_date
FROM mart WHERE NOT churned"""
    ),
    "at_risk_kpis": with_mart(
        rounded(
            f"""SELECT count(*) FILTER (NOT churned AND {DANGER}) AS at_risk_tenants,
       coalesce((sum(arr::DECIMAL(28,6)) FILTER (NOT churned AND {DANGER}))::DOUBLE, 0) AS arr_at_risk,
       (SELECT count(*) FROM renewals) AS renewals FROM mart""",
            "arr_at_risk",
        )
    ),
    "at_risk_list": with_mart(
        f"""SELECT company_name, plan, region, csm_assigned, health_tier,
       round_even(health_score, 1) AS health_score, {WHOLE_ARR}, renewal_date, days_since_cs_touch,
       total_events_30d, round_even(active_user_pct * 100, 1) AS active_user_pct, cs_blind_spot
FROM mart WHERE NOT churned AND {DANGER}"""
    ),
    "renewal_table": with_mart(
        f"""SELECT company_name, plan, csm_assigned, {WHOLE_ARR}, days_to_renewal, renewal_date, health_tier,
       round_even(health_score, 1) AS health_score, total_events_30d, days_since_cs_touch FROM renewals"""
    ),
    "blind_spot_detail": with_mart(
        f"""SELECT company_name, plan, region, {WHOLE_ARR}, churn_date, total_events_30d, total_events_90d
FROM mart WHERE cs_blind_spot"""
    ),
    "blind_spot_arr_lost": with_mart(
        """SELECT count(*) AS blind_spots, CAST(coalesce(sum(round_even(arr, 0)), 0) AS BIGINT) AS arr_lost
FROM mart WHERE cs_blind_spot"""
    ),
    "weekly_totals": with_mart(
        rounded(
            """SELECT week_start, CAST(sum(event_count) AS BIGINT) AS total_events,
       CAST(sum(hv_event_count) AS BIGINT) AS hv_events, CAST(sum(active_users) AS BIGINT) AS active_users,
       count(DISTINCT tenant_id) AS active_tenants,
       CASE WHEN sum(event_count) = 0 THEN NULL ELSE sum(hv_event_count) / sum(event_count) END AS hv_pct
FROM weekly WHERE tenant_id IN (SELECT tenant_id FROM mart) GROUP BY 1""",
            "hv_pct",
        )
    ),
    "weekly_by_plan": with_mart(
        """SELECT week_start, m.plan, CAST(sum(event_count) AS BIGINT) AS event_count
FROM weekly JOIN (SELECT DISTINCT tenant_id, plan FROM mart) m USING (tenant_id)
WHERE m.plan IS NOT NULL GROUP BY 1, 2"""
    ),
    "weekly_by_tier": with_mart(
        """SELECT week_start, CASE WHEN health_tier <> 'Churned' THEN health_tier END AS health_tier,
       CASE health_tier WHEN 'Healthy' THEN 1 WHEN 'Neutral' THEN 2 WHEN 'At Risk' THEN 3
                        WHEN 'Red Alert' THEN 4 END AS tier_order,
       CAST(sum(event_count) AS BIGINT) AS event_count
FROM weekly JOIN (SELECT DISTINCT tenant_id, health_tier FROM mart) m USING (tenant_id)
GROUP BY week_start, m.health_tier"""
    ),
    "declining_tenants": with_mart(
        rounded(
            f"""SELECT company_name, plan, region, csm_assigned, health_tier, health_score, {WHOLE_ARR},
       round_even(usage_trend_ratio, 3) AS usage_trend_ratio, total_events_recent_4w, total_events_prior_4w
FROM mart WHERE NOT churned AND usage_trend_ratio < 0.6::DOUBLE""",
            "health_score",
        )
    ),
    "channel_best": with_mart(
        f"""SELECT
  (SELECT {TITLE} FROM channel ORDER BY pct_healthy DESC, acquisition_source LIMIT 1) AS best_retention_channel,
  (SELECT {TITLE} FROM channel ORDER BY churn_rate, acquisition_source LIMIT 1) AS lowest_churn_channel,
  (SELECT {TITLE} FROM channel ORDER BY avg_arr DESC, acquisition_source LIMIT 1) AS highest_arr_channel"""
    ),
    "channel_rankings": with_mart(
        rounded(
            f"""SELECT acquisition_source, churn_rate, avg_arr, pct_healthy, total_tenants,
       {_bars("churn_rate", "ASC")} AS churn_order, {_bars("avg_arr", "DESC")} AS arr_order,
       {_bars("pct_healthy", "DESC")} AS healthy_order, churn_rate > 0.25::DOUBLE AS high_churn
FROM channel""",
            "churn_rate",
            "avg_arr",
            "pct_healthy",
        )
    ),
    "channel_matrix": with_mart(
        rounded(
            "SELECT acquisition_source, pct_healthy, avg_arr, total_tenants, churn_rate FROM channel",
            "pct_healthy",
            "avg_arr",
            "churn_rate",
        )
    ),
    "channel_recommendation": with_mart(
        rounded(
            f"""(SELECT 'increase' AS recommendation, {TITLE} AS channel, pct_healthy, avg_arr, churn_rate
 FROM channel ORDER BY pct_healthy DESC, acquisition_source LIMIT 1)
UNION ALL
(SELECT 'review', {TITLE}, pct_healthy, avg_arr, churn_rate
 FROM channel ORDER BY churn_rate DESC, acquisition_source LIMIT 1)""",
            "pct_healthy",
            "avg_arr",
            "churn_rate",
        )
    ),
    "channel_detail_table": with_mart(
        """SELECT acquisition_source, total_tenants, churned_tenants,
       CAST(round_even(churn_rate * 100, 1) AS VARCHAR) || '%' AS churn_rate,
       CAST(round_even(avg_arr, 0) AS BIGINT) AS avg_arr, CAST(round_even(total_arr, 0) AS BIGINT) AS total_arr,
       CAST(round_even(pct_healthy * 100, 1) AS VARCHAR) || '%' AS pct_healthy, expansion_candidates
FROM channel"""
    ),
    "funnel_kpis": with_mart(
        rounded(
            """SELECT a.tenants AS trial_accounts, b.tenants AS retained_paying, c.tenants AS healthy_retained,
       b.tenants / greatest(a.tenants, 1) AS retained_share, c.tenants / greatest(a.tenants, 1) AS healthy_share
FROM funnel a JOIN funnel b ON b.stage_order = 4 JOIN funnel c ON c.stage_order = 5
WHERE a.stage_order = 1""",
            "retained_share",
            "healthy_share",
        )
    ),
    "funnel_biggest_drop": with_mart(
        rounded(
            """SELECT stage, drop_from_prev, round_even(drop_from_prev * 100, 1) AS drop_pct
FROM funnel WHERE stage_order > 1 ORDER BY drop_from_prev DESC, stage_order LIMIT 1""",
            "drop_from_prev",
        )
    ),
    "funnel_table": with_mart(
        rounded(
            "SELECT *, round_even(drop_from_prev * 100, 1) AS drop_pct FROM funnel",
            "conversion_from_prev",
            "drop_from_prev",
            "conversion_from_start",
        )
    ),
    "funnel_by_plan": with_mart(
        rounded(
            """SELECT plan, 'retained_rate' AS metric, sum(retained_paid) / greatest(sum(trial_accounts), 1) AS rate
FROM diagnostics GROUP BY plan
UNION ALL
SELECT plan, 'healthy_rate', sum(healthy_retained) / greatest(sum(trial_accounts), 1)
FROM diagnostics GROUP BY plan""",
            "rate",
        )
    ),
    "funnel_by_region": with_mart(
        rounded(
            """SELECT region, CAST(sum(trial_accounts) AS BIGINT) AS trial_accounts,
       CAST(sum(retained_paid) AS BIGINT) AS retained_paid,
       CAST(sum(healthy_retained) AS BIGINT) AS healthy_retained,
       sum(retained_paid) / greatest(sum(trial_accounts), 1) AS retained_rate
FROM diagnostics GROUP BY region""",
            "retained_rate",
        )
    ),
    "scan_optional_parquet": with_predictions(
        rounded("SELECT * FROM predictions", "arr", "health_score", "churn_probability")
    ),
    "churn_threshold_flags": with_predictions(
        rounded("SELECT * FROM flagged", "arr", "health_score", "churn_probability")
    ),
    "churn_kpis": with_predictions(
        rounded(
            """SELECT count(*) FILTER (churn_flag = 1) AS high_risk_tenants,
       coalesce((sum(arr::DECIMAL(28,6)) FILTER (churn_flag = 1))::DOUBLE, 0) AS high_risk_arr,
       avg(churn_probability) AS avg_probability FROM flagged WHERE NOT churned""",
            "high_risk_arr",
            "avg_probability",
        )
    ),
    "churn_histogram": with_predictions(
        rounded(
            """SELECT churn_flag, bin, count(*) AS tenants, (bin - 1) / 30 AS bin_start
FROM (SELECT churn_flag, CAST(least(floor(churn_probability * 30) + 1, 30) AS INTEGER) AS bin
      FROM flagged WHERE NOT churned)
GROUP BY churn_flag, bin""",
            "bin_start",
        )
    ),
    "churn_scatter": with_predictions(
        rounded(
            """SELECT tenant_id, company_name, plan, churn_probability, arr, health_tier
FROM predictions WHERE NOT churned""",
            "churn_probability",
            "arr",
        )
    ),
    "churn_high_risk_table": with_predictions(
        rounded(
            f"""SELECT CASE WHEN f.churned THEN 'Churned' ELSE 'Active' END AS status,
       f.company_name, f.plan, m.region, m.csm_assigned, CAST(round_even(f.arr, 0) AS BIGINT) AS arr,
       CAST(round_even(f.churn_probability * 100, 1) AS VARCHAR) || '%' AS churn_probability,
       f.health_tier, f.health_score, m.days_since_cs_touch, m.usage_trend_ratio
FROM flagged f LEFT JOIN mart m USING (tenant_id) WHERE f.churn_flag = 1""",
            "health_score",
            "usage_trend_ratio",
        )
    ),
    "high_risk_summary": with_predictions(
        rounded(
            """SELECT count(*) FILTER (churn_flag = 1) AS flagged_tenants,
       coalesce((sum(arr::DECIMAL(28,6)) FILTER (churn_flag = 1))::DOUBLE, 0) AS arr_at_risk FROM predictions""",
            "arr_at_risk",
        )
    ),
}
