"""Features and evaluation. Metrics use score = 1 - health_score / 100, label = churned."""

from oracle.marts import rounded, with_mart

# Categories of the mapped data; the one-hot columns of the expected result.
SOURCES = ["inbound", "outbound", "partner", "referral", "trial", "unknown"]
REGIONS = ["AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST"]
INDUSTRIES = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY", "unknown"]

FEATURES = """feats AS (
  SELECT * REPLACE (CAST(coalesce(pov_started, false) AS INTEGER) AS pov_started),
         CAST(coalesce(renewal_date - DATE '2024-06-30', 999) AS INTEGER) AS days_to_renewal,
         coalesce((DATE '2024-06-30' - contract_start_date) / 30, 0) AS contract_age_months,
         CASE plan WHEN 'business' THEN 1 WHEN 'enterprise' THEN 2 ELSE 0 END AS plan_encoded,
         CASE employee_size WHEN '51-200' THEN 1 WHEN '201-1000' THEN 2 WHEN '1000+' THEN 3 ELSE 0 END
           AS employee_size_encoded,
         CASE lifecycle_stage WHEN 'onboarding' THEN 0 WHEN 'at-risk' THEN 2 WHEN 'churned' THEN 3
              ELSE 1 END AS lifecycle_encoded
  FROM mart
)"""


def _dummies(column: str, prefix: str, values: list[str]) -> list[str]:
    return [
        f"CAST(coalesce({column}, 'unknown') = '{v}' AS INTEGER) AS \"{prefix}_{v}\"" for v in values
    ]


ONE_HOT = ", ".join(
    _dummies("acquisition_source", "src", SOURCES)
    + _dummies("region", "rgn", REGIONS)
    + _dummies("industry", "ind", INDUSTRIES)
)

BASE = """arr days_to_renewal contract_age_months plan_encoded employee_size_encoded pov_started
days_since_cs_touch cs_touches_90d total_events_30d total_events_60d total_events_90d hv_events_30d
hv_share_30d active_days_30d active_users_30d usage_trend_ratio total_events_recent_4w
total_events_prior_4w total_users active_users active_user_pct score_active_users score_event_volume
score_hv_share score_trend score_cs_touch""".split()
DUMMY_NAMES = (
    [f"src_{v}" for v in SOURCES] + [f"rgn_{v}" for v in REGIONS] + [f"ind_{v}" for v in INDUSTRIES]
)
LONG = " UNION ALL ".join(
    f"SELECT tenant_id, '{name}' AS feature, coalesce(CAST(\"{name}\" AS DOUBLE), 0) AS value FROM wide"
    for name in BASE + DUMMY_NAMES
)

SCORED = """eval AS (
  SELECT CAST(churned AS INTEGER) AS label, 1 - health_score / 100.0::DOUBLE AS score, arr FROM mart
),
marked AS (SELECT *, CAST(score >= 0.35::DOUBLE AS INTEGER) AS flag FROM eval),
cells AS (
  SELECT count(*) FILTER (flag = 0 AND label = 0) AS tn, count(*) FILTER (flag = 1 AND label = 0) AS fp,
         count(*) FILTER (flag = 0 AND label = 1) AS fn, count(*) FILTER (flag = 1 AND label = 1) AS tp
  FROM marked
),
points AS (
  SELECT DISTINCT score,
         sum(label) OVER w AS tp, count(*) OVER w - sum(label) OVER w AS fp,
         (SELECT sum(label) FROM eval) AS p, (SELECT count(*) - sum(label) FROM eval) AS n
  FROM eval
  WINDOW w AS (ORDER BY score DESC RANGE UNBOUNDED PRECEDING)
),
roc AS (
  SELECT score AS threshold, fp / n AS fpr, tp / p AS tpr FROM points
  UNION ALL SELECT 'inf'::DOUBLE, 0.0::DOUBLE, 0.0::DOUBLE
),
pr AS (
  SELECT score AS threshold, tp / (tp + fp) AS precision, tp / p AS recall FROM points
  UNION ALL SELECT 'inf'::DOUBLE, 1.0::DOUBLE, 0.0::DOUBLE
)"""


def with_features(query: str) -> str:
    return with_mart("").rstrip() + f",\n{FEATURES}\n{query}"


def with_eval(query: str) -> str:
    return with_mart("").rstrip() + f",\n{SCORED}\n{query}"


REPORT = """SELECT 'Active' AS name, p0 AS precision, r0 AS recall, f0 AS f1, s0 AS support FROM m
UNION ALL SELECT 'Churned', p1, r1, f1, s1 FROM m
UNION ALL SELECT 'accuracy', NULL, NULL, (tn + tp) / (s0 + s1), s0 + s1 FROM m
UNION ALL SELECT 'macro avg', (p0 + p1) / 2, (r0 + r1) / 2, (f0 + f1) / 2, s0 + s1 FROM m
UNION ALL SELECT 'weighted avg', (p0 * s0 + p1 * s1) / (s0 + s1), (r0 * s0 + r1 * s1) / (s0 + s1),
       (f0 * s0 + f1 * s1) / (s0 + s1), s0 + s1 FROM m"""
PER_CLASS = """m AS (
  SELECT *, coalesce(2 * p0 * r0 / nullif(p0 + r0, 0), 0) AS f0,
            coalesce(2 * p1 * r1 / nullif(p1 + r1, 0), 0) AS f1
  FROM (
    SELECT *, tn + fp AS s0, tp + fn AS s1,
           coalesce(tn / nullif(tn + fn, 0), 0) AS p0, coalesce(tn / nullif(tn + fp, 0), 0) AS r0,
           coalesce(tp / nullif(tp + fp, 0), 0) AS p1, coalesce(tp / nullif(tp + fn, 0), 0) AS r1
    FROM cells
  )
)"""

QUERIES = {
    "churn_features": with_features(
        rounded(
            """SELECT tenant_id, days_to_renewal, contract_age_months, plan_encoded, employee_size_encoded,
       lifecycle_encoded, pov_started FROM feats""",
            "contract_age_months",
        )
    ),
    "one_hot_features": with_features(f"SELECT tenant_id, {ONE_HOT} FROM feats"),
    "feature_selection": with_features(
        rounded(f"SELECT * FROM (WITH wide AS (SELECT *, {ONE_HOT} FROM feats) {LONG})", "value")
    ),
    "class_balance": with_eval(
        rounded(
            """SELECT count(*) AS n, count(*) FILTER (label = 1) AS positives, avg(label) AS churn_rate,
       count(*) FILTER (label = 0) / count(*) FILTER (label = 1) AS scale_pos_weight FROM eval""",
            "churn_rate",
            "scale_pos_weight",
        )
    ),
    "stratified_folds": with_eval(
        """SELECT label, CAST(f.fold AS INTEGER) AS fold,
       count(*) // 5 + CASE WHEN f.fold < count(*) % 5 THEN 1 ELSE 0 END AS tenants
FROM eval, (SELECT unnest(range(5)) AS fold) f GROUP BY label, f.fold"""
    ),
    "confusion_matrix": with_eval("SELECT tn, fp, fn, tp FROM cells"),
    "arr_by_outcome": with_eval(
        rounded(
            """SELECT coalesce((sum(arr::DECIMAL(28,6)) FILTER (flag = 1 AND label = 1))::DOUBLE, 0) AS arr_correctly_flagged,
       coalesce((sum(arr::DECIMAL(28,6)) FILTER (flag = 0 AND label = 1))::DOUBLE, 0) AS arr_missed FROM marked""",
            "arr_correctly_flagged",
            "arr_missed",
        )
    ),
    "classification_report": with_eval("").rstrip() + f",\n{PER_CLASS}\n" + rounded(
        REPORT, "precision", "recall", "f1"
    ),
    "roc_curve": with_eval(rounded("SELECT * FROM roc", "threshold", "fpr", "tpr")),
    "roc_auc": with_eval(
        rounded(
            """SELECT sum((fpr - x) * (tpr + y) / 2) AS roc_auc FROM (
  SELECT fpr, tpr, lag(fpr) OVER w AS x, lag(tpr) OVER w AS y FROM roc WINDOW w AS (ORDER BY threshold DESC)
)""",
            "roc_auc",
        )
    ),
    "pr_curve": with_eval(rounded("SELECT * FROM pr", "threshold", "precision", "recall")),
    "average_precision": with_eval(
        rounded(
            """SELECT sum((recall - r) * precision) AS average_precision FROM (
  SELECT recall, precision, lag(recall) OVER (ORDER BY threshold DESC) AS r FROM pr
)""",
            "average_precision",
        )
    ),
}

# Outputs of the trained model: which rows and columns they have and what must hold for any learner.
CARRIED = rounded(
    """SELECT tenant_id, company_name, plan, arr, churned, renewal_date,
       CAST(coalesce(renewal_date - DATE '2024-06-30', 999) AS INTEGER) AS days_to_renewal, health_score, health_tier,
       true AS in_range, true AS flag_agrees FROM mart""",
    "health_score",
)
NAMES = " UNION ".join(
    [f"SELECT '{name}' AS feature" for name in BASE]
    + [f"SELECT '{p}_' || coalesce({c}, 'unknown') FROM mart" for p, c in
       (("src", "acquisition_source"), ("rgn", "region"), ("ind", "industry"))]
)
QUERIES |= {
    "churn_predictions": with_mart(CARRIED),
    "model_store": with_mart(CARRIED),
    "feature_importance": with_mart(f"SELECT feature, true AS in_range, 1.0::DOUBLE AS total FROM ({NAMES})"),
    "feature_importance_topn": with_mart(
        f"SELECT CAST(row_number() OVER (ORDER BY feature) AS INTEGER) AS place, true AS falls FROM ({NAMES}) LIMIT 15"
    ),
    "train_churn_model": with_mart(
        f"SELECT 300 AS trees, CAST(count(*) AS INTEGER) AS features, true AS grown FROM ({NAMES})"
    ),
    "cross_validate_churn": """SELECT unnest(['cv_roc_auc_mean', 'cv_roc_auc_std', 'cv_avg_precision_mean',
       'cv_avg_precision_std']) AS figure, true AS in_range""",
    "leakage_check": "SELECT true AS leak_shows, true AS in_range",
    "model_metrics": with_mart(
        """SELECT 'GBTClassifier' AS model, 0.35::DOUBLE AS decision_threshold,
       count(*) FILTER (churned) AS churned, count(*) FILTER (NOT churned) AS active,
       coalesce((sum(arr::DECIMAL(28,6)) FILTER (churned))::DOUBLE, 0) AS churned_arr, true AS in_range FROM mart"""
    ),
    "model_metrics_summary": "SELECT 0.35::DOUBLE AS decision_threshold, true AS in_range",
}
