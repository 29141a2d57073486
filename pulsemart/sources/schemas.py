"""Declared schemas of the six source tables and of the optional model outputs.

Dates and times arrive as text and are parsed in cleaning, where bad values are
counted. Yes/no columns are stored as 0/1.
"""

from __future__ import annotations

# Column names and types are the data contract (fixed values).
RAW_SCHEMAS = {
    "tenants": (
        "tenant_id STRING, company_name STRING, plan STRING, region STRING, "
        "industry STRING, employee_size STRING, csm_assigned STRING"
    ),
    "subscriptions": (
        "subscription_id STRING, tenant_id STRING, plan STRING, arr DOUBLE, "
        "contract_start_date STRING, renewal_date STRING, churned INT, churn_date STRING"
    ),
    "users": (
        "user_id STRING, tenant_id STRING, role STRING, registered_at STRING, "
        "last_seen_at STRING, is_active INT"
    ),
    "events": (
        "event_id STRING, tenant_id STRING, user_id STRING, event_name STRING, "
        "event_time STRING, event_count BIGINT, properties STRING"
    ),
    "crm_companies": (
        "company_id STRING, tenant_id STRING, lifecycle_stage STRING, "
        "acquisition_source STRING, pov_started INT, created_at STRING, "
        "region STRING, industry STRING"
    ),
    "crm_activities": (
        "activity_id STRING, tenant_id STRING, activity_type STRING, "
        "activity_date STRING, outcome STRING, days_to_renewal INT"
    ),
}

TABLES = tuple(RAW_SCHEMAS)

# Position of a row in its source, where "first" has a meaning: only tenants are deduplicated.
SEQUENCE = "ingest_seq"
SEQUENCED = ("tenants",)
# Rows of a CSV with more or fewer values than its header has names.
MALFORMED = "malformed_row"
EXTRA = (SEQUENCE, MALFORMED)
YES_NO = ("churned", "is_active", "pov_started")

PREDICTIONS_SCHEMA = (
    "tenant_id STRING, company_name STRING, plan STRING, arr DOUBLE, churned BOOLEAN, "
    "renewal_date DATE, days_to_renewal INT, health_score DOUBLE, health_tier STRING, "
    "churn_probability DOUBLE, churn_flag INT"
)
IMPORTANCE_SCHEMA = "feature STRING, importance DOUBLE"
METRICS_SCHEMA = (
    "model STRING, cv_roc_auc_mean DOUBLE, cv_roc_auc_std DOUBLE, "
    "cv_avg_precision_mean DOUBLE, cv_avg_precision_std DOUBLE, decision_threshold DOUBLE, "
    "true_positives BIGINT, false_positives BIGINT, false_negatives BIGINT, "
    "true_negatives BIGINT, arr_correctly_flagged DOUBLE, arr_missed DOUBLE"
)
