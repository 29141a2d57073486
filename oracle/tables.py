"""The six source tables and their clean versions as CTEs."""

DAY = "DATE '2024-06-30'"
HV = (
    "('policy_created', 'risky_workspace_resolved', "
    "'sensitivity_label_applied', 'license_recommendation_applied')"
)


def moved(tn: str, every: int, rest: int) -> str:
    step = "+ 1" if rest == 0 else "- 1"
    return f"CASE WHEN ({tn}) % {every} = {rest} THEN ({tn}) {step} ELSE ({tn}) END"


def accounts(name: str, tn: str) -> str:
    return f"""{name} AS (
  SELECT g.tn, g.c_name, g.c_mktsegment, r.r_name
  FROM (
    SELECT {tn} AS tn,
           arg_min(c_name, c_custkey) AS c_name,
           arg_min(c_mktsegment, c_custkey) AS c_mktsegment,
           arg_min(c_nationkey, c_custkey) AS c_nationkey
    FROM customer GROUP BY 1
  ) g
  JOIN nation n ON n.n_nationkey = g.c_nationkey
  JOIN region r ON r.r_regionkey = n.n_regionkey
)"""


RAW = f"""
{accounts("tenant_accounts", "c_custkey // 5")},
{accounts("company_accounts", moved("c_custkey // 5", 31, 30))},
raw_tenants AS (
  SELECT 'ten_' || tn AS tenant_id,
         c_name || CASE WHEN q.seq = 1 THEN ' (copy)' ELSE '' END AS company_name,
         CASE tn % 3 WHEN 0 THEN ' Starter' WHEN 1 THEN 'business' ELSE 'ENTERPRISE' END AS plan,
         r_name AS region,
         CASE WHEN tn % 23 <> 22 THEN c_mktsegment END AS industry,
         CASE tn % 5 WHEN 0 THEN '1-50' WHEN 1 THEN '51-200' WHEN 2 THEN '201-1000'
                     WHEN 3 THEN '1000+' ELSE 'unknown' END AS employee_size,
         s.s_name AS csm_assigned,
         q.seq AS ingest_seq
  FROM tenant_accounts a
  LEFT JOIN supplier s ON s.s_suppkey = a.tn % (SELECT max(s_suppkey) + 1 FROM supplier)
  JOIN (VALUES (0), (1)) q(seq) ON q.seq = 0 OR a.tn % 50 = 0
),
raw_subscriptions AS (
  SELECT 'sub_' || o_orderkey AS subscription_id,
         'ten_' || tn AS tenant_id,
         CASE tn % 3 WHEN 0 THEN 'starter' WHEN 1 THEN 'business' ELSE 'enterprise' END AS plan,
         CASE WHEN o_orderkey % 61 = 0 THEN 0.0::DOUBLE ELSE o_totalprice END AS arr,
         CAST(CAST(o_orderdate AS DATE) + 8217 AS VARCHAR) AS contract_start_date,
         CAST({DAY} + CAST(o_orderkey % 400 - 40 AS INTEGER) AS VARCHAR) AS renewal_date,
         gone::INTEGER AS churned,
         CASE WHEN (gone AND o_orderkey % 10 <> 0) OR (NOT gone AND o_orderkey % 50 = 0)
              THEN CAST({DAY} - CAST(o_orderkey % 120 AS INTEGER) AS VARCHAR) END AS churn_date
  FROM (
    SELECT *, o_orderstatus = 'F' AND o_orderpriority <> '1-URGENT' AS gone
    FROM (SELECT *, {moved("o_custkey // 5", 29, 28)} AS tn FROM orders)
    QUALIFY row_number() OVER (PARTITION BY tn ORDER BY o_orderkey DESC) = 1
  )
),
raw_users AS (
  SELECT 'usr_' || c_custkey AS user_id,
         'ten_' || ({moved("c_custkey // 5", 25, 0)}) AS tenant_id,
         CASE c_mktsegment WHEN 'BUILDING' THEN 'Admin ' WHEN 'MACHINERY' THEN ' member'
              WHEN 'FURNITURE' THEN 'read-only' WHEN 'HOUSEHOLD' THEN 'member' ELSE 'owner' END AS role,
         CAST(DATE '2023-01-01' + CAST(c_custkey % 365 AS INTEGER) AS VARCHAR) AS registered_at,
         CAST({DAY} - CAST((c_custkey * 7) % 600 AS INTEGER) AS VARCHAR) AS last_seen_at,
         (c_acctbal > 3000)::INTEGER AS is_active
  FROM customer
),
raw_events AS (
  SELECT 'evt_' || event_id AS event_id,
         'ten_' || ({moved("u // 5", 20, 0)}) AS tenant_id,
         'usr_' || u AS user_id,
         CASE event_type WHEN 'purchase' THEN 'policy_created' WHEN 'signup' THEN 'policy_updated'
              WHEN 'click' THEN 'pp_sync_completed' WHEN 'view' THEN 'report_generated'
              WHEN 'error' THEN CASE WHEN event_id % 2 = 0 THEN 'risky_workspace_resolved'
                                     ELSE 'risky_workspace_detected' END END AS event_name,
         CASE WHEN event_id % 997 = 0 THEN 'not-a-time'
              ELSE strftime(TIMESTAMP '2024-01-01' + (ts - TIMESTAMP '2024-01-01') * 6,
                            '%Y-%m-%dT%H:%M:%S') END AS event_time,
         CAST(floor(value) AS BIGINT) % 5 AS event_count,
         CASE WHEN event_id % 12 <> 0 THEN props END AS properties
  FROM (SELECT *, user_id * 10 + event_id % 10 AS u FROM events)
),
raw_crm_companies AS (
  SELECT 'crm_' || tn AS company_id,
         'ten_' || tn AS tenant_id,
         CASE WHEN tn % 7 < 5 AND 'ten_' || tn IN (SELECT tenant_id FROM raw_subscriptions WHERE churned = 1) THEN 'churned'
              WHEN tn % 3 = 0 THEN 'Onboarding ' WHEN tn % 3 = 1 THEN 'active' ELSE 'At-Risk' END AS lifecycle_stage,
         CASE (tn // 3) % 6 WHEN 0 THEN 'Inbound' WHEN 1 THEN 'outbound ' WHEN 2 THEN 'partner'
                            WHEN 3 THEN 'trial' WHEN 4 THEN 'referral' END AS acquisition_source,
         (tn % 10 < 7)::INTEGER AS pov_started,
         CAST(DATE '2023-01-01' + CAST(tn % 365 AS INTEGER) AS VARCHAR) AS created_at,
         r_name AS region,
         c_mktsegment AS industry
  FROM company_accounts
),
raw_crm_activities AS (
  SELECT 'act_' || o_orderkey AS activity_id,
         'ten_' || tn AS tenant_id,
         CASE o_orderpriority[1] WHEN '1' THEN 'Support_Ticket' WHEN '2' THEN 'call_completed'
              WHEN '3' THEN 'email_sent ' WHEN '4' THEN 'meeting_held' WHEN '5' THEN 'qbr_completed'
              END AS activity_type,
         CAST({DAY} - CAST((tn % 6) * 20 + (o_orderkey // 10) % 365 AS INTEGER) AS VARCHAR)
           AS activity_date,
         CASE o_orderpriority[1] WHEN '1' THEN ' Positive' WHEN '2' THEN 'neutral'
              WHEN '3' THEN 'negative' WHEN '4' THEN 'No_Response' WHEN '5' THEN 'neutral'
              END AS outcome,
         CAST(o_orderkey % 400 - 40 + (o_orderkey // 10) % 365 AS INTEGER) AS days_to_renewal
  FROM (SELECT *, {moved("o_custkey // 5", 7, 0)} AS tn FROM orders)
)"""

CLEAN = f"""
clean_tenants AS (
  SELECT tenant_id, company_name, trim(lower(plan)) AS plan, region, industry,
         CASE WHEN employee_size IN ('1-50', '51-200', '201-1000', '1000+') THEN employee_size END
           AS employee_size,
         csm_assigned,
         CASE employee_size WHEN '1-50' THEN 1 WHEN '51-200' THEN 2 WHEN '201-1000' THEN 3
                            WHEN '1000+' THEN 4 END AS employee_size_rank
  FROM raw_tenants
  QUALIFY row_number() OVER (PARTITION BY tenant_id ORDER BY ingest_seq) = 1
),
clean_subscriptions AS (
  SELECT subscription_id, tenant_id, plan, arr, contract_start_date, renewal_date,
         was_churned OR ended IS NOT NULL AS churned,
         CASE WHEN was_churned AND ended IS NULL THEN renewal_date ELSE ended END AS churn_date,
         coalesce(arr <= 0, false) AS arr_suspect
  FROM (
    SELECT subscription_id, tenant_id, plan, arr,
           try_cast(contract_start_date AS DATE) AS contract_start_date,
           try_cast(renewal_date AS DATE) AS renewal_date,
           coalesce(churned = 1, false) AS was_churned,
           try_cast(churn_date AS DATE) AS ended
    FROM raw_subscriptions
  )
),
clean_users AS (
  SELECT user_id, tenant_id,
         CASE WHEN trim(lower(role)) IN ('admin', 'member', 'read-only') THEN trim(lower(role))
              ELSE 'member' END AS role,
         try_cast(registered_at AS DATE) AS registered_at,
         try_cast(last_seen_at AS DATE) AS last_seen_at,
         coalesce(is_active = 1, false) AS is_active,
         coalesce(try_cast(last_seen_at AS DATE) < try_cast(registered_at AS DATE), false)
           AS date_order_suspect
  FROM raw_users
),
clean_events AS (
  SELECT event_id, tenant_id, user_id, event_name, t AS event_time,
         CASE WHEN event_count < 1 THEN 1 ELSE event_count END AS event_count,
         properties, CAST(t AS DATE) AS event_date,
         coalesce(event_name IN {HV}, false) AS is_high_value
  FROM (SELECT *, try_cast(event_time AS TIMESTAMP) AS t FROM raw_events)
  WHERE t IS NOT NULL
),
clean_crm_companies AS (
  SELECT company_id, tenant_id, trim(lower(lifecycle_stage)) AS lifecycle_stage,
         trim(lower(acquisition_source)) AS acquisition_source,
         coalesce(pov_started = 1, false) AS pov_started,
         try_cast(created_at AS DATE) AS created_at, region, industry
  FROM raw_crm_companies
),
clean_crm_activities AS (
  SELECT activity_id, tenant_id, trim(lower(activity_type)) AS activity_type,
         try_cast(activity_date AS DATE) AS activity_date,
         trim(lower(outcome)) AS outcome, days_to_renewal
  FROM raw_crm_activities
)"""

RAW_COLUMNS = {
    "tenants": "tenant_id company_name plan region industry employee_size csm_assigned",
    "subscriptions": "subscription_id tenant_id plan arr contract_start_date renewal_date churned churn_date",
    "users": "user_id tenant_id role registered_at last_seen_at is_active",
    "events": "event_id tenant_id user_id event_name event_time event_count properties",
    "crm_companies": "company_id tenant_id lifecycle_stage acquisition_source pov_started created_at region industry",
    "crm_activities": "activity_id tenant_id activity_type activity_date outcome days_to_renewal",
}

RULES = {
    "tenants": [
        ("tenant_id", "duplicate IDs", "kept first occurrence",
         "SELECT count(*) - (SELECT count(DISTINCT tenant_id) FROM raw_tenants) FROM raw_tenants"),
        ("employee_size", "unexpected values", "replaced with NaN",
         "SELECT count(*) FROM clean_tenants WHERE employee_size IS NULL"),
    ],
    "subscriptions": [
        ("churn_date", "churned=True but churn_date is NULL", "set churn_date = renewal_date as proxy",
         "SELECT count(*) FROM raw_subscriptions WHERE churned = 1 AND try_cast(churn_date AS DATE) IS NULL"),
        ("churned", "churned=False but churn_date is populated", "set churned=True to match churn_date",
         "SELECT count(*) FROM raw_subscriptions WHERE churned = 0 AND try_cast(churn_date AS DATE) IS NOT NULL"),
        ("arr", "ARR <= 0", "retained -- flagged", "SELECT count(*) FROM raw_subscriptions WHERE arr <= 0"),
    ],
    "users": [
        ("last_seen_at", "last_seen_at < registered_at", "retained -- flagged as date_order_suspect",
         "SELECT count(*) FROM clean_users WHERE last_seen_at < registered_at"),
        ("role", "unexpected role values", "replaced with 'member'",
         "SELECT count(*) FROM raw_users WHERE role IS NULL "
         "OR trim(lower(role)) NOT IN ('admin', 'member', 'read-only')"),
    ],
    "events": [
        ("event_time", "unparseable timestamp", "rows dropped -- unusable without timestamp",
         "SELECT count(*) FROM raw_events WHERE try_cast(event_time AS TIMESTAMP) IS NULL"),
        ("event_count", "event_count < 1", "set to 1 -- minimum meaningful count",
         "SELECT count(*) FROM raw_events WHERE try_cast(event_time AS TIMESTAMP) IS NOT NULL "
         "AND event_count < 1"),
    ],
    "crm_activities": [
        ("days_to_renewal", "negative values (activity after renewal date)",
         "retained -- expected per data spec",
         "SELECT count(*) FROM raw_crm_activities WHERE days_to_renewal < 0"),
    ],
}


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _line(table: str, column: str, issue: str, action: str, count: str) -> str:
    return (
        f'SELECT {_quoted(table)} AS "table", {_quoted(column)} AS "column", {_quoted(issue)} AS issue, '
        f"CAST(({count}) AS BIGINT) AS affected_rows, {_quoted(action)} AS action"
    )


NULL_LINES = " UNION ALL ".join(
    _line(t, c, "null values", "retained -- handled downstream",
          f"SELECT count(*) FROM raw_{t} WHERE {c} IS NULL")
    for t, columns in RAW_COLUMNS.items()
    for c in columns.split()
)
RULE_LINES = " UNION ALL ".join(
    _line(t, *rule) for t, rules in RULES.items() for rule in rules
)


def with_raw(query: str) -> str:
    return f"WITH {RAW}\n{query}"


def with_clean(query: str) -> str:
    return f"WITH {RAW},{CLEAN}\n{query}"


def _row_text(columns: str) -> str:
    return " || '|' || ".join(f"coalesce(CAST({c} AS VARCHAR), '<null>')" for c in columns.split())


def _profile(prefix: str, table: str, columns: str) -> str:
    checksum = f"CAST(sum(('0x' || substr(md5({_row_text(columns)}), 1, 15))::BIGINT) AS VARCHAR)"
    return (
        f"SELECT '{table}' AS table_name, '*' AS column_name, count(*) AS n_rows, count(*) AS n_present, "
        f"{checksum} AS smallest, {checksum} AS largest FROM {prefix}{table} UNION ALL "
    ) + " UNION ALL ".join(
        f"SELECT '{table}' AS table_name, '{c}' AS column_name, count(*) AS n_rows, count({c}) AS n_present, "
        f"min(CAST({c} AS VARCHAR)) AS smallest, max(CAST({c} AS VARCHAR)) AS largest FROM {prefix}{table}"
        for c in columns.split()
    )


CLEAN_COLUMNS = {
    "tenants": RAW_COLUMNS["tenants"] + " employee_size_rank",
    "subscriptions": RAW_COLUMNS["subscriptions"] + " arr_suspect",
    "users": RAW_COLUMNS["users"] + " date_order_suspect",
    "events": RAW_COLUMNS["events"] + " event_date is_high_value",
    "crm_companies": RAW_COLUMNS["crm_companies"],
    "crm_activities": RAW_COLUMNS["crm_activities"],
}

QUERIES = {
    "scan_csv_tables": with_raw(" UNION ALL ".join(_profile("raw_", t, c) for t, c in RAW_COLUMNS.items())),
    "scan_sql_table": with_raw(f"SELECT {', '.join(RAW_COLUMNS['events'].split())} FROM raw_events"),
    "scan_parquet": with_clean("SELECT * FROM clean_events"),
    "sink_parquet": with_clean(" UNION ALL ".join(_profile("clean_", t, c) for t, c in CLEAN_COLUMNS.items())),
    "sink_csv_report": with_clean(f"SELECT * FROM ({NULL_LINES} UNION ALL {RULE_LINES}) WHERE affected_rows > 0"),
    "dq_null_summary": with_raw(f"SELECT * FROM ({NULL_LINES}) WHERE affected_rows > 0"),
    "dq_rule_checks": with_clean(f"SELECT * FROM ({RULE_LINES}) WHERE affected_rows > 0"),
    "dq_report": with_clean(f"SELECT * FROM ({NULL_LINES} UNION ALL {RULE_LINES}) WHERE affected_rows > 0"),
    **{f"clean_{t}": with_clean(f"SELECT * FROM clean_{t}") for t in RAW_COLUMNS},
}
