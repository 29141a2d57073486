"""The six source tables, derived from the benchmark's star schema and event stream.

Every row of customer, orders and events ends up in a source table: five
neighbouring customers form a tenant. The data also has to contain tenants
without users, events, CRM records or a subscription; those gaps come from
moving a tenant's rows to its neighbour, not from dropping rows.

All numbers and words below are fixed values of the mapping.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Declared, so that opening a table costs no schema-inference job.
SCHEMAS = {
    "region": "r_regionkey INT, r_name STRING",
    "nation": "n_nationkey INT, n_name STRING, n_regionkey INT",
    "customer": (
        "c_custkey BIGINT, c_name STRING, c_nationkey INT, c_acctbal DOUBLE, c_mktsegment STRING"
    ),
    "supplier": "s_suppkey BIGINT, s_name STRING",
    "orders": (
        "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE, "
        "o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING"
    ),
    "events": (
        "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, props STRING"
    ),
}
TODAY = "DATE'2024-06-30'"


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[table]).parquet(f"{sf_dir.rstrip('/')}/{table}.parquet")


def _tenant(customer_key: str) -> str:
    return f"{customer_key} div 5"


def _moved(tn: str, every: int, rest: int) -> str:
    """Leave tenants with ``tn % every = rest`` empty by giving their rows to a neighbour."""
    step = "+ 1" if rest == 0 else "- 1"
    return f"if(({tn}) % {every} = {rest}, ({tn}) {step}, {tn})"


def _accounts(spark: SparkSession, sf_dir: str, tn: str) -> DataFrame:
    """One row per tenant number, described by its customer with the smallest key."""
    customer = _read(spark, sf_dir, "customer").withColumnRenamed("c_nationkey", "n_nationkey")
    # The key alone is aggregated, by hash; its row is fetched by the key.
    first = customer.groupBy(F.expr(tn).alias("tn")).agg(F.min("c_custkey").alias("c_custkey"))
    return (
        first.join(customer, "c_custkey")
        .join(_read(spark, sf_dir, "nation"), "n_nationkey")
        .withColumnRenamed("n_regionkey", "r_regionkey")
        .join(_read(spark, sf_dir, "region"), "r_regionkey")
    )


def tenants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every fiftieth tenant is listed a second time; the first listing is the valid one."""
    managers = _read(spark, sf_dir, "supplier")
    last = managers.select(F.max("s_suppkey")).scalar()
    return (
        _accounts(spark, sf_dir, _tenant("c_custkey"))
        .withColumn("s_suppkey", F.col("tn") % (last + 1))
        .join(managers, "s_suppkey", "left")
        .selectExpr("*", "explode(if(tn % 50 = 0, array(0, 1), array(0))) AS ingest_seq")
        .selectExpr(
            "concat('ten_', tn) AS tenant_id",
            "if(ingest_seq = 1, concat(c_name, ' (copy)'), c_name) AS company_name",
            "try_element_at(array(' Starter', 'business', 'ENTERPRISE'), cast(tn % 3 + 1 AS INT)) AS plan",
            "r_name AS region",
            "if(tn % 23 != 22, c_mktsegment, NULL) AS industry",
            "try_element_at(array('1-50', '51-200', '201-1000', '1000+', 'unknown'), cast(tn % 5 + 1 AS INT))"
            " AS employee_size",
            "s_name AS csm_assigned",
            "ingest_seq",
        )
    )


def _last_orders(spark: SparkSession, sf_dir: str, tn: str) -> DataFrame:
    """The order with the largest key of every tenant number, and whether it ends the subscription."""
    orders = _read(spark, sf_dir, "orders")
    last = orders.groupBy(F.expr(tn).alias("tn")).agg(F.max("o_orderkey").alias("o_orderkey"))
    gone = "o_orderstatus = 'F' AND o_orderpriority != '1-URGENT' AS gone"
    return last.join(orders, "o_orderkey").selectExpr("*", gone)


def subscriptions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A tenant's order with the largest key."""
    return (
        _last_orders(spark, sf_dir, _moved(_tenant("o_custkey"), 29, 28))
        .selectExpr("*", f"cast(date_sub({TODAY}, cast(o_orderkey % 120 AS INT)) AS STRING) AS ended")
        .selectExpr(
            "concat('sub_', o_orderkey) AS subscription_id",
            "concat('ten_', tn) AS tenant_id",
            "try_element_at(array('starter', 'business', 'enterprise'), cast(tn % 3 + 1 AS INT)) AS plan",
            "if(o_orderkey % 61 = 0, 0D, o_totalprice) AS arr",
            "cast(date_add(cast(o_orderdate AS DATE), 8217) AS STRING) AS contract_start_date",
            f"cast(date_add({TODAY}, cast(o_orderkey % 400 - 40 AS INT)) AS STRING) AS renewal_date",
            "cast(gone AS INT) AS churned",
            "CASE WHEN gone AND o_orderkey % 10 != 0 THEN ended"
            " WHEN NOT gone AND o_orderkey % 50 = 0 THEN ended END AS churn_date",
        )
    )


def users(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _read(spark, sf_dir, "customer").selectExpr(
        "concat('usr_', c_custkey) AS user_id",
        f"concat('ten_', {_moved(_tenant('c_custkey'), 25, 0)}) AS tenant_id",
        "CASE c_mktsegment WHEN 'BUILDING' THEN 'Admin ' WHEN 'MACHINERY' THEN ' member'"
        " WHEN 'FURNITURE' THEN 'read-only' WHEN 'HOUSEHOLD' THEN 'member' ELSE 'owner' END AS role",
        "cast(date_add(DATE'2023-01-01', cast(c_custkey % 365 AS INT)) AS STRING) AS registered_at",
        f"cast(date_sub({TODAY}, cast((c_custkey * 7) % 600 AS INT)) AS STRING) AS last_seen_at",
        "cast(c_acctbal > 3000 AS INT) AS is_active",
    )


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stream's 30 days are stretched to 180, the half year before the snapshot."""
    start = "TIMESTAMP_NTZ'2024-01-01 00:00:00'"
    return (
        _read(spark, sf_dir, "events")
        .withColumn("u", F.expr("user_id * 10 + event_id % 10"))
        .selectExpr(
            "concat('evt_', event_id) AS event_id",
            f"concat('ten_', {_moved(_tenant('u'), 20, 0)}) AS tenant_id",
            "concat('usr_', u) AS user_id",
            "CASE event_type WHEN 'purchase' THEN 'policy_created' WHEN 'signup' THEN 'policy_updated'"
            " WHEN 'click' THEN 'pp_sync_completed' WHEN 'view' THEN 'report_generated' WHEN 'error'"
            " THEN if(event_id % 2 = 0, 'risky_workspace_resolved', 'risky_workspace_detected')"
            " END AS event_name",
            "if(event_id % 997 = 0, 'not-a-time',"
            f" replace(substring(cast({start} + (ts - {start}) * 6 AS STRING), 1, 19), ' ', 'T'))"
            " AS event_time",
            "floor(value) % 5 AS event_count",
            "if(event_id % 12 != 0, props, NULL) AS properties",
        )
    )


def crm_companies(spark: SparkSession, sf_dir: str) -> DataFrame:
    # The stage knows more about the outcome than a prediction may: five in seven of
    # the tenants that are gone say so.
    gone = _last_orders(spark, sf_dir, _moved(_tenant("o_custkey"), 29, 28)).where("gone AND tn % 7 < 5").select("tn", "gone")
    accounts = _accounts(spark, sf_dir, _moved(_tenant("c_custkey"), 31, 30)).join(gone, "tn", "left")
    return accounts.selectExpr(
        "concat('crm_', tn) AS company_id",
        "concat('ten_', tn) AS tenant_id",
        "if(gone, 'churned', try_element_at(array('Onboarding ', 'active', 'At-Risk'), cast(tn % 3 + 1 AS INT)))"
        " AS lifecycle_stage",
        "try_element_at(array('Inbound', 'outbound ', 'partner', 'trial', 'referral'),"
        " cast((tn div 3) % 6 + 1 AS INT)) AS acquisition_source",
        "cast(tn % 10 < 7 AS INT) AS pov_started",
        "cast(date_add(DATE'2023-01-01', cast(tn % 365 AS INT)) AS STRING) AS created_at",
        "r_name AS region",
        "c_mktsegment AS industry",
    )


def crm_activities(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        _read(spark, sf_dir, "orders")
        .withColumns(
            {
                "tn": F.expr(_moved(_tenant("o_custkey"), 7, 0)),
                "spread": F.expr("(o_orderkey div 10) % 365"),
                "priority": F.expr("substring(o_orderpriority, 1, 1)"),
            }
        )
        .selectExpr(
            "concat('act_', o_orderkey) AS activity_id",
            "concat('ten_', tn) AS tenant_id",
            "CASE priority WHEN '1' THEN 'Support_Ticket' WHEN '2' THEN 'call_completed'"
            " WHEN '3' THEN 'email_sent ' WHEN '4' THEN 'meeting_held' WHEN '5' THEN 'qbr_completed' END"
            " AS activity_type",
            f"cast(date_sub({TODAY}, cast((tn % 6) * 20 + spread AS INT)) AS STRING) AS activity_date",
            "CASE priority WHEN '1' THEN ' Positive' WHEN '2' THEN 'neutral' WHEN '3' THEN 'negative'"
            " WHEN '4' THEN 'No_Response' WHEN '5' THEN 'neutral' END AS outcome",
            "cast(o_orderkey % 400 - 40 + spread AS INT) AS days_to_renewal",
        )
    )


BUILDERS = {
    "tenants": tenants,
    "subscriptions": subscriptions,
    "users": users,
    "events": events,
    "crm_companies": crm_companies,
    "crm_activities": crm_activities,
}


class RawTables(Mapping):
    """Source tables by name; each is opened when it is first asked for."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self._spark, self._sf_dir = spark, sf_dir
        self._opened: dict[str, DataFrame] = {}

    def __getitem__(self, table: str) -> DataFrame:
        if table not in self._opened:
            self._opened[table] = BUILDERS[table](self._spark, self._sf_dir)
        return self._opened[table]

    def __iter__(self) -> Iterator[str]:
        return iter(BUILDERS)

    def __len__(self) -> int:
        return len(BUILDERS)

    def __contains__(self, table: object) -> bool:
        return table in BUILDERS
