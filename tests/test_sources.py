"""Reading and writing tables."""

import os
from datetime import date

import pytest

from pulsemart.operators import cleaning, quality
from pulsemart.sources import (
    scan_csv_tables,
    scan_events,
    scan_optional_parquet,
    scan_sql_table,
    sink_csv_report,
    sink_parquet,
)
from pulsemart.sources.schemas import EXTRA, METRICS_SCHEMA, RAW_SCHEMAS, TABLES

CSV = {
    "tenants": "tenant_id,company_name,plan,region,industry,employee_size,csm_assigned\nt,\"A, B\", Pro ,r,,1-50,m\n",
    "subscriptions": "subscription_id,tenant_id,plan,arr,contract_start_date,renewal_date,churned,churn_date\n"
    "s,t,pro,10.5,2024-01-01,2024-09-01,True,\ns2,u,pro,x,2024-01-01,2024-09-01,0,\n",
    "users": "user_id,tenant_id,role,registered_at,last_seen_at,is_active\nu,t,admin,2024-01-01,2024-02-01,False\n",
    "events": "event_id,tenant_id,user_id,event_name,event_time,event_count,properties\n"
    'e,t,u,x,2024-06-01T10:00:00,3,"{""k"": ""a,b""}"\n',
    "crm_companies": "company_id,tenant_id,lifecycle_stage,acquisition_source,pov_started,created_at,region,industry\n"
    "c,t,active,trial,1,2024-01-01,r,i\n",
    "crm_activities": "activity_id,tenant_id,activity_type,activity_date,outcome,days_to_renewal\n"
    "a,t,call,2024-01-01,positive,-3\n",
}
HEADERS = {table: text.split("\n")[0] + "\n" for table, text in CSV.items()}


@pytest.fixture
def folder(tmp_path):
    for table, text in CSV.items():
        (tmp_path / f"{table}.csv").write_text(text)
    return str(tmp_path)


def test_csv_values(spark, folder):
    tables = scan_csv_tables(spark, folder)
    assert list(tables) == list(TABLES)
    for table, df in tables.items():
        df = df.drop(*EXTRA)
        assert df.schema.simpleString() == spark.createDataFrame([], RAW_SCHEMAS[table]).schema.simpleString()
    assert tables["tenants"].first()[:5] == ("t", "A, B", " Pro ", "r", None)
    assert [(r.arr, r.churned) for r in tables["subscriptions"].collect()] == [(10.5, 1), (None, 0)]
    assert tables["users"].first().is_active == 0
    assert tables["events"].first().properties == '{"k": "a,b"}'


def test_first_line_of_a_tenant_wins(spark, folder):
    with open(f"{folder}/tenants.csv", "a") as f:
        f.writelines(f"t{i % 7},name{99999 - i},p,r,i,1-50,m\n" for i in range(20000))
    small_splits = {"spark.sql.files.maxPartitionBytes": "64k", "spark.sql.files.openCostInBytes": "0"}
    before = {key: spark.conf.get(key) for key in small_splits}
    try:
        for key, value in small_splits.items():
            spark.conf.set(key, value)
        tenants = scan_csv_tables(spark, folder, multi_line=False)["tenants"]
        assert tenants.rdd.getNumPartitions() > 4
        got = {r.tenant_id: r.company_name for r in cleaning.clean_tenants(tenants).collect()}
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
    assert got == {"t": "A, B", **{f"t{i}": f"name{99999 - i}" for i in range(7)}}


def test_all_missing_files_are_named(spark, folder):
    os.remove(f"{folder}/users.csv")
    os.remove(f"{folder}/events.csv")
    with pytest.raises(FileNotFoundError) as error:
        scan_csv_tables(spark, folder)
    assert "users.csv" in str(error.value) and "events.csv" in str(error.value)


def test_existing_target_is_kept_or_replaced(spark, folder, tmp_path):
    target = str(tmp_path / "loaded")
    scan_csv_tables(spark, folder, target)
    with open(f"{folder}/users.csv", "a") as f:
        f.write("u2,t,member,2024-01-01,2024-02-01,1\n")
    assert scan_csv_tables(spark, folder, target)["users"].count() == 1
    assert scan_csv_tables(spark, folder, target, skip_existing=False)["users"].count() == 2


def test_sql_table(spark):
    spark.range(3).createOrReplaceTempView("three_rows")
    assert scan_sql_table(spark, "three_rows").count() == 3


def test_optional_table(spark, tmp_path):
    path = str(tmp_path / "metrics")
    empty = scan_optional_parquet(spark, path, METRICS_SCHEMA)
    assert empty.count() == 0 and "cv_roc_auc_mean" in empty.columns
    sink_parquet(spark.createDataFrame([], METRICS_SCHEMA).limit(0), path)
    assert scan_optional_parquet(spark, path, METRICS_SCHEMA).columns == empty.columns


def test_empty_report_has_a_header(spark, tmp_path):
    path = str(tmp_path / "report")
    users = spark.createDataFrame([("u", "t", "admin", "2024-01-01", "2024-02-01", 1)], RAW_SCHEMAS["users"])
    sink_csv_report(quality.dq_report({"users": users}), path, order_by=["table"])
    parts = [f for f in os.listdir(path) if f.endswith(".csv")]
    assert len(parts) == 1
    text = open(f"{path}/{parts[0]}").read()
    assert text.strip() == "table,column,issue,affected_rows,action"


@pytest.mark.parametrize("in_time_order", [False, True])
def test_event_scan_reads_only_the_months_it_needs(spark, tmp_path, in_time_order):
    path = str(tmp_path / "events")
    rows = [(f"e{i}", "t", "u", "x", f"2024-{1 + i % 6:02d}-{1 + i % 28:02d}", 1, None) for i in range(200)]
    clean = cleaning.clean_events(spark.createDataFrame(rows, RAW_SCHEMAS["events"]).repartition(4))
    sink_parquet(clean, path, by_month_of="event_time", in_time_order=in_time_order)
    months = sorted(d for d in os.listdir(path) if d.startswith("event_month="))
    assert months == [f"event_month=2024-{m:02d}" for m in range(1, 7)]
    files = [len([f for f in os.listdir(f"{path}/{m}") if f.endswith(".parquet")]) for m in months]
    assert all(1 <= n <= 4 for n in files) if in_time_order else files == [1] * 6

    scan = scan_events(spark, path, date(2024, 4, 1))
    plan = scan._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(event_month" in plan and "PushedFilters: [IsNotNull(event_time), Gr" in plan
    assert scan.count() == clean.where("event_time >= '2024-04-01'").count() > 0


def csv_folder(tmp_path, **tables):
    """The six tables with a header each; ``tables`` replaces a file, or a folder of part files, by name."""
    for table, header in HEADERS.items():
        content = tables.get(table, header)
        place = tmp_path / f"{table}.csv"
        if isinstance(content, dict):
            place.mkdir()
            for name, text in content.items():
                (place / name).write_text(text)
        else:
            place.write_text(content)
    return str(tmp_path)


def test_columns_are_found_by_name(spark, tmp_path):
    swapped = (
        "extra,company_name,tenant_id,csm_assigned,plan,region,industry,employee_size\n"
        "x,Acme,t1,Sam,starter,EMEA,Tech,1-50\n"
    )
    row = scan_csv_tables(spark, csv_folder(tmp_path, tenants=swapped))["tenants"].first()
    assert (row.tenant_id, row.company_name, row.csm_assigned, row.employee_size) == ("t1", "Acme", "Sam", "1-50")


def test_missing_columns_are_named_together_with_missing_files(spark, tmp_path):
    folder = csv_folder(tmp_path, users="user_id,tenant_id,role\n")
    os.rename(f"{folder}/events.csv", f"{folder}/elsewhere.csv")
    with pytest.raises(FileNotFoundError) as error:
        scan_csv_tables(spark, folder)
    for part in ("events.csv", "users.csv: registered_at", "users.csv: is_active"):
        assert part in str(error.value)


def test_quoted_line_breaks_stay_in_their_row(spark, tmp_path):
    text = HEADERS["tenants"] + 't1,"Acme\nInc",starter,EMEA,Tech,1-50,"Sam ""S"""\nt2,B,starter,EMEA,Tech,1-50,Kim\n'
    rows = scan_csv_tables(spark, csv_folder(tmp_path, tenants=text))["tenants"].orderBy("tenant_id").collect()
    assert [(r.tenant_id, r.company_name, r.csm_assigned) for r in rows] == [("t1", "Acme\nInc", 'Sam "S"'), ("t2", "B", "Kim")]


def test_whole_numbers_may_be_written_with_a_point(spark, tmp_path):
    text = HEADERS["crm_activities"] + "".join(
        f"a{i},t,call,2024-01-01,neutral,{v}\n" for i, v in enumerate(["-5.0", "3.0", "7", "2.5", "", "x", "1e2"])
    )
    rows = scan_csv_tables(spark, csv_folder(tmp_path, crm_activities=text))["crm_activities"].orderBy("activity_id").collect()
    assert [r.days_to_renewal for r in rows] == [-5, 3, 7, None, None, None, 100]


def test_first_of_duplicates_follows_file_names(spark, tmp_path):
    line = "t1,{},starter,EMEA,Tech,1-50,Sam\n"
    parts = {
        "part-0.csv": HEADERS["tenants"] + line.format("FIRST"),
        "part-1.csv": HEADERS["tenants"] + "".join(line.format(f"later {i}") for i in range(500)),
        "part-2.csv": HEADERS["tenants"] + line.format("LAST"),
    }
    raw = scan_csv_tables(spark, csv_folder(tmp_path, tenants=parts))["tenants"]
    assert [r.company_name for r in cleaning.clean_tenants(raw).collect()] == ["FIRST"]


def test_malformed_rows_are_reported(spark, tmp_path):
    text = HEADERS["users"] + "u1,t,admin,2024-01-01,2024-01-02,1\nu2,t,admin\nu3,t,admin,2024-01-01,2024-01-02,1,more,and more\n"
    report = quality.dq_report(scan_csv_tables(spark, csv_folder(tmp_path, users=text)))
    lines = {(r.table, r.issue): r.affected_rows for r in report.where("column = '*'").collect()}
    assert lines == {("users", "more or fewer values than columns"): 2}


def test_months_in_random_order_leave_few_files(spark, tmp_path):
    path = str(tmp_path / "events")
    rows = [(f"e{i}", "t", "u", "x", f"2024-{1 + i % 6:02d}-{1 + i % 28:02d}", 1, None) for i in range(10_000)]
    clean = cleaning.clean_events(spark.createDataFrame(rows, RAW_SCHEMAS["events"]).repartition(40))
    sink_parquet(clean, path, by_month_of="event_time")
    files = [f for d in os.listdir(path) if d.startswith("event_month=") for f in os.listdir(f"{path}/{d}") if f.endswith(".parquet")]
    assert len(files) == 6
