"""What the health mart reads and moves, from stored clean tables."""

import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from pulsemart import HealthConfig, jobs
from pulsemart.plans import marts
from pulsemart.sources import scan_parquet, versions
from pulsemart.sources.driver_tables import RawTables
from pulsemart.sources.schemas import TABLES
from tests.compare import spark_rows

CFG = HealthConfig()


@pytest.fixture(scope="module")
def outs(spark, sf_dir, tmp_path_factory):
    """The clean job's tables, plain and with the tenants' own in buckets."""
    raw = RawTables(spark, sf_dir)
    paths = [str(tmp_path_factory.mktemp(name)) for name in ("plain", "bucketed")]
    jobs.clean_job(raw, paths[0])
    jobs.clean_job(raw, paths[1], buckets=8)
    return paths


def initial_plan(df):
    return re.sub(r"#\d+L?", "", df._jdf.queryExecution().sparkPlan().toString()), df._jdf.queryExecution().executedPlan().toString()


def test_every_clean_table_is_read_once(spark, outs):
    for out in outs:
        plan, _ = initial_plan(marts.mart_tenant_health(jobs.clean_tables(spark, out), CFG))
        scans = Counter(re.findall(r"/(\w+)_clean[\],]", "\n".join(line for line in plan.split("\n") if "FileScan" in line)))
        assert scans == {table: 1 for table in TABLES}


def test_same_mart_from_buckets(spark, outs):
    plain, bucketed = (marts.mart_tenant_health(jobs.clean_tables(spark, out), CFG) for out in outs)
    assert spark_rows(plain) == spark_rows(bucketed)


@pytest.fixture
def no_broadcast(spark):
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "-1")
    yield
    spark.conf.set(key, before)


def exchanges(df):
    return initial_plan(df)[1].count("Exchange hashpartitioning(tenant_id")


def test_stored_by_tenant_nothing_is_moved_on_that_side(spark, outs, no_broadcast):
    """Too large to broadcast, as at scale: the three sides in buckets are joined where they are."""
    plain, bucketed = (jobs.clean_tables(spark, out) for out in outs)

    def joined(t):
        own = t.tenants.select("tenant_id", "plan").join(t.subscriptions.select("tenant_id", "arr"), "tenant_id", "left")
        return own.join(t.crm_companies.select("tenant_id", "pov_started"), "tenant_id", "left")

    assert exchanges(joined(plain)) == 3
    assert exchanges(joined(bucketed)) == 0
    assert spark_rows(joined(plain)) == spark_rows(joined(bucketed))
    mart = [exchanges(marts.mart_tenant_health(t, CFG)) for t in (plain, bucketed)]
    assert mart[0] - mart[1] == 3


def test_a_new_version_and_a_failed_one(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    some = random.Random(1)
    # A tenant with a third of the rows, null ones, odd names of columns.
    rows = [("hot" if some.random() < 0.34 else some.choice(["a", "b", "c", None]), i, "x") for i in range(3000)]
    first = spark.createDataFrame(rows, "tenant_id string, n long, `odd name` string")
    versions.replace_bucketed(first, path, "tenant_id", 4)
    assert spark_rows(scan_parquet(spark, path)) == spark_rows(first)
    with monkeypatch.context() as m:
        m.setattr(versions.Folder, "publish", lambda *a: (_ for _ in ()).throw(KeyboardInterrupt))
        with pytest.raises(KeyboardInterrupt):
            versions.replace_bucketed(first.limit(5), path, "tenant_id", 4)
    assert scan_parquet(spark, path).count() == 3000
    second = first.where(F.col("n") < 100)
    versions.replace_bucketed(second, path, "tenant_id", 6)
    assert spark_rows(scan_parquet(spark, path)) == spark_rows(second) == spark_rows(spark.read.parquet(path))
    versions.replace_table(first, path)
    assert spark_rows(scan_parquet(spark, path)) == spark_rows(first)
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("pulsemart_") and t.tableType != "EXTERNAL"]
