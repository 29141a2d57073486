"""Boosting runs a job per level of every tree: few tasks each, in the same order whatever the files."""

import threading
from dataclasses import replace
from math import ceil
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from pulsemart import HealthConfig, jobs
from pulsemart.ml import training
from pulsemart.ml.features import BASE_FEATURES
from pulsemart.sources import sink_parquet
from tests.compare import spark_rows

CFG = HealthConfig()
FEW_TREES = training.TreeParams(trees=4)


@pytest.fixture(scope="module")
def mart(spark):
    """600 rows; some tenants come twice, some have no id, one column has nulls."""
    noise = [F.pmod(F.xxhash64("id", F.lit(c)), F.lit(97)).cast("double").alias(c) for c in BASE_FEATURES]
    texts = ("company_name", "plan", "employee_size", "lifecycle_stage", "health_tier", "acquisition_source", "region", "industry")
    drawn = spark.range(600).select("id", *[c for c, n in zip(noise, BASE_FEATURES) if n not in ("days_to_renewal", "contract_age_months", "plan_encoded", "employee_size_encoded", "pov_started")])
    return drawn.select(
        F.when(F.col("id") % 50 != 0, F.concat(F.lit("ten_"), (F.col("id") % 550).cast("string"))).alias("tenant_id"),
        *[F.when(F.col("id") % 7 != 0, F.concat(F.lit(f"{c}_"), (F.col("id") % 3).cast("string"))).alias(c) for c in texts],
        *[c for c in drawn.columns if c != "id"],
        ((F.col("arr") > 60) | (F.col("id") % 5 == 0)).alias("churned"),
        F.expr("date_add(DATE'2024-06-01', cast(id % 90 AS INT))").alias("renewal_date"),
        F.expr("date_add(DATE'2023-06-01', cast(id % 90 AS INT))").alias("contract_start_date"),
        (F.col("id") % 2 == 0).alias("pov_started"),
        F.col("arr").alias("health_score"),
    ).localCheckpoint()


def test_few_tasks_a_level(spark, mart):
    data = training.training_set(mart, CFG)
    spread = replace(data, rows=data.rows.repartition(16))
    spark.sparkContext.setJobGroup("few tasks", "boosting")
    try:
        model = training.train_churn_model(spread, FEW_TREES)
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert model.getNumTrees == 4
    tracker = spark.sparkContext.statusTracker()
    found = {s for j in tracker.getJobIdsForGroup("few tasks") for s in tracker.getJobInfo(j).stageIds}
    infos = [tracker.getStageInfo(s) for s in found]
    ran = [i.numTasks for i in infos if i and i.numCompletedTasks]
    assert len(ran) > 20 and sum(n > 1 for n in ran) <= 2, ran


def test_the_files_do_not_change_the_model(mart):
    data = training.training_set(mart, CFG)
    layouts = [data, *[replace(data, rows=data.rows.repartition(n, "arr")) for n in (1, 5)]]
    one, two, three = (spark_rows(training.churn_predictions(training.train_churn_model(d, FEW_TREES), data, CFG)) for d in layouts)
    assert one == two == three


def test_tasks_grow_with_the_rows(mart, monkeypatch):
    monkeypatch.setattr(training, "TASK_ENTRIES", 2000)
    data = training.training_set(mart, CFG)
    assert data.tasks == ceil(600 * len(data.names) / 2000) > 5
    dealt = training.learning_rows(data)
    sizes = [r["count"] for r in dealt.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(sizes) == 600 and len(sizes) == data.tasks and max(sizes) <= 2 * min(sizes)
    assert training.train_churn_model(data, FEW_TREES).getNumTrees == 4


def _meeting():
    """A step that ends only if another runs at the same time."""
    barrier = threading.Barrier(2, timeout=20)
    return lambda *a, **k: barrier.wait()


def test_model_and_validation_are_fitted_side_by_side(spark, mart, monkeypatch, tmp_path):
    fitted = object.__new__(entry.Fitted)
    fitted.mart, fitted.data = mart, SimpleNamespace(rows=mart)
    meet = _meeting()
    monkeypatch.setattr(training, "train_churn_model", meet)
    monkeypatch.setattr(training, "cross_validate_churn", meet)
    monkeypatch.setattr(training, "model_metrics", lambda *a: a)
    assert {entry._metrics(fitted)[0], entry._metrics(fitted)[2]} == {0, 1}
    sink_parquet(mart, jobs.mart_path(str(tmp_path), "mart_tenant_health"))
    monkeypatch.setattr(training, "churn_predictions", lambda *a: (_ for _ in ()).throw(KeyError("fitted")))
    with pytest.raises(KeyError, match="fitted"):
        jobs.model_job(spark, str(tmp_path), CFG, FEW_TREES)


def test_leaky_and_clean_validation_run_side_by_side(spark, mart, monkeypatch):
    fitted = object.__new__(entry.Fitted)
    fitted.mart, fitted.data = mart, SimpleNamespace(rows=mart)
    meet = _meeting()
    monkeypatch.setattr(training, "leakage_check", meet)
    monkeypatch.setattr(training, "cross_validate_churn", meet)
    monkeypatch.setattr(entry.checks, "checked_leak", lambda *a: a)
    assert set(entry.queries()["leakage_check"].__closure__[0].cell_contents(fitted, spark)) == {0, 1}
