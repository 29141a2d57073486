"""The three batch jobs end to end on the smallest data set."""

import os

import pytest

import __spark_entry__ as entry
from pulsemart import HealthConfig, jobs
from pulsemart.__main__ import main
from pulsemart.ml import training
from pulsemart.plans import marts
from pulsemart.plans.reports import churn
from pulsemart.sources import scan_parquet
from pulsemart.sources.driver_tables import RawTables
from tests.compare import spark_rows

SMALL = "/root/testdata/sf0.001"
FEW_TREES = training.TreeParams(trees=4)


def test_command_line_from_csv_to_marts(spark, tmp_path, capfd):
    raw = RawTables(spark, SMALL)
    for table in raw:
        raw[table].drop("ingest_seq").toPandas().to_csv(tmp_path / f"{table}.csv", index=False)
    out = str(tmp_path / "out")
    main(["clean", "--csv", str(tmp_path), "--out", out])
    main(["marts", "--out", out])
    capfd.readouterr()
    tables = jobs.report_tables(spark, out)
    assert {t: tables[t].count() for t in ("churn_predictions", "feature_importance", "churn_model_metrics")} == {
        "churn_predictions": 0, "feature_importance": 0, "churn_model_metrics": 0
    }
    assert spark_rows(tables["mart_weekly_activity"]) == spark_rows(entry.Inputs(spark, SMALL).weekly)
    assert spark_rows(tables["mart_tenant_health"].drop("company_name")) == spark_rows(
        entry.Inputs(spark, SMALL).mart.drop("company_name")
    )
    with pytest.raises(SystemExit):
        main(["clean", "--out", out])


@pytest.fixture(scope="module")
def out(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("jobs"))
    jobs.clean_job(RawTables(spark, SMALL), folder)
    jobs.mart_job(spark, folder)
    jobs.model_job(spark, folder, params=FEW_TREES)
    return folder


def stored(spark, out, mart):
    return scan_parquet(spark, jobs.mart_path(out, mart))


def test_stored_marts_equal_the_lazy_ones(spark, out):
    x = entry.Inputs(spark, SMALL)
    for name, df in {
        "mart_tenant_health": x.mart,
        "mart_weekly_activity": x.weekly,
        "mart_renewal_pipeline": x.renewals,
        "mart_trial_funnel": x.funnel,
    }.items():
        assert spark_rows(stored(spark, out, name)) == spark_rows(df)


def test_invariants(spark, out):
    mart = stored(spark, out, "mart_tenant_health").toPandas()
    assert mart.health_score.between(0, 100).all()
    assert mart.tenant_id.is_unique
    assert (mart[mart.cs_blind_spot].churned).all()
    assert not (mart[mart.expansion_candidate].churned).any()
    channel = stored(spark, out, "mart_channel_performance").toPandas()
    with_source = mart[mart.acquisition_source.notna()]
    assert channel.total_tenants.sum() == len(with_source)
    assert channel.total_arr.sum() == pytest.approx(with_source.arr.sum())
    funnel = stored(spark, out, "mart_trial_funnel").toPandas().sort_values("stage_order")
    assert funnel.tenants.iloc[0] == (mart.acquisition_source == "trial").sum()
    summary = marts.mart_summary(stored(spark, out, "mart_tenant_health")).first()
    tiers = [summary[c] for c in summary.asDict() if c.startswith("tier_")]
    assert sum(tiers) == summary.total_tenants == len(mart)


def test_model_outputs(spark, out):
    tables = jobs.report_tables(spark, out)
    assert churn.feature_importance_topn(tables["feature_importance"]).count() == 15
    assert churn.model_metrics_summary(tables["churn_model_metrics"]).first().decision_threshold == 0.35
    assert churn.churn_kpis(tables["churn_predictions"]).first().avg_probability is not None
    predictions = stored(spark, out, "churn_predictions").toPandas()
    assert predictions.churn_probability.between(0, 1).all()
    assert len(predictions) == stored(spark, out, "mart_tenant_health").count()
    metrics = spark.read.option("header", True).csv(jobs.mart_path(out, "churn_model_metrics")).first()
    cells = [int(metrics[c]) for c in ("true_positives", "false_positives", "false_negatives", "true_negatives")]
    assert sum(cells) == len(predictions)
    assert int(metrics.true_positives) + int(metrics.false_positives) == predictions.churn_flag.sum()
    importance = spark.read.option("header", True).csv(jobs.mart_path(out, "feature_importance")).collect()
    assert sum(float(r.importance) for r in importance) == pytest.approx(1.0)
    assert "lifecycle_encoded" not in {r.feature for r in importance}
    assert os.path.isdir(jobs.mart_path(out, "churn_model"))


def test_same_seed_gives_the_same_model(spark, out):
    mart = stored(spark, out, "mart_tenant_health")
    cfg = HealthConfig()
    runs = []
    for _ in range(2):
        data = training.training_set(mart, cfg)
        model = training.train_churn_model(data, FEW_TREES)
        runs.append(spark_rows(training.churn_predictions(model, data, cfg)))
    assert runs[0] == runs[1]
    loaded = training.load_model(jobs.mart_path(out, "churn_model"))
    assert spark_rows(training.churn_predictions(loaded, data, cfg)) == runs[0]


def test_leaky_feature_is_only_in_the_comparison_run(spark, out):
    mart = stored(spark, out, "mart_tenant_health")
    assert "lifecycle_encoded" in training.training_set(mart, include_leaky=True).names
    auc = training.leakage_check(mart, params=training.TreeParams(trees=2)).first()[0]
    assert 0 <= auc <= 1
