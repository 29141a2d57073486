"""A stored model scores other marts as the one in memory does."""

import os
import subprocess
import sys

import pytest
from pyspark.sql import functions as F

from pulsemart import HealthConfig
from pulsemart.ml import model_store, training
from pulsemart.ml.features import categories, churn_features, feature_selection
from pulsemart.plans import marts
from pulsemart.sources import sink_parquet
from pulsemart.sources.driver_tables import RawTables
from pulsemart.sources.versions import Folder
from tests.compare import spark_rows

CFG = HealthConfig(churn_threshold=0.4)
FRESH = """
import sys
from pulsemart import HealthConfig
from pulsemart.ml import model_store
from pulsemart.session import local_session
from pulsemart.sources import scan_parquet, sink_parquet
spark = local_session("2")
model = model_store.load_model(sys.argv[1])
scored = model_store.score_mart(model, scan_parquet(spark, sys.argv[2]), HealthConfig(churn_threshold=0.9))
sink_parquet(scored, sys.argv[3])
"""


@pytest.fixture(scope="module")
def trained(spark, sf_dir, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("mart") / "mart")
    tables = marts.CleanTables.from_raw(RawTables(spark, sf_dir), CFG)
    sink_parquet(marts.mart_tenant_health(tables, CFG).where("hash(tenant_id) % 2 = 0"), path)
    mart = spark.read.parquet(path)
    data = training.training_set(mart, CFG)
    return mart, data, training.train_churn_model(data, training.TreeParams(trees=4)), path


def test_same_predictions_after_a_round_trip(spark, trained, tmp_path):
    mart, data, learner, _ = trained
    path = str(tmp_path / "model")
    model_store.save_model(model_store.churn_model(learner, data, CFG), path)
    loaded = model_store.load_model(path)
    assert loaded.about == model_store.About(training.MODEL_NAME, tuple(data.names), 0.4)
    want = spark_rows(training.churn_predictions(learner, data, CFG))
    assert spark_rows(model_store.score_mart(loaded, mart, CFG)) == want
    assert training.load_model(path).getNumTrees == 4


def test_another_mart_in_a_fresh_session(spark, trained, tmp_path):
    """Unseen and null categories, other tenants, a session that knows the files only; the threshold is the model's."""
    mart, data, learner, _ = trained
    model_path, mart_path, out = (str(tmp_path / n) for n in ("model", "mart", "out"))
    model_store.save_model(model_store.churn_model(learner, data, CFG), model_path)
    other = mart.withColumn("industry", F.lit("SPACE MINING")).withColumn("region", F.lit(None).cast("string")).limit(50)
    sink_parquet(other, mart_path)
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    subprocess.run([sys.executable, "-c", FRESH, model_path, mart_path, out], check=True, cwd=root, timeout=300, capture_output=True)
    got = {r.tenant_id: r for r in spark.read.parquet(out).collect()}
    assert len(got) == 50
    assert all(r.churn_flag == int(r.churn_probability >= 0.4) or abs(r.churn_probability - 0.4) < 1e-4 for r in got.values())
    # A tenant of no known industry scores like one whose industries are all 0.
    vectors = feature_selection(churn_features(spark.read.parquet(mart_path), CFG), categories(mart))
    size = len(data.names)
    industries = [i for i, n in enumerate(data.names) if n.startswith("ind_")]
    assert all(v.features.size == size and not any(v.features[i] for i in industries) for v in vectors.select("features").collect())
    scored = training.score(learner, vectors).select("tenant_id", F.bround("score", 4).alias("p")).collect()
    assert {r.tenant_id: r.p for r in scored} == {t: r.churn_probability for t, r in got.items()}


def test_a_failed_save_leaves_the_old_model(spark, trained, tmp_path, monkeypatch):
    _, data, learner, _ = trained
    path = str(tmp_path / "model")
    model_store.save_model(model_store.churn_model(learner, data, CFG), path)
    with monkeypatch.context() as m:
        m.setattr(Folder, "publish", lambda *a: (_ for _ in ()).throw(KeyboardInterrupt))
        with pytest.raises(KeyboardInterrupt):
            model_store.save_model(model_store.churn_model(learner, data, HealthConfig(churn_threshold=0.7)), path)
    assert model_store.load_model(path).about.threshold == 0.4
    model_store.save_model(model_store.churn_model(learner, data, HealthConfig(churn_threshold=0.7)), path)
    assert model_store.load_model(path).about.threshold == 0.7
    with pytest.raises(FileNotFoundError):
        model_store.load_model(str(tmp_path / "none"))
