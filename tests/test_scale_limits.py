"""No caps: categories, account managers; exact money, title case, checks that can fail."""

import pytest
from pyspark.sql import functions as F

from pulsemart.functions import money_avg, money_sum, title
from pulsemart.ml import checks, features, metrics
from pulsemart.ml.training import KEEP
from pulsemart.sources.driver_tables import RawTables


def test_three_thousand_industries(spark):
    base = [F.col("id").cast("double").alias(c) for c in features.BASE_FEATURES]
    df = spark.range(3000).select(
        F.concat(F.lit("ten_"), "id").alias("tenant_id"), *base, F.lit("a.b `c`").alias("acquisition_source"),
        F.lit(None).cast("string").alias("region"), F.concat(F.lit("i"), F.lpad(F.col("id").cast("string"), 4, "0")).alias("industry"),
    )
    pairs = features.categories(df)
    names = features.feature_names(pairs)
    assert len(names) == len(features.BASE_FEATURES) + 1 + 1 + 3000
    rows = features.feature_selection(df, pairs).select("industry", "arr", "features").where("arr % 500 = 7").collect()
    for r in rows:
        vector = r.features.toArray()
        shown = {names[i] for i in range(len(features.BASE_FEATURES), len(names)) if vector[i]}
        assert len(vector) == len(names) and vector[0] == r.arr
        assert shown == {"src_a.b `c`", "rgn_unknown", f"ind_{r.industry}"}
    unseen = features.feature_selection(df.withColumn("industry", F.lit("new")).limit(1), pairs).first().features
    assert unseen.toArray()[len(features.BASE_FEATURES) + 2 :].sum() == 0


def test_every_account_manager_is_used(spark, sf_dir):
    tenants = RawTables(spark, sf_dir)["tenants"]
    suppliers = spark.read.parquet(f"{sf_dir}/supplier.parquet").count()
    found = tenants.select("csm_assigned").distinct().count()
    assert found == min(suppliers, tenants.select("tenant_id").distinct().count())


def test_money_does_not_depend_on_the_order(spark):
    values = [(2e10 + i / 100,) for i in range(1000)] + [(None,)]
    df = spark.createDataFrame(values, "arr DOUBLE")
    sums = {df.repartition(n).agg(money_sum(F.col("arr"))).first()[0] for n in (1, 3, 7)}
    assert sums == {20000000004995.0}
    assert df.agg(money_avg(F.col("arr"))).first()[0] == 20000000004995.0 / 1000
    none = df.where("arr IS NULL").agg(money_sum(F.col("arr")), money_avg(F.col("arr"))).first()
    assert tuple(none) == (0.0, None)


def test_title_case(spark):
    df = spark.createDataFrame([("self-serve",), ("PAID search 2x",), ("élan",), ("",), (None,)], "c string")
    assert [r[0] for r in df.select(title(F.col("c"))).collect()] == ["Self-Serve", "Paid Search 2X", "Élan", "", None]


def test_curves_are_lazy(spark):
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("lazy", "no job may run")
    try:
        scored = spark.range(1000).select((F.col("id") / 1000).alias("score"), (F.col("id") % 3 == 0).cast("int").alias("label"))
        metrics.roc_auc(scored)
        metrics.pr_curve(scored)
        assert not tracker.getJobIdsForGroup("lazy")
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_checks_can_fail(spark):
    carried = {c: F.lit(None) for c in KEEP}
    rows = spark.createDataFrame([(0.4, 1), (0.4, 0), (1.2, 1), (0.35, 0), (None, 0)], "churn_probability DOUBLE, churn_flag INT")
    got = checks.checked_predictions(rows.withColumns(carried)).select("in_range", "flag_agrees").collect()
    assert [tuple(r) for r in got] == [(True, True), (True, False), (False, True), (True, True), (False, None)]
    weights = spark.createDataFrame([("a", 0.5), ("b", 0.7)], "feature STRING, importance DOUBLE")
    assert {r.total for r in checks.checked_importance(weights).collect()} == {1.2}
    leak = spark.createDataFrame([(0.6,)], "leaky_cv_roc_auc DOUBLE")
    clean = spark.createDataFrame([(0.7,)], "cv_roc_auc_mean DOUBLE")
    assert checks.checked_leak(leak, clean).first().leak_shows is False


@pytest.mark.parametrize("swap", [False, True])
def test_profile_sees_swapped_values(spark, swap):
    from pulsemart.operators.profile import column_profile

    rows = [("a", 1), ("b", 2)]
    other = [("a", 2), ("b", 1)] if swap else rows[::-1]
    one, two = (sorted(map(tuple, column_profile(spark.createDataFrame(r, "x string, y int"), "t").collect())) for r in (rows, other))
    assert (one == two) is not swap
