"""Distributed running totals, row numbers and the curves built on them."""

import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.sql import functions as F

from pulsemart.ml import metrics
from pulsemart.ml.training import stratified_folds
from pulsemart.operators.ranking import row_numbers, running_totals


@pytest.mark.parametrize("ranges", [1, 2, 7, 64])
def test_running_totals(spark, ranges):
    rng = random.Random(5)
    rows = [(float(s), rng.randint(0, 4)) for s in rng.sample(range(-500, 2000), 700)]
    got = running_totals(spark.createDataFrame(rows, "score DOUBLE, n INT"), "score", ["n"], ranges).collect()
    assert len(got) == len(rows)
    for r in got:
        assert r.cum_n == sum(n for s, n in rows if s >= r.score)
        assert r.all_n == sum(n for _, n in rows)


def test_row_numbers_are_gapless_and_ordered(spark):
    df = spark.range(5000).select(
        (F.col("id") % 7 == 0).cast("int").alias("label"), F.xxhash64("id").alias("h"), "id"
    )
    rows = row_numbers(df, "label", "h", buckets=16).collect()
    for label in (0, 1):
        mine = sorted((r.row_number, r.h) for r in rows if r.label == label)
        assert [n for n, _ in mine] == list(range(1, len(mine) + 1))
        assert [h % 16 for _, h in mine] == sorted(h % 16 for _, h in mine)


def test_folds_are_stratified_and_repeatable(spark):
    df = spark.range(1003).select(
        F.concat(F.lit("ten_"), "id").alias("tenant_id"), (F.col("id") % 6 == 0).cast("int").alias("label")
    )
    first = {r.tenant_id: (r.label, r.fold) for r in stratified_folds(df).collect()}
    again = {r.tenant_id: (r.label, r.fold) for r in stratified_folds(df.repartition(7)).collect()}
    assert first == again and len(first) == 1003
    for label in (0, 1):
        sizes = [sum(v == (label, fold) for v in first.values()) for fold in range(5)]
        assert max(sizes) - min(sizes) <= 1


def expected_auc(pairs):
    positive = [s for y, s in pairs if y == 1]
    negative = [s for y, s in pairs if y == 0]
    wins = sum((p > n) + 0.5 * (p == n) for p in positive for n in negative)
    return wins / (len(positive) * len(negative))


def expected_ap(pairs):
    total, area, hits, seen = sum(y for y, _ in pairs), 0.0, 0, 0
    for score in sorted({s for _, s in pairs}, reverse=True):
        here = [y for y, s in pairs if s == score]
        hits, seen = hits + sum(here), seen + len(here)
        area += sum(here) / total * hits / seen
    return area


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    st.lists(
        st.tuples(st.integers(0, 1), st.sampled_from([0.0, 0.1, 0.25, 0.3, 0.35, 0.5, 0.75, 1.0])),
        min_size=2,
        max_size=60,
    ).filter(lambda rows: 0 < sum(y for y, _ in rows) < len(rows))
)
def test_areas(spark, rows):
    df = spark.createDataFrame([(y, s, 1.0) for y, s in rows], "label INT, score DOUBLE, arr DOUBLE")
    got = metrics.ranking_quality(df, ranges=3).first()
    assert got.roc_auc == pytest.approx(expected_auc(rows))
    assert got.average_precision == pytest.approx(expected_ap(rows))


def test_area_agrees_with_spark_evaluator_when_a_third_of_rows_share_a_score(spark):
    rng = random.Random(9)
    rows = [(rng.randint(0, 1), 0.5 if rng.random() < 0.34 else rng.random()) for _ in range(4000)]
    df = spark.createDataFrame([(y, float(s)) for y, s in rows], "label INT, score DOUBLE")
    evaluator = BinaryClassificationEvaluator(rawPredictionCol="score", numBins=0)
    assert metrics.roc_auc(df).first()[0] == pytest.approx(evaluator.evaluate(df), abs=1e-6)
