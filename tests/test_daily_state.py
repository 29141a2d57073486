"""A state advanced batch by batch says what all events say."""

import random
from datetime import date

import pytest
from pyspark.sql import functions as F

from pulsemart import HealthConfig, jobs
from pulsemart.config import Window
from pulsemart.operators import cleaning, daily_state, usage
from pulsemart.plans import marts
from pulsemart.sources import sink_parquet, versions
from pulsemart.sources.schemas import RAW_SCHEMAS
from tests.compare import spark_rows
from tests.test_usage_bruteforce import make_events

CFG = HealthConfig()
SHORT = HealthConfig(windows=(Window("30d", 7), Window("60d", 20, 3), Window("90d", 124), Window("recent_4w", 62), Window("prior_4w", 125, 61)))


def events(spark, rows):
    return cleaning.clean_events(spark.createDataFrame(rows, RAW_SCHEMAS["events"]))


def results(df, cfg):
    return [
        spark_rows(f(df, cfg) if f is not usage.last_event else f(df))
        for f in (usage.event_windows, usage.last_event, usage.event_metrics, usage.pp_trend, usage.weekly_activity)
    ]


@pytest.mark.parametrize("cfg", [CFG, SHORT], ids=["default", "other windows"])
def test_equal_to_a_full_recomputation(spark, tmp_path, cfg):
    path = str(tmp_path / "state")
    rows = make_events(5)
    some = random.Random(1)
    # Days arrive in order, but for a tenth of the events, which come with any later batch.
    rows.sort(key=lambda r: r[4])
    batches = [[] for _ in range(4)]
    for i, row in enumerate(rows):
        own = 4 * i // len(rows)
        batches[some.randint(own, 3) if some.random() < 0.1 else own].append(row)
    sofar = []
    for number, batch in enumerate(batches):
        assert daily_state.advance(path, events(spark, batch), number, cfg)
        sofar += batch
        if number in (1, 3):
            assert results(daily_state.usage_state(spark, path), cfg) == results(events(spark, sofar), cfg)
    want = results(events(spark, rows), cfg)
    before = daily_state.usage_state(spark, path)
    assert before.agg(F.sum("event_rows")).first()[0] == sum(r[1] is not None for r in rows)
    many = before.count()
    daily_state.compact(spark, path, cfg)
    after = daily_state.usage_state(spark, path)
    assert after.count() < many < len(rows)
    assert results(after, cfg) == want
    # Batches that were there before the compaction are still known.
    assert not daily_state.advance(path, events(spark, batches[3]), 3, cfg)
    assert daily_state.advance(path, events(spark, batches[0][:5]), 4, cfg)
    assert results(daily_state.usage_state(spark, path), cfg) == results(events(spark, rows + batches[0][:5]), cfg)


def test_a_batch_is_added_once(spark, tmp_path, monkeypatch):
    """Killed before it is published, then tried again, then again."""
    path = str(tmp_path / "state")
    rows = make_events(6, 300)
    daily_state.advance(path, events(spark, rows[:200]), 1, CFG)
    real = versions.Folder.publish
    with monkeypatch.context() as m:
        m.setattr(versions.Folder, "publish", lambda *a: (_ for _ in ()).throw(KeyboardInterrupt))
        with pytest.raises(KeyboardInterrupt):
            daily_state.advance(path, events(spark, rows[200:]), 2, CFG)
    assert versions.Folder.publish is real
    assert results(daily_state.usage_state(spark, path), CFG) == results(events(spark, rows[:200]), CFG)
    assert daily_state.advance(path, events(spark, rows[200:]), 2, CFG)
    assert not daily_state.advance(path, events(spark, rows[200:]), 2, CFG)
    assert not daily_state.advance(path, events(spark, rows[:200]), 1, CFG)
    assert results(daily_state.usage_state(spark, path), CFG) == results(events(spark, rows), CFG)


def test_empty_batches(spark, tmp_path):
    path = str(tmp_path / "state")
    none = events(spark, make_events(7, 1)).limit(0)
    assert daily_state.advance(path, none, 0, CFG)
    assert daily_state.usage_state(spark, path).count() == 0
    assert daily_state.advance(path, events(spark, make_events(7, 50)), 1, CFG)
    assert daily_state.advance(path, none, 2, CFG)
    assert results(daily_state.usage_state(spark, path), CFG) == results(events(spark, make_events(7, 50)), CFG)


def test_only_the_months_needed_are_read(spark, tmp_path):
    path = str(tmp_path / "state")
    daily_state.advance(path, events(spark, make_events(8, 400)), 0, CFG)
    state = daily_state.usage_state(spark, path, date(2024, 5, 1))
    plan = state._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(event_month" in plan
    assert state.count() > 0 and state.agg(F.min("event_date")).first()[0] >= date(2024, 5, 1)


def test_marts_from_the_state(spark, tmp_path):
    """The jobs give the same marts from events and from a state that came in two batches."""
    rows = make_events(9, 600)
    raw = spark.createDataFrame(rows, RAW_SCHEMAS["events"])
    out = str(tmp_path / "out")
    for number, part in enumerate((rows[:400], rows[400:])):
        assert jobs.usage_job(spark.createDataFrame(part, RAW_SCHEMAS["events"]), out, number)
    sink_parquet(cleaning.clean_events(raw), jobs.clean_path(out, "events"), by_month_of="event_time")
    for build in (lambda t: marts.mart_weekly_activity(t, CFG), lambda t: usage.event_metrics(t.events, CFG)):
        assert spark_rows(build(jobs.clean_tables(spark, out, from_state=True))) == spark_rows(build(jobs.clean_tables(spark, out)))
