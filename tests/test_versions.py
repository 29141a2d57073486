"""Replacing a table: what readers find before, during and after, and after failures."""

import os

import pytest
from pyspark.sql import functions as F

from pulsemart.sources import scan_events, scan_optional_parquet, scan_parquet, sink_parquet, versions

FAILS = "if(id = 7, raise_error('stopped'), id) as id"


def ids(df):
    return sorted(r.id for r in df.collect())


def parquet_files(path):
    return sorted(f for d, _, names in os.walk(path) for f in names if f.endswith(".parquet"))


def test_a_failed_write_leaves_the_old_table(spark, tmp_path):
    path = str(tmp_path / "t")
    sink_parquet(spark.range(5), path)
    before = parquet_files(path)
    with pytest.raises(Exception, match="stopped"):
        sink_parquet(spark.range(10, numPartitions=4).selectExpr(FAILS), path)
    assert ids(scan_parquet(spark, path)) == [0, 1, 2, 3, 4]
    sink_parquet(spark.range(2), path)
    assert ids(scan_parquet(spark, path)) == [0, 1]
    assert not set(before) & set(parquet_files(path))


@pytest.mark.parametrize("months", [False, True])
def test_a_write_killed_before_it_is_published(spark, tmp_path, monkeypatch, months):
    """All new files are there, the manifest is not: as after a kill between the two."""
    path = str(tmp_path / "t")
    by = "event_time" if months else None

    def events(n):
        return spark.range(n).select("id", F.date_add(F.lit("2024-01-10").cast("date"), (F.col("id") * 20).cast("int")).alias("event_time"))

    sink_parquet(events(4), path, by_month_of=by)
    old = parquet_files(path)
    with monkeypatch.context() as m:
        m.setattr(versions.Folder, "publish", lambda *a: (_ for _ in ()).throw(KeyboardInterrupt))
        with pytest.raises(KeyboardInterrupt):
            sink_parquet(events(9), path, by_month_of=by)
    assert set(old) < set(parquet_files(path))
    assert ids(scan_parquet(spark, path)) == ids(scan_events(spark, path)) == [0, 1, 2, 3]
    assert ids(scan_optional_parquet(spark, path, "id long, event_time date")) == [0, 1, 2, 3]
    # The next write takes the leftovers away.
    sink_parquet(events(2), path, by_month_of=by)
    assert ids(scan_parquet(spark, path)) == [0, 1] == ids(spark.read.parquet(path))
    if months:
        assert [d for d in sorted(os.listdir(path)) if d.startswith("event_month")] == ["event_month=2024-01"]


def test_a_first_write_that_fails_leaves_no_table(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    real = versions.Folder.publish
    with monkeypatch.context() as m:
        m.setattr(versions.Folder, "publish", lambda self, v: real(self, v) if not v.number else (_ for _ in ()).throw(KeyboardInterrupt))
        with pytest.raises(KeyboardInterrupt):
            sink_parquet(spark.range(5), path)
    assert parquet_files(path)
    assert scan_optional_parquet(spark, path, "id long").count() == 0
    with pytest.raises(FileNotFoundError):
        scan_parquet(spark, path)
    sink_parquet(spark.range(3), path)
    assert ids(scan_parquet(spark, path)) == [0, 1, 2]


def test_plain_folders_are_read_and_replaced(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(3).write.parquet(path)
    spark.range(3, 5).write.mode("append").parquet(path)
    assert ids(scan_parquet(spark, path)) == [0, 1, 2, 3, 4]
    with pytest.raises(Exception, match="stopped"):
        sink_parquet(spark.range(10).selectExpr(FAILS), path)
    assert ids(scan_parquet(spark, path)) == [0, 1, 2, 3, 4]
    sink_parquet(spark.range(1), path)
    assert ids(scan_parquet(spark, path)) == [0] == ids(spark.read.parquet(path))


def test_a_table_can_be_made_from_itself(spark, tmp_path):
    path = str(tmp_path / "t")
    sink_parquet(spark.range(4), path)
    for _ in range(2):
        sink_parquet(scan_parquet(spark, path).select((F.col("id") + 1).alias("id")), path)
    assert ids(scan_parquet(spark, path)) == [2, 3, 4, 5]
    assert len([f for f in os.listdir(path) if f.startswith("_manifest")]) == 1


def test_empty_tables_keep_their_columns(spark, tmp_path):
    path = str(tmp_path / "t")
    none = spark.createDataFrame([], "id long, event_time timestamp")
    sink_parquet(none, path, by_month_of="event_time")
    assert scan_parquet(spark, path).dtypes == [("id", "bigint"), ("event_time", "timestamp"), ("event_month", "string")]
    assert scan_events(spark, path).count() == 0
    sink_parquet(none, path)
    assert scan_parquet(spark, path).columns == ["id", "event_time"]


def test_two_writers_at_once_are_noticed(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    sink_parquet(spark.range(1), path)
    real = versions.Folder.publish

    def second_comes_first(self, version):
        monkeypatch.setattr(versions.Folder, "publish", real)
        real(self, versions.Version(version.number, ("other",), schema=version.schema))
        real(self, version)

    monkeypatch.setattr(versions.Folder, "publish", second_comes_first)
    with pytest.raises(RuntimeError, match="someone else"):
        sink_parquet(spark.range(2), path)
