"""Where intermediate tables go."""

import os
from types import SimpleNamespace

import pytest

from pulsemart import session


class FakeContext:
    def __init__(self, master, folder=None):
        self.master, self.folder = master, folder

    def getCheckpointDir(self):
        return self.folder

    def setCheckpointDir(self, folder):
        self.folder = folder


def fake(master, configured=None):
    conf = SimpleNamespace(get=lambda key, default=None: configured if key == "spark.checkpoint.dir" else default)
    return SimpleNamespace(conf=conf, sparkContext=FakeContext(master))


def test_configured_folder_is_used():
    spark = fake("yarn", "hdfs://shared/checkpoints")
    assert session.shared_folder(spark) == "hdfs://shared/checkpoints"
    assert spark.sparkContext.folder == "hdfs://shared/checkpoints"
    assert session.new_table_path(spark, "x").startswith("hdfs://shared/checkpoints/x-")


def test_cluster_without_a_shared_folder_is_an_error():
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.shared_folder(fake("yarn"))


def test_local_session_falls_back_to_one_folder_of_its_own():
    spark = fake("local[4]")
    first = session.shared_folder(spark)
    assert first and session.shared_folder(spark) == first


def test_cut_lineage_starts_a_new_plan(spark):
    df = spark.range(100).selectExpr("id % 7 AS k", "id").groupBy("k").count()
    cut = session.cut_lineage(df)
    plan = cut._jdf.queryExecution().executedPlan().toString()
    assert "FileScan parquet" in plan and "Aggregate" not in plan
    assert sorted(map(tuple, cut.collect())) == sorted(map(tuple, df.collect()))


def test_temporary_tables_go_with_their_block(spark):
    with session.temporary_tables():
        inside = session.new_table_path(spark, "inside")
        spark.range(3).write.parquet(inside)
        assert spark.read.parquet(inside).count() == 3
    outside = session.new_table_path(spark, "outside")
    spark.range(3).write.parquet(outside)
    assert not os.path.exists(inside) and os.path.exists(outside)
