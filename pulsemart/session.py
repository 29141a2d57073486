"""Session settings the jobs rely on, and the shared folder for intermediate tables."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterable, Iterator
from contextlib import contextmanager
from multiprocessing.pool import ThreadPool
from typing import TypeVar

from pyarrow.fs import FileSystem, FileType
from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

T = TypeVar("T")

# Tables written inside the open `temporary_tables` blocks.
_scopes: list[list[str]] = []

# Nothing here depends on the size of an input: shuffles start with as many partitions as the
# cluster's owner has set (spark.sql.adaptive.coalescePartitions.initialPartitionNum, or
# spark.sql.shuffle.partitions) and are merged at run time to the advisory size.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
}


def local_session(cores: str = "8", app: str = "pulsemart", **extra: str) -> SparkSession:
    """A single-machine session for tests and the benchmark; a cluster brings its own."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    defaults = {
        **SETTINGS,
        "spark.sql.shuffle.partitions": cores if cores.isdigit() else "8",
        "spark.ui.enabled": "false",
        "spark.driver.memory": "8g",
        **extra,
    }
    for key, value in defaults.items():
        builder = builder.config(key, value)
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    return session


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach, from ``spark.checkpoint.dir``.

    Only a local session may fall back to a folder of its own: on a cluster an
    executor's private disk would lose the data with the executor.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    context = spark.sparkContext
    if not folder:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
        folder = context.getCheckpointDir() or tempfile.mkdtemp(prefix="pulsemart-")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(folder)
    return folder


def new_table_path(spark: SparkSession, name: str) -> str:
    """Fresh path below the shared folder, so no run overwrites another's tables."""
    path = f"{shared_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    if _scopes:
        _scopes[-1].append(path)
    return path


@contextmanager
def temporary_tables() -> Iterator[None]:
    """Delete, at the end, the tables written through `new_table_path` inside this block.

    For callers whose results are written out by then; elsewhere a lazy result may still
    read them, and clearing old tables is left to the retention of the shared folder.
    """
    paths: list[str] = []
    _scopes.append(paths)
    try:
        yield
    finally:
        _scopes.remove(paths)
        for path in paths:
            system, place = FileSystem.from_uri(path)
            if system.get_file_info(place).type == FileType.Directory:
                system.delete_dir(place)


def side_by_side(spark: SparkSession, steps: Iterable[Callable[[], T]]) -> list[T]:
    """The results of independent steps, each of which runs its own jobs: their tasks share the executors."""
    steps = list(steps)
    with ThreadPool(max(len(steps), 1)) as pool:
        return pool.map(inheritable_thread_target(spark)(lambda step: step()), steps)


def cut_lineage(df: DataFrame, name: str = "step") -> DataFrame:
    """Write ``df`` to the shared folder and continue from there.

    The table outlives the executors that computed it, and its size is known to
    the planner. Folders are unique per call; see `temporary_tables`.
    """
    path = new_table_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
