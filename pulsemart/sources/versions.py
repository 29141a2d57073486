"""Table versions: a folder's manifest names the write whose files make up the table.

All files of a Spark write carry its id in their names. A write adds its files next to the old
ones and then publishes a manifest that names it; readers take the files of the write named by
the latest manifest, by a filter on names. A write that fails or is killed before that leaves
the old table, and a first one leaves none. Only then the old files go.
"""

from __future__ import annotations

import hashlib
import json
import re
import uuid
from collections.abc import Callable
from dataclasses import asdict, dataclass, replace
from multiprocessing.pool import ThreadPool

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

MANIFEST = "_manifest-"
WRITE_ID = r"^part-\d+-([0-9a-f]{8}(?:-[0-9a-f]{4}){3}-[0-9a-f]{12})"


@dataclass(frozen=True)
class Version:
    """``number`` grows with every publication; ``writes`` are ids in names of files, ``folder`` a
    subfolder for what is no table, ``schema`` the columns as JSON, ``through`` the last batch
    that was added, ``buckets`` and ``bucketed_by`` how rows are dealt to files."""

    number: int
    writes: tuple[str, ...] = ()
    folder: str | None = None
    schema: str | None = None
    through: int | None = None
    buckets: int | None = None
    bucketed_by: str | None = None


class Folder:
    """A folder in any file system Spark reaches."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self._paths = spark._jvm.org.apache.hadoop.fs.Path
        self.files = self._paths(self.path).getFileSystem(spark._jsc.hadoopConfiguration())

    def place(self, name: str):
        return self._paths(f"{self.path}/{name}")

    def read(self, name: str) -> str:
        stream = self.files.open(self.place(name))
        try:
            return self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def write(self, name: str, text: str):
        """The place of a small file with this text."""
        place = self.place(name)
        stream = self.files.create(place, True)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()
        return place

    def manifests(self) -> list[str]:
        found = self.files.globStatus(self.place(f"{MANIFEST}*"))
        return sorted(status.getPath().getName() for status in found or [])

    def current(self) -> Version | None:
        """The version of the latest manifest; None without one."""
        names = self.manifests()
        if not names:
            return None
        values = json.loads(self.read(names[-1]))
        return Version(**{**values, "writes": tuple(values["writes"])})

    def publish(self, version: Version) -> None:
        """Complete under another name first: a manifest is there whole or not at all."""
        hidden = self.write(f"_new-{uuid.uuid4().hex}", json.dumps(asdict(version)))
        name = f"{MANIFEST}{version.number:012d}"
        if self.files.exists(self.place(name)) or not self.files.rename(hidden, self.place(name)):
            self.files.delete(hidden, False)
            raise RuntimeError(f"{self.path} was written by someone else at the same time")
        for older in self.manifests():
            if older < name:
                self.files.delete(self.place(older), False)

    def first_table_file(self) -> str | None:
        """The name of one file of a table."""
        found = self.files.listFiles(self._paths(self.path), True)
        while found.hasNext():
            name = found.next().getPath().getName()
            if name.endswith(".parquet"):
                return name
        return None

    def exists(self) -> bool:
        return self.files.exists(self._paths(self.path))

    def delete_all(self, paths: list[str]) -> None:
        with ThreadPool(16) as pool:
            pool.map(lambda path: self.files.delete(self._paths(path), True), paths)


def data_files(spark: SparkSession, path: str) -> DataFrame:
    """(path, id) of all files of tables below a folder, listed by Spark; a foreign file's id is its name."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.parquet").load(path)
    name = F.regexp_extract("path", "[^/]*$", 0)
    own = F.regexp_extract(name, WRITE_ID, 1)
    return files.select("path", F.when(own != "", own).otherwise(name).alias("id"))


def _ids(spark: SparkSession, path: str) -> set[str]:
    """As many as writes have files there: one, or a few more after failures."""
    return {r.id for r in data_files(spark, path).select("id").distinct().collect()}


def _first_id(folder: Folder) -> set[str]:
    """The id in a folder that only one write has files in, without listing them all."""
    name = folder.first_table_file()
    return set() if name is None else {re.match(WRITE_ID, name).group(1)}


def _written(
    df: DataFrame, path: str, partition_by: tuple[str, ...], write: Callable[[DataFrame, str], None] | None = None
) -> tuple[Folder, Version, set[str], Version]:
    """Add the files of ``df``: (folder, version before, ids of all files before, a version of the new ones alone)."""
    spark = df.sparkSession
    folder = Folder(spark, path)
    fresh = not folder.exists()
    before = None if fresh else folder.current()
    old = set() if fresh else _ids(spark, path)
    if before is None:
        # From now on only files of writes that are named count.
        before = Version(0, tuple(sorted(old)))
        folder.publish(before)
    if write is None:
        df.write.mode("append").partitionBy(*partition_by).parquet(path)
    else:
        write(df, path)
    written = _ids(spark, path) - old if not fresh else _first_id(folder)
    if len(written) > 1:
        raise RuntimeError(f"{path} was written by someone else at the same time")
    last = [df.schema[c] for c in partition_by]
    schema = StructType([f for f in df.schema if f.name not in partition_by] + last)
    return folder, before, old, Version(before.number + 1, tuple(written), schema=schema.json(), through=before.through)


def replace_table(df: DataFrame, path: str, partition_by: tuple[str, ...] = ()) -> None:
    """Make ``df`` the table at ``path``; until that is complete readers find the table there was.

    ``df`` may read that table itself. One writer at a time: two that overlap are noticed when
    the second publishes. Files of the old table and of failed writes go at the end.
    """
    folder, _, old, version = _written(df, path, partition_by)
    _publish_alone(folder, version, old, partition_by)


def replace_bucketed(df: DataFrame, path: str, column: str, buckets: int) -> None:
    """Like `replace_table`, with the rows dealt to ``buckets`` by ``column`` and sorted by it.

    `read_table` gives them to Spark as such, so joins and aggregates by that column need no
    shuffle on this side. Rows of a bucket come together by a shuffle that splits large ones,
    into as many files.
    """

    def write(rows: DataFrame, place: str) -> None:
        name = _register(rows.sparkSession, place, rows.schema, column, buckets, {}, uuid.uuid4().hex)
        try:
            rows.hint("rebalance", column).write.mode("append").insertInto(name)
        finally:
            # The files stay: the table only lent its layout.
            rows.sparkSession.sql(f"DROP TABLE {name}")

    folder, _, old, version = _written(df, path, (), write)
    _publish_alone(folder, replace(version, buckets=buckets, bucketed_by=column), old, ())


def _register(spark: SparkSession, path: str, schema: StructType, column: str, buckets: int, options: dict[str, str], key: str) -> str:
    """The name of a session's table over bucketed files."""
    name = f"pulsemart_{key}"
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
    given = ", ".join(f"'{k}' '{v}'" for k, v in {"path": path, **options}.items())
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet OPTIONS ({given}) "
        f"CLUSTERED BY (`{column}`) SORTED BY (`{column}`) INTO {buckets} BUCKETS"
    )
    return name


def _publish_alone(folder: Folder, version: Version, old: set[str], partition_by: tuple[str, ...]) -> None:
    """Publish a version and take the files of all others away."""
    folder.publish(version)
    if old:
        gone = data_files(folder.spark, folder.path).where(F.col("id").isin(sorted(old))).select("path")
        folder.delete_all([r.path for r in gone.collect()])
        _drop_empty(folder, partition_by)


def add_batch(df: DataFrame, path: str, batch: int, partition_by: tuple[str, ...] = ()) -> bool:
    """Add ``df`` to the table at ``path`` as its batch of that number; false if that was already done.

    Numbers of batches rise. Files and number are published together, so a batch is there once
    or not at all, however often it is tried.
    """
    folder = Folder(df.sparkSession, path)
    current = folder.current() if folder.exists() else None
    if current is not None and current.through is not None and batch <= current.through:
        return False
    folder, before, _, version = _written(df, path, partition_by)
    folder.publish(replace(version, writes=(*before.writes, *version.writes), through=batch))
    return True


def _drop_empty(folder: Folder, partition_by: tuple[str, ...]) -> None:
    """Partition folders that the new table does not use."""
    if partition_by:
        for status in folder.files.globStatus(folder.place(f"{partition_by[0]}=*")) or []:
            if not folder.files.listFiles(status.getPath(), True).hasNext():
                folder.files.delete(status.getPath(), True)


def table_exists(spark: SparkSession, path: str) -> bool:
    """Whether a complete table is there: one whose write was published, or a folder or file without manifests."""
    folder = Folder(spark, path)
    version = folder.current()
    if version is None:
        return folder.exists()
    return bool(version.writes) or version.schema is not None


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """The current version of a table, or a plain Parquet folder or file."""
    version = Folder(spark, path).current()
    if version is None:
        return spark.read.parquet(path)
    if not table_exists(spark, path):
        raise FileNotFoundError(f"{path}: no write of this table was completed")
    named = f"*{{{','.join(version.writes)}}}*" if version.writes else "none"
    schema = None if version.schema is None else StructType.fromJson(json.loads(version.schema))
    if version.buckets is not None:
        key = hashlib.sha256(f"{path} {named}".encode()).hexdigest()[:32]
        return spark.table(_register(spark, path, schema, version.bucketed_by, version.buckets, {"pathGlobFilter": named}, key))
    reader = spark.read.option("pathGlobFilter", named)
    return (reader if schema is None else reader.schema(schema)).parquet(path)
