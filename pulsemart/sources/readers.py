"""Table scans: CSV, SQL tables, Parquet (required and optional)."""

from __future__ import annotations

from datetime import date
from functools import partial

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, IntegerType, LongType, StringType, StructField, StructType

from pulsemart.functions import flag, instant_literal
from pulsemart.session import side_by_side
from pulsemart.sources.csv_records import csv_records, has_line_breaks, parse_records
from pulsemart.sources.schemas import MALFORMED, RAW_SCHEMAS, SEQUENCE, SEQUENCED, TABLES, YES_NO
from pulsemart.sources.sinks import sink_parquet
from pulsemart.sources.versions import Folder, read_table, table_exists


def path_exists(spark: SparkSession, path: str) -> bool:
    """Look through the file system Spark itself uses (HDFS, object store or local)."""
    return Folder(spark, path).exists()


def _schema(ddl: str) -> StructType:
    return StructType.fromDDL(ddl)


def _typed(name: str, kind: DataType) -> Column:
    """Text to the declared type. Exporters write whole numbers as ``5.0`` where a column has
    gaps; yes/no columns hold 0/1 or True/False. Other text is NULL."""
    text = F.col(name)
    if name in YES_NO:
        return F.when(text.isNotNull(), flag(name).cast("int")).alias(name)
    if isinstance(kind, (IntegerType, LongType)):
        number = text.try_cast("double")
        whole = F.when(number == F.floor(number), number).try_cast(kind)
        return F.coalesce(text.try_cast(kind), whole).alias(name)
    return text.try_cast(kind).alias(name)


def csv_columns(spark: SparkSession, path: str) -> list[str]:
    """Names in the header; every file of a folder must have the same ones in the same order."""
    return spark.read.option("header", True).option("escape", '"').csv(path).columns


def missing_columns(spark: SparkSession, table: str, path: str) -> list[str]:
    there = set(csv_columns(spark, path))
    return [f.name for f in _schema(RAW_SCHEMAS[table]) if f.name not in there]


def scan_csv_table(spark: SparkSession, table: str, path: str, multi_line: bool | None = None) -> DataFrame:
    """One header CSV, or a folder of them, with the declared columns, found by name.

    A quoted value may hold line breaks. Files are read in byte ranges by many tasks either way:
    by Spark's own line reader if a first scan finds no line that could leave a quoted value
    open, else by `csv_records`. ``multi_line`` skips that scan: false if no value holds a line
    break, true if some may.
    ``MALFORMED`` marks rows with more or fewer values than the header has names. Tenants
    also get their position: file by file in the order of their names, and down the lines.
    """
    names = csv_columns(spark, path)
    corrupt = "_corrupt"
    if has_line_breaks(spark, path) if multi_line is None else multi_line:
        raw = parse_records(csv_records(spark, path, names), names, corrupt)
        place = F.struct("file", "block", F.col("number").alias("line"))
    else:
        raw, place = _csv_by_lines(spark, path, names, corrupt)
    position = [place.alias(SEQUENCE)] if table in SEQUENCED else []
    typed = [_typed(f.name, f.dataType) for f in _schema(RAW_SCHEMAS[table])]
    return raw.select(*typed, F.col(corrupt).isNotNull().alias(MALFORMED), *position)


def _csv_by_lines(spark: SparkSession, path: str, names: list[str], corrupt: str) -> tuple[DataFrame, Column]:
    read_as = StructType([StructField(n, StringType()) for n in names] + [StructField(corrupt, StringType())])
    raw = (
        spark.read.schema(read_as)
        .option("header", True)
        .option("enforceSchema", False)
        .option("escape", '"')
        .option("columnNameOfCorruptRecord", corrupt)
        .csv(path)
    )
    # The file's name goes before the task's numbering: Spark reads larger files first.
    place = F.struct(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("line"),
    )
    return raw, place


def scan_csv_tables(
    spark: SparkSession,
    folder: str,
    target: str | None = None,
    skip_existing: bool = True,
    multi_line: bool | None = None,
) -> dict[str, DataFrame]:
    """The six source tables from ``folder/<table>.csv``.

    All missing files and columns are reported at once. With ``target`` the tables are also
    written there as Parquet and read back, so that every CSV is parsed once; existing ones
    are kept, or replaced when ``skip_existing`` is false.
    """
    paths = {table: f"{folder.rstrip('/')}/{table}.csv" for table in TABLES}
    missing = [path for path in paths.values() if not path_exists(spark, path)]
    there = [table for table, path in paths.items() if path not in missing]
    for table, columns in zip(there, side_by_side(spark, [partial(missing_columns, spark, t, paths[t]) for t in there])):
        missing += [f"{paths[table]}: {column}" for column in columns]
    if missing:
        raise FileNotFoundError(f"missing CSV files or columns: {missing}")
    scans = [partial(scan_csv_table, spark, t, paths[t], multi_line) for t in TABLES]
    tables = dict(zip(TABLES, side_by_side(spark, scans)))
    if target is None:
        return tables
    places = {table: f"{target.rstrip('/')}/{table}" for table in TABLES}
    wanted = [t for t in TABLES if not (skip_existing and table_exists(spark, places[t]))]
    side_by_side(spark, [partial(sink_parquet, tables[t], places[t]) for t in wanted])
    return {table: scan_parquet(spark, place) for table, place in places.items()}


def scan_sql_table(spark: SparkSession, table: str) -> DataFrame:
    """Full scan of a catalog table or view."""
    return spark.table(table)


def scan_parquet(spark: SparkSession, path: str) -> DataFrame:
    """The last complete version of a table `sink_parquet` wrote, or any Parquet folder."""
    return read_table(spark, path)


def scan_events(spark: SparkSession, path: str, since: date | None = None) -> DataFrame:
    """Clean events from ``since`` on; the month folders before it are never listed."""
    events = read_table(spark, path)
    if since is None:
        return events
    if "event_month" in events.columns:
        events = events.where(F.col("event_month") >= F.lit(since.strftime("%Y-%m")))
    return events.where(F.col("event_time") >= instant_literal(since))


def scan_optional_parquet(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The table, or an empty one with the same columns when it was never written, or not completely."""
    if table_exists(spark, path):
        return read_table(spark, path)
    return spark.createDataFrame([], _schema(schema))


def scan_optional_csv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Like `scan_optional_parquet`, for reports written as CSV."""
    if path_exists(spark, path):
        return spark.read.schema(_schema(schema)).option("header", True).csv(path)
    return spark.createDataFrame([], _schema(schema))
