"""Compare a Spark result with DuckDB's, as sorted rows with columns sorted by name."""

from __future__ import annotations

import math
from pathlib import Path

import duckdb
from pyspark.sql import DataFrame

DRIVER_TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
]


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in DRIVER_TABLES:
        path = Path(sf_dir) / f"{table}.parquet"
        if path.exists():
            con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{path}')")
    return con


def _value(v):
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return repr(v + 0.0)
    if isinstance(v, bool):
        return str(v)
    return None if v is None else str(v)


def _sorted(names: list[str], rows) -> tuple[list[str], list[tuple]]:
    order = sorted(range(len(names)), key=lambda i: names[i])
    out = [tuple(_value(r[i]) for i in order) for r in rows]
    return [names[i] for i in order], sorted(out, key=lambda r: tuple((v is None, v or "") for v in r))


def spark_rows(df: DataFrame):
    return _sorted(df.columns, [tuple(r) for r in df.collect()])


def duck_rows(con, sql: str):
    cursor = con.execute(sql)
    return _sorted([d[0] for d in cursor.description], cursor.fetchall())
