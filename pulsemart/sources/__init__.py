from pulsemart.sources.readers import (
    scan_csv_tables,
    scan_events,
    scan_optional_csv,
    scan_optional_parquet,
    scan_parquet,
    scan_sql_table,
)
from pulsemart.sources.sinks import sink_csv_report, sink_parquet

__all__ = [
    "scan_csv_tables",
    "scan_events",
    "scan_optional_csv",
    "scan_optional_parquet",
    "scan_parquet",
    "scan_sql_table",
    "sink_csv_report",
    "sink_parquet",
]
