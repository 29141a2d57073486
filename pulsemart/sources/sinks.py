"""Writers for clean tables, marts and reports."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsemart.sources.versions import replace_table


def sink_parquet(
    df: DataFrame, path: str, by_month_of: str | None = None, in_time_order: bool = False
) -> None:
    """Replace the table at ``path``, or leave it as it was if the job fails: see `versions`.

    ``by_month_of`` lays a time series out in month folders so that look-back
    scans prune. One shuffle brings the rows of a month together first: large
    months are split over several tasks, small ones share one, so there are
    about as many files as months or full-sized parts. Input known to be
    ``in_time_order`` is written without it, a file per task and month it holds.
    """
    if by_month_of is None:
        replace_table(df, path)
        return
    monthly = df.withColumn("event_month", F.date_format(F.col(by_month_of).cast("date"), "yyyy-MM"))
    if not in_time_order:
        monthly = monthly.hint("rebalance", "event_month")
    replace_table(monthly, path, ("event_month",))


def sink_csv_report(df: DataFrame, path: str, order_by: list[str] | None = None) -> None:
    """One CSV part with a header, also when there are no rows.

    For reports whose size is bounded by the schema (a row per check, feature or
    model), so a single part is safe.
    """
    out = df.repartition(1)
    if order_by:
        out = out.sortWithinPartitions(*order_by)
    out.write.mode("overwrite").option("header", True).csv(path)
