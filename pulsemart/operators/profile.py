"""Column profile of a table, used to compare what was written with what is read back."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def column_profile(df: DataFrame, table: str) -> DataFrame:
    """Per column: rows, present values and the ends of its text order, from one aggregation.

    The line of column ``*`` holds the sum of a hash of every whole row: values that were
    altered, or swapped between rows, change it, the order of the rows does not.
    """
    measures = []
    for i, c in enumerate(df.columns):
        text = F.col(c).cast("string")
        measures += [F.count(c).alias(f"n{i}"), F.min(text).alias(f"lo{i}"), F.max(text).alias(f"hi{i}")]
    shown = [F.coalesce(F.col(c).cast("string"), F.lit("<null>")) for c in df.columns]
    digits = F.substring(F.md5(F.concat_ws("|", *shown)), 1, 15)
    row_hash = F.conv(digits, 16, 10).cast("decimal(20,0)")
    totals = df.agg(F.count("*").alias("n_rows"), F.sum(row_hash).cast("string").alias("checksum"), *measures)
    whole = F.struct(
        F.lit(table).alias("table_name"),
        F.lit("*").alias("column_name"),
        F.col("n_rows"),
        F.col("n_rows").alias("n_present"),
        F.col("checksum").alias("smallest"),
        F.col("checksum").alias("largest"),
    )
    lines = [whole] + [
        F.struct(
            F.lit(table).alias("table_name"),
            F.lit(c).alias("column_name"),
            F.col("n_rows"),
            F.col(f"n{i}").alias("n_present"),
            F.col(f"lo{i}").alias("smallest"),
            F.col(f"hi{i}").alias("largest"),
        )
        for i, c in enumerate(df.columns)
    ]
    return totals.select(F.inline(F.array(*lines)))
