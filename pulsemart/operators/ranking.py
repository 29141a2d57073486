"""Running totals and row numbers over a whole table, without a one-task window.

A window without PARTITION BY moves every row into one task. Here rows first go
to ranges of the ordering key; a range needs only the total of the ranges
before it, and those are a handful of rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def _tasks(df: DataFrame) -> int:
    """As many ranges as shuffles have tasks, so that their number grows with the cluster's setting."""
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def range_cuts(df: DataFrame, column: str, ranges: int) -> Column:
    """At most ``ranges - 1`` cut points that split the rows about evenly, as a subquery of the plan.

    They only balance the work: any cut points give the same, exact result.
    """
    shares = [i / ranges for i in range(1, ranges)]
    value = F.col(column).cast("double")
    return df.select(F.array_distinct(F.percentile_approx(value, shares)).alias("cuts")).scalar()


def _range_of(df: DataFrame, column: str, ranges: int) -> Column:
    if ranges < 2:
        return F.lit(0)
    value = F.col(column).cast("double")
    placed = F.sort_array(F.array_append(range_cuts(df, column, ranges), value))
    return F.array_position(placed, value)


def _with_offsets(
    df: DataFrame, keys: Sequence[str], bucket_order: Column, totals: dict[str, Column]
) -> DataFrame:
    """Add, per total, its sum over all earlier buckets of the same keys and over all buckets."""
    earlier = W.partitionBy(*keys).orderBy(bucket_order).rowsBetween(W.unboundedPreceding, -1)
    every = W.partitionBy(*keys)
    offsets = (
        df.groupBy(*keys, "bucket")
        .agg(*[total.alias(name) for name, total in totals.items()])
        .select(
            *keys,
            "bucket",
            *[F.coalesce(F.sum(name).over(earlier), F.lit(0)).alias(f"{name}_before") for name in totals],
            *[F.sum(name).over(every).alias(f"{name}_all") for name in totals],
        )
    )
    # One row per key and bucket: far below the size where a broadcast could hurt.
    return df.join(F.broadcast(offsets), [*keys, "bucket"])


def running_totals(df: DataFrame, order: str, sums: Sequence[str], ranges: int | None = None) -> DataFrame:
    """``cum_<c>``: sum of ``c`` over all rows with ``order`` at or above this row's;
    ``all_<c>``: over all rows.

    ``order`` must be distinct per row, so no group of equal values can pile up.
    """
    bucketed = df.withColumn("bucket", _range_of(df, order, ranges or _tasks(df)))
    placed = _with_offsets(bucketed, [], F.col("bucket").desc(), {c: F.sum(c) for c in sums})
    inside = W.partitionBy("bucket").orderBy(F.col(order).desc()).rowsBetween(W.unboundedPreceding, 0)
    return placed.select(
        *df.columns,
        *[(F.col(f"{c}_before") + F.sum(c).over(inside)).alias(f"cum_{c}") for c in sums],
        *[F.col(f"{c}_all").alias(f"all_{c}") for c in sums],
    )


def row_numbers(df: DataFrame, strata: str, hashed: str, buckets: int | None = None) -> DataFrame:
    """``row_number`` 1..n within each stratum, in the order of a hash column.

    Buckets are ranges of an evenly spread hash, so each holds 1/buckets of a
    stratum even when there are only two strata.
    """
    bucketed = df.withColumn("bucket", F.pmod(F.col(hashed), F.lit(buckets or _tasks(df))))
    placed = _with_offsets(bucketed, [strata], F.col("bucket"), {"rows": F.count("*")})
    inside = W.partitionBy(strata, "bucket").orderBy(hashed)
    number = F.col("rows_before") + F.row_number().over(inside)
    return placed.select(*df.columns, number.alias("row_number"))
