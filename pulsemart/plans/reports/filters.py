"""Filter choices and the filter every page applies first."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsemart.config import TIERS

DIMENSIONS = {"plan": "plan", "region": "region", "csm": "csm_assigned"}


def filter_options(mart: DataFrame, tiers: Sequence[str] = TIERS) -> DataFrame:
    """Distinct values per dimension from one scan, plus the fixed tier list, in display order."""
    found = (
        mart.select(*[F.col(c).alias(name) for name, c in DIMENSIONS.items()])
        .unpivot([], list(DIMENSIONS), "dimension", "value")
        .where(F.col("value").isNotNull())
        .distinct()
        .withColumn("position", F.lit(0))
    )
    fixed = mart.sparkSession.range(1).select(
        F.inline(
            F.array(
                *[
                    F.struct(
                        F.lit("tier").alias("dimension"), F.lit(t).alias("value"), F.lit(i).alias("position")
                    )
                    for i, t in enumerate(tiers, start=1)
                ]
            )
        )
    )
    return found.unionByName(fixed).orderBy("dimension", "position", "value").select("dimension", "value")


def apply_filters(
    mart: DataFrame,
    plans: Sequence[str] = (),
    regions: Sequence[str] = (),
    csms: Sequence[str] = (),
    tiers: Sequence[str] = (),
) -> DataFrame:
    """Keep tenants matching every non-empty selection; NULL matches no selection."""
    out = mart
    for column, selected in (
        ("plan", plans),
        ("region", regions),
        ("csm_assigned", csms),
        ("health_tier", tiers),
    ):
        if selected:
            out = out.where(F.col(column).isin(*selected))
    return out
