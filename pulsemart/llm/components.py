"""Connected components of a link table, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsemart.session import cut_lineage


def _stars(links: DataFrame, larger_only: bool) -> DataFrame:
    """Join neighbours to the smallest node around them.

    Large star: every node's larger neighbours move to the smallest of the node and its
    neighbours. Small star: a node's smaller neighbours, and itself, move to the smallest
    of them. Both keep the components; alternated, they end in one star per component.
    """
    if larger_only:
        around = links.select(F.col("a").alias("node"), F.col("b").alias("near")).unionAll(
            links.select(F.col("b").alias("node"), F.col("a").alias("near"))
        )
        smallest = around.groupBy("node").agg(F.least(F.min("near"), F.first("node")).alias("to"))
        moved = around.where("near > node").join(smallest, "node").select(F.col("near").alias("x"), "to")
    else:
        around = links.select(F.greatest("a", "b").alias("node"), F.least("a", "b").alias("near"))
        smallest = around.groupBy("node").agg(F.min("near").alias("to"))
        moved = around.join(smallest, "node").select(F.col("near").alias("x"), "to")
        moved = moved.unionAll(smallest.select(F.col("node").alias("x"), "to"))
    return moved.where("x != to").select(F.col("to").alias("a"), F.col("x").alias("b")).distinct()


def connected_components(links: DataFrame) -> DataFrame:
    """(node, component) for every node of ``links`` (a, b); the component is its smallest node.

    Every round is a few joins on tables written to the shared folder. The rounds end when
    the links no longer change, after about log(n) of them. Null links are ignored.
    """
    links = cut_lineage(
        links.where("a != b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "links"
    )
    state = None
    while True:
        links = cut_lineage(_stars(_stars(links, True), False), "links")
        now = links.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == state or not now[0]:
            break
        state = now
    return links.select(F.col("b").alias("node"), F.col("a").alias("component")).unionAll(
        links.select(F.col("a").alias("node"), F.col("a").alias("component")).distinct()
    )
