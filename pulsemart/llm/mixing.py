"""Mixing sources to target weights: repetition rates per source, whole documents per draw."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from pulsemart.llm.text import free_names
from pulsemart.session import cut_lineage

WORD = r"[^\x20\x09-\x0D]+"
SEED = "mix"
CAP = 3
CYCLE = 3
DRAWS = 1 << 52


def words(text: Column) -> Column:
    """Number of words; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def draw(key: Column, seed: str = SEED) -> Column:
    """A number in [0, 1) that depends on the key's text and the seed only."""
    digits = F.substring(F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit("null")))), 1, 13)
    return F.conv(digits, 16, 10).cast("double") / F.lit(float(DRAWS))


def source_weights(sizes: DataFrame, cycle: int = CYCLE) -> DataFrame:
    """(source, source_size, weight): 1, 2, .. ``cycle``, repeating, in the order of code points, null last.

    Numbering runs over ranges of sources, so no task sees all of them.
    """
    order = F.col("source").asc_nulls_last()
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    ranged = cut_lineage(totals.repartitionByRange(order).withColumn("range", F.spark_partition_id()), "sources")
    # One row per range.
    before = W.orderBy("range").rowsBetween(W.unboundedPreceding, -1)
    offsets = ranged.groupBy("range").agg(F.count("*").alias("n")).select(
        "range", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("earlier")
    )
    number = F.col("earlier") + F.row_number().over(W.partitionBy("range").orderBy(order)) - 1
    return ranged.join(offsets, "range").select(
        "source", "source_size", (number % cycle + 1).cast("long").alias("weight")
    )


def source_targets(weighted: DataFrame, cap: int = CAP) -> DataFrame:
    """Add ``target``: shares of the total size by weight, none above ``cap`` times its source's size.

    Sources above their cap stop there and the rest is shared again among the others,
    until none is above. A round is one sum over the sources.
    """
    capped = F.lit(False)
    share = None
    limit = F.col("source_size") * cap
    stopped = -1
    while True:
        total, sizes, weights, count = weighted.agg(
            F.coalesce(F.sum("source_size"), F.lit(0)),
            F.coalesce(F.sum(F.when(capped, limit)), F.lit(0)),
            F.coalesce(F.sum(F.when(~capped, F.col("weight"))), F.lit(0)),
            F.count(F.when(capped, 1)),
        ).first()
        if weights:
            share = (total - sizes, weights)
        if count == stopped or not weights:
            break
        stopped = count
        # limit < weight * share, in whole numbers
        capped = capped | (
            limit.cast("decimal(38,0)") * F.lit(weights) < F.col("weight").cast("decimal(38,0)") * F.lit(share[0])
        )
    if share is None:
        return weighted.withColumn("target", F.lit(0.0))
    open_target = F.col("weight").cast("double") * F.lit(float(share[0])) / F.lit(float(share[1]))
    return weighted.withColumn("target", F.when(capped, limit.cast("double")).otherwise(open_target))


def mixing_rates(docs: DataFrame, source_column: str = "source", text_column: str = "text") -> DataFrame:
    """(source, source_size, target, rate) per source, written once so that its size is known to joins."""
    sizes = docs.select(F.col(source_column).alias("source"), words(F.col(text_column)).alias("size"))
    return rates_of(sizes)


def rates_of(sizes: DataFrame) -> DataFrame:
    targets = source_targets(source_weights(sizes))
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    return cut_lineage(targets.select("source", "source_size", "target", rate.alias("rate")), "rates")


def copies(rate: Column, key: Column, seed: str = SEED) -> Column:
    """floor(rate), and one more with the fraction's probability."""
    whole = F.floor(rate)
    return (whole + F.when(draw(key, seed) < rate - whole, 1).otherwise(0)).cast("long")


def mix_sizes(
    docs: DataFrame, id_column: str = "doc_id", source_column: str = "source", text_column: str = "text"
) -> DataFrame:
    """One row per row of ``docs``: doc_id, source, size, source_size, target, rate, copies, taken.

    A null text has size 0, a null source is a source of its own and the last one, a null
    id draws as the text "null". Rows with the same id draw alike. Sources of size 0 get
    target and rate 0. An empty table gives no rows. Other columns are ignored.
    """
    sizes = cut_lineage(
        docs.select(
            F.col(id_column).alias("doc_id"),
            F.col(source_column).alias("source"),
            words(F.col(text_column)).alias("size"),
        ),
        "sizes",
    )
    rates = rates_of(sizes).withColumnRenamed("source", "of")
    placed = sizes.join(rates, F.col("source").eqNullSafe(F.col("of"))).drop("of")
    return placed.withColumn("copies", copies(F.col("rate"), F.col("doc_id"))).withColumn(
        "taken", F.col("size") * F.col("copies")
    )


def mix_documents(docs: DataFrame) -> DataFrame:
    """``docs`` with each row as often as `mix_sizes` takes it, in the columns of ``docs``."""
    of, rate, copy = free_names(docs.columns, "mix_of", "mix_rate", "mix_copy")
    rates = mixing_rates(docs).select(F.col("source").alias(of), F.col("rate").alias(rate))
    placed = docs.join(rates, F.col("source").eqNullSafe(F.col(of)))
    times = copies(F.col(rate), F.col("doc_id")).cast("int")
    repeated = placed.withColumn(copy, F.explode(F.array_repeat(F.lit(1), times)))
    return repeated.select(*[F.col(f"`{c}`") for c in docs.columns])
