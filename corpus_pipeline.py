"""The corpus pipeline: documents in, cleaned and mixed documents out, stage by stage.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame with the columns of
``documents``; it is written as Parquet and read again as the next stage's docs.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from pulsemart.llm import decontaminate, langid, mixing, simhash, toxicity
from pulsemart.session import cut_lineage

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

# Those of the operator's own query: shingles of three words, fingerprints within two bits.
NEAR_SHINGLE, NEAR_BITS = 3, 2


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is known go on; texts without a letter or unlike every language do not."""
    return langid.keep_known_languages(docs, langid.fit_language_model(docs, langid.trusted_rows()))


def not_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents predicted toxic do not go on."""
    model = toxicity.fit_toxicity(docs, table(spark, sf_dir, "labels"), toxicity.trusted_rows())
    return toxicity.drop_toxic(docs, model)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays, that with the smallest id."""
    return simhash.drop_near_duplicates(docs, radius=NEAR_BITS, shingle=NEAR_SHINGLE)


def not_in_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that repeat a benchmark item, also with other numbers or names, do not go on."""
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated or left out so that the sources meet their target weights."""
    return mixing.mix_documents(docs)


STAGES: list[tuple[str, Stage]] = [
    ("language", known_language),
    ("toxicity", not_toxic),
    ("near_dedup", near_dedup),
    ("decontaminate", not_in_benchmark),
    ("mix", mix),
]

# Language and toxicity models are trained and near duplicates are found by iteration: SQL cannot express them.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = cut_lineage(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
