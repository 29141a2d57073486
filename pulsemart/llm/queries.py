"""The package's queries over one data directory."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pulsemart.llm import (
    decontaminate,
    filter_audit,
    langid,
    licenses,
    mixing,
    neighbours,
    ngrams,
    quality,
    sentencepieces,
    simhash,
    toxicity,
    warc,
    whitening,
)

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _held_out(modulus: int, remainder: int):
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % modulus == remainder


def op1_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return neighbours.nearest_neighbours(vectors, F.col("vec_id") % 100 == 0)


def op2_stupid_backoff(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = ngrams.score_documents(table(spark, sf_dir, "documents"))
    # The order of a floating-point sum is not fixed.
    return scored.select(
        "doc_id", "words", F.round("score", 6).alias("score"), F.round("per_word", 6).alias("per_word")
    )


def op3_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan_licenses(table(spark, sf_dir, "documents"), licenses.default_licenses(spark))


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = quality.fit_quality(docs, table(spark, sf_dir, "labels"), quality.trusted_rows())
    scored = quality.score_quality(docs, model)
    return scored.select("doc_id", _held_out(4, 2).alias("held_out"), "score", "predicted")


def op5_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = langid.fit_language_model(docs, langid.trusted_rows())
    found = langid.identify_language(docs, model)
    return found.select("doc_id", _held_out(4, 2).alias("held_out"), "lang_pred", "score", "rejected")


def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    read = warc.read_warc(warc.archive_pages(spark, pages), with_payload=False)
    kind = pages.schema["page_id"].dataType
    return read.select(
        F.col("page_id").cast(kind).alias("page_id"),
        "payload_bytes",
        "payload_digest",
        "record_type",
        F.col("refers_to").cast(kind).alias("refers_to"),
    )


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = toxicity.fit_toxicity(docs, table(spark, sf_dir, "labels"), toxicity.trusted_rows())
    scored = toxicity.score_toxicity(docs, model)
    return scored.select("doc_id", _held_out(5, 0).alias("held_out"), "score", "predicted")


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.simhash_components(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "fingerprint", "component_id")


def op9_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "item_id", "windows", "coverage", "changed")


def op10_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix_sizes(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    whitened = whitening.whiten(table(spark, sf_dir, "embeddings"))
    # A sum beyond the range of a long is null here; the operator's own column holds 38 digits.
    return whitened.withColumn("deviation", F.col("deviation").try_cast("bigint"))


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit_filters(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def tokenizer_path(name: str = "piece_bpe_32k.model") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op13_sentencepiece(spark: SparkSession, sf_dir: str, model_path: str | None = None) -> DataFrame:
    model = sentencepieces.read_piece_model(model_path or tokenizer_path())
    encoded = sentencepieces.encode_documents(table(spark, sf_dir, "documents"), model, decoded=True)
    return encoded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
        # The bytes of the text that the pieces' spans cover.
        F.aggregate(
            F.zip_with("begins", "ends", lambda begin, end: end - begin), F.lit(0).cast("long"), lambda a, b: a + b
        ).alias("bytes_covered"),
    )


QUERIES: dict[str, Query] = {
    "op1_neighbours": op1_neighbours,
    "op2_stupid_backoff": op2_stupid_backoff,
    "op3_licenses": op3_licenses,
    "op4_quality": op4_quality,
    "op5_language": op5_language,
    "op6_warc": op6_warc,
    "op7_toxicity": op7_toxicity,
    "op8_simhash": op8_simhash,
    "op9_decontaminate": op9_decontaminate,
    "op10_mix_sources": op10_mix_sources,
    "op11_whitening": op11_whitening,
    "op12_filter_audit": op12_filter_audit,
    "op13_sentencepiece": op13_sentencepiece,
}
