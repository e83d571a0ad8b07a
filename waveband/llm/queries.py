"""The registered queries: each operator over its whole table, reduced to the contract's columns."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from waveband.llm import (
    decontamination,
    jaccard_join,
    language_id,
    license_scan,
    personal_data,
    quality_neighbours,
    quality_rules,
    samples,
    sentencepiece_coding,
    spelling,
    toxicity,
    url_filter,
    warc,
    whitening,
)
from waveband.llm.shared import new_folder


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    predicted = language_id.predict(table(spark, sf_dir, "documents"))
    return predicted.select("doc_id", samples.held_out("doc_id").alias("held_out"), "lang_pred", "score")


def op5_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentencepiece_coding.round_trip(table(spark, sf_dir, "documents"))


def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_folder(spark, "warc")
    warc.write(table(spark, sf_dir, "pages"), path)
    resolved = warc.resolve(warc.read(spark, path, with_payload=False))
    return resolved.select(F.col("record_id").alias("page_id"), "payload_bytes", "payload_digest", "record_type", "refers_to")


def op7_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.join(table(spark, sf_dir, "documents"))


def op8_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan(table(spark, sf_dir, "documents"))


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judge(table(spark, sf_dir, "documents"))


def op1_quality_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = quality_neighbours.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return scored.select("doc_id", samples.held_out("doc_id").alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


def op2_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(table(spark, sf_dir, "pages"))


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, benchmark = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    return decontamination.digest(decontamination.locate(docs, benchmark))


def op10_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return personal_data.find(table(spark, sf_dir, "documents"))


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(spelling.counted(table(spark, sf_dir, "documents")))


def op12_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = toxicity.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return scored.select("doc_id", samples.held_out("doc_id", 3, 1).alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))


def op13_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_quality_neighbours": op1_quality_neighbours,
    "op2_url_filter": op2_url_filter,
    "op3_decontamination": op3_decontamination,
    "op4_language_id": op4_language_id,
    "op5_sentencepiece": op5_sentencepiece,
    "op6_warc": op6_warc,
    "op7_jaccard_join": op7_jaccard_join,
    "op8_license_scan": op8_license_scan,
    "op9_quality_rules": op9_quality_rules,
    "op10_personal_data": op10_personal_data,
    "op11_spelling_variants": op11_spelling_variants,
    "op12_toxicity": op12_toxicity,
    "op13_embedding_whitening": op13_embedding_whitening,
}
