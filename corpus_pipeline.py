"""The corpus pipeline: stages that each take what the one before has kept.

``run`` applies :data:`STAGES` to ``documents``; each stage's rows are written as Parquet
in the shared folder and read again, so a lost executor costs one stage at most.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from waveband.llm import decontamination, jaccard_join, personal_data, quality_rules, sentencepiece_coding
from waveband.llm.shared import fresh_name, written


def keep_good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Failing lines go from the texts, rejected documents go altogether, and with them null and empty texts; repeated rows are judged one by one."""
    return quality_rules.clean(docs)


def keep_one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of linked rows the first by id and text's hash stays; near copies share 80 percent of their five-word shingles.

    Rows are linked by themselves, not by their ids: of rows that repeat an id those with other texts are rows of
    their own, and equal ones are one. Empty and null texts link with nothing. Rows without an id all stay.
    """
    hashed, first, first_hash = (fresh_name(docs, name) for name in ("hash", "first", "first_hash"))
    keyed = docs.where("doc_id IS NOT NULL").withColumn(hashed, F.coalesce(F.sha2("text", 256), F.lit("")))
    joined = jaccard_join.join(keyed.select(F.struct("doc_id", F.col(hashed).alias("hash")).alias("doc_id"), "text"), words=5, percent=80)
    firsts = joined.where("doc_id = component_id").select(F.col("doc_id.doc_id").alias(first), F.col("doc_id.hash").alias(first_hash)).distinct()
    # equal rows go first, and by plain columns, so that the semi join finds the texts dealt by its keys: they are shuffled once
    single = keyed.dropDuplicates(["doc_id", hashed])
    kept = single.join(firsts, (single["doc_id"] == F.col(first)) & (single[hashed] == F.col(first_hash)), "left_semi")
    return kept.select(*docs.columns).unionByName(docs.where("doc_id IS NULL"))


def remove_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of the benchmark go from the texts; every row stays, null and empty texts and repeated rows too."""
    return decontamination.remove(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data in the texts becomes its kind; every row stays, null texts as they are."""
    return personal_data.mask(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Counts and digests of the ids, and of the text that they decode to, for every row; null counts as the empty text."""
    return sentencepiece_coding.round_trip(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_rules", keep_good_documents),
    ("jaccard_join", keep_one_of_each_group),
    ("decontamination", remove_benchmark),
    ("personal_data", mask_personal_data),
    ("sentencepiece", encode),
]

#: SentencePiece encoding cannot be stated in SQL; tests hold the pipeline against a brute-force version.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
