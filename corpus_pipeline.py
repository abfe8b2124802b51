"""The corpus pipeline: documents in, cleaned and encoded documents out.

Each stage takes (spark, docs, sf_dir), works on all that the stage before it
kept, and is written as Parquet and read again as the next one's ``docs``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from candela.llm import bpe, decontaminate, near_dup, pii, quality, text as tx


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass every quality rule."""
    return quality.quality_filter(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: five-word shingles, a similarity of 0.8 or more."""
    return near_dup.drop_near_duplicates(docs, size=5, percent=80)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no passage of the benchmark."""
    return decontaminate.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def redact_pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data replaced by its kind."""
    return pii.redact(docs)


def byte_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of the encoded texts."""
    return bpe.digests(bpe.encode_decode(docs))


STAGES = [
    ("quality_rules", quality_rules),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("redact_pii", redact_pii),
    ("byte_bpe", byte_bpe),
]
#: Not SQL: the stages are tested against brute force in tests/llm.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = tx.write_table(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
