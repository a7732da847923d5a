"""The corpus pipeline: documents through five stages, each written and read again.

Toxic documents go; of near duplicates (five-word shingles, similarity 0.8) one stays; documents
that leak a test item go; secrets are replaced by a mark; what is left is packed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from stagehouse.llm import credentials, decontaminate, jaccard, tiers, toxicity
from stagehouse.llm.storage import table, written


def toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.drop_toxic(docs, table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return jaccard.one_per_class(docs, words=5, percent=80)


def benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.drop_leaking(docs, table(spark, sf_dir, "benchmark"))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return credentials.redact(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return tiers.pack_documents(docs)


STAGES = [
    ("toxicity", toxic),
    ("near_duplicates", near_duplicates),
    ("decontamination", benchmark_leaks),
    ("secrets", secrets),
    ("packing", packed),
]

#: Models, shingle classes and token ids have no SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
