"""The corpus pipeline: five stages, each a whole operator over all that the one before has kept.

Each function takes (spark, docs, sf_dir); what it returns is written as Parquet and read again as the next one's docs. All but the last
return the columns of documents. SQL can't express most stages, so ORACLE_SQL is None and tests hold the stages against plain versions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lexiflow.llm import decontaminate, exact_dedup, language_id, minhash, packing
from lexiflow.llm.common import scratch, table


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in no language (without text or letters) go."""
    return language_id.accepted(docs)


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, the document with the largest id stays."""
    return exact_dedup.kept_rows(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by five-word shingles with a similarity of 0.8, the one with the least id stays."""
    return minhash.kept_rows(docs, width=5, num=80, den=100)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item, whole or edited, go."""
    return decontaminate.clean_rows(docs, table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in sequences of at most 4096 tokens."""
    return packing.pack(docs).withColumnRenamed("id", "doc_id")


STAGES = [
    ("language_id", identify_language),
    ("exact_dedup", drop_exact_copies),
    ("near_dedup", drop_near_copies),
    ("decontamination", drop_leaks),
    ("packing", pack),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        path = scratch(spark, f"lexiflow-stage-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
