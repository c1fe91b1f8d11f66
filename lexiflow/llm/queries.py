"""The thin opN_<name> queries over the driver tables, and their SQL where SQL can say the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import chat, decontaminate, exact_dedup, kneser_ney, language_id, minhash, packing, quality, substring, warc
from .common import fold, table


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")


def op2_revisit_resolution(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = warc.resolve(warc.captures_of(table(spark, sf_dir, "pages")))
    return out.select("record_id", "canonical_url", "refers_to", "outcome", warc.listed(F.col("headers")).alias("headers"))


def op3_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = minhash.link_near(table(spark, sf_dir, "documents"), width=3, num=85, den=100)
    return out.select(F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"), F.col("component").alias("component_id"), "kept")


def op4_kneser_ney(spark: SparkSession, sf_dir: str) -> DataFrame:
    fold_ = fold(F.col("doc_id"), 10)
    out = kneser_ney.learn_and_score(table(spark, sf_dir, "documents"), fold_ != 0, order=3).withColumnRenamed("id", "doc_id")
    return out.select("doc_id", (fold_ == 0).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    fold_ = fold(F.col("doc_id"), 3)
    out = quality.learn_and_score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), learn=fold_ != 1).withColumnRenamed("id", "doc_id")
    return out.select("doc_id", (fold_ == 1).alias("held_out"), "score", "predicted")


def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.link_copies(table(spark, sf_dir, "documents")).select(F.col("id").alias("doc_id"), "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"))


OP6_SQL = """
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       doc_id = max(doc_id) OVER w AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW w AS (PARTITION BY coalesce(text, ''))
"""


def op7_tool_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = chat.link(*chat.calls_and_results(table(spark, sf_dir, "conversations")), chat.TOOLS)
    return out.withColumnRenamed("conv", "conv_id").withColumn("errors", F.array_join("errors", ","))


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = decontaminate.find(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return out.select(F.col("id").alias("doc_id"), F.col("item").alias("item_id"), "similarity", "end_word")


def op9_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring.kept_digest(substring.remove_repeats(table(spark, sf_dir, "documents"))).withColumnRenamed("id", "doc_id")


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    out = language_id.identify(docs, learn=fold(F.col("doc_id"), 4) != 2)
    return out.select("doc_id", (fold(F.col("doc_id"), 4) == 2).alias("held_out"), "lang_pred", "score")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_packing": op1_packing,
    "op2_revisit_resolution": op2_revisit_resolution,
    "op3_minhash": op3_minhash,
    "op4_kneser_ney": op4_kneser_ney,
    "op5_quality": op5_quality,
    "op6_exact_dedup": op6_exact_dedup,
    "op7_tool_calls": op7_tool_calls,
    "op8_decontamination": op8_decontamination,
    "op9_substring_dedup": op9_substring_dedup,
    "op10_language_id": op10_language_id,
}
SQL: dict[str, str] = {
    "op2_revisit_resolution": warc.OP2_SQL,
    "op6_exact_dedup": OP6_SQL,
    "op7_tool_calls": chat.OP7_SQL,
}
