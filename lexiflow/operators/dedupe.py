"""Entries with the same headword, and page versions: the richest or largest stays."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .ranking import keep_first


def richness() -> Column:
    """How much an entry holds: its lists' sizes and those of its derivation lists."""
    size = lambda c: F.coalesce(F.size(c), F.lit(0))
    derived = F.aggregate(F.coalesce(F.map_values("orddannelser"), F.array().cast("array<array<string>>")), F.lit(0), lambda a, v: a + F.coalesce(F.size(v), F.lit(0)))
    return size("definitions") + size("fixed_expressions") + size("wordforms") + size("udtale") + derived


def richest(df: DataFrame, key: list[str], score: Column, position: str) -> DataFrame:
    """One row a key: the highest score, the earliest of equal ones; `group_position` is where the key was first seen."""
    first = df.groupBy(*key).agg(F.min(position).alias("group_position"))
    best = keep_first(df.withColumn("_score", score), key, -F.col("_score"), F.col(position)).drop("_score")
    on = [best[k].eqNullSafe(first[k]) for k in key]
    condition = on[0]
    for c in on[1:]:
        condition = condition & c
    return best.join(first, condition).select(*[best[c] for c in best.columns], "group_position")


def duplicate_stats(df: DataFrame, key: str) -> DataFrame:
    """Rows, distinct keys (null is one) and surplus rows."""
    groups = df.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    return groups.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("total"), F.count(F.lit(1)).alias("distinct_keys")).withColumn("duplicates", F.col("total") - F.col("distinct_keys"))


def duplicate_listing(df: DataFrame, key: str, position: str) -> DataFrame:
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("n"), F.min(position).alias("first_seen")).where("n > 1")


def largest_version(versions: DataFrame, key: str, content: str, position: str) -> DataFrame:
    """The version of each key with the most bytes, the first of equal ones; versions that failed (null) don't count."""
    return keep_first(versions.where(F.col(content).isNotNull()), [key], -F.octet_length(content), F.col(position))


def replaced(current: DataFrame, chosen: DataFrame, key: str, content: str = "content") -> DataFrame:
    """Current pages with the chosen version in their place, and what stood there as backup."""
    new = chosen.select(key, F.col(content).alias("_new"))
    return current.join(new, key, "left").select(key, F.coalesce("_new", content).alias(content), F.when(F.col("_new").isNotNull(), F.col(content)).alias("backup"))
