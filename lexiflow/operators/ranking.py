"""Positions in a total order, without one task that holds all rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..storage import written


def numbered(df: DataFrame, *order: Column | str, name: str = "position", start: int = 0) -> DataFrame:
    """df with each row's place in the order. Rows are sorted by ranges; a partition's first place comes from the partitions' counts."""
    marked = written(df.orderBy(*order).withColumn("_id", F.monotonically_increasing_id()), "lexiflow-sorted")
    part = F.shiftright("_id", 33)
    counts = marked.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy().orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)  # over a row for each partition
    first = counts.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_first"))
    place = F.col("_first") + F.col("_id").bitwiseAND(F.lit((1 << 33) - 1)) + start
    return marked.withColumn("_part", part).join(F.broadcast(first), "_part").withColumn(name, place.cast("bigint")).drop("_part", "_id", "_first")


def keep_first(df: DataFrame, key: list[str], *order: Column) -> DataFrame:
    """The first row of each key, as a minimum that is combined before the shuffle. order: columns that decide, ascending."""
    rest = [c for c in df.columns if c not in key]
    rank = F.struct(*[o.alias(f"_o{i}") for i, o in enumerate(order)], *rest)
    return df.groupBy(*key).agg(F.min(rank).alias("_r")).select(*key, *[F.col(f"_r.{c}").alias(c) for c in rest]).select(df.columns)


def keep_last(df: DataFrame, key: list[str], *order: Column) -> DataFrame:
    rest = [c for c in df.columns if c not in key]
    rank = F.struct(*[o.alias(f"_o{i}") for i, o in enumerate(order)], *rest)
    return df.groupBy(*key).agg(F.max(rank).alias("_r")).select(*key, *[F.col(f"_r.{c}").alias(c) for c in rest]).select(df.columns)


def value_counts(df: DataFrame, value: str, position: str) -> DataFrame:
    """Counts of non-empty values with the position where each was first seen."""
    return df.where(F.coalesce(F.col(value) != "", F.lit(False))).groupBy(value).agg(F.count(F.lit(1)).alias("n"), F.min(position).alias("first_seen"))


def rank_map(words: DataFrame, word: str = "word", rank: str = "rank") -> DataFrame:
    """Lower-case word -> its last (worst) rank in the list."""
    return words.groupBy(F.lower(word).alias("word")).agg(F.max(rank).alias("rank"))
