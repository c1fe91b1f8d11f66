"""Lookups, resume and merge. Sides aren't forced to broadcast: the optimiser does so below its size threshold, and shuffles beyond it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..storage import exists
from .ranking import keep_first, keep_last, rank_map


def pending(wanted: DataFrame, done: DataFrame, key: list[str]) -> DataFrame:
    """What is wanted and not done yet; goes below any costly step."""
    return wanted.join(done.select(*key).distinct(), key, "left_anti")


def optional(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """The table at path, or none of its rows if there is none yet."""
    return spark.read.schema(schema).parquet(path) if exists(spark, path) else spark.createDataFrame([], schema)


def upsert(existing: DataFrame, new: DataFrame, key: list[str]) -> DataFrame:
    """New keys are added; existing ones stay as they are."""
    return existing.unionByName(pending(new, existing, key))


def merged(parts: list[DataFrame], key: list[str]) -> DataFrame:
    """All parts' rows; a key's row is that of the last part that has it."""
    tagged = parts[0].withColumn("_part", F.lit(0))
    for i, p in enumerate(parts[1:], 1):
        tagged = tagged.unionByName(p.withColumn("_part", F.lit(i)))
    return keep_first(tagged, key, -F.col("_part")).drop("_part")


def label_join(df: DataFrame, labels: DataFrame, key: str, text: Column, label: str) -> DataFrame:
    """`text (label)` where both are there, else text."""
    joined = df.join(labels, key, "left")
    both = F.coalesce((text != "") & (F.col(label) != ""), F.lit(False))
    return joined.withColumn("labelled", F.when(both, F.concat(text, F.lit(" ("), F.col(label), F.lit(")"))).otherwise(F.coalesce(text, F.lit(""))))


def ranked_entries(entries: DataFrame, words: DataFrame, position: str = "ord", file: str = "file", limit: int | None = None) -> DataFrame:
    """Entries with `frequency_rank` by the stem of their file: one entry a stem (the first), entries without a file unranked and all kept.

    Ranked entries come first by rank, the others follow in their own order: sort by `frequency_rank` (nulls last) and position.
    With no words at all, every entry stays and none is ranked.
    """
    from ..functions.text import stem

    if limit:
        entries = entries.where(F.col(position) < limit)
    keyed = entries.withColumn("_key", F.lower(stem(F.col(file))))
    ranks = rank_map(words)
    if words.isEmpty():
        return entries.withColumn("frequency_rank", F.lit(None).cast("int"))
    firsts = keep_first(keyed.where("_key is not null and _key != ''").select("_key", position), ["_key"], F.col(position)).withColumn("_first", F.lit(True))
    kept = keyed.join(firsts, ["_key", position], "left").where("_first or _key is null or _key = ''")
    return kept.join(ranks.withColumnsRenamed({"word": "_key", "rank": "frequency_rank"}), "_key", "left").drop("_key", "_first")


def listed_entries(entries: DataFrame, words: DataFrame, position: str = "ord", file: str = "file") -> DataFrame:
    """Entries with `rank` in the order of a word list, taken as it is spelt: of entries whose file has a listed stem, the last one, at the word's first
    rank; all others unranked and kept. Sort by `rank` (nulls last) and position."""
    from ..functions.text import stem

    first = words.groupBy(F.col("word").alias("_key")).agg(F.min("rank").alias("rank"))
    joined = entries.withColumn("_key", F.lower(stem(F.col(file)))).join(first, "_key", "left")
    last = keep_last(joined.where("rank is not null").select("_key", position), ["_key"], F.col(position)).withColumn("_last", F.lit(True))
    return joined.join(last, ["_key", position], "left").where("_last or rank is null").drop("_key", "_last")


def elementwise(df: DataFrame, key: str, items: str, lookup: DataFrame, by: str, value: str) -> DataFrame:
    """df with `found`: for each element of an array of structs, in order, what the lookup has for its field `by` (or null)."""
    flat = df.select(key, F.posexplode(items).alias("_pos", "_item")).withColumn(by, F.col(f"_item.{by}"))
    hit = flat.join(lookup.select(by, F.col(value).alias("_value")), by, "left")
    lists = hit.groupBy(key).agg(F.transform(F.array_sort(F.collect_list(F.struct("_pos", "_value"))), lambda x: x._value).alias("found"))
    return df.join(lists, key, "left")


def set_report(wanted: Column, got: Column) -> tuple[Column, Column, Column]:
    """What is missing, what is too much, and whether both sets are the same."""
    return F.array_sort(F.array_except(wanted, got)), F.array_sort(F.array_except(got, wanted)), F.array_sort(F.array_distinct(wanted)) == F.array_sort(F.array_distinct(got))
