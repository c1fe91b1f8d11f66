"""Readers: page folders, JSON arrays in their order, JSON objects as tables, resumable tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, MapType, StringType, StructType

from ..functions.text import basename
from ..operators.lookup import optional

__all__ = ["entries", "json_array", "json_map", "optional", "pages"]


def pages(spark: SparkSession, folder: str, suffix: str = ".html") -> DataFrame:
    """(file, html) of the files with this suffix; bytes that aren't UTF-8 give a null page."""
    raw = spark.read.format("binaryFile").option("pathGlobFilter", f"*{suffix}").load(folder)
    return raw.select(F.url_decode(basename(F.col("path"))).alias("file"), F.try_validate_utf8(F.col("content").cast("string")).alias("html"))


def _whole(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("wholetext", True).text(path)


def json_array(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """The items of a JSON array with their place in it as `ord`. The document is one value, as the format can't be split; large tables
    belong in Parquet with an `ord` column."""
    items = _whole(spark, path).select(F.posexplode(F.from_json("value", ArrayType(schema))).alias("ord", "item"))
    return items.select(F.col("ord").cast("bigint").alias("ord"), "item.*")


def entries(spark: SparkSession, path: str) -> DataFrame:
    from ..schema import ENTRY

    return json_array(spark, path, ENTRY)


def json_map(spark: SparkSession, path: str, value: DataType | None = None, key: str = "key") -> DataFrame:
    """(key, value) of a JSON object; of a key that stands twice, the last value counts."""
    rows = _whole(spark, path).select(F.posexplode(F.map_entries(F.from_json("value", MapType(StringType(), value or StringType())))).alias("_at", "_entry"))
    return rows.groupBy(F.col("_entry.key").alias(key)).agg(F.max_by("_entry.value", "_at").alias("value"))
