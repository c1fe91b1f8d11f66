"""What the operators of this subpackage share on the Spark side."""

from __future__ import annotations

import gc

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ship
from ..storage import remove, scratch, shared_dir, written

__all__ = ["drop_written", "fold", "mapped", "release", "remove", "scratch", "shared_dir", "table", "written"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def drop_written(df: DataFrame) -> None:
    """Removes the files of a table from written(), once nothing reads it any more."""
    for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        remove(df.sparkSession, folder)


def release(spark: SparkSession) -> None:
    """Lets Spark remove the shuffle files of jobs that are over: it does so once their plans are collected as garbage."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def fold(doc_id: Column, modulus: int) -> Column:
    """crc32 of the id as text, modulo modulus; a null id counts as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % modulus


def mapped(df: DataFrame, run, schema) -> DataFrame:
    """df.mapInArrow(run, schema), with this package on the executors."""
    ship(df.sparkSession)
    return df.mapInArrow(run, schema)
