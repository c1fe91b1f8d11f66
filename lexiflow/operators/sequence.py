"""Sequence operators over ordered siblings, as windows within one parent."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def label_lookback(df: DataFrame, parent: str, position: str, marker: Column, label: Column) -> DataFrame:
    """`label` of each marker: the nearest one before it, unless another marker stands between."""
    before = Window.partitionBy(parent).orderBy(position).rowsBetween(Window.unboundedPreceding, -1)
    run = df.withColumn("_run", F.coalesce(F.sum(marker.cast("int")).over(before), F.lit(0)))
    inside = Window.partitionBy(parent, "_run").orderBy(position).rowsBetween(Window.unboundedPreceding, -1)
    return run.withColumn("label", F.last(label, ignorenulls=True).over(inside)).where(marker).drop("_run")


def segments(df: DataFrame, parent: str, position: str, marker: Column, *aggregates: Column) -> DataFrame:
    """Runs that each end with a marker; what follows the last marker is no segment."""
    before = Window.partitionBy(parent).orderBy(position).rowsBetween(Window.unboundedPreceding, -1)
    cut = df.withColumn("segment", F.coalesce(F.sum(marker.cast("int")).over(before), F.lit(0)))
    return cut.groupBy(parent, "segment").agg(F.max(marker.cast("int")).alias("_closed"), *aggregates).where("_closed = 1").drop("_closed")


def next_of(df: DataFrame, parent: str, position: str, value: Column, name: str) -> DataFrame:
    """The first non-null value after each row, at any distance."""
    after = Window.partitionBy(parent).orderBy(position).rowsBetween(1, Window.unboundedFollowing)
    return df.withColumn(name, F.first(value, ignorenulls=True).over(after))


def header_of(df: DataFrame, parent: str, position: str, header: Column, name: str) -> DataFrame:
    """The header that each row stands under: the nearest one at or before it."""
    upto = Window.partitionBy(parent).orderBy(position).rowsBetween(Window.unboundedPreceding, 0)
    return df.withColumn(name, F.last(header, ignorenulls=True).over(upto))


def chunked(df: DataFrame, parent: list[str], order: list[str], size: int | None) -> DataFrame:
    """`idx` from 0 within the parent, `chunk` of `size` items each (one chunk if there is no size)."""
    idx = F.row_number().over(Window.partitionBy(*parent).orderBy(*order)) - 1
    df = df.withColumn("idx", idx.cast("bigint"))
    return df.withColumn("chunk", F.floor(F.col("idx") / size).cast("bigint") if size else F.lit(0).cast("bigint"))


def all_or_nothing(df: DataFrame, parent: list[str], ok: Column) -> DataFrame:
    """The rows of parents of which no row failed."""
    good = df.groupBy(*parent).agg(F.bool_and(ok).alias("_ok")).where("_ok").drop("_ok")
    return df.join(good, parent, "left_semi")
