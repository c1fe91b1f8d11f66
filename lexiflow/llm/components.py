"""Connected components by alternating large-star and small-star rounds, with minima aggregated before the shuffle.

Minima are written out before they are joined back, so that both sides of each join are plain exchanges and adaptive
execution can split a hub's edges over many tasks. Nothing is collected but one checksum a round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import drop_written, written


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """edges (u, v): each node's chosen neighbours are linked with the smallest of them and itself."""
    if large:  # every neighbour; the larger ones move
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    else:  # smaller neighbours; all of them and the node itself move
        both = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = written(both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m")), "lexiflow-least")
    moved = both.join(least, "u")
    if large:
        out = moved.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        out = moved.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select("u", F.col("m").alias("v")))
    return out.where("u != v").distinct()


def components(edges: DataFrame) -> DataFrame:
    """edges: two columns of one ordered type. Returns (node, component), component being the least node reachable; only nodes with an edge to another appear."""
    a, b = edges.columns
    now = written(edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u != v").distinct(), "lexiflow-edges")
    mark = None
    while True:
        # no more rounds once the edges stay the same: then each node is linked with its component's least one
        seen = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if tuple(seen) == mark:
            break
        mark = tuple(seen)
        wide = written(_star(now, True), "lexiflow-edges")
        then = written(_star(wide, False), "lexiflow-edges")
        drop_written(now)
        now = then
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
