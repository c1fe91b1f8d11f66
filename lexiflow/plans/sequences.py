"""Queries over ordered rows: structure extraction as windows, batches."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import sequence
from .registry import Tables, query

BIG = "bigint"


@query("""WITH r AS (SELECT *, coalesce(count(*) FILTER (event_type = 'purchase') OVER (PARTITION BY user_id ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS run FROM events),
l AS (SELECT *, last_value(CASE WHEN event_type = 'click' THEN props END IGNORE NULLS) OVER (PARTITION BY user_id, run ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS label FROM r)
SELECT user_id, event_id, label FROM l WHERE event_type = 'purchase'""")
def q_label_lookback(t: Tables) -> DataFrame:
    kind = F.col("event_type")
    return sequence.label_lookback(t.events.select("user_id", "event_id", "event_type", "props"), "user_id", "event_id", kind == "purchase", F.when(kind == "click", F.col("props"))).select("user_id", "event_id", "label")


@query("""WITH r AS (SELECT *, coalesce(count(*) FILTER (event_type = 'signup') OVER (PARTITION BY user_id ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS segment FROM events)
SELECT user_id, segment, count(*) AS n, max(event_id) AS last_event, string_agg(event_type, ' ' ORDER BY event_id) AS description FROM r GROUP BY 1, 2 HAVING bool_or(event_type = 'signup')""")
def q_segments(t: Tables) -> DataFrame:
    order = F.array_sort(F.collect_list(F.struct("event_id", "event_type")))
    found = sequence.segments(t.events, "user_id", "event_id", F.col("event_type") == "signup", F.count(F.lit(1)).alias("n"), F.max("event_id").alias("last_event"), order.alias("x"))
    return found.select("user_id", F.col("segment").cast(BIG).alias("segment"), "n", "last_event", F.array_join(F.transform("x", lambda x: x.event_type), " ").alias("description"))


@query("""SELECT user_id, event_id, next_purchase FROM (SELECT user_id, event_id, event_type, first_value(CASE WHEN event_type = 'purchase' THEN event_id END IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY event_id ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS next_purchase FROM events) WHERE event_type = 'signup'""")
def q_next_sibling(t: Tables) -> DataFrame:
    rows = sequence.next_of(t.events.select("user_id", "event_id", "event_type"), "user_id", "event_id", F.when(F.col("event_type") == "purchase", F.col("event_id")), "next_purchase")
    return rows.where("event_type = 'signup'").select("user_id", "event_id", "next_purchase")


@query("SELECT conv_id, turn, last_value(CASE WHEN role = 'user' THEN turn END IGNORE NULLS) OVER (PARTITION BY conv_id ORDER BY turn) AS header FROM conversations")
def q_header_ffill(t: Tables) -> DataFrame:
    return sequence.header_of(t.conversations.select("conv_id", "turn", "role"), "conv_id", "turn", F.when(F.col("role") == "user", F.col("turn")), "header").select("conv_id", "turn", "header")


@query("""SELECT event_id, CASE WHEN event_type = 'signup' AND value > 50 THEN 'definition' WHEN event_type = 'signup' THEN 'see_also' WHEN event_type = 'click' THEN 'related' WHEN value > 80 THEN 'grammar' WHEN event_type = 'view' THEN 'usage' ELSE 'example' END AS type FROM events""")
def q_dispatch_case(t: Tables) -> DataFrame:
    kind, value = F.col("event_type"), F.col("value")
    chosen = F.when((kind == "signup") & (value > 50), "definition").when(kind == "signup", "see_also").when(kind == "click", "related").when(value > 80, "grammar").when(kind == "view", "usage").otherwise("example")
    return t.events.select("event_id", chosen.alias("type"))


def _chunks(t: Tables, size: int | None) -> DataFrame:
    lines = t.lineitem.select("l_partkey", "l_orderkey", "l_linenumber", "l_suppkey", "l_shipdate", "l_quantity")
    return sequence.chunked(lines, ["l_partkey"], ["l_orderkey", "l_linenumber", "l_suppkey", "l_shipdate", "l_quantity"], size).groupBy("l_partkey", "chunk").agg(F.count(F.lit(1)).alias("n_items"), F.min("idx").alias("first_idx"), F.sum("l_orderkey").alias("keys"))


def _sql_chunks(chunk: str) -> str:
    return f"""SELECT l_partkey, {chunk} AS chunk, count(*) AS n_items, min(idx) AS first_idx, sum(l_orderkey)::BIGINT AS keys FROM (
SELECT l_partkey, l_orderkey, row_number() OVER (PARTITION BY l_partkey ORDER BY l_orderkey, l_linenumber, l_suppkey, l_shipdate, l_quantity) - 1 AS idx FROM lineitem) GROUP BY 1, 2"""


@query(_sql_chunks("idx // 30"))
def q_batch_chunks_30(t: Tables) -> DataFrame:
    return _chunks(t, 30)


@query(_sql_chunks("idx // 20"))
def q_batch_chunks_20(t: Tables) -> DataFrame:
    return _chunks(t, 20)


@query(_sql_chunks("0::BIGINT"))
def q_batch_unchunked(t: Tables) -> DataFrame:
    return _chunks(t, None)


@query("SELECT l_partkey, count(*) AS n, sum(l_quantity) AS quantity FROM lineitem GROUP BY 1 HAVING bool_and(l_quantity < 50)")
def q_batch_all_or_nothing(t: Tables) -> DataFrame:
    kept = sequence.all_or_nothing(t.lineitem.select("l_partkey", "l_quantity"), ["l_partkey"], F.col("l_quantity") < 50)
    return kept.groupBy("l_partkey").agg(F.count(F.lit(1)).alias("n"), F.sum("l_quantity").alias("quantity"))
