"""Queries over replies of a translation service, generated from events.props."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text as tx
from ..operators import translate
from .registry import Tables, query


@query("""SELECT event_id, json_extract(doc, '$.k')::BIGINT AS k FROM (SELECT event_id, CASE WHEN event_id % 4 = 3 THEN NULL ELSE props END AS doc FROM events)""")
def q_fence_parse(t: Tables) -> DataFrame:
    way = F.col("event_id") % 4
    reply = F.when(way == 0, F.col("props")).when(way == 1, F.concat(F.lit("```json\n"), "props", F.lit("\n```"))).when(way == 2, F.concat(F.lit("```JSON\n"), "props", F.lit("\n```  "))).otherwise(F.concat("props", F.lit(" truncated")))
    return t.events.select("event_id", F.try_variant_get(tx.json_value(tx.strip_fence(reply)), "$.k", "bigint").alias("k"))


#: By event_id % 8: what a reply looks like, and what the check says.
SHAPES = [
    ('{"headword": "H", "definitions": {"0": P}}', "ok"),
    ('{"H": {"definitions": {"0": P}}}', "ok"),
    ('{"0": P}', "ok"),
    ('{"headword": "H", "definitions": [P]}', "ok"),
    ('{"headword": "H", "definitions": [P, P]}', "wrong length"),
    ('{"headword": "other", "definitions": {"0": P}}', "wrong schema"),
    ("{}", "invalid JSON"),
    ("[P]", "invalid JSON"),
]


@query("SELECT event_id, CASE event_id % 8 " + " ".join(f"WHEN {i} THEN '{v}'" for i, (_, v) in enumerate(SHAPES)) + " END AS verdict FROM events")
def q_reply_schema(t: Tables) -> DataFrame:
    shape = F.element_at(F.array(*[F.lit(s) for s, _ in SHAPES]), (F.col("event_id") % 8 + 1).cast("int"))
    reply = F.replace(F.replace(shape, F.lit("H"), F.col("event_type")), F.lit("P"), F.col("props"))
    return t.events.select("event_id", translate.checked(reply, F.col("event_type"), F.lit(1)).alias("verdict"))


@query("SELECT event_id, CASE WHEN event_id % 5 = 0 THEN 'wrong keys' WHEN event_id % 5 = 1 THEN 'wrong keys' ELSE 'ok' END AS definitions, CASE WHEN event_id % 5 = 0 THEN 'wrong keys' WHEN event_id % 5 = 1 THEN 'wrong keys' ELSE 'ok' END AS expressions FROM events")
def q_reply_keyset(t: Tables) -> DataFrame:
    way = F.col("event_id") % 5
    inner = F.when(way == 0, '"0": "a"').when(way == 1, '"0": "a", "1": "b", "2": "c"').otherwise('"1": "b", "0": "a"')
    build = lambda kind: F.concat(F.lit('{"headword": "'), "event_type", F.lit(f'", "{kind}": {{'), inner, F.lit("}}"))
    verdict = lambda kind: translate.checked(build(kind), F.col("event_type"), F.lit(2), kind)
    return t.events.select("event_id", verdict(translate.DEFINITIONS).alias("definitions"), verdict(translate.EXPRESSIONS).alias("expressions"))


@query("""SELECT event_id, CASE event_id % 4 WHEN 0 THEN event_type WHEN 1 THEN 'w' || event_id ELSE '' END AS lemma, CASE event_id % 4 WHEN 0 THEN 'g' WHEN 1 THEN 'w' || event_id ELSE '' END AS gloss,
CASE event_id % 4 WHEN 0 THEN event_type ELSE '' END AS expr_lemma FROM events""")
def q_reply_values(t: Tables) -> DataFrame:
    way = F.col("event_id") % 4
    value = F.when(way == 0, F.concat(F.lit('{"lemma": "'), "event_type", F.lit('", "gloss": "g"}'))).when(way == 1, F.concat(F.lit('"w'), F.col("event_id").cast("string"), F.lit('"'))).when(way == 2, F.lit("17")).otherwise(F.lit('{"lemma": "x"}'))
    pair = translate.pair(value)
    return t.events.select("event_id", pair.lemma.alias("lemma"), pair.gloss.alias("gloss"), translate.pair(value, translate.EXPRESSIONS).lemma.alias("expr_lemma"))


@query("SELECT n AS attempt, n * (n + 1) AS waited FROM (SELECT unnest(range(1, 11)) AS n)")
def q_backoff(t: Tables) -> DataFrame:
    return t.spark.range(1, 11).select(F.col("id").alias("attempt"), F.aggregate(F.sequence(F.lit(1).cast("bigint"), "id"), F.lit(0).cast("bigint"), lambda a, k: a + 2 * k).alias("waited"))
