"""Tool-call linking for chat data [DataFrame functions only].

Calls are hash-joined with results by conversation and call identifier, put into topological order by what they refer to, checked against
their tools' argument schemas, and written as canonical JSON (keys sorted at every depth, no white space).

A call's level is the length of the longest chain of calls that it refers to. Levels are found by rounds that settle the calls whose references are
all settled: as many rounds as the longest chain. Calls that never settle are in a cycle, or refer to one that is. Positions within a
conversation take no window over it: counts of blocks of turns give each block's first position, so one conversation with a third
of all turns is spread over tasks.

Defined cases: a call without a result is `missing`, one with several takes the earliest and is `repeated`; a result without a call gives a row of its own
(`orphan`); a reference to a call that the conversation lacks is an error and doesn't count for the level; arguments that are null or no
JSON object are an error, and are written as null; unknown tools are an error; rows with a null conversation or identifier are
linked with nothing; calls that share an identifier each get the results; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import json_value
from .common import written

#: Tools of the query below: argument -> type (of SCHEMA_OF_VARIANT), with `?` where it may be left out.
TOOLS = {
    "search": {"q": "STRING", "limit": "BIGINT"},
    "open": {"ref": "STRING", "depth": "BIGINT"},
    "sum": {"ref": "STRING", "parts": "ARRAY<BIGINT>", "note": "?STRING"},
}


def canonical_json(text: Column) -> Column:
    """The JSON text with sorted keys and no white space; null for what is no JSON."""
    return F.to_json(json_value(text))


def argument_errors(tool: Column, arguments: Column, tools: dict[str, dict[str, str]]) -> Column:
    """Ascending array of what is wrong with a call's arguments."""
    parsed = json_value(arguments)
    names = F.json_object_keys(arguments)
    kind = F.schema_of_variant(parsed)
    out = F.when(tool.isNull() | ~tool.isin(list(tools)), F.array(F.lit("tool"))).otherwise(F.array().cast("array<string>"))
    for name, schema in tools.items():
        found = []
        for arg, want in schema.items():
            got = F.schema_of_variant(F.try_variant_get(parsed, f"$.{arg}", "variant"))
            there = F.array_contains(names, arg)
            wrong = F.when(there & (F.coalesce(got, F.lit("VOID")) != want.lstrip("?")), f"type:{arg}")
            found.append(wrong if want.startswith("?") else F.when(~there, f"missing:{arg}").otherwise(wrong))
        extra = F.transform(F.array_except(names, F.array(*map(F.lit, schema))), lambda k: F.concat(F.lit("extra:"), k))
        out = F.when(tool == name, F.concat(F.array_compact(F.array(*found)), extra)).otherwise(out)
    return F.when(~F.coalesce(kind.startswith("OBJECT"), F.lit(False)), F.array(F.lit("json"))).otherwise(F.array_sort(out))


def levels(calls: DataFrame, references: DataFrame) -> DataFrame:
    """(conv, call, level) of each distinct call; level is null in and after a cycle. references: conv, call, ref, all of them known calls."""
    nodes = calls.select("conv", "call").distinct()
    open_ = written(references.select("conv", "call", "ref").distinct(), "lexiflow-references")
    settled = written(nodes.join(open_.select("conv", "call").distinct(), ["conv", "call"], "left_anti").withColumn("level", F.lit(0)), "lexiflow-levels")
    parts, fresh, depth = [settled], settled, 0
    waiting = written(open_.groupBy("conv", "call").agg(F.count(F.lit(1)).alias("n")), "lexiflow-waiting")
    while not fresh.isEmpty() and not waiting.isEmpty():
        depth += 1
        met = open_.join(fresh.select("conv", F.col("call").alias("ref")), ["conv", "ref"]).groupBy("conv", "call").agg(F.count(F.lit(1)).alias("met"))
        now = written(waiting.join(met, ["conv", "call"], "left").select("conv", "call", (F.col("n") - F.coalesce("met", F.lit(0))).alias("n")), "lexiflow-waiting")
        fresh = written(now.where("n = 0").select("conv", "call", F.lit(depth).alias("level")), "lexiflow-levels")
        waiting = written(now.where("n > 0"), "lexiflow-waiting")
        parts.append(fresh)
    out = parts[0]
    for x in parts[1:]:
        out = out.unionByName(x)
    return out.unionByName(waiting.select("conv", "call", F.lit(None).cast("int").alias("level")))


def link(calls: DataFrame, results: DataFrame, tools: dict[str, dict[str, str]], block: int = 256) -> DataFrame:
    """calls: conv, turn, call, tool, arguments, refs (array of calls). results: conv, turn, call, content.

    Returns kind ('call' or 'orphan'), conv, call, turn, tool, level, position, result, errors and line.
    """
    one = results.where("conv is not null and call is not null").groupBy("conv", "call").agg(F.min(F.struct("turn", "content")).alias("r"), F.count(F.lit(1)).alias("n"))
    one = written(one, "lexiflow-results")
    known = written(calls.where("conv is not null and call is not null").select("conv", "call").distinct(), "lexiflow-calls")
    named = calls.where("conv is not null and call is not null").select("conv", "call", F.explode(F.array_distinct("refs")).alias("ref")).where("ref is not null")
    references = written(named.join(known.select("conv", F.col("call").alias("ref"), F.lit(True).alias("there")), ["conv", "ref"], "left"), "lexiflow-named")
    level = written(levels(known, references.where("there")), "lexiflow-levels")
    lost = written(references.where("there is null").groupBy("conv", "call").agg(F.array_sort(F.collect_set(F.concat(F.lit("ref:"), "ref"))).alias("lost")), "lexiflow-lost")
    rows = calls.join(level, ["conv", "call"], "left").join(lost, ["conv", "call"], "left").join(one.hint("shuffle_hash"), ["conv", "call"], "left")
    cyclic = F.when(F.col("level").isNull() & F.col("call").isNotNull() & F.col("conv").isNotNull(), F.array(F.lit("cycle"))).otherwise(F.array().cast("array<string>"))
    errors = F.concat(argument_errors(F.col("tool"), F.col("arguments"), tools), F.coalesce("lost", F.array().cast("array<string>")), cyclic)
    result = F.when(F.col("n").isNull(), "missing").when(F.col("n") > 1, "repeated").otherwise("ok")
    rows = rows.select("conv", "call", "turn", "tool", "level", result.alias("result"), errors.alias("errors"), F.col("r.content").alias("content"), json_value(F.col("arguments")).alias("arguments"))
    rows = rows.withColumn("block", F.floor(F.col("turn") / block)).withColumn("depth", F.coalesce("level", F.lit(2**31 - 1)))
    rows = written(rows.withColumn("line", F.to_json(F.struct(F.when(F.schema_of_variant("arguments").startswith("OBJECT"), F.col("arguments")).alias("arguments"), F.col("call").alias("id"), F.col("tool").alias("name"), F.col("content").alias("result")), {"ignoreNullFields": "false"})).drop("arguments", "content"), "lexiflow-linked")
    sizes = written(rows.groupBy("conv", "depth", "block").agg(F.count(F.lit(1)).alias("c")), "lexiflow-blocks")
    before = Window.partitionBy("conv").orderBy("depth", F.col("block").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, -1)
    first = written(sizes.select(F.col("conv").alias("_c"), F.col("depth").alias("_d"), F.col("block").alias("_b"), F.coalesce(F.sum("c").over(before), F.lit(0)).alias("first")), "lexiflow-blocks")
    inside = Window.partitionBy("conv", "depth", "block").orderBy("turn", "call", "tool", "line")
    numbered = rows.withColumn("k", F.row_number().over(inside)).join(first, F.col("conv").eqNullSafe(F.col("_c")) & (F.col("depth") == F.col("_d")) & F.col("block").eqNullSafe(F.col("_b")))
    out = numbered.select(F.lit("call").alias("kind"), "conv", "call", "turn", "tool", "level", (F.col("first") + F.col("k") - 1).cast("long").alias("position"), "result", "errors", "line")
    orphans = results.join(known, ["conv", "call"], "left_anti")
    empty = F.array().cast("array<string>")
    line = F.to_json(F.struct(F.col("call").alias("id"), F.col("content").alias("result")), {"ignoreNullFields": "false"})
    return out.unionByName(orphans.select(F.lit("orphan").alias("kind"), "conv", "call", "turn", F.lit(None).cast("string").alias("tool"), F.lit(None).cast("int").alias("level"), F.lit(None).cast("long").alias("position"), F.lit("orphan").alias("result"), empty.alias("errors"), line.alias("line")))


def calls_and_results(chat: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Calls and results made from a table of plain conversations, which has none: each assistant turn calls a tool, each user turn answers
    the turn before it. Some arguments break their schema, some calls refer to earlier ones, to none, or to each other."""
    name = lambda turn: F.concat(F.lit("c"), F.col("conv_id").cast("string"), F.lit("-"), turn.cast("string"))
    turn, digest = F.col("turn"), F.substring(F.md5(F.coalesce("text", F.lit(""))), 1, 8)
    tool = F.element_at(F.array(F.lit("sum"), F.lit("open"), F.lit("search")), (turn % 3 + 1).cast("int"))
    ref = F.when(turn % 13 == 9, name(turn + 2)).otherwise(name(turn - 2))
    t = turn.cast("string")
    search = F.concat(F.lit('{ "q": "'), digest, F.lit('", "limit": '), F.when(turn % 5 == 0, F.concat(F.lit('"'), t, F.lit('"'))).otherwise(t), F.lit("}"))
    opened = F.concat(F.lit('{"ref": "'), ref, F.lit('"'), F.when(turn % 7 == 0, F.lit("")).otherwise(F.concat(F.lit(', "depth": '), t)), F.lit(" }"))
    summed = F.concat(F.lit('{"ref" :"'), ref, F.lit('", "parts": [1, '), t, F.lit(']'), F.when(turn % 4 == 3, F.concat(F.lit(', "extra": {"b": 1, "a": "'), digest, F.lit('"}'))).otherwise(F.lit("")), F.lit("}"))
    arguments = F.when(turn % 11 == 10, F.lit("not json")).when(tool == "search", search).when(tool == "open", opened).otherwise(summed)
    calls = chat.where("role = 'assistant'").select(F.col("conv_id").alias("conv"), "turn", name(turn).alias("call"), tool.alias("tool"), arguments.alias("arguments"), F.when((tool != "search") & (turn % 11 != 10), F.array(ref)).otherwise(F.array().cast("array<string>")).alias("refs"))
    results = chat.where("role = 'user'").select(F.col("conv_id").alias("conv"), "turn", name(turn - 1).alias("call"), digest.alias("content"))
    return calls, results


OP7_SQL = r"""
WITH RECURSIVE a AS (
  SELECT conv_id, turn, role, substr(md5(coalesce(text, '')), 1, 8) AS d FROM conversations
), c AS (
  SELECT conv_id AS conv, turn, 'c' || conv_id || '-' || turn AS call, CASE turn % 3 WHEN 0 THEN 'sum' WHEN 1 THEN 'open' ELSE 'search' END AS tool, d, turn % 11 = 10 AS broken,
         CASE WHEN turn % 13 = 9 THEN 'c' || conv_id || '-' || (turn + 2) ELSE 'c' || conv_id || '-' || (turn - 2) END AS ref FROM a WHERE role = 'assistant'
), r AS (SELECT conv_id AS conv, turn, 'c' || conv_id || '-' || (turn - 1) AS call, d AS content FROM a WHERE role = 'user'
), one AS (SELECT conv, call, count(*) AS n, arg_min(content, turn) AS content FROM r GROUP BY ALL
), refs AS (SELECT c.conv, c.call, c.ref, k.call IS NOT NULL AS there FROM c LEFT JOIN c k ON k.conv = c.conv AND k.call = c.ref WHERE c.tool <> 'search' AND NOT c.broken
), lv AS (
  SELECT c.conv, c.call, 0 AS level FROM c LEFT JOIN refs USING (conv, call) WHERE coalesce(refs.there, false) = false
  UNION ALL SELECT refs.conv, refs.call, lv.level + 1 FROM lv JOIN refs ON refs.conv = lv.conv AND refs.ref = lv.call AND refs.there
), j AS (
  SELECT c.*, lv.level, CASE WHEN one.n IS NULL THEN 'missing' WHEN one.n > 1 THEN 'repeated' ELSE 'ok' END AS result, one.content, refs.there,
    CASE WHEN broken THEN 'null' WHEN tool = 'search' THEN '{"limit":' || CASE WHEN turn % 5 = 0 THEN '"' || turn || '"' ELSE turn::VARCHAR END || ',"q":"' || d || '"}'
         WHEN tool = 'open' THEN '{' || CASE WHEN turn % 7 = 0 THEN '' ELSE '"depth":' || turn || ',' END || '"ref":"' || c.ref || '"}'
         ELSE '{' || CASE WHEN turn % 4 = 3 THEN '"extra":{"a":"' || d || '","b":1},' ELSE '' END || '"parts":[1,' || turn || '],"ref":"' || c.ref || '"}' END AS args,
    list_filter([CASE WHEN broken THEN 'json' END, CASE WHEN NOT broken AND tool = 'search' AND turn % 5 = 0 THEN 'type:limit' END, CASE WHEN NOT broken AND tool = 'open' AND turn % 7 = 0 THEN 'missing:depth' END,
      CASE WHEN NOT broken AND tool = 'sum' AND turn % 4 = 3 THEN 'extra:extra' END, CASE WHEN refs.there = false THEN 'ref:' || c.ref END, CASE WHEN lv.level IS NULL THEN 'cycle' END], lambda x: x IS NOT NULL) AS errors
  FROM c LEFT JOIN lv USING (conv, call) LEFT JOIN one USING (conv, call) LEFT JOIN refs USING (conv, call)
)
SELECT 'call' AS kind, conv AS conv_id, call, turn, tool, level, row_number() OVER (PARTITION BY conv ORDER BY coalesce(level, 2147483647), turn, call) - 1 AS position, result, array_to_string(errors, ',') AS errors,
       '{"arguments":' || args || ',"id":"' || call || '","name":"' || tool || '","result":' || coalesce('"' || content || '"', 'null') || '}' AS line FROM j
UNION ALL
SELECT 'orphan', conv, call, turn, NULL, NULL, NULL, 'orphan', '', '{"id":"' || call || '","result":"' || content || '"}' FROM r ANTI JOIN c USING (conv, call)
"""
