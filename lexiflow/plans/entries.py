"""Queries over analogues of entries: deduplication, ranks, lookups, rendering."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text as tx
from ..operators import dedupe, lookup, render
from ..operators.ranking import keep_first, keep_last, numbered, rank_map, value_counts
from .registry import Tables, query

BIG = "bigint"


@query("SELECT conv_id, count(*) + count(*) FILTER (role = 'user') + count(*) FILTER (role = 'assistant') + count(*) FILTER (role = 'system') AS score FROM conversations GROUP BY conv_id")
def q_richness_score(t: Tables) -> DataFrame:
    none = F.array().cast("array<string>")
    per = lambda r: F.collect_list(F.when(F.col("role") == r, F.col("role")))
    entry = t.conversations.groupBy("conv_id").agg(F.collect_list("turn").alias("definitions"), per("user").alias("u"), per("assistant").alias("a"), per("system").alias("s"))
    entry = entry.select("conv_id", "definitions", none.alias("fixed_expressions"), none.alias("wordforms"), none.alias("udtale"), F.create_map(F.lit("user"), "u", F.lit("assistant"), "a", F.lit("system"), "s").alias("orddannelser"))
    return entry.select("conv_id", dedupe.richness().cast(BIG).alias("score"))


SQL_BEST = "SELECT *, row_number() OVER (PARTITION BY p_name ORDER BY p_size DESC, p_partkey) AS k, min(p_partkey) OVER (PARTITION BY p_name) AS group_position FROM part"


@query(f"SELECT p_name, p_partkey, p_size, p_brand, group_position FROM ({SQL_BEST}) WHERE k = 1")
def q_dedupe_argmax(t: Tables) -> DataFrame:
    return dedupe.richest(t.part.select("p_name", "p_partkey", "p_size", "p_brand"), ["p_name"], F.col("p_size"), "p_partkey")


@query("SELECT sum(n)::BIGINT AS total, count(*) AS distinct_keys, (sum(n) - count(*))::BIGINT AS duplicates FROM (SELECT p_name, count(*) AS n FROM part GROUP BY 1)")
def q_dup_stats(t: Tables) -> DataFrame:
    return dedupe.duplicate_stats(t.part, "p_name")


@query("SELECT p_name, count(*) AS n, min(p_partkey) AS first_seen FROM part GROUP BY 1 HAVING count(*) > 1")
def q_dup_listing(t: Tables) -> DataFrame:
    return dedupe.duplicate_listing(t.part, "p_name", "p_partkey")


@query("SELECT md5(text) AS text_md5, min(doc_id) AS doc_id FROM documents GROUP BY text")
def q_keep_first(t: Tables) -> DataFrame:
    # by digest and length, so that texts aren't shuffled
    rows = t.documents.select(F.md5("text").alias("text_md5"), F.sha2("text", 256).alias("sha"), "doc_id")
    return keep_first(rows, ["text_md5", "sha"], F.col("doc_id")).select("text_md5", "doc_id")


SQL_LAST = "SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_shipdate DESC, l_partkey DESC, l_suppkey DESC, l_quantity DESC) AS k FROM lineitem"


def last_lines(t: Tables) -> DataFrame:
    rows = t.lineitem.select("l_orderkey", "l_linenumber", "l_shipdate", "l_partkey", "l_suppkey", "l_quantity")
    return keep_last(rows, ["l_orderkey", "l_linenumber"], F.col("l_shipdate"), F.col("l_partkey"), F.col("l_suppkey"), F.col("l_quantity")).drop("l_shipdate")


@query(f"SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity FROM ({SQL_LAST}) WHERE k = 1")
def q_keep_last(t: Tables) -> DataFrame:
    return last_lines(t)


def words(t: Tables, limit: str = "true") -> DataFrame:
    return t.part.where(limit).select(F.col("p_name").alias("word"), (F.col("p_partkey") + 1).cast("int").alias("rank"))


@query("SELECT lower(p_name) AS word, max(p_partkey + 1)::INTEGER AS rank FROM part GROUP BY 1")
def q_rank_map(t: Tables) -> DataFrame:
    return rank_map(words(t))


SQL_RANKS = "SELECT lower(p_name) AS w, max(p_partkey + 1) AS r FROM part WHERE p_partkey % 3 = 0 GROUP BY 1"


@query(f"""WITH e AS (SELECT p_partkey, 'dir/' || p_name || '.html' AS file, CASE WHEN p_partkey % 5 = 0 THEN NULL ELSE lower(p_name) END AS w FROM part),
k AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY w ORDER BY p_partkey) AS n FROM e) WHERE w IS NULL OR n = 1)
SELECT p_partkey, r::INTEGER AS frequency_rank, row_number() OVER (ORDER BY r NULLS LAST, p_partkey) - 1 AS position FROM k LEFT JOIN ({SQL_RANKS}) USING (w)""")
def q_rank_left_join_sort(t: Tables) -> DataFrame:
    file = F.when(F.col("p_partkey") % 5 != 0, F.concat(F.lit("dir/"), F.col("p_name"), F.lit(".html")))
    entries = t.part.select("p_partkey", file.alias("file"))
    ranked = lookup.ranked_entries(entries, words(t, "p_partkey % 3 = 0"), "p_partkey").select("p_partkey", "frequency_rank")
    return numbered(ranked, F.col("frequency_rank").asc_nulls_last(), "p_partkey")


@query(f"""WITH e AS (SELECT p_partkey, r, row_number() OVER (PARTITION BY p_name ORDER BY p_partkey DESC) AS k FROM part LEFT JOIN (SELECT p_name, min(p_partkey + 1) AS r FROM part WHERE p_partkey % 50 = 0 GROUP BY 1) USING (p_name))
SELECT p_partkey, r::INTEGER AS rank FROM e WHERE r IS NULL OR k = 1""")
def q_wordlist_driven_order(t: Tables) -> DataFrame:
    entries = t.part.select("p_partkey", F.concat(F.lit("dir/"), F.col("p_name"), F.lit(".html")).alias("file"))
    return lookup.listed_entries(entries, words(t, "p_partkey % 50 = 0"), "p_partkey").select("p_partkey", "rank")


@query("SELECT o_orderkey, o_custkey, o_orderstatus FROM orders ORDER BY o_orderkey LIMIT 500")
def q_limit_head(t: Tables) -> DataFrame:
    return t.orders.select("o_orderkey", "o_custkey", "o_orderstatus").orderBy("o_orderkey").limit(500)


@query("SELECT event_type, n, first_seen, row_number() OVER (ORDER BY n DESC, first_seen) AS place FROM (SELECT event_type, count(*) AS n, min(event_id) AS first_seen FROM events WHERE event_type <> '' GROUP BY 1)")
def q_pos_counts(t: Tables) -> DataFrame:
    return numbered(value_counts(t.events, "event_type", "event_id"), F.desc("n"), "first_seen", name="place", start=1)


@query("SELECT string_agg(event_type, ', ' ORDER BY n DESC, f) AS payload FROM (SELECT event_type, count(*) AS n, min(event_id) AS f FROM events WHERE event_type <> '' GROUP BY 1)")
def q_pos_distinct_prompt(t: Tables) -> DataFrame:
    counts = value_counts(t.events, "event_type", "event_id")
    return counts.agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct((-F.col("n")).alias("n"), "first_seen", "event_type"))), lambda x: x.event_type), ", ").alias("payload"))


@query("SELECT l_orderkey, count(DISTINCT l_suppkey) AS n FROM lineitem GROUP BY 1 HAVING count(DISTINCT l_suppkey) > 4")
def q_suspicious_values(t: Tables) -> DataFrame:
    return t.lineitem.select("l_orderkey", "l_suppkey").distinct().groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("n")).where("n > 4")


@query("""WITH a AS (SELECT DISTINCT event_type AS e FROM events), g AS (SELECT DISTINCT user_id, strftime(ts, '%Y-%m-%d') AS day, event_type AS e FROM events), u AS (SELECT DISTINCT user_id, day FROM g)
SELECT user_id, day, coalesce(string_agg(a.e, ',' ORDER BY a.e) FILTER (g.e IS NULL), '') AS missing, '' AS extra, count(*) FILTER (g.e IS NULL) = 0 AS same FROM u CROSS JOIN a LEFT JOIN g USING (user_id, day, e) GROUP BY user_id, day""")
def q_set_diff_report(t: Tables) -> DataFrame:
    everything = F.array(*[F.lit(x) for x in ("click", "error", "purchase", "signup", "view")])
    got = t.events.groupBy("user_id", F.date_format("ts", "yyyy-MM-dd").alias("day")).agg(F.collect_set("event_type").alias("got"))
    missing, extra, same = lookup.set_report(everything, F.col("got"))
    return got.select("user_id", "day", F.array_join(missing, ",").alias("missing"), F.array_join(extra, ",").alias("extra"), same.alias("same"))


@query("SELECT c_custkey, c_mktsegment || coalesce(' (' || nullif(n_name, '') || ')', '') AS labelled FROM customer LEFT JOIN (SELECT * FROM nation WHERE n_nationkey < 20) ON c_nationkey = n_nationkey")
def q_pos_label_join(t: Tables) -> DataFrame:
    labels = t.nation.where("n_nationkey < 20").select(F.col("n_nationkey").alias("c_nationkey"), "n_name")
    return lookup.label_join(t.customer.select("c_custkey", "c_nationkey", "c_mktsegment"), labels, "c_nationkey", F.col("c_mktsegment"), "n_name").select("c_custkey", "labelled")


@query(f"SELECT o_orderkey, n AS l_linenumber, l_partkey, l_suppkey FROM orders CROSS JOIN (SELECT unnest(range(1, 4))::INTEGER AS n) LEFT JOIN (SELECT * FROM ({SQL_LAST}) WHERE k = 1) l ON l_orderkey = o_orderkey AND l_linenumber = n")
def q_composite_lookup(t: Tables) -> DataFrame:
    wanted = t.orders.select(F.col("o_orderkey").alias("l_orderkey"), F.explode(F.sequence(F.lit(1), F.lit(3))).alias("l_linenumber"))
    return wanted.join(last_lines(t), ["l_orderkey", "l_linenumber"], "left").select(F.col("l_orderkey").alias("o_orderkey"), "l_linenumber", "l_partkey", "l_suppkey")


@query("SELECT doc_id, source FROM documents SEMI JOIN labels USING (doc_id)")
def q_media_semi(t: Tables) -> DataFrame:
    return t.documents.select("doc_id", "source").join(t.labels.select("doc_id"), "doc_id", "left_semi")


@query("SELECT DISTINCT l_partkey FROM lineitem WHERE l_returnflag = 'R'")
def q_media_distinct(t: Tables) -> DataFrame:
    return t.lineitem.where("l_returnflag = 'R'").select("l_partkey").distinct()


@query("SELECT conv_id, string_agg(coalesce(quality::VARCHAR, '-'), ' ' ORDER BY turn) AS found FROM conversations LEFT JOIN labels ON conv_id + turn = doc_id GROUP BY conv_id")
def q_elementwise_lookup(t: Tables) -> DataFrame:
    lists = t.conversations.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", (F.col("conv_id") + F.col("turn")).alias("doc_id")))).alias("items"))
    out = lookup.elementwise(lists, "conv_id", "items", t.labels, "doc_id", "quality")
    return out.select("conv_id", F.array_join(F.transform("found", lambda x: F.coalesce(x.cast("string"), F.lit("-"))), " ").alias("found"))


@query("SELECT conv_id, row_number() OVER w - 1 AS idx, md5(text) AS text_md5 FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn)")
def q_index_rejoin(t: Tables) -> DataFrame:
    texts = t.conversations.groupBy("conv_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("turn", F.md5("text").alias("s")))), lambda x: x.s).alias("texts"))
    reply = F.transform("texts", lambda _, i: F.struct(i.cast("string").alias("key"), F.lit(1).alias("value")))  # "0".."n-1", as a reply has them
    return texts.select("conv_id", "texts", F.explode(reply).alias("r")).select("conv_id", F.col("r.key").cast(BIG).alias("idx"), F.expr("element_at(texts, cast(r.key as int) + 1)").alias("text_md5"))


@query("SELECT conv_id, coalesce(string_agg(turn || ' ' || text, '<br>' ORDER BY turn) FILTER (role = 'system'), '(no definition)') AS definition FROM conversations GROUP BY conv_id")
def q_def_concat(t: Tables) -> DataFrame:
    line = F.concat_ws(" ", F.col("turn").cast("string"), F.col("text"))
    found = t.conversations.groupBy("conv_id").agg(F.collect_list(F.when(F.col("role") == "system", F.struct(F.col("turn").alias("k"), line.alias("s")))).alias("x"))
    return found.select("conv_id", render.or_placeholder(tx.ordered_text(F.col("x"), "<br>")).alias("definition"))


@query("SELECT conv_id, coalesce(arg_min(text, turn) FILTER (role = 'assistant' AND text <> ''), '') AS first_text FROM conversations GROUP BY conv_id")
def q_first_nonempty(t: Tables) -> DataFrame:
    lists = t.conversations.groupBy("conv_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("turn", F.when(F.col("role") == "assistant", F.col("text")).alias("s")))), lambda x: x.s).alias("x"))
    return lists.select("conv_id", tx.first_nonempty(F.col("x")).alias("first_text"))


@query("""SELECT user_id, string_agg(nullif(p, ''), '; ' ORDER BY event_id) AS dropped, string_agg(p, ', ' ORDER BY event_id) AS kept
FROM (SELECT user_id, event_id, CASE WHEN event_id % 4 = 0 THEN '' ELSE replace(replace(props, '{', ''), '}', '') END AS p FROM events) GROUP BY user_id""")
def q_join_safe(t: Tables) -> DataFrame:
    p = F.when(F.col("event_id") % 4 == 0, "").otherwise(F.col("props"))
    lists = t.events.groupBy("user_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("event_id", p.alias("s")))), lambda x: x.s).alias("x"))
    return lists.select("user_id", tx.join_safe(F.col("x")).alias("dropped"), tx.join_safe(F.transform("x", tx.sanitize), ", ", keep_empty=True).alias("kept"))


@query("""SELECT o_custkey, string_agg(o_orderkey::VARCHAR, ', ' ORDER BY CASE o_orderstatus WHEN 'F' THEN 0 WHEN 'O' THEN 1 ELSE 2 END, o_orderkey) AS derivatives FROM orders WHERE o_orderstatus IN ('F', 'O', 'P') GROUP BY o_custkey""")
def q_concat_categories(t: Tables) -> DataFrame:
    per = t.orders.where("o_orderstatus in ('F', 'O', 'P')").groupBy("o_custkey", "o_orderstatus").agg(F.transform(F.array_sort(F.collect_list("o_orderkey")), lambda x: x.cast("string")).alias("keys"))
    maps = per.groupBy("o_custkey").agg(F.map_from_entries(F.collect_list(F.struct("o_orderstatus", "keys"))).alias("m"))
    return maps.select("o_custkey", tx.join_safe(render.categories(F.col("m"), ["F", "O", "P"]), ", ").alias("derivatives"))


@query("""SELECT p_brand, string_agg(p_name || CASE WHEN k % 2 = 0 THEN '<div class="translation">' || k || ' (' || p_size || ')</div>' ELSE '' END, '<br>' ORDER BY k) AS collocations
FROM (SELECT p_brand, p_name, min(p_partkey) AS k, arg_min(p_size, p_partkey) AS p_size FROM part GROUP BY 1, 2) GROUP BY p_brand""")
def q_collocations(t: Tables) -> DataFrame:
    rows = keep_first(t.part.select("p_brand", "p_name", "p_partkey", "p_size"), ["p_brand", "p_name"], F.col("p_partkey"))
    translated = F.col("p_partkey") % 2 == 0
    line = render.translated(F.col("p_name"), F.when(translated, F.col("p_partkey").cast("string")), F.when(translated, F.col("p_size").cast("string")))
    return rows.groupBy("p_brand").agg(tx.ordered_text(F.collect_list(F.struct("p_partkey", line.alias("s"))), "<br>").alias("collocations"))


@query("""SELECT p_partkey, '<div class="ipa-row"><span class="ipa-text">[' || p_name || ']</span>' || CASE WHEN p_size % 2 = 0 THEN '<span class="ipa-label">(' || p_type || ')</span>' ELSE '' END
 || CASE WHEN p_size % 3 = 0 THEN '[sound:' || p_brand || '.mp3]' ELSE '' END || '</div>' AS ipa FROM part""")
def q_ipa_rows(t: Tables) -> DataFrame:
    p = t.part
    item = F.struct(F.concat(F.lit("[ "), p.p_name, F.lit(" ]")).alias("ipa"), F.when(p.p_size % 2 == 0, p.p_type).alias("label"), F.when(p.p_size % 3 == 0, F.concat(F.lit("audio/"), p.p_brand, F.lit(".mp3"))).alias("path"))
    return p.select("p_partkey", render.pronunciations(F.array(item)).alias("ipa"))


@query("SELECT n_nationkey, CASE WHEN n_regionkey = 2 THEN '使用' ELSE 'Made with' END || ' ' || 2024 AS footer FROM nation")
def q_footer_switch(t: Tables) -> DataFrame:
    language = F.when(F.col("n_regionkey") == 2, "Chinese").otherwise("Danish")
    return t.nation.select("n_nationkey", render.footer(language, F.lit(2024)).alias("footer"))


@query("""SELECT c_name AS "Headword", c_mktsegment AS "POS", '' AS "IPA", '1 ' || c_name AS "Definition", '' AS "Grammar", c_mktsegment AS "Example", c_name || '; ' || c_mktsegment AS "Variants", '' AS "Collocations",
 c_nationkey::VARCHAR AS "Derivatives", '' AS "Etymology", printf('%05d', c_custkey) AS "FrequencyRank", substr(sha256(c_name || chr(31) || c_mktsegment || '-danish'), 1, 20) AS guid FROM customer""")
def q_note_assembly(t: Tables) -> DataFrame:
    c = t.customer
    fields = {"Headword": c.c_name, "POS": c.c_mktsegment, "Definition": F.concat(F.lit("1 "), c.c_name), "Example": c.c_mktsegment, "Variants": tx.join_safe(F.array("c_name", "c_mktsegment")), "Derivatives": c.c_nationkey.cast("string"), "FrequencyRank": tx.rank_text(c.c_custkey)}
    return render.notes(c, fields, guid=tx.guid(c.c_name, F.concat(c.c_mktsegment, F.lit("-danish"))))


@query("SELECT doc_id, CASE WHEN length(text) > 120 THEN substr(regexp_replace(replace(replace(text, '{', ''), '}', ''), '^[\\s\\p{Z}]+|[\\s\\p{Z}]+$', '', 'g'), 1, 120) || '…' ELSE regexp_replace(replace(replace(text, '{', ''), '}', ''), '^[\\s\\p{Z}]+|[\\s\\p{Z}]+$', '', 'g') END AS etymology FROM documents")
def q_ellipsis_120(t: Tables) -> DataFrame:
    return t.documents.select("doc_id", tx.ellipsis(F.col("text")).alias("etymology"))


@query("SELECT doc_id, CASE WHEN text <> '' THEN substr(regexp_replace(replace(replace(text, '{', ''), '}', ''), '^[\\s\\p{Z}]+|[\\s\\p{Z}]+$', '', 'g'), 1, 120) || '…' ELSE '' END AS etymology FROM documents")
def q_ellipsis_always(t: Tables) -> DataFrame:
    return t.documents.select("doc_id", tx.ellipsis(F.col("text"), always=True).alias("etymology"))


@query("SELECT o_orderkey, printf('%05d', o_orderkey) AS rank_text, row_number() OVER (ORDER BY printf('%05d', o_orderkey)) - 1 AS position FROM orders")
def q_rank_text(t: Tables) -> DataFrame:
    return numbered(t.orders.select("o_orderkey", tx.rank_text(F.col("o_orderkey")).alias("rank_text")), "rank_text")


@query("SELECT event_id, replace(replace(props, '{', ''), '}', '') AS clean FROM events")
def q_sanitize(t: Tables) -> DataFrame:
    return t.events.select("event_id", tx.sanitize(F.col("props")).alias("clean"))


@query("SELECT c_custkey, regexp_replace(c_name, '\\d+$', '') AS name FROM customer")
def q_trailing_digits(t: Tables) -> DataFrame:
    return t.customer.select("c_custkey", tx.strip_digits(F.col("c_name")).alias("name"))


@query("SELECT p_partkey, split_part(p_name, ' ', 1) || 'en, ' || split_part(p_name, ' ', 2) || ', -abcdefg' AS forms FROM part")
def q_suffix_expand(t: Tables) -> DataFrame:
    forms = tx.split_forms(F.concat(F.lit(" -en, ,"), F.split_part("p_name", F.lit(" "), F.lit(2)), F.lit(", -abcdefg")))
    return t.part.select("p_partkey", F.array_join(tx.expand_suffixes(F.split_part("p_name", F.lit(" "), F.lit(1)), forms), ", ").alias("forms"))


@query("SELECT source, max_by(doc_id, doc_id) AS doc_id, max(doc_id) % 7 AS value FROM documents GROUP BY source")
def q_category_map_last(t: Tables) -> DataFrame:
    rows = t.documents.select("source", "doc_id", (F.col("doc_id") % 7).alias("value"))
    return keep_last(rows, ["source"], F.col("doc_id"))


@query("SELECT c_custkey, substr(sha256(c_name || chr(31) || c_mktsegment), 1, 20) AS guid FROM customer")
def q_guid(t: Tables) -> DataFrame:
    return t.customer.select("c_custkey", tx.guid(F.col("c_name"), F.col("c_mktsegment")).alias("guid"))


@query("SELECT event_type, a AS adler FROM (VALUES ('click', 101712391::BIGINT), ('error', 107741739::BIGINT), ('purchase', 258212700::BIGINT), ('signup', 151323287::BIGINT), ('view', 72876476::BIGINT)) v(event_type, a)")
def q_adler32(t: Tables) -> DataFrame:
    return t.events.select("event_type").distinct().select("event_type", tx.adler32(F.col("event_type")).alias("adler"))


@query("SELECT conv_id, turn, md5(nfc_normalize(text)) AS nfc_md5 FROM conversations")
def q_nfc(t: Tables) -> DataFrame:
    apart = F.col("text")
    for whole, parts in (("é", "é"), ("è", "è"), ("ä", "ä"), ("ö", "ö"), ("ñ", "ñ")):
        apart = F.replace(apart, F.lit(whole), F.lit(parts))
    return t.conversations.select("conv_id", "turn", F.md5(tx.nfc(apart)).alias("nfc_md5"))


@query("""SELECT count(*) FILTER (r IS NOT NULL) AS ranked, count(*) FILTER (r IS NULL) AS unranked, count(*) AS cards FROM part LEFT JOIN (SELECT DISTINCT p_name, 1 AS r FROM part WHERE p_partkey % 50 = 0) USING (p_name)""")
def q_report_counters(t: Tables) -> DataFrame:
    listed = words(t, "p_partkey % 50 = 0").select(F.col("word").alias("p_name")).distinct().withColumn("r", F.lit(1))
    return t.part.select("p_name").join(listed, "p_name", "left").agg(F.count_if(F.col("r").isNotNull()).alias("ranked"), F.count_if(F.col("r").isNull()).alias("unranked"), F.count(F.lit(1)).alias("cards"))
