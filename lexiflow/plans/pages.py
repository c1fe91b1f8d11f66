"""Queries over web pages: extraction, URLs, versions, resume."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text as tx
from ..functions import url as ux
from ..operators import dedupe, lookup
from ..operators.ranking import numbered
from .registry import Tables, query

NAV = "(?s)<nav>(.*?)</nav>"
ANCHOR = '<a href="([^"]*)">([^<]*)</a>'


def anchors(t: Tables, whole_page: bool = False) -> DataFrame:
    """page_id, pos, href, text of the links of each page, in order."""
    html = F.col("html") if whole_page else F.regexp_extract("html", NAV, 1)
    both = F.arrays_zip(F.regexp_extract_all(html, F.lit(ANCHOR), F.lit(1)).alias("href"), F.regexp_extract_all(html, F.lit(ANCHOR), F.lit(2)).alias("text"))
    return t.pages.select("page_id", F.posexplode(both).alias("pos", "a")).select("page_id", F.col("pos").cast("bigint").alias("pos"), "a.href", "a.text")


SQL_ANCHORS = """
SELECT page_id, unnest(range(len(h))) AS pos, unnest(h) AS href, unnest(x) AS text FROM (
  SELECT page_id, regexp_extract_all({html}, '<a href="([^"]*)">([^<]*)</a>', 1) AS h, regexp_extract_all({html}, '<a href="([^"]*)">([^<]*)</a>', 2) AS x FROM pages)
"""
SQL_NAV = SQL_ANCHORS.format(html="regexp_extract(html, '(?s)<nav>(.*?)</nav>', 1)")
SQL_ALL = SQL_ANCHORS.format(html="html")


@query(f"SELECT page_id, pos + 1 AS rank, lower(text) AS word FROM ({SQL_NAV})")
def q_html_list_words(t: Tables) -> DataFrame:
    return anchors(t).select("page_id", (F.col("pos") + 1).alias("rank"), F.lower("text").alias("word"))


@query("SELECT page_id, trim(regexp_extract(html, '(?s)<title>(.*?)</title>', 1)) AS title FROM pages")
def q_html_title_text(t: Tables) -> DataFrame:
    return t.pages.select("page_id", F.trim(F.regexp_extract("html", "(?s)<title>(.*?)</title>", 1)).alias("title"))


@query(f"SELECT page_id, count(*) AS n_links, string_agg(href, ' ' ORDER BY pos) AS hrefs FROM (SELECT page_id, href, min(pos) AS pos FROM ({SQL_ALL}) GROUP BY ALL) GROUP BY page_id")
def q_html_links_distinct(t: Tables) -> DataFrame:
    found = F.array_distinct(F.regexp_extract_all("html", F.lit(ANCHOR), F.lit(1)))
    return t.pages.select("page_id", found.alias("h")).where(F.size("h") > 0).select("page_id", F.size("h").cast("bigint").alias("n_links"), F.array_join("h", " ").alias("hrefs"))


def _sql_param(name: str) -> str:
    return f"nullif(url_decode(regexp_extract(url, '[?&]{name}=([^&#]*)', 1)), '')"


@query(f"SELECT page_id, {_sql_param('page')} AS page, {_sql_param('ref')} AS ref, {_sql_param('utm_source')} AS utm_source, coalesce({_sql_param('ref')} = 'x', false) AS is_x FROM pages WHERE url LIKE '%?%'")
def q_url_query_param(t: Tables) -> DataFrame:
    u = F.col("url")
    rows = t.pages.where(u.contains("?")).select("page_id", *[ux.query_param(u, n).alias(n) for n in ("page", "ref", "utm_source")])
    return rows.withColumn("is_x", F.coalesce(F.col("ref") == "x", F.lit(False)))


SQL_PATH = "regexp_replace(regexp_replace(url, '[?#].*$', ''), '^[A-Za-z][A-Za-z0-9+.-]*://[^/]*', '')"


@query(f"""SELECT page_id, replace(CASE WHEN page_id % 3 = 0 THEN 'my file ' || page_id || '.mp3' ELSE regexp_extract({SQL_PATH}, '([^/]*)$', 1) END, ' ', '.') AS name FROM pages""")
def q_url_filename(t: Tables) -> DataFrame:
    header = F.when(F.col("page_id") % 3 == 0, F.concat(F.lit('attachment; filename="my file '), F.col("page_id").cast("string"), F.lit('.mp3"')))
    return t.pages.select("page_id", ux.media_name(header, F.col("url")).alias("name"))


@query("SELECT page_id, regexp_extract(url, '([^/]*)$', 1) AS base, regexp_extract(regexp_extract(url, '([^/]*)$', 1), '^(.+?)(?:\\.[^.]*)?$', 1) AS stem FROM pages")
def q_stem_basename(t: Tables) -> DataFrame:
    return t.pages.select("page_id", tx.basename(F.col("url")).alias("base"), tx.stem(F.col("url")).alias("stem"))


HOST = "^[a-z]+://([^/?#]*)"
SQL_HOST = "regexp_extract(url, '^[a-z]+://([^/?#]*)', 1)"


@query(f"SELECT host, page_id, n_bytes FROM (SELECT {SQL_HOST} AS host, page_id, strlen(html) AS n_bytes, row_number() OVER (PARTITION BY {SQL_HOST} ORDER BY strlen(html) DESC, page_id) AS k FROM pages WHERE html IS NOT NULL) WHERE k = 1")
def q_alt_versions_largest(t: Tables) -> DataFrame:
    versions = t.pages.select(F.regexp_extract("url", HOST, 1).alias("host"), "page_id", "html")
    return dedupe.largest_version(versions, "host", "html", "page_id").select("host", "page_id", F.octet_length("html").cast("bigint").alias("n_bytes"))


@query(f"""WITH p AS (SELECT {SQL_HOST} AS host, page_id, html, count(*) OVER (PARTITION BY {SQL_HOST}) AS n,
  row_number() OVER (PARTITION BY {SQL_HOST} ORDER BY strlen(html) DESC, page_id) AS k, row_number() OVER (PARTITION BY {SQL_HOST} ORDER BY page_id) AS f FROM pages)
SELECT a.host, a.n AS versions, a.page_id AS chosen, md5(a.html) AS content, md5(b.html) AS backup FROM p a JOIN p b ON a.host = b.host AND a.k = 1 AND b.f = 1 WHERE a.n > 1""")
def q_alt_versions_multi(t: Tables) -> DataFrame:
    versions = t.pages.select(F.regexp_extract("url", HOST, 1).alias("host"), "page_id", F.col("html").alias("content"))
    several = versions.groupBy("host").agg(F.count(F.lit(1)).alias("versions"), F.min_by("content", "page_id").alias("content")).where("versions > 1")
    chosen = dedupe.largest_version(versions.join(several.select("host"), "host", "left_semi"), "host", "content", "page_id")
    new = dedupe.replaced(several.select("host", "content"), chosen, "host")
    return several.select("host", "versions").join(chosen.select("host", F.col("page_id").alias("chosen")), "host").join(new, "host").select("host", "versions", "chosen", F.md5("content").alias("content"), F.md5("backup").alias("backup"))


@query("SELECT page_id, url, row_number() OVER (ORDER BY url, page_id) - 1 AS position FROM pages WHERE url LIKE '%.html'")
def q_html_page_filter(t: Tables) -> DataFrame:
    return numbered(t.pages.where(F.col("url").endswith(".html")).select("page_id", "url"), "url", "page_id")


@query("SELECT 'documents' AS kind, count(*) AS n, sum(doc_id)::BIGINT AS ids FROM documents ANTI JOIN labels USING (doc_id) UNION ALL SELECT 'orders', count(*), sum(o_orderkey)::BIGINT FROM orders ANTI JOIN lineitem ON o_orderkey = l_orderkey")
def q_pending_antijoin(t: Tables) -> DataFrame:
    docs = lookup.pending(t.documents.select("doc_id"), t.labels, ["doc_id"])
    orders = lookup.pending(t.orders.select(F.col("o_orderkey").alias("l_orderkey")), t.lineitem, ["l_orderkey"])
    return docs.agg(F.lit("documents").alias("kind"), F.count(F.lit(1)).alias("n"), F.sum("doc_id").alias("ids")).unionByName(orders.agg(F.lit("orders").alias("kind"), F.count(F.lit(1)).alias("n"), F.sum("l_orderkey").alias("ids")))


@query("SELECT user_id, count(*) FILTER (event_type <> 'error') AS n_ok, count(*) FILTER (event_type = 'error') AS n_error, min(event_id) FILTER (event_type = 'error') AS first_error FROM events GROUP BY user_id")
def q_error_split(t: Tables) -> DataFrame:
    bad = F.col("event_type") == "error"
    return t.events.groupBy("user_id").agg(F.count_if(~bad).alias("n_ok"), F.count_if(bad).alias("n_error"), F.min(F.when(bad, F.col("event_id"))).alias("first_error"))


@query("SELECT doc_id, quality, 'old' AS origin FROM labels UNION ALL SELECT doc_id, NULL, 'new' FROM documents ANTI JOIN labels USING (doc_id)")
def q_upsert_existing_wins(t: Tables) -> DataFrame:
    old = t.labels.select("doc_id", "quality", F.lit("old").alias("origin"))
    return lookup.upsert(old, t.documents.select("doc_id", F.lit(None).cast("int").alias("quality"), F.lit("new").alias("origin")), ["doc_id"])


@query("SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN 'late' ELSE 'early' END AS part, CASE WHEN doc_id % 3 = 0 THEN quality + 10 ELSE quality END AS quality FROM labels")
def q_merge_last_wins(t: Tables) -> DataFrame:
    early = t.labels.select("doc_id", F.lit("early").alias("part"), "quality")
    late = t.labels.where("doc_id % 3 = 0").select("doc_id", F.lit("late").alias("part"), (F.col("quality") + 10).alias("quality"))
    return lookup.merged([early, late], ["doc_id"])


@query("SELECT n_nationkey, n_name, n_regionkey, '{\"n_nationkey\":' || n_nationkey || ',\"n_name\":\"' || n_name || '\",\"n_regionkey\":' || n_regionkey || '}' AS doc FROM nation")
def q_json_roundtrip(t: Tables) -> DataFrame:
    rows = t.nation
    doc = rows.select(F.to_json(F.struct("n_nationkey", "n_name", "n_regionkey")).alias("doc"))
    return doc.withColumn("r", F.from_json("doc", rows.schema)).select("r.n_nationkey", "r.n_name", "r.n_regionkey", "doc")


UNWANTED = ["The", "la", "de", "of"]


@query(f"SELECT page_id, pos, regexp_replace(text, '\\d+$', '') AS word FROM ({SQL_NAV}) WHERE text NOT IN ('The', 'la', 'de', 'of') AND regexp_replace(text, '\\d+$', '') <> ''")
def q_unwanted_filter(t: Tables) -> DataFrame:
    return anchors(t).withColumn("word", F.element_at(F.concat(tx.clean_links(F.array("text"), UNWANTED), F.array(F.lit(""))), 1)).where("word <> ''").select("page_id", "pos", "word")


@query(f"SELECT page_id, count(*) FILTER (starts_with(href, '/')) AS n_local, count(*) FILTER (href LIKE '%,') AS n_comma, count(*) FILTER (regexp_matches(href, '[A-Z]')) AS n_upper FROM ({SQL_ALL}) GROUP BY page_id")
def q_class_tests(t: Tables) -> DataFrame:
    h = F.col("href")
    return anchors(t, whole_page=True).groupBy("page_id").agg(F.count_if(h.startswith("/")).alias("n_local"), F.count_if(h.endswith(",")).alias("n_comma"), F.count_if(h.rlike("[A-Z]")).alias("n_upper"))


@query("""SELECT page_id, regexp_extract(html, '(?s)<h1>(.*?)</h1>', 1) AS headword, nullif(regexp_extract(html, '(?s)<footer>(.*?)</footer>', 1), '') AS footer
FROM pages WHERE html LIKE '%<article>%' AND html NOT LIKE '%$$$%'""")
def q_entry_gate(t: Tables) -> DataFrame:
    html = F.col("html")
    gate = html.contains("<article>") & ~html.contains("$$$")
    return t.pages.where(gate).select("page_id", F.regexp_extract("html", "(?s)<h1>(.*?)</h1>", 1).alias("headword"), F.nullif(F.regexp_extract("html", "(?s)<footer>(.*?)</footer>", 1), F.lit("")).alias("footer"))
