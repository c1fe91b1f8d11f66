"""Not-modified revisit resolution for web captures [DataFrame functions].

A revisit record (a 304 answer) has no body. It is joined, as of its time, with the latest earlier full response of the same
canonical URL. The validators must agree: the entity tag if the revisit has one (weak comparison), else the time of the last
modification; without either it is taken unvalidated. On agreement the response's headers are updated with those that a 304
may change; those that describe the body stay.

The as-of join is a union and a window, without pairs of captures. So that a URL with a third of all captures is no single task, a window covers
one span of time of one URL; what an earlier span leaves is carried over by a window on a row for each span.

Defined cases: a null URL or time resolves to nothing (`unresolved`), as does a revisit without an earlier response; captures of the same
time are ordered by id; repeated rows each get a result; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import written

#: Headers of a stored response that a 304 answer must not change, in lower case.
KEPT_HEADERS = ["connection", "content-encoding", "content-length", "content-md5", "content-range", "content-type", "proxy-authenticate", "proxy-authorization", "te", "trailer", "transfer-encoding", "upgrade"]
#: Fixed value: query parameters that name a visit, not a page.
TRACKING = "^(utm_[a-z]+|ref|sid|sessionid|phpsessid|jsessionid|fbclid|gclid)(=|$)"


def canonical_url(url: Column) -> Column:
    """Host in lower case without scheme, `www.` and default port; path without a closing slash; query without tracking, sorted."""
    body = F.regexp_replace(F.regexp_replace(url, "#.*$", ""), "^[A-Za-z][A-Za-z0-9+.-]*://", "")
    host = F.regexp_replace(F.regexp_replace(F.lower(F.regexp_extract(body, "^([^/?]*)", 1)), "^www\\.", ""), ":(80|443)$", "")
    rest = F.regexp_replace(body, "^[^/?]*", "")
    path = F.regexp_replace(F.regexp_extract(rest, "^([^?]*)", 1), "/+$", "")
    query = F.array_sort(F.filter(F.split(F.regexp_extract(rest, "\\?(.*)$", 1), "&"), lambda x: (x != "") & ~F.lower(x).rlike(TRACKING)))
    return F.concat(host, path, F.when(F.size(query) > 0, F.concat(F.lit("?"), F.array_join(query, "&"))).otherwise(""))


def _bare(tag: Column) -> Column:
    return F.regexp_replace(tag, "^W/", "")


def resolve(captures: DataFrame, span: int = 100_000) -> DataFrame:
    """captures: record_id, url, ts (a whole number), kind ('response' or 'revisit'), etag, last_modified, headers (map of strings, keys in lower case).

    Returns for each revisit: record_id, canonical_url, refers_to, refers_ts, outcome ('etag', 'last_modified', 'unvalidated', 'mismatch' or
    'unresolved') and headers, which are the revisit's own unless it was resolved.
    """
    rows = captures.select("record_id", canonical_url(F.col("url")).alias("canonical_url"), "ts", "kind", "etag", "last_modified", "headers").withColumn("part", F.floor(F.col("ts") / span))
    # headers stay behind; they are fetched for those that are referred to
    slim = rows.drop("headers")
    full = F.when(F.col("kind") == "response", F.struct("ts", "record_id", "etag", "last_modified"))
    placed = slim.where("canonical_url is not null and ts is not null").withColumn("full", full)
    spans = written(placed.groupBy("canonical_url", "part").agg(F.max("full").alias("last")), "lexiflow-spans")
    before = Window.partitionBy("canonical_url").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    carried = spans.select("canonical_url", "part", F.last("last", ignorenulls=True).over(before).alias("carried"))
    within = Window.partitionBy("canonical_url", "part").orderBy("ts", "record_id").rowsBetween(Window.unboundedPreceding, -1)
    asof = placed.withColumn("own", F.last("full", ignorenulls=True).over(within)).where("kind = 'revisit'")
    found = asof.join(written(carried.where("carried is not null"), "lexiflow-carried"), ["canonical_url", "part"], "left").withColumn("to", F.coalesce("own", "carried"))
    found = found.select("record_id", F.col("to.ts").alias("refers_ts"), F.col("to.record_id").alias("refers_to"), F.col("to.etag").alias("to_etag"), F.col("to.last_modified").alias("to_modified")).distinct()
    revisits = rows.where("kind = 'revisit'").join(found, "record_id", "left")
    outcome = (
        F.when(F.col("refers_to").isNull(), "unresolved")
        .when(F.col("etag").isNotNull(), F.when(_bare(F.col("etag")) == _bare(F.col("to_etag")), "etag").otherwise("mismatch"))
        .when(F.col("last_modified").isNotNull(), F.when(F.col("last_modified") == F.col("to_modified"), "last_modified").otherwise("mismatch"))
        .otherwise("unvalidated")
    )
    told = revisits.withColumn("outcome", outcome)
    told = told.withColumn("refers_to", F.when(~F.col("outcome").isin("mismatch", "unresolved"), F.col("refers_to"))).withColumn("refers_ts", F.when(F.col("refers_to").isNotNull(), F.col("refers_ts")))
    stored = written(rows.where("kind = 'response'").groupBy(F.col("record_id").alias("refers_to")).agg(F.first("headers").alias("stored")), "lexiflow-headers")
    own = F.coalesce("headers", F.create_map().cast("map<string,string>"))
    new = F.map_filter(own, lambda k, _: ~k.isin(KEPT_HEADERS))
    old = F.coalesce("stored", F.create_map().cast("map<string,string>"))
    merged = F.map_concat(F.map_filter(old, lambda k, _: ~F.array_contains(F.map_keys(new), k)), new)
    return told.join(stored, "refers_to", "left").select("record_id", "canonical_url", "refers_to", "refers_ts", "outcome", F.when(F.col("refers_to").isNotNull(), merged).otherwise(F.col("headers")).alias("headers"))


def captures_of(pages: DataFrame) -> DataFrame:
    """Captures made from a table of pages, as the pages table has no revisits: each page is fetched in full at time 2 * page_id, and again one tick
    later under another spelling of its URL, which is answered by 304. Each way to validate comes up, wrong tags included."""
    page, tag = F.col("page_id"), F.concat(F.lit('"'), F.md5(F.coalesce("html", F.lit(""))), F.lit('"'))
    modified = F.concat(F.lit("day-"), (page % 97).cast("string"))
    header = lambda *kv: F.create_map(*[x if isinstance(x, Column) else F.lit(x) for x in kv])
    full = pages.select((2 * page).alias("record_id"), "url", (2 * page).alias("ts"), F.lit("response").alias("kind"), tag.alias("etag"), modified.alias("last_modified"), header("content-type", "text/html", "content-length", F.octet_length(F.coalesce("html", F.lit(""))).cast("string"), "cache-control", "max-age=60", "etag", tag).alias("headers"))
    way = page % 5
    own_tag = F.when(page % 11 == 0, None).when(way == 0, F.lit('"other"')).when(way == 1, None).when(way == 2, F.concat(F.lit("W/"), tag)).otherwise(tag)
    own_modified = F.when((page % 11 != 0) & (way == 1), modified)
    spelt = F.concat(F.regexp_replace("url", "[/]?([?#].*)?$", ""), F.lit("/"), F.regexp_extract("url", "(\\?[^#]*)", 1), F.lit("#seen"))
    again = pages.select((2 * page + 1).alias("record_id"), spelt.alias("url"), (2 * page + 1).alias("ts"), F.lit("revisit").alias("kind"), own_tag.alias("etag"), own_modified.alias("last_modified"), header("content-length", "0", "cache-control", "max-age=120", "age", (page % 7).cast("string")).alias("headers"))
    return full.unionByName(again)


OP2_SQL = r"""
WITH c AS (
  SELECT 2 * page_id AS record_id, url, 2 * page_id AS ts, 'response' AS kind, '"' || md5(coalesce(html, '')) || '"' AS etag, 'day-' || (page_id % 97) AS last_modified,
         strlen(coalesce(html, '')) AS bytes, page_id FROM pages
  UNION ALL
  SELECT 2 * page_id + 1, regexp_replace(url, '[/]?([?#].*)?$', '') || '/' || regexp_extract(url, '(\?[^#]*)', 1) || '#seen', 2 * page_id + 1, 'revisit',
         CASE WHEN page_id % 11 = 0 THEN NULL WHEN page_id % 5 = 0 THEN '"other"' WHEN page_id % 5 = 1 THEN NULL
              WHEN page_id % 5 = 2 THEN 'W/"' || md5(coalesce(html, '')) || '"' ELSE '"' || md5(coalesce(html, '')) || '"' END,
         CASE WHEN page_id % 11 <> 0 AND page_id % 5 = 1 THEN 'day-' || (page_id % 97) END, 0, page_id FROM pages
), b AS (SELECT *, regexp_replace(regexp_replace(url, '#.*$', ''), '^[A-Za-z][A-Za-z0-9+.-]*://', '') AS body FROM c
), p AS (
  SELECT *, regexp_replace(regexp_replace(lower(regexp_extract(body, '^([^/?]*)', 1)), '^www\.', ''), ':(80|443)$', '') AS host,
         regexp_replace(regexp_extract(regexp_replace(body, '^[^/?]*', ''), '^([^?]*)', 1), '/+$', '') AS path,
         list_sort(list_filter(string_split(regexp_extract(regexp_replace(body, '^[^/?]*', ''), '\?(.*)$', 1), '&'),
           lambda x: x <> '' AND NOT regexp_matches(lower(x), '^(utm_[a-z]+|ref|sid|sessionid|phpsessid|jsessionid|fbclid|gclid)(=|$)'))) AS q FROM b
), k AS (SELECT *, host || path || CASE WHEN len(q) > 0 THEN '?' || array_to_string(q, '&') ELSE '' END AS canonical_url FROM p
), r AS (SELECT * FROM k WHERE kind = 'revisit'), f AS (SELECT * FROM k WHERE kind = 'response'
), j AS (SELECT r.record_id, r.canonical_url, r.page_id, r.etag, r.last_modified, f.record_id AS to_id, f.etag AS to_etag, f.last_modified AS to_modified, f.bytes AS to_bytes
  FROM r ASOF LEFT JOIN f ON r.canonical_url = f.canonical_url AND r.ts > f.ts
), o AS (SELECT *, CASE WHEN to_id IS NULL THEN 'unresolved'
    WHEN etag IS NOT NULL THEN CASE WHEN regexp_replace(etag, '^W/', '') = to_etag THEN 'etag' ELSE 'mismatch' END
    WHEN last_modified IS NOT NULL THEN CASE WHEN last_modified = to_modified THEN 'last_modified' ELSE 'mismatch' END
    ELSE 'unvalidated' END AS outcome FROM j)
SELECT record_id, canonical_url, CASE WHEN outcome IN ('mismatch', 'unresolved') THEN NULL ELSE to_id END AS refers_to, outcome,
  CASE WHEN outcome IN ('mismatch', 'unresolved') THEN 'age=' || (page_id % 7) || '; cache-control=max-age=120; content-length=0'
       ELSE 'age=' || (page_id % 7) || '; cache-control=max-age=120; content-length=' || to_bytes || '; content-type=text/html; etag=' || to_etag END AS headers
FROM o
"""


def listed(headers: Column) -> Column:
    return F.array_join(F.transform(F.array_sort(F.map_keys(headers)), lambda k: F.concat(k, F.lit("="), F.try_element_at(headers, k))), "; ")
