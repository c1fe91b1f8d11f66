from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from lexiflow.llm import warc

SCHEMA = "record_id long, url string, ts long, kind string, etag string, last_modified string, headers map<string,string>"


@pytest.mark.parametrize(
    ("url", "want"),
    [
        ("HTTP://WWW.Example.com:80/A/b/?b=2&utm_source=x&a=1#f", "example.com/A/b?a=1&b=2"),
        ("https://example.com", "example.com"),
        ("example.com/?ref=x", "example.com"),
        ("https://m.example.com/x//", "m.example.com/x"),
        ("https://h/p?sid", "h/p"),
        (None, None),
    ],
)
def test_canonical_url(spark, url, want):
    assert spark.createDataFrame([(url,)], "u string").select(warc.canonical_url(F.col("u"))).first()[0] == want


def plain(rows):
    out = {}
    for r in rows:
        if r[3] != "revisit":
            continue
        before = [x for x in rows if x[3] == "response" and x[1] is not None and x[1] == r[1] and (x[2], x[0]) < (r[2], r[0])]
        if not before:
            out[r[0]] = (None, "unresolved", r[6])
            continue
        to = max(before, key=lambda x: (x[2], x[0]))
        bare = lambda t: t.removeprefix("W/") if t else t
        outcome = ("etag" if bare(r[4]) == bare(to[4]) else "mismatch") if r[4] else ("last_modified" if r[5] == to[5] else "mismatch") if r[5] else "unvalidated"
        if outcome == "mismatch":
            out[r[0]] = (None, outcome, r[6])
        else:
            out[r[0]] = (to[0], outcome, {**(to[6] or {}), **{k: v for k, v in (r[6] or {}).items() if k not in warc.KEPT_HEADERS}})
    return out


@pytest.mark.parametrize("span", [1, 50, 10**9])
def test_resolves_as_brute_force(spark, span):
    rng = random.Random(span)
    rows = []
    for i in range(400):
        url = "h/hot" if rng.random() < 0.4 else f"h/{rng.randrange(60)}"
        tag = rng.choice([None, '"a"', '"b"', 'W/"a"'])
        rows.append((i, url, rng.randrange(300), rng.choice(["response", "revisit", "revisit"]), tag, rng.choice([None, "d1", "d2"]), rng.choice([None, {"content-length": str(i), "age": "1"}, {"x": str(i)}])))
    rows.append((400, None, 5, "revisit", None, None, {"x": "1"}))
    got = {r.record_id: (r.refers_to, r.outcome, r.headers) for r in warc.resolve(spark.createDataFrame(rows, SCHEMA), span).collect()}
    assert got == plain(rows)


def test_no_rows_null_times_and_repeats(spark):
    assert warc.resolve(spark.createDataFrame([], SCHEMA)).collect() == []
    rows = [(1, "h/a", 1, "response", '"x"', None, {}), (2, "h/a", None, "revisit", '"x"', None, {}), (3, "h/a", 2, "revisit", '"x"', None, None), (3, "h/a", 2, "revisit", '"x"', None, None)]
    got = sorted((r.record_id, r.refers_to or 0, r.outcome) for r in warc.resolve(spark.createDataFrame(rows, SCHEMA).withColumn("full", F.lit("clash"))).collect())
    assert got == [(2, 0, "unresolved"), (3, 1, "etag"), (3, 1, "etag")]
