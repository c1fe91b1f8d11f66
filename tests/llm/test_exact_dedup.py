from __future__ import annotations

import hashlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from lexiflow.llm import exact_dedup


def want(texts):
    groups = defaultdict(list)
    for i, t in texts.items():
        groups[t or ""].append(i)
    return {i: (max(groups[t or ""]), len(groups[t or ""]), i == max(groups[t or ""])) for i, t in texts.items()}


@pytest.mark.parametrize("files", [None, 2])
def test_groups_as_brute_force(frame, texts, files):
    got = exact_dedup.link_copies(frame, files_per_batch=files).select("id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("d")).collect()
    assert {r.id: (r.keep_id, r.group_size, r.kept) for r in got} == want(texts)
    assert all(r.d == hashlib.sha256((texts[r.id] or "").encode()).hexdigest() for r in got)


def test_full_bytes_decide_when_digests_collide(frame, texts):
    weak = lambda c: F.unhex(F.substring(F.sha2(c.cast("binary"), 256), 1, 2))
    got = exact_dedup.link_copies(frame, digest=weak).collect()
    assert {r.id: (r.keep_id, r.group_size, r.kept) for r in got} == want(texts)


def test_kept_rows_nulls_repeats_and_no_rows(spark, no_rows):
    assert exact_dedup.link_copies(no_rows).collect() == []
    assert exact_dedup.kept_rows(no_rows).collect() == []
    df = spark.createDataFrame([(1, "a", "x"), (2, "a", "x"), (2, "a", "x"), (None, "a", "x"), (None, "b", "x"), (3, None, "x"), (4, "", "x")], "doc_id long, text string, digest string")
    out = exact_dedup.kept_rows(df)
    assert out.columns == df.columns
    assert sorted((r.doc_id or 0, r.text) for r in out.collect()) == [(0, "b"), (2, "a"), (4, "")]


def test_kept_rows_keep_columns_named_like_ours(spark):
    df = spark.createDataFrame([(1, "a", "x", "p"), (2, "a", "y", "q"), (3, "b", "z", "r")], "doc_id long, text string, _digest string, _id string")
    out = exact_dedup.kept_rows(df)
    assert out.columns == df.columns and sorted(map(tuple, out.collect())) == [(2, "a", "y", "q"), (3, "b", "z", "r")]
