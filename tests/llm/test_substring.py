from __future__ import annotations

import numpy as np
import pytest

from lexiflow.llm import substring
from lexiflow.llm.fm_index import FMIndex

from .brute import repeats


@pytest.mark.parametrize("hot", [3, 256])
def test_removal_as_brute_force(frame, texts, hot):
    got = {r.id: (r.n_words, r.n_removed, r.kept_sha256) for r in substring.kept_digest(substring.remove_repeats(frame, hot=hot, shard_words=3000)).collect()}
    assert got == repeats(texts)


def test_no_rows_null_ids_and_equal_rows(spark, no_rows):
    assert substring.remove_repeats(no_rows).collect() == []
    text = " ".join(map(str, range(25)))
    df = spark.createDataFrame([(None, text), (1, text), (2, "x " + text), (2, "x " + text), (3, None)], "doc_id long, text string")
    got = sorted((r.id is not None, r.id or 0, r.n_words, r.n_removed, r.kept_text) for r in substring.remove_repeats(df).collect())
    assert got == [(False, 0, 25, 0, text), (True, 1, 25, 25, ""), (True, 2, 26, 25, "x"), (True, 2, 26, 25, "x"), (True, 3, 0, 0, "")]


def test_matching_statistics():
    rng = np.random.default_rng(1)
    text = np.append(rng.integers(1, 4, 300), 0)
    length, _, _ = FMIndex(text, 4, 6).matching(np.arange(6, 301))
    s = "".join(map(str, text))
    for end, n in zip(range(6, 301), length.tolist(), strict=True):
        best = max(k for k in range(7) if k == 0 or sum(s.startswith(s[end - k : end], x) for x in range(len(s))) > 1)
        assert n == best


def test_ids_of_any_ordered_type(spark):
    passage = " ".join(f"w{i}" for i in range(30))
    docs = {"b": f"x1 {passage} y1", "a": f"{passage} z2 z3", "10": "alone " * 5, "9": f"q {passage}"}
    df = spark.createDataFrame(list(docs.items()), "name string, body string")
    got = {r.id: (r.n_words, r.n_removed, r.kept_sha256) for r in substring.kept_digest(substring.remove_repeats(df, "name", "body")).collect()}
    assert got == repeats(docs)
