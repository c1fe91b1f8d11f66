from __future__ import annotations

import random

import numpy as np
import pytest

from lexiflow.llm import decontaminate

from .conftest import edited, prose


def plain_score(a: list, b: list) -> int:
    h = np.zeros((len(a) + 1, len(b) + 1), dtype=int)
    for i, x in enumerate(a, 1):
        for j, y in enumerate(b, 1):
            h[i, j] = max(0, h[i - 1, j - 1] + (2 if x == y else -1), h[i - 1, j] - 1, h[i, j - 1] - 1)
    return int(h.max())


def split(t: str) -> list[str]:
    return "".join(c if c.isalnum() else " " for c in t.lower()).split()


def test_alignment():
    rng = np.random.default_rng(3)
    for _ in range(200):
        a, b = rng.integers(0, 5, rng.integers(1, 15)), rng.integers(0, 5, rng.integers(1, 25))
        assert decontaminate.align(a, b)[0] == plain_score(a.tolist(), b.tolist())


@pytest.fixture(scope="module")
def tables(spark):
    rng = random.Random(9)
    items = {i: prose(rng, rng.choice((20, 40, 60))) for i in range(30)}
    docs, leaks = {}, set()
    for i in range(200):
        docs[i] = prose(rng, rng.choice((30, 200)))
        if i % 4 == 0:
            k = rng.randrange(30)
            copy = edited(rng, items[k], rng.choice((0, 0, 0.1, 0.2)))
            docs[i] = f"{docs[i]} {copy.upper() if i % 8 == 0 else copy}, {prose(rng, 20)}"
            leaks.add((i, k))
        elif i % 4 == 1:  # half of what a hit needs
            docs[i] += " " + " ".join(items[rng.randrange(30)].split()[:6])
    return spark.createDataFrame(list(docs.items()), "doc_id long, text string"), spark.createDataFrame([*items.items(), (30, None), (31, " .. ")], "item_id long, text string"), docs, items, leaks


@pytest.mark.parametrize("block_words", [100, 1_000_000])
def test_finds_whole_and_edited_items_and_nothing_else(tables, block_words):
    docs, items, texts, own, leaks = tables
    got = decontaminate.find(docs, items, block_words=block_words).collect()
    # a copy may be edited so much that a full alignment scores below the threshold, or that no seed is left
    grams = lambda w: {tuple(w[k : k + 3]) for k in range(len(w) - 2)}
    want = {(i, k) for i, k in leaks if plain_score(split(own[k]), split(texts[i])) >= len(split(own[k]))}
    sure = {(i, k) for i, k in want if len(grams(split(own[k])) & grams(split(texts[i]))) > len(grams(split(own[k]))) // 2}
    found = {(r.id, r.item) for r in got}
    assert sure <= found <= want and len(found) > 0.8 * len(leaks)
    assert all(r.similarity >= 0.5 for r in got)


def test_scores_as_brute_force(tables):
    docs, items, texts, own, _ = tables
    for r in decontaminate.find(docs, items).collect():
        w = split(own[r.item])
        assert r.similarity == pytest.approx(plain_score(w, split(texts[r.id])) / (2 * len(w)))


def test_copies_with_words_inserted_as_brute_force(spark):
    rng = random.Random(4)
    items = {i: prose(rng, 40) for i in range(12)}
    docs = {}
    for k, text in items.items():
        w = text.split()
        for more in (10, 22, 26, 30, 34, 38):
            at = rng.randrange(8, 32)
            docs[len(docs)] = (f"{prose(rng, 50)} {' '.join(w[:at])} {prose(rng, more)} {' '.join(w[at:])} {prose(rng, 50)}", k)
    full = {i: plain_score(split(items[k]), split(t)) / 80 for i, (t, k) in docs.items()}
    frames = [spark.createDataFrame([(i, t) for i, (t, _) in docs.items()], "doc_id long, text string"), spark.createDataFrame(list(items.items()), "item_id long, text string")]
    got = {r.id: r.similarity for r in decontaminate.find(*frames).collect() if r.item == docs[r.id][1]}
    assert got == pytest.approx({i: s for i, s in full.items() if s >= 0.5})


def test_defined_cases(spark, no_rows, tables):
    docs, items, texts, own, leaks = tables
    assert decontaminate.find(no_rows, items).collect() == []
    assert decontaminate.find(docs, items.limit(0)).collect() == []
    short = spark.createDataFrame([(1, "xyzzy plugh")], "item_id long, text string")
    some = spark.createDataFrame([(1, "a xyzzy, plugh b"), (1, "a xyzzy, plugh b"), (2, None), (3, "xyzzy"), (None, "xyzzy plugh")], "doc_id long, text string")
    assert sorted((r.id or 0, r.item) for r in decontaminate.find(some, short).collect()) == [(0, 1), (1, 1), (1, 1)]
    kept = decontaminate.clean_rows(some, short)
    assert sorted(r.doc_id for r in kept.collect()) == [2, 3]
