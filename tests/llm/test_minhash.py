from __future__ import annotations

import random
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from lexiflow.llm import minhash
from lexiflow.llm.components import components

from .brute import near
from .conftest import prose


@pytest.mark.parametrize(("width", "num", "den", "long_list"), [(3, 85, 100, 32), (5, 80, 100, 8)])
def test_links_as_brute_force(frame, texts, width, num, den, long_list):
    want = near(texts, width, num, den)
    got = {r.id: r for r in minhash.link_near(frame, width=width, num=num, den=den, long_list=long_list).collect()}
    assert {i: (r.n, r.component) for i, r in got.items()} == want
    assert all(r.kept == (r.component == i) for i, r in got.items())


@pytest.mark.parametrize(("width", "num", "den"), [(3, 85, 100), (5, 80, 100)])
def test_families_of_short_texts_as_brute_force(spark, width, num, den):
    rng = random.Random(width)
    docs = {}
    for length in (8, 9, 12, 17):
        base = [f"{w}{length}" for w in prose(rng, length).split()]
        docs[len(docs)] = " ".join(base)
        for i in range(300):
            new = f"w{rng.randrange(10**9)}"
            docs[len(docs)] = " ".join(([new, *base], [*base, new], [new, *base[1:]], [*base[:-1], new], base[:-1] + [new, new + "y"])[i % 5])
    want = near(docs, width, num, den)
    frame = spark.createDataFrame(list(docs.items()), "doc_id long, text string").repartition(5)
    assert {r.id: (r.n, r.component) for r in minhash.link_near(frame, width=width, num=num, den=den).collect()} == want


@pytest.mark.parametrize(("num", "den"), [(85, 100), (80, 100), (90, 100)])
def test_similar_sets_share_a_prefix_value(num, den):
    rng = np.random.default_rng(num)
    least = minhash.least_shared(48, num, den)
    for _ in range(4000):
        union = rng.permutation(10**6)[: rng.integers(2, 300)]
        differ = union[: len(union) - -(-len(union) * num // den)]
        to_a = rng.random(len(differ)) < 0.5
        a, b = (set(union.tolist()) - set(x.tolist()) for x in (differ[~to_a], differ[to_a]))
        order = {v: rng.random() for v in a | b}
        first = []
        for s in (a, b):
            kept = sorted(s)[:48]
            need = min(-(-len(s) * num // den), least)
            first.append(set(sorted(kept, key=order.get)[: len(kept) - need + 1]))
        assert first[0] & first[1]


def test_dense_group_in_several_components(spark):
    """Near copies of one text at distances about the threshold: some linked with its middle, some only with each other, most pairs just not similar."""
    rng = random.Random(11)
    base = prose(rng, 120).split()
    docs = {}
    for i in range(260):
        words = list(base)
        spots = rng.sample(range(0, 120, 4), rng.choice((1, 2, 3, 4, 5)))
        for p in spots:
            words[p] = f"n{rng.randrange(10**9)}"
        docs[i] = " ".join(words)
        if i % 9 == 0:  # a copy of a far copy
            words[rng.randrange(120)] = "again"
            docs[1000 + i] = " ".join(words)
    want = near(docs, 3, 85, 100)
    assert len({c for _, c in want.values()}) > 3
    frame = spark.createDataFrame(list(docs.items()), "doc_id long, text string").repartition(5)
    assert {r.id: (r.n, r.component) for r in minhash.link_near(frame, width=3, num=85, den=100, long_list=8).collect()} == want


def test_all_links_of_a_driver_table(spark, width=3, num=85, den=100):
    folder = Path("/root/testdata/sf0.01/documents.parquet")
    if not folder.exists():
        pytest.skip("no driver tables here")
    frame = spark.read.parquet(str(folder)).select("doc_id", "text")
    want = near(dict(frame.collect()), width, num, den)
    assert {r.id: (r.n, r.component) for r in minhash.link_near(frame, width=width, num=num, den=den).collect()} == want


def test_kept_rows_keep_columns_and_one_of_each_group(frame, texts):
    want = near(texts, 5, 80, 100)
    out = minhash.kept_rows(frame.withColumn("rep", F.lit("clash")).withColumn("component", F.lit(1)))
    assert out.columns == [*frame.columns, "rep", "component"]
    assert sorted(r.doc_id for r in out.collect()) == sorted(i for i, (_, c) in want.items() if c == i)


def test_nulls_repeats_and_no_rows(spark, no_rows):
    assert minhash.link_near(no_rows).collect() == []
    text = "a b c d e f g h i j"
    df = spark.createDataFrame([(None, text), (4, text), (4, text), (5, text), (None, None), (6, None), (7, "")], "doc_id long, text string")
    got = sorted((r.id is None, r.id or 0, r.n, r.component, r.kept) for r in minhash.link_near(df).collect())
    assert got == [(False, 4, 6, 4, True), (False, 4, 6, 4, True), (False, 5, 6, 4, False), (False, 6, 0, 6, True), (False, 7, 0, 7, True), (True, 0, 0, None, True), (True, 0, 6, None, True)]


def test_components_of_a_path_and_a_star(spark):
    path = [(i, i + 1) for i in range(40)]
    star = [(100, 100 + i) for i in range(1, 30)]
    got = {r.node: r.component for r in components(spark.createDataFrame(path + star + [(7, 7)], "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, **{100 + i: 100 for i in range(30)}}
