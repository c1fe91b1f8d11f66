from __future__ import annotations

import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from lexiflow.llm import quality

from .conftest import prose


def junk(rng, text):
    way = rng.randrange(3)
    return " ".join(w + "$$$" for w in text.split()) if way == 0 else text.upper().replace(" ", "!! ") if way == 1 else " ".join([text.split()[0]] * 40)


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(4)
    out = []
    for i in range(300):
        text = prose(rng, rng.choice((5, 50, 200)))
        good = rng.random() < 0.6
        out.append((i, text if good else junk(rng, text), int(good)))
    return out


def test_held_out_accuracy_and_bounds(spark, rows):
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(i, y) for i, _, y in rows], "doc_id long, quality int")
    got = {r.id: r for r in quality.learn_and_score(docs, labels, learn=F.col("doc_id") % 3 != 1).collect()}
    held = [(i, y) for i, _, y in rows if i % 3 == 1]
    assert sum(got[i].predicted == y for i, y in held) >= 0.95 * len(held)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got.values())
    few = quality.sample(docs, labels, "doc_id", "text", "quality", 50)
    assert len(few[1]) == 50


def test_pairs_learn_what_single_features_cannot():
    rng = np.random.default_rng(0)
    x = rng.random((2000, 4))
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.5)).astype(float)
    model = quality.fit(x, y)
    assert (0, 1) in {tuple(sorted(p[:2])) for p in model.pairs}
    assert ((quality.scores(x, model) >= 0.5) == y).mean() > 0.95
    single = quality.fit(x, y, most_pairs=0)
    assert ((quality.scores(x, single) >= 0.5) == y).mean() < 0.65


def test_features_of_a_block_are_those_of_each_text():
    texts = ["", None, "One two, two!\nOne two, two!\n", "É 漢 $$ 12", "a" * 100, "x\n\n\ny"]
    block = quality.features(pa.array(texts))
    for row, t in zip(block, texts, strict=True):
        assert row.tolist() == quality.features(pa.array([t], pa.string()))[0].tolist()
    named = dict(zip(quality.NAMES, block[2], strict=True))
    assert named["distinct_words"] == 3 / 6 and named["distinct_lines"] == 1 / 2 and named["distinct_pairs"] == 3 / 5


def test_defined_cases(spark, no_rows):
    labels = spark.createDataFrame([(1, 1), (1, 0), (2, None), (None, 1)], "doc_id long, quality int")
    assert quality.learn_and_score(no_rows, labels).collect() == []
    docs = spark.createDataFrame([(1, None), (1, ""), (None, "a b"), (3, "a b")], "doc_id long, text string")
    assert len(quality.learn_and_score(docs, labels).collect()) == 4
    assert {r.score for r in quality.learn_and_score(docs, labels.limit(0)).collect()} == {0.5}
