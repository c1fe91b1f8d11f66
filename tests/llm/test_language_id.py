from __future__ import annotations

import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from lexiflow.llm import language_id
from lexiflow.llm.words import text_buffer

SOUNDS = {"aa": "an er th in on re ed nd ha at", "bb": "ció ar os es la que ñe do ez mi", "cc": "ß ung sch ä keit ö ver ü tz pf"}


def corpus(seed: int, n: int) -> list[tuple[int, str, str]]:
    rng = random.Random(seed)
    out = []
    for i in range(n):
        lang = rng.choice(list(SOUNDS))
        out.append((i, " ".join("".join(rng.choice(SOUNDS[lang].split()) for _ in range(rng.choice((1, 2, 3)))) for _ in range(rng.choice((4, 40, 400)))), lang))
    return out


def test_held_out_accuracy(spark):
    rows = corpus(1, 400)
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = {r.doc_id: r for r in language_id.identify(df, learn=F.col("doc_id") % 4 != 2).collect()}
    held = [(i, lang) for i, _, lang in rows if i % 4 == 2]
    assert sum(got[i].lang_pred == lang for i, lang in held) >= 0.98 * len(held)
    assert all(0 <= r.score <= 1 for r in got.values())


def test_folded_matrix_is_the_kernel_machine():
    """Scores by one matrix product equal kernels with each landmark, found with sets of n-grams."""
    texts = [t.encode() for _, t, _ in corpus(2, 60)]
    langs = [g for _, _, g in corpus(2, 60)]
    model = language_id.fit(texts, langs, landmarks=12)
    x = language_id.presence(*language_id._pack(texts), model.byte_class, model.tables, len(model.weights))
    for row, t in zip(x, texts, strict=True):
        cls = model.byte_class[np.frombuffer(t, dtype=np.uint8)]
        own = set()
        for n in (1, 2, 3):
            for k in range(len(cls) - n + 1):
                g = cls[k : k + n]
                if (g > 0).all():
                    own.add(int(model.tables[n - 1][sum(int(c) * (int(model.byte_class.max()) + 1) ** (n - 1 - j) for j, c in enumerate(g))]))
        assert set(np.flatnonzero(row).tolist()) == own - {0}


def test_scores_equal_plain_kernel_ridge():
    """Kernels from sets of n-grams and ridge regression in dual form, with every labelled text a landmark."""
    rows = corpus(4, 45)
    texts, langs = [t.encode() for _, t, _ in rows], [g for _, _, g in rows]
    model = language_id.fit(texts, langs, landmarks=10**6)
    names = sorted(set(langs))
    fold = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))
    grams = lambda t: {t.translate(fold)[k : k + n] for n in (1, 2, 3) for k in range(len(t) - n + 1)}
    known = set().union(*map(grams, texts))
    own = [grams(t) for t in texts]
    kernel = lambda s: [len(s & m) / (len(s & known) * len(m)) ** 0.5 if s & known else 0.0 for m in own]
    k = np.array([kernel(s) for s in own])
    w = np.array([1 / langs.count(g) for g in langs])
    w *= len(w) / w.sum()
    y = np.array([[1.0 if g == name else -1.0 for name in names] for g in langs])
    ones = np.ones((len(k), 1))
    left = np.block([[k.T @ (k * w[:, None]) + 0.1 * (k + 1e-6 * np.eye(len(k))), k.T @ (w[:, None] * ones)], [ones.T @ (k * w[:, None]), np.array([[w.sum() + 1e-9]])]])
    right = np.vstack([k.T @ (y * w[:, None]), (ones * w[:, None]).T @ y])
    solved = np.linalg.lstsq(left, right, rcond=None)[0]
    new = [t for _, t, _ in corpus(5, 40)] + ["ANER", "漢 an", "zz"]
    f = np.array([kernel(grams(t.encode())) for t in new]) @ solved[:-1] + solved[-1]
    p = np.exp(4 * (f - f.max(1, keepdims=True)))
    p /= p.sum(1, keepdims=True)
    got, score = language_id.score_block(*text_buffer(pa.array(new)), model)
    assert got == [names[i] for i in p.argmax(1)]
    np.testing.assert_allclose(score, p.max(1), atol=2e-3)


def test_a_letter_is_what_unicode_calls_one():
    texts = [t.encode() for _, t, _ in corpus(3, 30)]
    model = language_id.fit(texts, [g for _, _, g in corpus(3, 30)])
    got, score = language_id.score_block(*text_buffer(pa.array(["½", "² 12", "_", "é", "漢"])), model)
    assert [g == "und" for g in got] == [True, True, True, False, False] and score[0] == score[1] == 0


def test_long_texts_are_read_whole():
    texts = [t.encode() for _, t, _ in corpus(3, 30)]
    model = language_id.fit(texts, [g for _, _, g in corpus(3, 30)])
    long = b"\x01" * ((1 << 20) - 1) + texts[0]
    a = language_id.presence(*text_buffer(pa.array([texts[0].decode()])), model.byte_class, model.tables, len(model.weights))
    b = language_id.presence(*text_buffer(pa.array([long.decode()])), model.byte_class, model.tables, len(model.weights))
    assert (b >= a).all()


def test_defined_cases(spark, no_rows):
    assert language_id.identify(no_rows).collect() == []
    rows = [(1, None, "aa"), (2, "", "aa"), (3, "12 !? \n", "aa"), (4, "漢", "aa"), (5, "an er", None), (None, "an er", "aa"), (6, "an er", "aa")]
    df = spark.createDataFrame([(*r, "clash") for r in rows], "doc_id long, text string, lang string, score string")
    got = {(r.doc_id): (r.lang_pred, r.score) for r in language_id.identify(df.drop("score")).collect()}
    assert got[1] == got[2] == got[3] == ("und", 0.0)
    assert got[4][0] == got[5][0] == got[None][0] == "aa"
    out = language_id.accepted(df)
    assert out.columns == df.columns and sorted(r.doc_id or 0 for r in out.collect()) == [0, 4, 5, 6] and {r.score for r in out.collect()} == {"clash"}
    unlabelled = df.drop("score").withColumn("lang", F.lit(None).cast("string"))
    assert {r.lang_pred for r in language_id.identify(unlabelled).collect()} == {"und"}


def test_learns_from_long_texts_and_leaves_no_language_out(spark):
    rng = random.Random(8)
    word = lambda letters: "".join(rng.choice(letters) for _ in range(4))
    text = lambda letters, n: " ".join(word(letters) for _ in range(n))
    rows = [(i, text("abcdef", 60), "short") for i in range(40)] + [(100 + i, text("ghijkl", 9000), "long") for i in range(12)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    assert {r.doc_id: r.lang_pred for r in language_id.identify(docs).collect()} == {i: g for i, _, g in rows}
    texts, langs = language_id.sample(docs, most_bytes=1 << 10, per_lang=8)
    assert 0 < sum(len(t) for t, g in zip(texts, langs, strict=True) if g == "short") <= 8 << 10
    assert langs.count("long") == 1  # one text is over the room of its language
    with pytest.raises(ValueError, match="more than 1 languages"):
        language_id.sample(docs, most_langs=1)
