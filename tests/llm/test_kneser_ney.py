from __future__ import annotations

import tracemalloc
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from lexiflow.llm import kneser_ney, queries
from lexiflow.llm.common import fold as fold_column

from .brute import base_scores, fold, kneser_ney as plain


@pytest.mark.parametrize("order", [2, 3])
def test_scores_as_brute_force(frame, texts, order):
    learn = lambda i: fold(i, 10) != 0
    out = kneser_ney.learn_and_score(frame, fold_column(F.col("doc_id"), 10) != 0, order=order, flush=2000).collect()
    base, score = base_scores(texts, learn), plain(texts, learn, order)
    assert len(out) == len(texts)
    for r in out:
        n, known, total, b = base[r.id]
        assert (r.n_tokens, r.n_known, r.train_tokens) == (n, known, total)
        assert r.base_score == pytest.approx(b, rel=1e-9)
        assert r.score == pytest.approx(score[r.id], rel=1e-9)
    held = [r for r in out if not learn(r.id)]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


def test_nothing_to_learn_from(spark, no_rows):
    assert kneser_ney.learn_and_score(no_rows, F.lit(True)).collect() == []
    df = spark.createDataFrame([(1, "a b"), (None, None)], "doc_id long, text string")
    got = sorted((r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score) for r in kneser_ney.learn_and_score(df, F.lit(False)).collect())
    assert got == [(1, 0, 0, 0.0, 0.0), (3, 0, 0, 0.0, 0.0)]


@pytest.mark.skipif(not Path("/root/testdata/sf0.001").exists(), reason="no driver tables here")
def test_query_scores_with_two_words_of_context(spark):
    folder = "/root/testdata/sf0.001"
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    want = plain(docs, lambda i: fold(i, 10) != 0, 3)
    got = {r.doc_id: r.score for r in queries.op4_kneser_ney(spark, folder).collect()}
    assert got == pytest.approx(want, rel=1e-6)


def test_counts_beyond_four_bytes_and_a_folder_that_is_not_there():
    big = np.array([(1 << 32) + 5, 1], dtype=np.int64)
    key = np.array([3, 1 << 40], dtype=np.uint64)
    rows = kneser_ney._sent("x", 0, key, None, [big, big], 1)
    back, sums = kneser_ney._summed([r[3] for r in rows] * 2)
    assert back.tolist() == kneser_ney.place_of(key, 1).tolist() and [v.tolist() for v in sums] == [(2 * big).tolist()] * 2
    cols, counts = kneser_ney.grams(kneser_ney.packed_grams([key, key[::-1]], big))
    assert sorted(zip(*(c.tolist() for c in cols), counts.tolist(), strict=True)) == sorted(zip(key.tolist(), key[::-1].tolist(), big.tolist(), strict=True))
    with pytest.raises(FileNotFoundError):
        kneser_ney.Scorer({"folder": "/nowhere"})


def test_packed_rows_are_found_again():
    rng = np.random.default_rng(5)
    key = np.unique(rng.integers(0, 1 << 40, 5000, dtype=np.uint64))
    key[1::2] = key[::2][: len(key[1::2])] ^ np.uint64(1)  # pairs that share their upper bits
    key = np.unique(key)
    vals = [rng.choice([1, 2, 7, 300, 1 << 33], len(key), p=[0.7, 0.1, 0.1, 0.05, 0.05]) for _ in range(3)]
    got = kneser_ney.Packed(np.frombuffer(kneser_ney.packed(key, vals), dtype=np.uint8))
    assert (got.find(key) == np.stack(vals, axis=1)).all()
    away = np.setdiff1d(rng.integers(0, 1 << 40, 5000, dtype=np.uint64), key)
    assert not got.find(away).any()
    back, rows = got.rows()
    order = np.argsort(back)
    assert back[order].tolist() == key.tolist() and (rows[order] == np.stack(vals, axis=1)).all()


def some_grams(n: int, bodies: int, words: int, shards: int) -> list[bytes]:
    """About n n-grams of the first shard."""
    rng = np.random.default_rng(7)
    word = rng.integers(0, 1 << 64, words, dtype=np.uint64)
    out = []
    for _ in range(bodies):
        cols = [word[rng.integers(0, words, n // bodies * shards)] for _ in range(3)]
        own = kneser_ney.shard_of(kneser_ney.key_of(cols), shards) == 0
        out.append(kneser_ney.packed_grams([c[own] for c in cols], rng.choice([1, 2, 300], own.sum())))
    return out


def settled(folder, kind: str, bodies: list[bytes], shards: int) -> list[tuple]:
    """Rows that the task of a shard hands on."""
    batch = kneser_ney._batch([(kind, 0, 0, b, None) for b in bodies])
    return [tuple(r.values()) for out in kneser_ney._settle(str(folder), 3, shards)(iter([batch])) for r in out.to_pylist()]


def test_a_shard_is_settled_in_a_few_times_its_words(tmp_path):
    n = 1_200_000
    bodies = some_grams(n, 12, 50_000, 8)
    tracemalloc.start()
    try:
        settled(tmp_path, "gram3", bodies, 8)
        assert tracemalloc.get_traced_memory()[1] < 4 * 24 * n
    finally:
        tracemalloc.stop()


def test_ranges_of_a_shard_change_nothing(tmp_path, monkeypatch):
    def everything(name: str, piece: int, rows: int) -> list:
        folder = tmp_path / name
        folder.mkdir()
        monkeypatch.setattr(kneser_ney, "PIECE", piece)
        monkeypatch.setattr(kneser_ney, "ROWS_AT_ONCE", rows)
        out = settled(folder, "gram3", bodies, 1)
        for kind, left in (("ctx3", True), ("gram2", False)):
            own = [r[3] for r in out if r[0] == kind]
            out += settled(folder, kind, own * 2, 1) if left else settled(folder, kind, own, 1)
        stats = sorted(r for r in out if r[4])
        grams = [kneser_ney.grams(r[3]) for r in out if r[0] == "gram2"]
        return [stats, sorted(zip(*(np.concatenate(c).tolist() for c in zip(*(cols for cols, _ in grams), strict=True)), strict=True)), {f.name: f.read_bytes() for f in folder.iterdir()}]

    bodies = some_grams(60_000, 6, 60, 1)
    whole, cut = everything("whole", 1 << 40, 1 << 40), everything("cut", 20_000, 1_000)
    assert {"gram3-0-0", "ctx3-0-0", "gram2-0-0"} <= set(whole[2])
    assert cut == whole
