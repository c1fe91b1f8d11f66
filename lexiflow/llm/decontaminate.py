"""Benchmark decontamination: rare n-gram seeds find where a test item may stand in a text, Smith-Waterman alignment scores it.

Words are runs of letters and digits, ASCII letters folded. Every item's n-grams are counted over the whole corpus; its
rarer half (`least_seeds` of them at least) are its seeds. Where a text has a seed of an item (a copy that keeps no seed is missed), the
item is aligned with that passage word by word (match 2, mismatch and gap -1); similarity is the best score over that of a
perfect copy. Items are broadcast in blocks of at most `block_words` words, so neither the broadcast nor a worker's index
grows with the benchmark; each block reads the corpus again.

Defined cases: null and empty texts and items have no words and no hits; an item with fewer words than a seed is its own seed; repeated
items and repeated texts each give their own rows; a passage that occurs in any number of texts is found in each; empty tables
give an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import mapped, written
from .words import NOT_ALNUM, ngram_hashes, slices, words

SIEVE = 1 << 20


@dataclass
class Index:
    """Seeds of a block of items: hashes ascending, with the item and the place of each; a hash may stand for many."""

    items: list[np.ndarray]
    hashes: np.ndarray
    item: np.ndarray
    place: np.ndarray
    need: np.ndarray  # seeds that a passage must have, by item
    sieve: np.ndarray


def index(items: list[np.ndarray], seeds: list[np.ndarray], grams: list[np.ndarray], least: int = 1) -> Index:
    h = np.concatenate([g[s] for g, s in zip(grams, seeds, strict=True)] or [np.zeros(0, np.uint64)])
    item = np.repeat(np.arange(len(items)), [len(s) for s in seeds])
    place = np.concatenate(seeds or [np.zeros(0, np.int64)])
    order = np.argsort(h, kind="stable")
    sieve = np.zeros(SIEVE, dtype=bool)
    sieve[(h % np.uint64(SIEVE)).astype(np.int64)] = True
    need = np.array([min(least, len(s)) for s in seeds], dtype=np.int64)
    return Index(items, h[order], item[order], place[order], need, sieve)


def _grams(h: np.ndarray, n: int) -> np.ndarray:
    """Hashes of runs of n words, or of all the words if they are fewer."""
    return ngram_hashes(h, min(n, len(h))) if len(h) else np.zeros(0, dtype=np.uint64)


def look_up(grams: np.ndarray, ix: Index) -> tuple[np.ndarray, np.ndarray]:
    """Positions in grams and in the index of all equal pairs."""
    near = np.flatnonzero(ix.sieve[(grams % np.uint64(SIEVE)).astype(np.int64)])
    lo = np.searchsorted(ix.hashes, grams[near], "left")
    hi = np.searchsorted(ix.hashes, grams[near], "right")
    n = hi - lo
    at = np.repeat(near, n)
    inner = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    return at, np.repeat(lo, n) + inner


def align(item: np.ndarray, passage: np.ndarray) -> tuple[int, int]:
    """Smith-Waterman over words with match 2, mismatch -1, gap -1: the best score and the end of the passage's aligned part."""
    m = len(passage)
    prev, best, end = np.zeros(m + 1, dtype=np.int32), 0, 0
    steps = np.arange(m + 1, dtype=np.int32)
    for w in item:
        row = np.zeros(m + 1, dtype=np.int32)
        row[1:] = np.maximum(prev[:-1] + np.where(passage == w, 2, -1), prev[1:] - 1)
        np.maximum(row, 0, out=row)
        row = np.maximum.accumulate(row + steps) - steps  # gaps along the passage
        k = int(row.argmax())
        if row[k] > best:
            best, end = int(row[k]), k
        prev = row
    return best, end


def passages(places: np.ndarray, inner: np.ndarray, length: int, need: int, threshold: float) -> list[tuple[int, int]]:
    """Word ranges of a text that may hold an item of this length, from its seeds' places in the text and in the item. An alignment
    that reaches the threshold has at most `slack` gaps, so its seeds' diagonals, and its ends, are no further apart."""
    diagonal = places - inner
    order = np.argsort(diagonal, kind="stable")
    diagonal, inner = diagonal[order], inner[order]
    slack = max(4, int((1 - threshold) * 2 * length + 1e-9))
    cut = np.flatnonzero(np.diff(diagonal) > slack) + 1
    out = []
    for d, i in zip(np.split(diagonal, cut), np.split(inner, cut), strict=True):
        if len(np.unique(i)) >= need:
            out.append((max(0, int(d[0]) - slack), int(d[-1]) + length + slack))
    return out


def hits(h: np.ndarray, grams: np.ndarray, ix: Index, threshold: float) -> list[tuple[int, float, int]]:
    """(item, similarity, end word) of each item that a text has."""
    at, k = look_up(grams, ix)
    if not len(at):
        return []
    item = ix.item[k]
    out = []
    for i in np.unique(item):
        own = item == i
        if own.sum() < ix.need[i]:
            continue
        words_ = ix.items[i]
        top = max((align(words_, h[a:b]) + (a,) for a, b in passages(at[own], ix.place[k[own]], len(words_), ix.need[i], threshold)), default=None)
        if top and top[0] >= threshold * 2 * len(words_):
            out.append((int(i), top[0] / (2 * len(words_)), top[1] + top[2]))
    return out


def _batches(batches: Iterator[pa.RecordBatch], n: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray, np.ndarray]]:
    for batch in batches:
        for part in slices(batch, "text"):
            _, _, _, h, counts = words(part.column("text"), between=NOT_ALNUM)
            yield part, h, ngram_hashes(h, n), counts


def find(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text", n: int = 3, threshold: float = 0.5, least_seeds: int = 24, block_words: int = 1_000_000) -> DataFrame:
    """(id, item, similarity, end_word) for each text and each item that it holds, whole or edited."""
    spark = docs.sparkSession
    source = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    schema = T.StructType([T.StructField("id", docs.schema[id_col].dataType), T.StructField("item", benchmark.schema[item_col].dataType), T.StructField("similarity", T.DoubleType()), T.StructField("end_word", T.LongType())])
    results = [spark.createDataFrame([], schema)]
    block: list[tuple[object, np.ndarray]] = []
    size = 0

    def run_block(block: list[tuple[object, np.ndarray]]) -> DataFrame:
        keys, items = [k for k, _ in block], [w for _, w in block]
        grams = [_grams(w, n) for w in items]
        # how often the corpus has each n-gram; at most a row for each n-gram of the block comes back
        every = spark.sparkContext.broadcast(index(items, [np.arange(len(g)) for g in grams], grams))

        def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            ix = every.value
            total = np.zeros(len(ix.hashes), dtype=np.int64)
            for _, h, g, _ in _batches(batches, n):
                at, k = look_up(g, ix)
                total += np.bincount(k, minlength=len(total))
            at = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], names=["k", "c"])

        seen = mapped(source.select("text"), count, "k long, c long").groupBy("k").agg(F.sum("c")).collect()
        counts = np.zeros(len(every.value.hashes), dtype=np.int64)
        for k, c in seen:
            counts[k] = c
        ix, by_item = every.value, [np.zeros(len(g), dtype=np.int64) for g in grams]
        for k in range(len(counts)):
            by_item[ix.item[k]][ix.place[k]] = counts[k]
        rare = [np.sort(np.argsort(c, kind="stable")[: max(least_seeds, (len(c) + 1) // 2)]) for c in by_item]
        seeds = spark.sparkContext.broadcast((keys, index(items, rare, grams)))

        def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            keys, ix = seeds.value
            short = sorted({len(w) for w in ix.items if 0 < len(w) < n})
            for part, h, g, counts in _batches(batches, n):
                some = np.zeros(len(h) + 1, dtype=np.int64)
                some[1 : len(g) + 1] = ix.sieve[(g % np.uint64(SIEVE)).astype(np.int64)]
                if len(g) < len(h):
                    some[len(g) + 1 :] = 0
                some = np.cumsum(some)
                ends = np.cumsum(counts)
                rows = []
                for d in np.flatnonzero((some[ends] > some[ends - counts]) | bool(short)):
                    a, b = int(ends[d] - counts[d]), int(ends[d])
                    own = g[a : max(a, b - n + 1)]
                    rows += [(int(d), *x) for x in hits(h[a:b], own, ix, threshold)]
                    for m in short:
                        rows += [(int(d), *x) for x in hits(h[a:b], ngram_hashes(h[a:b], m), ix, threshold) if len(ix.items[x[0]]) == m]
                if rows:
                    d, i, s, e = zip(*rows, strict=True)
                    yield pa.RecordBatch.from_arrays([part.column("id").take(pa.array(d)), pa.array([keys[x] for x in i], part_type), pa.array(s, pa.float64()), pa.array(e, pa.int64())], names=["id", "item", "similarity", "end_word"])

        from pyspark.sql.pandas.types import to_arrow_type

        part_type = to_arrow_type(schema["item"].dataType)
        return mapped(source, search, schema)

    for row in benchmark.select(F.col(item_col), F.coalesce(F.col(item_text).cast("string"), F.lit(""))).toLocalIterator():
        w = words(pa.array([row[1]]), between=NOT_ALNUM)[3]
        if not len(w):
            continue
        if block and size + len(w) > block_words:
            results.append(run_block(block))
            block, size = [], 0
        block.append((row[0], w))
        size += len(w)
    if block:
        results.append(run_block(block))
    out = results[0]
    for x in results[1:]:
        out = out.unionByName(x)
    return out


def clean_rows(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", **how) -> DataFrame:
    """docs without those that hold an item of benchmark. All columns stay."""
    gone = written(find(docs, benchmark, id_col, text_col, **how).select(F.col("id").alias("_gone")).distinct(), "lexiflow-leaks")
    return docs.join(gone, docs[id_col].eqNullSafe(gone["_gone"]), "left_anti")
