"""Packing of tokenised documents into sequences: cutting stock by column generation.

A document is cut into whole sequences, a body (a multiple of `unit` tokens) and a tail shorter than `unit`. The histogram of piece
lengths, which has a bounded number of rows however large the corpus is, goes to the driver. There a linear program
over patterns (how many pieces of each length make a sequence) is solved by column generation: its duals price the lengths, and a
knapsack dynamic program finds the pattern that they favour most. Patterns are rounded down; the few pieces left over are
packed first-fit decreasing. Pieces get a rank among those of their length, and the plan maps ranks to places.

Ranks take no sort and no group in one task: a worker numbers the pieces of each length as it writes them, and the
numbers that each partition starts from come from the partitions' counts.

Defined cases: a null or empty text is one end token; rows with the same id or text are packed each by itself; an empty table gives an empty
result; a text of any length is cut, never shortened.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import mapped, written
from .words import slices, text_buffer, words

#: ASCII punctuation that never continues a match begun by a letter or digit, nor stands in a special token.
CUTS = b"!\"#$%&()*+,-./:;=?@[\\]^_`{}~"


def default_tokenizer() -> str:
    import public_tokenizers

    return str(public_tokenizers.path("word_bpe_49k.json"))


class WordIds:
    """Token ids of texts by a tokenizer that drops white space, with the ids of each distinct word kept.

    As the tokenizer splits at white space and before punctuation, a text's ids are those of its words joined; each word is
    encoded by the library once, until `most` words are held and all are forgotten.
    """

    def __init__(self, path: str, most: int = 2_000_000):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.most = most
        self.ends = np.zeros(max(self.tokenizer.get_vocab().values()) + 1, dtype=bool)
        for token, i in self.tokenizer.get_vocab().items():
            self.ends[i] = token.endswith("</w>")
        self.clear()

    def clear(self) -> None:
        self.keys = np.zeros(0, dtype=np.uint64)
        self.slots = np.zeros(0, dtype=np.int32)
        self.begin = np.zeros(1, dtype=np.int64)
        self.flat = np.zeros(0, dtype=np.uint32)

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of each text. Words of letters are encoded many at once, as each ends where an id with a word end stands."""
        out: list[np.ndarray | None] = [None] * len(texts)
        alpha = [i for i, t in enumerate(texts) if t.isalpha()]
        runs = [alpha[k : k + 256] for k in range(0, len(alpha), 256)]
        for run, e in zip(runs, self.tokenizer.encode_batch_fast([" ".join(texts[i] for i in r) for r in runs], add_special_tokens=False), strict=True):
            ids = np.array(e.ids, dtype=np.uint32)
            at = np.flatnonzero(self.ends[ids]) + 1
            if len(at) == len(run) and at[-1] == len(ids):
                for i, part in zip(run, np.split(ids, at[:-1]), strict=True):
                    out[i] = part
        rest = [i for i, x in enumerate(out) if x is None]
        for i, e in zip(rest, self.tokenizer.encode_batch_fast([texts[i] for i in rest], add_special_tokens=False), strict=True):
            out[i] = np.array(e.ids, dtype=np.uint32)
        return out

    def block(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids of a column of texts, and how many each text has."""
        plain = b"<|" in text_buffer(column)[0].tobytes()  # a special token may stand there, which has a case
        buf, starts, ends, h, counts = words(column, lower=not plain, extra_cuts=CUTS)
        if not len(h):
            return np.zeros(0, dtype=np.uint32), np.zeros(len(counts), dtype=np.int64)
        codes, uniq = pd.factorize(h)
        at = np.searchsorted(self.keys, uniq)
        at[at == len(self.keys)] = 0
        new = self.keys[at] != uniq if len(self.keys) else np.ones(len(uniq), dtype=bool)
        if new.any():
            if len(self.keys) + int(new.sum()) > self.most and len(self.keys):
                self.clear()
                new = np.ones(len(uniq), dtype=bool)
            first = np.empty(len(uniq), dtype=np.int64)
            first[codes[::-1]] = np.arange(len(codes))[::-1]
            where = first[new]
            raw = buf.tobytes()
            ids = self.encode([raw[a:b].decode() for a, b in zip(starts[where].tolist(), ends[where].tolist(), strict=True)])
            slots = np.arange(len(self.begin) - 1, len(self.begin) - 1 + len(ids), dtype=np.int32)
            self.begin = np.concatenate([self.begin, self.begin[-1] + np.cumsum([len(x) for x in ids])])
            self.flat = np.concatenate([self.flat, *ids])
            order = np.argsort(uniq[new])
            fresh = uniq[new][order]
            into = np.searchsorted(self.keys, fresh)
            self.keys, self.slots = np.insert(self.keys, into, fresh), np.insert(self.slots, into, slots[order])
            at = np.searchsorted(self.keys, uniq)
        slot = self.slots[at][codes]
        n = (self.begin[slot + 1] - self.begin[slot]).astype(np.int64)
        ends_ = np.cumsum(n)
        flat = self.flat[np.arange(int(ends_[-1])) - np.repeat(ends_ - n - self.begin[slot], n)]
        total = np.concatenate([[0], ends_])
        doc_end = np.cumsum(counts)
        return flat, total[doc_end] - total[doc_end - counts]


_kept: dict[str, WordIds] = {}


def pieces(docs: DataFrame, id_col: str, text_col: str, capacity: int, unit: int, end_id: int, tokenizer: str) -> DataFrame:
    """(id, start, length, crc, tokens, part, local): local counts the pieces of a length within a partition."""
    id_type = docs.schema[id_col].dataType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if tokenizer not in _kept:
            _kept[tokenizer] = WordIds(tokenizer)
        ids, part_no = _kept[tokenizer], TaskContext.get().partitionId()
        seen = np.zeros(capacity + 1, dtype=np.int64)
        end = np.array([end_id], dtype="<u4").tobytes()
        for batch in batches:
            for part in slices(batch, "text"):
                flat, counts = ids.block(part.column("text"))
                raw, at = memoryview(flat.astype("<u4").tobytes()), 0
                rows: list[tuple[int, int, int, int, int, int]] = []
                for d, n in enumerate(counts.tolist()):
                    mine = bytes(raw[4 * at : 4 * (at + n)]) + end
                    at += n
                    n += 1
                    whole = n - n % capacity
                    body = n - n % unit
                    for a, b in [*((x, x + capacity) for x in range(0, whole, capacity)), (whole, body), (body, n)]:
                        if b > a:
                            rows.append((d, a, b - a, zlib.crc32(mine[4 * a : 4 * b]), n, int(seen[b - a])))
                            seen[b - a] += 1
                d, a, length, crc, n, local = (np.array(x, dtype=np.int64) for x in zip(*rows, strict=True))
                yield pa.RecordBatch.from_arrays([part.column("id").take(pa.array(d)), *map(pa.array, (a, length, crc, n, np.full(len(d), part_no), local))], names=["id", "start", "length", "crc", "tokens", "part", "local"])

    schema = T.StructType([T.StructField("id", id_type), *(T.StructField(c, T.LongType()) for c in ("start", "length", "crc", "tokens", "part", "local"))])
    return mapped(docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")), run, schema)


def best_pattern(value: np.ndarray, width: np.ndarray, capacity: int) -> tuple[float, np.ndarray]:
    """Unbounded knapsack by dynamic programming: the worth and the counts of the best pattern."""
    worth, took = np.zeros(capacity + 1), np.full(capacity + 1, -1)
    use = np.flatnonzero(value > 1e-12)
    w, v = width[use], value[use]
    for c in range(1, capacity + 1):
        worth[c] = worth[c - 1]
        ok = w <= c
        if ok.any():
            gain = np.where(ok, worth[c - np.minimum(w, c)] + v, -1.0)
            k = int(gain.argmax())
            if gain[k] > worth[c] + 1e-15:
                worth[c], took[c] = gain[k], k
    counts, c = np.zeros(len(width), dtype=np.int64), capacity
    while c > 0:
        if took[c] < 0:
            c -= 1
        else:
            counts[use[took[c]]] += 1
            c -= int(w[took[c]])
    return float(worth[capacity]), counts


def column_generation(width: np.ndarray, demand: np.ndarray, capacity: int, most_rounds: int = 2000) -> list[tuple[np.ndarray, int]]:
    """Patterns and how often to use each, rounded down so that no length is oversupplied. Revised simplex with priced columns."""
    m = len(width)
    if not m:
        return []
    d = demand.astype(float) * (1 + 1e-9 * np.arange(1, m + 1))  # against ties
    columns = [np.where(np.arange(m) == i, capacity // width[i], 0) for i in range(m)]
    cost = np.ones(m)
    for _ in range(most_rounds):
        basis = np.array(columns, dtype=float).T
        x = np.linalg.solve(basis, d)
        y = np.linalg.solve(basis.T, cost)
        if y.min() < -1e-9:  # an oversupply pays
            enter, price = -np.eye(m)[int(y.argmin())], 0.0
        else:
            worth, counts = best_pattern(y, width, capacity)
            if worth <= 1 + 1e-7:
                break
            enter, price = counts.astype(float), 1.0
        step = np.linalg.solve(basis, enter)
        up = step > 1e-10
        if not up.any():
            break
        ratio = np.full(m, np.inf)
        ratio[up] = np.maximum(x[up], 0) / step[up]
        out = int(ratio.argmin())
        columns[out], cost[out] = enter, price
    x = np.floor(np.linalg.solve(np.array(columns, dtype=float).T, d) + 1e-6)
    plan = [[np.asarray(c, dtype=np.int64), int(n)] for c, n, p in zip(columns, x, cost, strict=True) if p and n >= 1]
    for i in range(m):
        over = sum(n * c[i] for c, n in plan) - int(demand[i])
        for row in sorted((r for r in plan if r[0][i]), key=lambda r: r[0][i]):
            if over <= 0:
                break
            cut = min(row[1], -(-over // int(row[0][i])))
            row[1] -= cut
            over -= cut * int(row[0][i])
    return [(c, n) for c, n in plan if n]


def first_fit(width: np.ndarray, demand: np.ndarray, capacity: int) -> list[tuple[np.ndarray, int]]:
    """Patterns for a few pieces, the widest first."""
    bins: list[list] = []
    for i in np.argsort(-width, kind="stable"):
        left = int(demand[i])
        for b in bins:
            n = min(left, b[1] // int(width[i]))
            b[0][i] += n
            b[1] -= n * int(width[i])
            left -= n
            if not left:
                break
        while left:
            n = min(left, capacity // int(width[i]))
            counts = np.zeros(len(width), dtype=np.int64)
            counts[i] = n
            bins.append([counts, capacity - n * int(width[i])])
            left -= n
    return [(b[0], 1) for b in bins]


def plan(histogram: dict[int, int], capacity: int, unit: int) -> list[tuple[int, int, int, int, int, int]]:
    """(length, first rank, last rank + 1, pieces a sequence, first sequence, offset of the first of them) for all ranks."""
    width = np.array(sorted(histogram), dtype=np.int64)
    demand = np.array([histogram[w] for w in width.tolist()], dtype=np.int64)
    patterns: list[tuple[np.ndarray, int]] = []
    for own, scale in ((width >= unit, unit), (width < unit, 1)):  # bodies in units, tails in tokens
        at = np.flatnonzero(own)
        for counts, n in column_generation(width[at] // scale, demand[at], capacity // scale):
            whole = np.zeros(len(width), dtype=np.int64)
            whole[at] = counts
            patterns.append((whole, n))
    left = demand - sum((c * n for c, n in patterns), np.zeros(len(width), dtype=np.int64))
    patterns += first_fit(width, left, capacity)
    rank, sequence, out = np.zeros(len(width), dtype=np.int64), 0, []
    for counts, n in patterns:
        offset = 0
        for i in np.flatnonzero(counts):
            k = int(counts[i])
            out.append((int(width[i]), int(rank[i]), int(rank[i]) + k * n, k, sequence, offset))
            rank[i] += k * n
            offset += k * int(width[i])
        sequence += n
    return out


def pack(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", capacity: int = 4096, unit: int = 64, end_id: int = 2, tokenizer: str | None = None) -> DataFrame:
    """(id, start, length, ids_crc32, doc_tokens, sequence_id, offset) of each piece."""
    spark = docs.sparkSession
    if capacity % unit:
        raise ValueError("capacity must be a multiple of unit")
    cut = written(pieces(docs, id_col, text_col, capacity, unit, end_id, tokenizer or default_tokenizer()), "lexiflow-pieces")
    counts = written(cut.groupBy("part", "length").agg((F.max("local") + 1).alias("n")), "lexiflow-counts")
    histogram = {r[0]: r[1] for r in counts.groupBy("length").agg(F.sum("n")).collect()}  # capacity / unit + unit rows at most
    rows = plan(histogram, capacity, unit)
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    base = counts.select("part", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    places = spark.createDataFrame(rows, "plan_length long, lo long, hi long, per long, sequence long, at long")  # bounded as the histogram
    ranked = cut.join(written(base, "lexiflow-base"), ["part", "length"]).withColumn("rank", F.col("base") + F.col("local"))
    out = ranked.join(F.broadcast(places), (F.col("length") == F.col("plan_length")) & (F.col("rank") >= F.col("lo")) & (F.col("rank") < F.col("hi")))
    k = F.col("rank") - F.col("lo")
    return out.select("id", "start", "length", F.col("crc").alias("ids_crc32"), F.col("tokens").alias("doc_tokens"), (F.col("sequence") + F.expr("(rank - lo) div per")).alias("sequence_id"), (F.col("at") + (k % F.col("per")) * F.col("length")).alias("offset"))
