"""Interpolated modified Kneser-Ney n-gram model: counted in Spark, kept as sorted hash arrays, memory-mapped by the workers.

Tokens are words (ASCII letters folded) and one end token a text; texts start after a begin token that is never predicted. The texts
are read once for each of `parts` parts; a pass counts the n-grams whose last word but one has its hash in the part. The contexts and
suffixes of an n-gram are in its part, so all but the sums of single words is settled in the pass, and only a part is shuffled at a time.

In a pass, workers count the n-grams of what they read and send them, by the n-gram's hash, to shards; a shard's task adds the counts
up, writes a sorted array of hashes with the counts beside it, and hands on what the next lower order needs: the distinct left
neighbours of each suffix, and for each context the sum and the numbers of n-grams seen once, twice and more often.
Shards are ranges of evenly spread hashes whose number grows with the text, so a very common word or pair is no hot shard.
A task deals what it gets to narrower ranges and adds them up one after another, with counts in the narrowest type that holds them, so
beside the n-grams themselves it holds the sorted copies of a range alone.

A shard keeps 40 bits of a hash. As a shard's size is fixed, an n-gram that was never seen is taken for another with a probability of
about 2e-6 (two million n-grams a shard), however large the corpus is; on small tables the probability is nil.

The files stand in the shared folder (a mounted path; `model_dir` names another), each written beside and renamed, so a task that
runs again leaves the same. Workers map the files that they look into, 1,000 at most at a time, and score whole texts from them.

Defined cases: a null or empty text is an end token alone; a very long text is counted and scored in blocks of its words' hashes, whole;
rows that repeat are counted as often; a null id is the empty text for the fold; columns of any other name are not read; with nothing to
learn from, every token is unknown with probability 1 and all scores are 0.
"""

from __future__ import annotations

import os
import uuid
from collections import OrderedDict
from collections.abc import Iterator
from urllib.parse import urlparse

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import ship
from .common import drop_written, mapped, release, scratch, written
from .words import BLOCK, mix, slices, words

END, BEGIN = np.uint64(0xE5A1F3C2D4B69788), np.uint64(0xB1C6E2F4A9D37851)
WHOLE = "whole"  # stands in a folder once all of the model is there
ROWS = "kind string, part int, shard int, body binary, stat array<bigint>"
CODEC = "zstd"
MOST_OPEN = 1000
PIECE = 2 << 20  # bytes of packed rows that are added up at a time
ROWS_AT_ONCE = 1 << 18


def key_of(cols: list[np.ndarray]) -> np.ndarray:
    """Hash of each n-gram; a single word keeps its own."""
    out = cols[0]
    for c in cols[1:]:
        out = mix(out * np.uint64(0x9FB21C651E98DF25) + c)
    return out


def added(key: np.ndarray, cols: list[np.ndarray], vals: list[np.ndarray]) -> tuple[np.ndarray, list[np.ndarray], list[np.ndarray]]:
    """Rows of the same key as one, in the order of keys, with vals summed."""
    if not len(key):
        return key, cols, vals
    order = np.argsort(key)
    key = key[order]
    first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
    return key[first], [c[order[first]] for c in cols], [np.add.reduceat(v[order], first) for v in vals]


def shard_of(key: np.ndarray, shards: int) -> np.ndarray:
    """Ranges of the hash, in order."""
    return ((key >> np.uint64(32)) * np.uint64(shards) >> np.uint64(32)).astype(np.int64)


def place_of(key: np.ndarray, shards: int) -> np.ndarray:
    """Where in its shard a hash stands, in 40 bits: ascends with the hash."""
    return key * np.uint64(shards) >> np.uint64(24)


def part_of(word: np.ndarray, parts: int) -> np.ndarray:
    return ((word & np.uint64(0xFFFFFFFF)) * np.uint64(parts) >> np.uint64(32)).astype(np.int64)


def once(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The values of x, each once, and where among them each stands."""
    out = pa.array(x).dictionary_encode()
    return out.dictionary.to_numpy(), out.indices.to_numpy()


def narrow(v: np.ndarray) -> np.ndarray:
    """Counts in the narrowest type that holds them."""
    return v.astype(_least(int(v.max(initial=0)) + 1))


def deal(out: list[list[list[np.ndarray]]], at: np.ndarray, cols: list[np.ndarray]) -> None:
    """Appends to each of out the rows of cols that are in its range; copies, so that a range can be let go by itself."""
    order = np.argsort(at.astype(_least(len(out))), kind="stable")
    cuts = np.searchsorted(at[order], np.arange(len(out) + 1))
    for held, a, b in zip(out, cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
        if b > a:
            held.append([c[order[a:b]] for c in cols])


def taken(out: list[list[list[np.ndarray]]]) -> Iterator[list[np.ndarray]]:
    """The columns of each range that has rows, in order; what is taken is let go."""
    for i, held in enumerate(out):
        if held:
            out[i] = []
            cols = [list(c) for c in zip(*held, strict=True)]
            held.clear()
            for k, c in enumerate(cols):
                cols[k] = np.concatenate(c)
            yield cols


def _padded(*arrays: np.ndarray) -> bytes:
    """Arrays one after another, each from a multiple of eight bytes on."""
    return b"".join(y for x in arrays for y in (np.ascontiguousarray(x).reshape(-1).view(np.uint8), b"\0" * (-x.nbytes % 8)))


def _least(n: int) -> np.dtype:
    """The narrowest type for numbers below n."""
    return np.min_scalar_type(max(n - 1, 0))


def _codes(vals: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """A number for each row's values, and whether all of them are below 256."""
    code = np.zeros(len(vals[0]), dtype=np.int64)
    small = np.ones(len(vals[0]), dtype=bool)
    for i, v in enumerate(vals):
        code |= np.minimum(v, 255).astype(np.int64) << (8 * i)
        small &= v < 256
    return code, small


def packed(key: np.ndarray, vals: list[np.ndarray]) -> bytes:
    """Places in one shard, ascending, and their values: first the rows with the commonest values, as keys alone, then those whose values
    all are below 256, with a code for them, then the others, with their values."""
    width = len(vals)
    blocks = [slice(a, a + ROWS_AT_ONCE) for a in range(0, len(key), ROWS_AT_ONCE)]
    found = []
    for block in blocks:
        code, small = _codes([v[block] for v in vals])
        found.append(np.unique(code[small], return_counts=True))
    none = np.zeros(0, dtype=np.int64)
    kinds, _, (times,) = added(np.concatenate([none, *(x for x, _ in found)]), [], [np.concatenate([none, *(x for _, x in found)])])
    common = kinds[np.argmax(times)] if len(kinds) else -1
    kinds = kinds[kinds != common]
    size = _least(len(kinds))
    highs, lows, fars, codes = [[], [], []], [[], [], []], [], []
    for block in blocks:
        own, (code, small) = key[block], _codes([v[block] for v in vals])
        high, low = (own >> np.uint64(8)).astype(np.uint32), (own & np.uint64(255)).astype(np.uint8)
        runs = [small & (code == common), small & (code != common), ~small]
        for i, run in enumerate(runs):
            highs[i].append(high[run])
            lows[i].append(low[run])
        codes.append(np.searchsorted(kinds, code[runs[1]]).astype(size))
        fars.append(np.stack([v[block][runs[2]] for v in vals], axis=1).astype(np.int64))
    known = np.concatenate([[max(common, 0)], kinds])
    table = np.stack([known >> (8 * i) & 255 for i in range(width)], axis=1).astype(np.int64)
    head = np.array([width, *(sum(map(len, x)) for x in highs), len(kinds), size.itemsize, 0, 0], dtype=np.int64)
    return _padded(head, table, *(np.concatenate(x) if x else none for x in (fars, sum(highs, []), sum(lows, []), codes)))


class Packed:
    """Views of what packed() made, in a buffer or a mapped file."""

    def __init__(self, buf: np.ndarray):
        self.width, self.common, self.small, self.big, n_codes, size = (int(x) for x in buf[:64].view(np.int64)[:6])
        at, n = 64, self.common + self.small + self.big

        def take(count: int, dtype) -> np.ndarray:
            nonlocal at
            size = count * np.dtype(dtype).itemsize
            out = buf[at : at + size].view(dtype)
            at += size + -size % 8
            return out

        self.table = take((n_codes + 1) * self.width, np.int64).reshape(-1, self.width)
        self.far = take(self.big * self.width, np.int64).reshape(-1, self.width)
        self.high, self.low = take(n, np.uint32), take(n, np.uint8)
        self.codes = take(self.small, f"u{size}")

    def rows(self) -> tuple[np.ndarray, np.ndarray]:
        key = self.high.astype(np.uint64) << np.uint64(8) | self.low
        return key, np.concatenate([np.repeat(self.table[:1], self.common, axis=0), self.table[self.codes.astype(np.int64) + 1], self.far])

    def find(self, key: np.ndarray) -> np.ndarray:
        """Values of keys, zeros for those that aren't there."""
        out = np.zeros((len(key), self.width), dtype=np.int64)
        high, low = (key >> np.uint64(8)).astype(np.uint32), (key & np.uint64(255)).astype(np.uint8)
        a, left, found = len(self.high), np.arange(len(key)), np.zeros(len(key), dtype=bool)
        for run, n in ((2, self.big), (1, self.small), (0, self.common)):
            a -= n
            if not n:
                continue
            upper, lower = self.high[a : a + n], self.low[a : a + n]
            own = high[left]
            at, rest = np.searchsorted(upper, own), left
            there = np.flatnonzero(upper.take(at, mode="clip") == own)
            while len(there):  # a round for each row with the same upper bits
                at, rest = at[there], rest[there]
                same = lower[at] == low[rest]
                row, hit = at[same], rest[same]
                out[hit] = self.table[0] if run == 0 else self.table[self.codes[row].astype(np.int64) + 1] if run == 1 else self.far[row]
                found[hit] = True
                at, rest = at[~same] + 1, rest[~same]
                there = np.flatnonzero((at < n) & (upper.take(at, mode="clip") == high[rest]))
            left = left[~found[left]]
        return out


def packed_grams(cols: list[np.ndarray], count: np.ndarray) -> bytes:
    """N-grams and their counts: the words once each, the n-grams as places among them, by the first word."""
    words_, at = once(np.concatenate(cols))
    at = at.reshape(len(cols), -1).astype(_least(len(words_)))
    order = np.lexsort(at[:2][::-1])
    at, count = at[:, order], count[order]
    at[0, 1:] = np.diff(at[0])
    far = count[count > 254]
    head = np.array([len(cols), len(count), len(words_), at.itemsize, len(far), 0, 0, 0], dtype=np.int64)
    body = _padded(head, far.astype(np.int64), words_, at, np.minimum(count, 255).astype(np.uint8))
    return len(body).to_bytes(8, "little") + pa.compress(body, codec=CODEC, asbytes=True)


def grams(blob: bytes) -> tuple[list[np.ndarray], np.ndarray]:
    """What packed_grams() made."""
    body = pa.decompress(blob[8:], decompressed_size=int.from_bytes(blob[:8], "little"), codec=CODEC, asbytes=True)
    k, n, n_words, size, n_far = np.frombuffer(body, dtype=np.int64, count=5).tolist()
    far = np.frombuffer(body, dtype=np.int64, count=n_far, offset=64)
    at = 64 + 8 * n_far
    words_ = np.frombuffer(body, dtype=np.uint64, count=n_words, offset=at)
    at += 8 * n_words
    places = np.frombuffer(body, dtype=f"u{size}", count=k * n, offset=at).reshape(k, n)
    at += k * n * size + -(k * n * size) % 8
    count = np.frombuffer(body, dtype=np.uint8, count=n, offset=at).astype(np.int64)
    count[count == 255] = far
    return [words_[np.cumsum(p, dtype=np.int64) if i == 0 else p] for i, p in enumerate(places)], count


def _sent(kind: str, part: int, key: np.ndarray, cols: list[np.ndarray] | None, vals: list[np.ndarray], shards: int) -> list[tuple]:
    """Rows for the shards; key ascends. cols: the words of n-grams, whose keys go on to lower orders."""
    at = np.searchsorted(shard_of(key, shards), np.arange(shards + 1))
    return [
        (kind, part, s, packed_grams([c[a:b] for c in cols], vals[0][a:b]) if cols else packed(place_of(key[a:b], shards), [v[a:b] for v in vals]), None)
        for s, (a, b) in enumerate(zip(at[:-1].tolist(), at[1:].tolist(), strict=True))
        if b > a
    ]


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    types = [pa.string(), pa.int32(), pa.int32(), pa.binary(), pa.list_(pa.int64())]
    columns_ = zip(*rows, strict=True) if rows else [[]] * len(types)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns_, types, strict=True)], names=["kind", "part", "shard", "body", "stat"])


def tokens(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Token hashes of all texts, an end token after each; tokens a text."""
    _, _, _, h, counts = words(column)
    out = np.full(len(h) + len(counts), END)
    at = np.arange(len(h)) + np.repeat(np.arange(len(counts)), counts)
    out[at] = h
    return out, counts + 1


def columns(t: np.ndarray, counts: np.ndarray, order: int) -> list[np.ndarray]:
    """The n-gram that ends at each token, a column for each of its words."""
    first = np.arange(len(t)) - np.repeat(np.cumsum(counts) - counts, counts)
    out = [t]
    for k in range(1, order):
        back = np.concatenate([np.full(min(k, len(t)), BEGIN), t[:-k] if k < len(t) else t[:0]])
        back[first < k] = BEGIN
        out.insert(0, back)
    return out


def _put(folder: str, name: str, body: bytes) -> None:
    beside = f"{folder}/.{name}-{uuid.uuid4().hex}"
    with open(beside, "wb") as f:
        f.write(body)
    os.replace(beside, f"{folder}/{name}")


def _pieces(bodies: list) -> list[list[list[np.ndarray]]]:
    """Empty ranges of a shard, as many as its bodies take."""
    return [[] for _ in range(1 + sum(map(len, bodies)) // PIECE)]


def _piece_of(place: np.ndarray, n: int) -> np.ndarray:
    return place * np.uint64(n) >> np.uint64(40)


def _summed(bodies: list) -> tuple[np.ndarray, list[np.ndarray]]:
    """Rows of packed() bodies, those of the same key as one; empties bodies."""
    pieces = _pieces(bodies)
    while bodies:
        key, vals = Packed(np.frombuffer(bodies.pop(), dtype=np.uint8)).rows()
        deal(pieces, _piece_of(key, len(pieces)), [key, *map(narrow, vals.T)])
    out = []
    for key, *vals in taken(pieces):
        key, _, sums = added(key, [], [v.astype(np.int64) for v in vals])
        out.append([key, *map(narrow, sums)])
    key, *sums = (np.concatenate(c) for c in zip(*out, strict=True))
    return key, sums


def _settle(folder: str, order: int, shards: int, last: bool = False):
    """What the task of a shard does, by the kind of its rows. Single words are added up in every pass, and settled in the last job."""

    def level(k: int, part: int, shard: int, bodies: list) -> Iterator[list[tuple]]:
        pieces = _pieces(bodies)
        groups = min(shards, len(pieces))
        to = lambda key: shard_of(key, shards) * groups // shards
        contexts, lower = [[] for _ in range(groups)], [[] for _ in range(groups)]
        while bodies:
            cols, count = grams(bodies.pop())
            deal(pieces, _piece_of(place_of(key_of(cols), shards), len(pieces)), [*cols, narrow(count)])
        places, counts, stat = [], [], [0] * 4
        for *cols, count in taken(pieces):
            key, cols, (c,) = added(key_of(cols), cols, [count.astype(np.int64)])
            places.append(place_of(key, shards))
            counts.append(narrow(c))
            stat = [n + int((c == i).sum()) for i, n in enumerate(stat, 1)]
            ctx = key_of(cols[:-1])
            deal(contexts, to(ctx), [ctx, counts[-1]])
            deal(lower, to(key_of(cols[1:])), cols[1:])
        places, counts = np.concatenate(places), np.concatenate(counts)
        _put(folder, f"gram{k}-{part}-{shard}", packed(places, [counts]))
        del places, counts
        for ctx, c in taken(contexts):
            ctx, _, sums = added(ctx, [], [c.astype(np.int64), *((c == i).astype(np.int64) for i in (1, 2)), (c > 2).astype(np.int64)])
            yield _sent(f"ctx{k}", part, ctx, None, sums, shards)
        for cols in taken(lower):
            low, cols, (n,) = added(key_of(cols), cols, [np.ones(len(cols[0]), dtype=np.int64)])
            yield _sent(f"gram{k - 1}", part, low, cols, [n], shards) if k > 2 else _sent("uni", 0, low, None, [n, np.zeros_like(n)], shards)
        yield [(f"stat{k}", part, shard, None, stat)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bodies, batch = [], None
        for batch in batches:
            kind, part, shard = (batch.column(c)[0].as_py() for c in ("kind", "part", "shard"))
            bodies += [b.as_buffer() for b in batch.column("body")]
        del batch
        if kind.startswith("gram"):
            yield from map(_batch, level(int(kind[4:]), part, shard, bodies))
            return
        key, sums = _summed(bodies)
        body, rows = packed(key, sums), []
        if not last and kind in ("uni", "ctx2"):
            rows.append((kind, part, shard, body, None))
        else:
            _put(folder, f"{kind}-{part}-{shard}", body)
            if kind == "uni":
                n, raw = sums
                rows.append(("stat1", part, shard, None, [int(x) for x in (*((n == i).sum() for i in (1, 2, 3, 4)), n.sum(), (n > 2).sum(), raw.sum(), (raw > 0).sum())]))
        yield _batch(rows)

    return run


def _local(path: str) -> str:
    """The mounted path of a folder."""
    url = urlparse(path)
    if url.scheme not in ("", "file"):
        raise ValueError(f"the model's arrays are memory-mapped, which {path} doesn't allow: name a mounted folder that all executors share as model_dir")
    return url.path


def train(docs: DataFrame, text_col: str = "text", order: int = 2, model_dir: str | None = None, shard_bytes: int = 16 << 20, flush: int = 1_000_000, parts: int = 6) -> dict:
    """Counts the texts of docs; returns what a worker needs to open the model."""
    spark = docs.sparkSession
    ship(spark)
    folder = _local(model_dir or scratch(spark, "lexiflow-ngrams"))
    os.makedirs(folder, exist_ok=True)
    source = docs.select(F.col(text_col).cast("string").alias("text"))
    size = source.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    shards = max(8, -(-size // (shard_bytes * parts)))

    groups = min(shards, 1 + flush // ROWS_AT_ONCE)

    def counter(part: int):
        def sent(held: list[list[list[np.ndarray]]], kind: str) -> Iterator[pa.RecordBatch]:
            for cols in taken(held):
                key, cols, (n,) = added(key_of(cols), cols, [np.ones(len(cols[0]), dtype=np.int64)])
                yield _batch(_sent("uni", 0, key, None, [np.zeros_like(n), n], shards) if kind == "uni" else _sent(kind, part, key, cols, [n], shards))

        def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            held: dict[str, list[list[list[np.ndarray]]]] = {kind: [[] for _ in range(groups)] for kind in (f"gram{order}", *(["uni"] if part == 0 else []))}
            n = dict.fromkeys(held, 0)
            for batch in batches:
                for piece in slices(batch, "text", BLOCK):
                    t, counts = tokens(piece.column("text"))
                    cols = columns(t, counts, order)
                    own = np.flatnonzero(part_of(cols[-2], parts) == part)
                    for kind in held:
                        new = [t] if kind == "uni" else [c[own] for c in cols]
                        deal(held[kind], shard_of(key_of(new), shards) * groups // shards, new)
                        n[kind] += len(new[0])
                        if n[kind] >= flush:
                            yield from sent(held[kind], kind)
                            n[kind] = 0
            for kind in held:
                yield from sent(held[kind], kind)

        return count

    stats: dict[str, list[int]] = {}

    def settled(rows: DataFrame, last: bool = False) -> DataFrame:
        out = written(rows.groupBy("kind", "part", "shard").applyInArrow(_settle(folder, order, shards, last), ROWS), "lexiflow-ngram-rows")
        release(spark)
        for r in out.select("kind", F.posexplode("stat").alias("i", "n")).groupBy("kind", "i").agg(F.sum("n").alias("n")).collect():  # 8 rows an order
            stats.setdefault(r.kind, [0] * 8)[r.i] += r.n
        return out.where(F.col("stat").isNull())

    left = []
    for part in range(parts):
        rows = settled(mapped(source, counter(part), ROWS))
        for _ in range(order - 2):
            before, rows = rows, settled(rows)
            drop_written(before)
        left.append(rows)
    every = left[0]
    for x in left[1:]:
        every = every.unionByName(x)
    drop_written(settled(every, last=True))
    for x in left:
        drop_written(x)
    one = stats.get("stat1", [0] * 8)
    open(f"{folder}/{WHOLE}", "w").close()
    return {"folder": folder, "order": order, "shards": shards, "parts": parts, "tokens": one[6], "distinct": one[7], "pairs": one[4], "unigram": [one[0], one[1], one[5]], "discounts": {k: discounts(*stats.get(f"stat{k}", [0] * 4)[:4]) for k in range(1, order + 1)}}


def discounts(n1: int, n2: int, n3: int, n4: int) -> list[float]:
    """What counts of 0, 1, 2 and more lose."""
    y = n1 / (n1 + 2 * n2) if n1 else 0.5
    d = [0.0, 1 - 2 * y * n2 / n1 if n1 else 0.5, 2 - 3 * y * n3 / n2 if n2 else 1.0, 3 - 4 * y * n4 / n3 if n3 else 1.5]
    return [min(max(x, 0.0), k) if k < 2 else min(max(x, 0.1), k - 0.1) for k, x in enumerate(d)]


class Scorer:
    """The model in a worker: maps a shard's files when it is first looked into."""

    def __init__(self, model: dict):
        if not os.path.exists(f"{model['folder']}/{WHOLE}"):
            raise FileNotFoundError(f"no model in {model['folder']}; is the folder mounted here?")
        self.model, self.open = model, OrderedDict()

    def shard(self, kind: str, part: int, shard: int) -> Packed | None:
        name = f"{kind}-{part}-{shard}"
        if name not in self.open:
            path = f"{self.model['folder']}/{name}"
            self.open[name] = Packed(np.memmap(path, dtype=np.uint8, mode="r").view(np.ndarray)) if os.path.exists(path) else None
            if len(self.open) > MOST_OPEN:
                self.open.popitem(last=False)
        self.open.move_to_end(name)
        return self.open[name]

    def find(self, kind: str, key: np.ndarray, part: np.ndarray, width: int) -> np.ndarray:
        """Values of ascending keys in their parts, zeros for those that aren't there."""
        out = np.zeros((len(key), width), dtype=np.int64)
        for p in np.unique(part).tolist():
            mine = np.flatnonzero(part == p)
            at = np.searchsorted(shard_of(key[mine], self.model["shards"]), np.arange(self.model["shards"] + 1))
            for s in np.flatnonzero(np.diff(at)).tolist():
                shard, own = self.shard(kind, p, s), mine[at[s] : at[s + 1]]
                if shard:
                    out[own] = shard.find(place_of(key[own], self.model["shards"]))
        return out

    def block(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Tokens, known tokens, base score and score of each text."""
        m = self.model
        t, counts = tokens(column)
        doc = np.repeat(np.arange(len(counts)), counts)
        add = lambda x: np.bincount(doc, weights=x, minlength=len(counts))
        word, back = once(t)
        order = np.argsort(word)
        word, back = word[order], np.argsort(order)[back]
        uni = self.find("uni", word, np.zeros(len(word), dtype=np.int64), 2)
        n, v = m["tokens"], m["distinct"]
        base = add(np.log10((uni[:, 1] + 0.1) / (n + 0.1 * (v + 1)))[back])
        known = add((uni[:, 1] > 0)[back]).astype(np.int64)
        d = np.array(m["discounts"][1])
        p = np.full(len(word), 1.0 / (v + 1))
        if m["pairs"]:
            gamma = float(np.dot(d[1:], m["unigram"])) / m["pairs"]
            p = (uni[:, 0] - d[np.minimum(uni[:, 0], 3)]) / m["pairs"] + gamma * p
        prob = p[back]
        starts = np.cumsum(counts) - counts
        gram, last = word, part_of(word, m["parts"])  # the n-grams of the order below, once each, and the parts of their last words
        for k in range(2, m["order"] + 1):
            d = np.array(m["discounts"][k])
            stats = np.concatenate([self.find(f"ctx{k}", gram, last, 4), self.find(f"ctx{k}", key_of([np.array([BEGIN])] * (k - 1)), part_of(np.array([BEGIN]), m["parts"]), 4)])
            total = np.maximum(stats[:, 0], 1)
            rest, seen = (stats[:, 1:] @ d[1:]) / total, stats[:, 0] > 0
            ctx = np.concatenate([back[:1], back[:-1]])  # the context of a token is the n-gram that ends before it
            ctx[starts] = len(gram)
            del stats, back, gram, last
            own = columns(t, counts, k)
            key, before = key_of(own), own[-2]
            del own
            order = np.argsort(key)
            key = key[order]
            fresh = np.concatenate([[True], key[1:] != key[:-1]])
            back = np.empty(len(key), dtype=np.int64)
            back[order] = np.cumsum(fresh) - 1
            gram, first = key[fresh], order[fresh]
            last, part = part_of(t[first], m["parts"]), part_of(before[first], m["parts"])
            del before, key, order, fresh, first
            c = self.find(f"gram{k}", gram, part, 1)[:, 0]
            c = (c - d[np.minimum(c, 3)])[back]
            prob = np.where(seen[ctx], c / total[ctx] + rest[ctx] * prob, prob)
        return counts, known, base, add(np.log10(prob))


def score(docs: DataFrame, model: dict, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_tokens, n_known, train_tokens, base_score, score) of each text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(model)
        for batch in batches:
            for part in slices(batch, "text"):
                n, known, base, own = scorer.block(part.column("text"))
                yield pa.RecordBatch.from_arrays([part.column("id"), *map(pa.array, (n, known, np.full(len(n), model["tokens"]), base, own))], names=["id", "n_tokens", "n_known", "train_tokens", "base_score", "score"])

    schema = T.StructType([T.StructField("id", docs.schema[id_col].dataType), *(T.StructField(c, T.LongType()) for c in ("n_tokens", "n_known", "train_tokens")), T.StructField("base_score", T.DoubleType()), T.StructField("score", T.DoubleType())])
    return mapped(docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")), run, schema)


def learn_and_score(docs: DataFrame, learn: Column, id_col: str = "doc_id", text_col: str = "text", **how) -> DataFrame:
    return score(docs, train(docs.where(learn), text_col, **how), id_col, text_col)
