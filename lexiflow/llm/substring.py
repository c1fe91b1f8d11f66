"""Substring deduplication: an FM-index a shard, searched backwards over a wavelet matrix for matching statistics.

A window is `window` consecutive words of one text. Each word goes that a window covers whose words also start earlier: in a text with a
smaller id, or earlier in the same one.

1. Each window has an anchor, the least hash among its runs of `anchor` words. Consecutive windows of one anchor make a
   segment. Equal windows have equal anchors, so only segments whose anchor stands twice or more, in the corpus or in
   themselves, can hold a repeat. Anchors alone are shuffled to find these; then the texts that have some are read again.
2. Segments with the same words become one, with the place where it first stands. All windows of a later copy are repeats. An anchor
   of over `hot` segments is split: there each window is a segment of its own, sent by its own hash.
3. Shards hold the distinct segments of their anchors. Each shard's FM-index gives the matching statistic of each window's
   end; where it reaches `window`, the earliest place among the suffixes found tells the repeats from their first.
4. Intervals of repeats go back to their texts.

Indexing each text against every other shard would cost the square of the corpus; sending segments by anchor keeps the work
in proportion to it.

Defined cases: a null or empty text has no words; rows are ordered by id, null ids first, and rows of one id by a hash of their text; rows
equal in both count as one text and get the same result; ids may be of any type that has an order; an empty table gives an empty result;
very long texts are read in blocks, and their words' hashes held; other columns are never read, whatever their names.

Words are compared by 40 bits of their hashes (`TOKEN`): two windows that differ in a single word pass for equal with a probability of 2**-40.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import ship
from .common import drop_written, mapped, release, written
from .fm_index import FMIndex
from .words import mix, ngram_hashes, slices, valid_starts, words

TOKEN = 5  # bytes of a word's hash that segments carry; digests have all of them
PARTS = 3  # of the segments, by digest
P1, P2 = 0x9E3779B97F4A7C15 | 1, 0xC2B2AE3D27D4EB4F | 1


def anchors(h: np.ndarray, counts: np.ndarray, window: int, anchor: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First word of each window, the window's anchor, and the hashes of all runs that may be one."""
    starts = np.flatnonzero(valid_starts(counts, window))
    g = ngram_hashes(h, anchor)
    n = window - anchor + 1  # runs in a window
    least, size = g, 1
    while size * 2 <= n:
        least = np.minimum(least[: len(least) - size], least[size:])
        size *= 2
    if size < n:
        least = np.minimum(least[: len(g) - n + 1], least[n - size : n - size + len(g) - n + 1])
    return starts, least[starts], g


def segments(starts: np.ndarray, anchor: np.ndarray, doc: np.ndarray, longest: int) -> tuple[np.ndarray, np.ndarray]:
    """Begin and end, among windows, of each run of windows with the same anchor that follow each other, in runs of `longest` at most."""
    if not len(starts):
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    fresh = np.concatenate([[True], (anchor[1:] != anchor[:-1]) | (doc[1:] != doc[:-1])])
    begin = np.flatnonzero(fresh)
    into = np.arange(len(starts)) - np.repeat(begin, np.diff(np.concatenate([begin, [len(starts)]])))
    begin = np.flatnonzero(into % longest == 0)
    return begin, np.concatenate([begin[1:], [len(starts)]])


def anchored_twice(starts: np.ndarray, least: np.ndarray, g: np.ndarray, begin: np.ndarray, runs: int) -> np.ndarray:
    """Whether each segment has its anchor at more than one place, so that it may repeat itself."""
    if not len(begin):
        return np.zeros(0, dtype=bool)
    enters = (g[starts + runs - 1] == least).astype(np.int64)
    enters[begin] = 0
    first = np.zeros(len(begin), dtype=np.int64)
    for k in range(runs):
        first += g[starts[begin] + k] == least[begin]
    return (np.add.reduceat(enters, begin) > 0) | (first > 1)


def _prefix(h: np.ndarray, base: int) -> tuple[np.ndarray, np.ndarray]:
    """Prefix sums of a polynomial in base over h, and the base's inverse powers."""
    n = len(h)
    power, inverse = np.ones(n + 1, dtype=np.uint64), np.ones(n + 1, dtype=np.uint64)
    power[1:], inverse[1:] = np.uint64(base), np.uint64(pow(base, -1, 1 << 64))
    np.cumprod(power, out=power)
    np.cumprod(inverse, out=inverse)
    return np.concatenate([np.zeros(1, np.uint64), np.cumsum(h * power[:n])]), inverse


def _digests(h: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """128 bits of each range of words, as two columns."""
    out = []
    for base in (P1, P2):
        sums, inverse = _prefix(mix(h + np.uint64(base)), base)
        out.append(mix((sums[b] - sums[a]) * inverse[a] + (b - a).astype(np.uint64)))
    return np.stack(out, axis=1)


def _read(part: pa.RecordBatch, window: int, anchor: int, longest: int):
    _, _, _, h, counts = words(part.column("text"), lower=False)
    starts, least, g = anchors(h, counts, window, anchor)
    doc = np.repeat(np.arange(len(counts)), counts)
    own = doc[starts]
    begin, end = segments(starts, least, own, longest)
    return h, counts, starts, least, g, own, begin, end


def _search(window: int):
    """What a shard does: (id, th, first word, last word + 1) of each run of repeated windows in the first stands of its segments."""

    def run(group: pa.Table) -> pa.Table:
        blobs = group.column("tokens").to_pylist()
        n = np.array([len(b) // TOKEN for b in blobs], dtype=np.int64)
        ids, th, start = group.column("id"), group.column("th"), np.array(group.column("start"))
        order = np.array(pc.sort_indices(pa.table({"id": ids, "th": th}), sort_keys=[("id", "ascending"), ("th", "ascending")], null_placement="at_start"))
        name = np.array(ids.combine_chunks().dictionary_encode(null_encoding="encode").indices)[order]
        th_ = np.array(th)[order]
        rank = np.empty(len(order), dtype=np.int64)
        rank[order] = np.cumsum(np.concatenate([[0], ((np.diff(th_) != 0) | (np.diff(name) != 0)).astype(np.int64)]))
        flat = np.zeros((int(n.sum()), 8), dtype=np.uint8)
        flat[:, :TOKEN] = np.frombuffer(b"".join(blobs), dtype=np.uint8).reshape(-1, TOKEN)
        blobs.clear()
        vocabulary, dense = np.unique(flat.view(np.uint64).reshape(-1), return_inverse=True)
        del flat
        # segments one after another, a 0 after each
        text = np.zeros(int(n.sum()) + len(n), dtype=np.int64)
        seg = np.repeat(np.arange(len(n)), n)
        text[np.arange(len(dense)) + seg] = dense + 1
        head = np.cumsum(n + 1) - (n + 1)
        index = FMIndex(text, len(vocabulary) + 1, window)
        windows = n - window + 1
        of = np.repeat(np.arange(len(n)), windows)
        into = np.arange(int(windows.sum())) - np.repeat(np.cumsum(windows) - windows, windows)
        length, lo, hi = index.matching(head[of] + into + window)
        whole = np.flatnonzero(length == window)
        if len(whole):
            # order of all places in the corpus: by text, then by word
            seg_of = np.searchsorted(head, index.places, "right") - 1
            place = rank[seg_of] << 32 | (start[seg_of] + index.places - head[seg_of])
            a, back = np.unique(lo[whole], return_inverse=True)
            b = np.zeros(len(a), dtype=np.int64)
            b[back] = hi[whole]
            least = np.minimum.reduceat(np.append(place, np.iinfo(np.int64).max), np.stack([a, b], axis=1).reshape(-1))[::2]
            mine = rank[of[whole]] << 32 | (start[of[whole]] + into[whole])
            whole = whole[least[back] < mine]
        s, w = of[whole], into[whole]
        edge = np.concatenate([[True], (np.diff(s) != 0) | (np.diff(w) != 1)]) if len(s) else np.zeros(0, dtype=bool)
        first = np.flatnonzero(edge)
        last = np.concatenate([first[1:], [len(s)]]) - 1 if len(s) else first
        take = pa.array(s[first])
        return pa.table({"id": ids.take(take), "th": th.take(take), "a": pa.array(start[s[first]] + w[first]), "b": pa.array(start[s[first]] + w[last] + window)})

    return run


def repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = 20, anchor: int = 6, hot: int = 256, longest: int = 64, shard_words: int = 1_000_000) -> DataFrame:
    """(id, th, a, b): ranges of words that repeated windows cover. th is the text's hash."""
    ship(docs.sparkSession)
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    source = docs.select(F.col(id_col).alias("id"), F.xxhash64(text).alias("th"), text.alias("text"))
    id_type = docs.schema[id_col].dataType.simpleString()

    def list_anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                _, counts, starts, least, g, own, begin, _ = _read(part, window, anchor, longest)
                begin = np.repeat(begin, 1 + anchored_twice(starts, least, g, begin, window - anchor + 1))
                n = np.bincount(own[begin], minlength=len(counts))
                offs = np.concatenate([[0], np.cumsum(n)]).astype(np.int32)
                yield pa.RecordBatch.from_arrays([part.column("id"), part.column("th"), pa.ListArray.from_arrays(pa.array(offs), pa.array(least[begin].view(np.int64)))], names=["id", "th", "anchors"])

    listed = mapped(source, list_anchors, f"id {id_type}, th long, anchors array<long>")
    spread = written(listed.select("id", "th", F.explode("anchors").alias("anchor")), "lexiflow-anchors")
    twice = written(spread.groupBy("anchor").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("anchor", (F.col("n") > hot).alias("many")), "lexiflow-repeated")
    mine = spread.join(twice, "anchor").groupBy("id", "th").agg(F.collect_set(F.when(~F.col("many"), F.col("anchor"))).alias("few"), F.collect_set(F.when(F.col("many"), F.col("anchor"))).alias("many"))
    mine = written(mine, "lexiflow-texts")
    drop_written(spread)
    drop_written(twice)
    release(docs.sparkSession)
    again = source.join(mine.withColumnsRenamed({"id": "_id", "th": "_th"}), F.col("id").eqNullSafe(F.col("_id")) & (F.col("th") == F.col("_th"))).select("id", "th", "text", "few", "many")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[bytes] = set()  # whose words this task has sent; at most a segment's digest for each row that it writes
        for batch in batches:
            for part in slices(batch, "text", most_bytes=1 << 20):
                h, counts, starts, least, _, own, begin, end = _read(part, window, anchor, longest)
                keep, single = [], []
                for into, name in ((keep, "few"), (single, "many")):
                    lists = part.column(name)
                    offs = np.array(lists.offsets)
                    owner = np.repeat(np.arange(len(counts)), np.diff(offs)).astype(np.uint64)
                    have = np.array(lists.flatten()).view(np.uint64) ^ mix(owner)
                    into.append(np.isin(least[begin] ^ mix(own[begin].astype(np.uint64)), have))
                few, many = np.flatnonzero(keep[0]), np.flatnonzero(single[0])
                alone = np.concatenate([np.arange(a, b) for a, b in zip(begin[many], end[many], strict=True)] or [np.zeros(0, np.int64)]).astype(np.int64)
                a = np.concatenate([starts[begin[few]], starts[alone]])
                b = np.concatenate([starts[end[few] - 1] + window, starts[alone] + window])
                if not len(a):
                    continue
                digest = _digests(h, a, b)
                route = np.concatenate([least[begin[few]], mix(digest[len(few) :, 0])]).view(np.int64)
                doc = np.concatenate([own[begin[few]], own[alone]])
                first = np.cumsum(counts) - counts
                raw = h.view(np.uint8).reshape(-1, 8)[:, :TOKEN].tobytes()
                keys = [x.tobytes() for x in digest]
                sent = []
                for key, x, y in zip(keys, a.tolist(), b.tolist(), strict=True):
                    sent.append(None if key in seen else raw[TOKEN * x : TOKEN * y])
                    seen.add(key)
                tokens = pa.array(sent, pa.binary())
                take = pa.array(doc)
                yield pa.RecordBatch.from_arrays([part.column("id").take(take), part.column("th").take(take), pa.array(a - first[doc]), pa.array(b - a), pa.array(route), pa.array(keys, pa.binary()), tokens], names=["id", "th", "start", "n", "route", "digest", "tokens"])

    # stands of all segments, with their words
    stands = written(mapped(again, cut, f"id {id_type}, th long, start long, n long, route long, digest binary, tokens binary"), "lexiflow-stands")
    drop_written(mine)
    release(docs.sparkSession)
    where = F.struct(F.col("id").isNotNull().alias("has"), "id", "th", "start")
    # in parts, one after another, as each shuffles its words; the places without the words are kept for the later copies
    part = F.pmod(F.xxhash64("digest"), F.lit(PARTS))
    places = written(stands.drop("tokens", "route"), "lexiflow-places")
    done = []
    for p in range(PARTS):
        own = stands.where(part == p).groupBy("digest", "route", "n").agg(F.min(where).alias("f"), F.max("tokens").alias("tokens"))
        done.append(written(own.select("digest", "route", "n", "f.id", "f.th", "f.start", "tokens"), "lexiflow-segments"))
        release(docs.sparkSession)
    drop_written(stands)
    firsts = reduce(DataFrame.unionByName, done)
    later = places.join(firsts.select("digest", F.col("id").alias("fid"), F.col("th").alias("fth"), F.col("start").alias("fstart")), "digest")
    later = later.where(~(F.col("id").eqNullSafe(F.col("fid")) & (F.col("th") == F.col("fth")) & (F.col("start") == F.col("fstart"))))
    total = firsts.agg(F.sum("n")).first()[0] or 0
    shards = max(32, -(-total // shard_words))
    found = firsts.select("id", "th", "start", "tokens", F.pmod(F.xxhash64("route"), F.lit(shards)).alias("shard")).groupBy("shard").applyInArrow(_search(window), f"id {id_type}, th long, a long, b long")
    out = written(later.select("id", "th", F.col("start").alias("a"), (F.col("start") + F.col("n")).alias("b")).unionByName(found), "lexiflow-repeats")
    drop_written(places)
    drop_written(firsts)
    release(docs.sparkSession)
    return out


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **how) -> DataFrame:
    """(id, n_words, n_removed, kept_text) of each row: its words that no repeated window covers, joined by one space."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    id_type = docs.schema[id_col].dataType
    found = repeats(docs, id_col, text_col, **how)
    runs = written(found.groupBy(F.col("id").alias("_id"), F.col("th").alias("_th")).agg(F.collect_set(F.struct("a", "b")).alias("runs")), "lexiflow-runs")
    drop_written(found)
    release(docs.sparkSession)
    source = docs.select(F.col(id_col).alias("id"), F.xxhash64(text).alias("th"), text.alias("text"))
    joined = source.join(runs, F.col("id").eqNullSafe(F.col("_id")) & (F.col("th") == F.col("_th")), "left").select("id", "text", "runs")

    def strip(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                n, gone, kept = [], [], []
                runs = part.column("runs")
                for i, t in enumerate(part.column("text")):
                    own = t.as_buffer().to_pybytes().split() if t.is_valid else []
                    n.append(len(own))
                    if runs[i].is_valid:
                        edge = np.zeros(len(own) + 1, dtype=np.int64)
                        values = runs[i].values
                        np.add.at(edge, np.array(values.field("a")), 1)
                        np.add.at(edge, np.array(values.field("b")), -1)
                        stay = np.flatnonzero(np.cumsum(edge[:-1]) == 0)
                        gone.append(len(own) - len(stay))
                        own = [own[k] for k in stay.tolist()]
                    else:
                        gone.append(0)
                    kept.append(b" ".join(own))
                yield pa.RecordBatch.from_arrays([part.column("id"), pa.array(n, pa.int64()), pa.array(gone, pa.int64()), pa.array(kept, pa.binary()).cast(pa.string())], names=["id", "n_words", "n_removed", "kept_text"])

    schema = T.StructType([T.StructField("id", id_type), T.StructField("n_words", T.LongType()), T.StructField("n_removed", T.LongType()), T.StructField("kept_text", T.StringType())])
    return mapped(joined, strip, schema)


def kept_digest(df: DataFrame) -> DataFrame:
    return df.withColumn("kept_sha256", F.sha2(F.col("kept_text").cast("binary"), 256)).drop("kept_text")
