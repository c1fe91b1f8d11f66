"""Near-duplicate detection with bottom-k sketches from one hash function.

1. Every text becomes a set of word shingles, each a 64-bit hash. Texts with the same set form a class, held by its least id.
2. A class's sketch is the k smallest hashes of its set. The union sketch of two similar classes (the k smallest values of both) has a number of
   common values at least (`least_shared`); so in any one order of all values, the same for all classes, the first of each class, as many
   that it retains fewer others than that number, hold a common one. Inverted lists of these prefixes, rarest values first, generate the overlaps:
   what many texts share comes last and is in no list.
3. Lists of up to `long_list` classes are paired out; longer ones are first split by size. Where they stay long, as for groups of very many
   near copies, each class is held against a leader of its longest list, the one whose whole set has the fewest values of its own.
4. The union sketch filters pairs by the same number; the full sets decide. Components of confirmed links.
5. What long lists hold outside their largest component is then paired exactly, from the full sets: both sizes tell how many common values
   a link needs, so the rarest of each set, as many that one is common, are listed, and only those outside a largest component look for
   members of other components there. No list is cut and no pair dropped.

Defined cases: null or empty texts, and those without words, have empty sets and no links; with fewer words than a shingle, the
whole sequence is one; a row with a null id is linked with nothing and has no component; rows of one id count as one document;
very long texts have whole sets (a few bytes a word in memory) and a sketch of fixed size; of equal sets and of ties the least id counts; other
columns are never read, whatever their names; an empty table gives an empty result.

Misses: a pair at the threshold whose union is larger than the sketch shares fewer values than `least_shared` with a probability of 1e-6 at
most, and such a pair alone can be missed. Smaller unions and step 5 are exact.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import comb, log

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import drop_written, mapped, written
from .components import components
from .words import mix, ngram_hashes, slices, words

C1, C2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


def shingle_sets(column: pa.Array, width: int) -> list[np.ndarray]:
    """Of each text: its distinct shingles' hashes, ascending as signed numbers."""
    _, _, _, h, counts = words(column)
    grams = ngram_hashes(h, width)
    out, at = [], 0
    for n in counts.tolist():
        if n >= width:
            out.append(np.unique(grams[at : at + n - width + 1].view(np.int64)))
        elif n:
            out.append(mix(ngram_hashes(h[at : at + n], n) + np.uint64(n)).view(np.int64))
        else:
            out.append(np.zeros(0, dtype=np.int64))
        at += n
    return out


def _lists(arrays: list[np.ndarray]) -> pa.Array:
    offs = np.concatenate([[0], np.cumsum([len(a) for a in arrays])]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offs), pa.array(np.concatenate([*arrays, np.zeros(0, dtype=np.int64)])))


def sketches(docs: DataFrame, id_col: str, text_col: str, width: int, k: int) -> DataFrame:
    """(id, n, digest, sketch) of each row; digest is null where the set is empty."""
    id_type = docs.schema[id_col].dataType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                sets = shingle_sets(part.column("text"), width)
                digests = []
                for s in sets:
                    u = s.view(np.uint64)
                    digests.append(np.array([mix(u + C1).sum(dtype=np.uint64), np.bitwise_xor.reduce(mix(u ^ C2)) + np.uint64(len(u))], dtype=np.uint64).tobytes() if len(u) else None)
                yield pa.RecordBatch.from_arrays([part.column("id"), pa.array([len(s) for s in sets], pa.int64()), pa.array(digests, pa.binary()), _lists([s[:k] for s in sets])], names=["id", "n", "digest", "sketch"])

    from pyspark.sql import types as T

    schema = T.StructType([T.StructField("id", id_type), T.StructField("n", T.LongType()), T.StructField("digest", T.BinaryType()), T.StructField("sketch", T.ArrayType(T.LongType()))])
    return mapped(docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")), run, schema)


def least_shared(k: int, num: int, den: int, miss: float = 1e-6) -> int:
    """How many of a union's k least values two sets of the threshold's similarity share at least, but for a probability of `miss`."""
    below, t = 0.0, num / den
    for x in range(k + 1):
        below += comb(k, x) * t**x * (1 - t) ** (k - x)
        if below > miss:
            return x
    return k


def _fits(num: int, den: int):
    """Sizes that let two sets be similar enough."""
    return F.least("na", "nb") * den >= F.greatest("na", "nb") * num


def _step(num: int, den: int) -> float:
    """Width of a class of sizes on a logarithmic scale: the sizes of two similar sets are at most one class apart."""
    return log(den / num) * (1 + 1e-9)


def _within(lists: DataFrame, num: int, den: int) -> DataFrame:
    """All pairs in lists of bounded length: lists has key, rep, n."""
    a = lists.select("key", F.col("rep").alias("a"), F.col("n").alias("na"))
    b = lists.select("key", F.col("rep").alias("b"), F.col("n").alias("nb"))
    return a.join(b, "key").where((F.col("a") < F.col("b")) & _fits(num, den)).select("a", "b")


def _counted(rows: DataFrame, name: str) -> DataFrame:
    """rows with the length c of the list of their key; keys of a single row go."""
    counts = written(rows.groupBy("key").agg(F.count(F.lit(1)).alias("c")).where("c > 1"), name)
    return written(rows.join(counts, "key"), name)


def prefixes(reps: DataFrame, num: int, den: int, k: int) -> DataFrame:
    """(rep, n, key): the rarest retained values of each class, as many that two similar classes have one in common."""
    kept = reps.select("rep", "n", F.explode("sketch").alias("key"))
    counts = written(kept.groupBy("key").agg(F.count(F.lit(1)).alias("c")).where("c > 1"), "lexiflow-lists")
    shared = kept.join(counts, "key").groupBy("rep", "n").agg(F.collect_list(F.struct("c", "key")).alias("v"))
    need = F.least(F.ceil(F.col("n") * num / den), F.lit(least_shared(k, num, den)))
    # values that no other class has come first in the order; what they leave of the prefix is the rarest of the others
    first = F.slice(F.array_sort("v"), 1, F.greatest(F.size("v") - need + 1, F.lit(0)).cast("int"))
    out = written(shared.select("rep", "n", F.explode(first).alias("v")).select("rep", "n", "v.key"), "lexiflow-prefixes")
    drop_written(counts)
    return out


def candidates(reps: DataFrame, num: int, den: int, k: int, long_list: int) -> tuple[DataFrame, DataFrame]:
    """Pairs (a, b) of classes that share a list of at most long_list classes, and the longer lists (key, rep, n, c)."""
    lists = _counted(prefixes(reps, num, den, k), "lexiflow-lists")
    found = _within(lists.where(F.col("c") <= long_list), num, den)
    size = F.floor(F.log(F.col("n").cast("double")) / _step(num, den))
    long_ = lists.where(F.col("c") > long_list).select("rep", "n", F.explode(F.array(F.xxhash64("key", size), F.xxhash64("key", size + 1))).alias("key"))
    sized = _counted(long_, "lexiflow-sized")
    found = found.unionByName(_within(sized.where(F.col("c") <= long_list), num, den))
    return written(found.distinct(), "lexiflow-pairs"), sized.where(F.col("c") > long_list)


def ranked(hot: DataFrame, full: DataFrame) -> DataFrame:
    """(rep, v, c, m, at): of each member of long lists (key, rep, n, c) the values of its whole set that another member has, too; c is the number of
    members that have it, m how many such values rep has, and at where v stands among them, rarest first."""
    from pyspark.sql import types as T

    sets = full.join(hot.select(F.col("rep").alias("id")).distinct().hint("merge"), "id", "left_semi")

    def values(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "s"):
                sizes = np.array([len(s.as_buffer()) // 8 for s in part.column("s")], dtype=np.int64)
                flat = np.concatenate([np.frombuffer(s.as_buffer(), dtype=np.int64) for s in part.column("s")])
                yield pa.RecordBatch.from_arrays([part.column("id").take(pa.array(np.repeat(np.arange(len(sizes)), sizes))), pa.array(flat)], names=["rep", "v"])

    flat = written(mapped(sets, values, T.StructType([T.StructField("rep", full.schema["id"].dataType), T.StructField("v", T.LongType())])), "lexiflow-values")
    counts = written(flat.groupBy("v").agg(F.count(F.lit(1)).alias("c")).where("c > 1"), "lexiflow-counts")
    own = Window.partitionBy("rep")
    place = F.row_number().over(own.orderBy("c", "v")) - 1
    out = written(flat.join(counts, "v").select("rep", "v", "c", F.count(F.lit(1)).over(own).alias("m"), place.alias("at")), "lexiflow-ranked")
    for done in (flat, counts):
        drop_written(done)
    return out


def led(hot: DataFrame, ranks: DataFrame, num: int, den: int) -> DataFrame:
    """Pairs (a, b) of members of long lists with the leader of their longest list: the one that has the fewest values of its own, and then the
    commonest others. In a group of near copies that is their middle, with which most are linked."""
    central = ranks.groupBy("rep").agg((-F.count(F.lit(1))).alias("size"), (-F.sum("c")).alias("weight"))
    members = hot.join(central, "rep").select("key", "rep", "n", "c", (F.col("n") + F.col("size")).alias("alone"), "weight")
    longest = hot.groupBy("rep", "n").agg(F.max(F.struct("c", "key"))["key"].alias("key"))
    leader = written(members.groupBy("key").agg(F.min(F.struct("alone", "weight", "rep", "n")).alias("l")).select("key", F.col("l.rep").alias("other"), F.col("l.n").alias("nb")), "lexiflow-leaders")
    star = longest.withColumnRenamed("n", "na").join(leader, "key").where("rep != other").where(_fits(num, den))
    return written(star.select(F.least("rep", "other").alias("a"), F.greatest("rep", "other").alias("b")).distinct(), "lexiflow-star")


def estimated(pairs: DataFrame, reps: DataFrame, num: int, den: int, k: int) -> DataFrame:
    """Those of pairs (a, b) whose union sketch allows enough similarity."""
    sk = reps.select("rep", "sketch")
    both = pairs.join(sk.select(F.col("rep").alias("a"), F.col("sketch").alias("sa")), "a").join(sk.select(F.col("rep").alias("b"), F.col("sketch").alias("sb")), "b")
    union = F.slice(F.array_sort(F.array_union("sa", "sb")), 1, k)
    share = F.size(F.array_intersect(F.array_intersect(union, F.col("sa")), F.col("sb")))
    need = F.when(F.size(union) < k, F.ceil(F.size(union) * num / den)).otherwise(least_shared(k, num, den))
    return written(both.where(share >= need).select("a", "b").distinct(), "lexiflow-candidates")


def apart(hot: DataFrame, near: DataFrame) -> DataFrame:
    """(rep, n, comp, out) of the members of lists whose members aren't all connected, with the component of each; out: it is outside the largest
    component of one of its lists. Of two members of a list in different components, one is out at least."""
    side = near.select(F.col("node").alias("rep"), F.col("component").alias("comp"))
    placed = written(hot.select("key", "rep", "n").join(side, "rep", "left").withColumn("comp", F.coalesce("comp", "rep")), "lexiflow-placed")
    sizes = placed.groupBy("key", "comp").agg(F.count(F.lit(1)).alias("m"))
    open_ = sizes.groupBy("key").agg(F.max(F.struct("m", "comp"))["comp"].alias("main"), F.count(F.lit(1)).alias("comps")).where("comps > 1")
    open_ = written(open_.select("key", "main"), "lexiflow-open")
    out = written(placed.join(open_, "key").groupBy("rep", "n", "comp").agg(F.bool_or(F.col("comp") != F.col("main")).alias("out")), "lexiflow-members")
    drop_written(placed)
    return out


def across(members: DataFrame, ranks: DataFrame, num: int, den: int) -> DataFrame:
    """Pairs (a, b) between members (rep, n, comp, out) that aren't connected yet, one of them out: all that can be similar, from their whole sets. Of
    two sets of sizes x and y the threshold asks for num * (x + y) / (num + den) common values, so one is among the rarest of each, as many
    that fewer remain; where the first common value stands in both orders bounds what they can have in common."""
    # rest: the value and all that come after it in the order; no similar set is smaller than n * num / den
    listed = ranks.join(members, "rep").select("v", "rep", "n", "comp", "out", (F.col("m") - F.col("at")).alias("rest"))
    listed = written(listed.where(F.col("rest") * (num + den) >= (F.col("n") + F.ceil(F.col("n") * num / den)) * num), "lexiflow-exact")
    left = listed.where("out").select("v", F.col("rep").alias("r"), F.col("n").alias("na"), F.col("comp").alias("ca"), F.col("rest").alias("ra"))
    right = listed.select("v", "rep", F.col("n").alias("nb"), F.col("comp").alias("cb"), F.col("rest").alias("rb"))
    pairs = left.join(right, "v").where("ca != cb").where(F.least("ra", "rb") * (num + den) >= (F.col("na") + F.col("nb")) * num).where(_fits(num, den))
    out = written(pairs.select(F.least("r", "rep").alias("a"), F.greatest("r", "rep").alias("b")).distinct(), "lexiflow-across")
    drop_written(listed)
    return out


def full_sets(docs: DataFrame, ids: DataFrame, id_col: str, text_col: str, width: int) -> DataFrame:
    """(id, s): the whole sets of these ids. The texts are shuffled once, whatever the number of ids, so that the plan is the same at every size."""
    from pyspark.sql import types as T

    id_type = docs.schema[id_col].dataType
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")).join(ids.hint("merge"), "id", "left_semi")

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                yield pa.RecordBatch.from_arrays([part.column("id"), pa.array([s.tobytes() for s in shingle_sets(part.column("text"), width)], pa.binary())], names=["id", "s"])

    return written(mapped(texts, sets, T.StructType([T.StructField("id", id_type), T.StructField("s", T.BinaryType())])).where("length(s) > 0"), "lexiflow-sets")


def confirmed(full: DataFrame, pairs: DataFrame, num: int, den: int) -> DataFrame:
    """Those of pairs (a, b) whose full sets are similar enough."""

    def hold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ok = []
            for x, y in zip(batch.column("x"), batch.column("y"), strict=True):
                x, y = np.frombuffer(x.as_buffer(), dtype=np.int64), np.frombuffer(y.as_buffer(), dtype=np.int64)
                at = np.minimum(np.searchsorted(y, x), len(y) - 1)
                same = int((y[at] == x).sum())
                ok.append(same * den >= num * (len(x) + len(y) - same))
            yield batch.select(["a", "b"]).filter(pa.array(ok, pa.bool_()))

    held = pairs.join(full.select(F.col("id").alias("a"), F.col("s").alias("x")).hint("merge"), "a").join(full.select(F.col("id").alias("b"), F.col("s").alias("y")).hint("merge"), "b")
    return written(mapped(held.select("a", "b", "x", "y"), hold, pairs.schema).distinct(), "lexiflow-links")


def link_near(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 5, num: int = 80, den: int = 100, k: int = 48, long_list: int = 32) -> DataFrame:
    """(id, n, component, kept) for each row: texts are linked whose shingle sets have den * intersection >= num * union."""
    rows = written(sketches(docs, id_col, text_col, width, k), "lexiflow-sketches")
    named = rows.where("digest is not null and id is not null")
    classes = written(named.groupBy("digest").agg(F.min("id").alias("rep")), "lexiflow-classes")
    reps = written(named.join(classes, (named.digest == classes.digest) & (named.id == classes.rep), "left_semi").select(F.col("id").alias("rep"), "n", "sketch"), "lexiflow-reps")
    found, hot = candidates(reps, num, den, k, long_list)
    pairs = estimated(found, reps, num, den, k)
    ids = written(pairs.select(F.explode(F.array("a", "b")).alias("id")).unionByName(hot.select(F.col("rep").alias("id"))).distinct(), "lexiflow-ids")
    full = full_sets(docs, ids, id_col, text_col, width)
    ranks = ranked(hot, full)
    near = written(components(confirmed(full, pairs.unionByName(led(hot, ranks, num, den)).distinct(), num, den)), "lexiflow-near")

    def with_links(more: DataFrame) -> None:
        nonlocal near
        if more.isEmpty() or (new := confirmed(full, more, num, den)).isEmpty():
            return
        # links between components; these are far fewer than the nodes
        ends = near.select("node", "component")
        new = new.join(ends.withColumnsRenamed({"node": "a", "component": "ca"}), "a", "left").join(ends.withColumnsRenamed({"node": "b", "component": "cb"}), "b", "left")
        joined = written(components(new.select(F.coalesce("ca", "a").alias("a"), F.coalesce("cb", "b").alias("b"))), "lexiflow-joined")
        known = ends.unionByName(joined.join(ends.select("node"), "node", "left_anti").select("node", F.col("node").alias("component")))
        moved = joined.select(F.col("node").alias("component"), F.col("component").alias("to"))
        near = written(known.join(moved, "component", "left").select("node", F.coalesce("to", "component").alias("component")), "lexiflow-near")

    with_links(across(apart(hot, near), ranks, num, den))
    for done in (full, ranks):
        drop_written(done)
    place = written(classes.join(near, classes.rep == near.node, "left").select("digest", F.coalesce("component", "rep").alias("component")), "lexiflow-place")
    out = rows.select("id", "n", "digest").join(place, "digest", "left")
    component = F.when(F.col("id").isNotNull(), F.coalesce("component", "id"))
    return out.select("id", "n", component.alias("component"), F.coalesce(F.col("id") == component, F.lit(True)).alias("kept"))


def kept_rows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **how) -> DataFrame:
    """docs with one document of each group of near-duplicates: that with the least id. All columns stay."""
    gone = link_near(docs, id_col, text_col, **how).where("not kept").select(F.col("id").alias("_gone"))
    gone = written(gone.distinct(), "lexiflow-gone")
    return docs.join(gone.hint("merge"), docs[id_col] == gone["_gone"], "left_anti")  # one plan at every size
