"""Quality classification by a generalised additive model with pairwise interactions.

Cyclic boosting grows shallow trees on one feature at a time (depth two, over the feature's bins), a small step for each in turn,
so each feature gets a table from bin to log-odds. Then the pairs of main features whose joint tables gain the most are
boosted in the same way (one cut in each feature). A text's score is the logistic of the sum of its bins' entries: table look-ups and
additions over whole blocks.

Features come from the whole text: shares of kinds of bytes, word and line lengths, repeats of words, word pairs and lines. Learning
reads the texts of at most `most_rows` labelled rows, chosen by a hash of the id; every text is scored.

Defined cases: null and empty texts have features of 0 and a score like any other; rows without a label aren't learned from; with no labelled
row at all, or labels of one kind, the score is the smoothed share of label 1; repeated labels or texts count as often; other columns
are left alone.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import mapped
from .words import ngram_hashes, slices, text_buffer, valid_starts, words

KINDS = np.zeros(256, dtype=np.int64)  # 0: other bytes
KINDS[[*range(97, 123)]] = 1
KINDS[[*range(65, 91)]] = 2
KINDS[[*range(48, 58)]] = 3
KINDS[[9, 11, 12, 13, 32]] = 4
KINDS[10] = 5
KINDS[list(b".,;:?")] = 6
KINDS[list(b"!")] = 7
KINDS[[*range(128, 256)]] = 8
KINDS[list(b"#$%&*@^~+=\\/_|<>{}[]()")] = 9
NAMES = ["log_bytes", "lower", "upper", "digit", "stop", "bang", "high", "symbol", "log_words", "word_len", "word_len_sd", "long_words", "symbol_words", "distinct_words", "distinct_pairs", "top_word", "log_lines", "distinct_lines", "line_words", "words_a_stop"]
LINE_END = np.zeros(256, dtype=bool)
LINE_END[list(b"\n\r")] = True


def _distinct(h: np.ndarray, doc: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values a text, and how often its commonest stands."""
    if not len(h):
        return np.zeros(n), np.zeros(n)
    order = np.lexsort((h, doc))
    h, doc = h[order], doc[order]
    first = np.flatnonzero(np.concatenate([[True], (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])]))
    runs = np.diff(np.concatenate([first, [len(h)]]))
    top = np.zeros(n)
    np.maximum.at(top, doc[first], runs)
    return np.bincount(doc[first], minlength=n).astype(float), top


def features(column: pa.Array) -> np.ndarray:
    """Texts x features."""
    buf, offs = text_buffer(column)
    n = len(offs) - 1
    size = np.diff(offs)
    doc = np.repeat(np.arange(n), size)
    kinds = np.bincount(doc * 10 + KINDS[buf], minlength=10 * n).reshape(n, 10).astype(float)
    del doc
    _, starts, ends, h, counts = words(column)
    own = np.repeat(np.arange(n), counts)
    length = (ends - starts).astype(float)
    total = np.maximum(counts, 1)
    add = lambda x: np.bincount(own, weights=x, minlength=n)
    mean = add(length) / total
    sd = np.sqrt(np.maximum(add(length**2) / total - mean**2, 0))
    tail = KINDS[buf[ends - 1]] if len(ends) else np.zeros(0, dtype=np.int64)
    distinct, top = _distinct(h, own, n)
    pair_at = np.flatnonzero(valid_starts(counts, 2))
    pairs, _ = _distinct(ngram_hashes(h, 2)[pair_at], own[pair_at], n)
    _, _, _, lh, lines = words(column, between=LINE_END) if len(buf) else (0, 0, 0, np.zeros(0, np.uint64), np.zeros(n, np.int64))
    distinct_lines, _ = _distinct(lh, np.repeat(np.arange(n), lines), n)
    b = np.maximum(size, 1)
    out = [np.log1p(size), kinds[:, 1] / b, kinds[:, 2] / b, kinds[:, 3] / b, kinds[:, 6] / b, kinds[:, 7] / b, kinds[:, 8] / b, kinds[:, 9] / b, np.log1p(counts), mean, sd, add(length > 14) / total, add(((tail == 9) | (tail == 7)).astype(float)) / total, distinct / total, pairs / np.maximum(counts - 1, 1), top / total, np.log1p(lines), distinct_lines / np.maximum(lines, 1), counts / np.maximum(lines, 1), counts / (1 + kinds[:, 6])]
    return np.stack(out, axis=1)


@dataclass
class Model:
    base: float
    edges: list[np.ndarray] = field(default_factory=list)
    tables: list[np.ndarray] = field(default_factory=list)
    pairs: list[tuple[int, int, np.ndarray]] = field(default_factory=list)


def _tree(grad: np.ndarray, hess: np.ndarray, depth: int, ridge: float) -> np.ndarray:
    """Values by bin of a tree of the given depth that cuts the bins' order."""
    out = np.full(len(grad), grad.sum() / (hess.sum() + ridge))
    if depth == 0 or len(grad) < 2:
        return out
    g, h = np.cumsum(grad)[:-1], np.cumsum(hess)[:-1]
    gain = g**2 / (h + ridge) + (grad.sum() - g) ** 2 / (hess.sum() - h + ridge)
    cut = int(gain.argmax()) + 1
    if gain[cut - 1] <= grad.sum() ** 2 / (hess.sum() + ridge) + 1e-12:
        return out
    return np.concatenate([_tree(grad[:cut], hess[:cut], depth - 1, ridge), _tree(grad[cut:], hess[cut:], depth - 1, ridge)])


def _corners(grad: np.ndarray, hess: np.ndarray, ridge: float) -> tuple[float, np.ndarray]:
    """The best cut of both features of a table of bins: its gain and the four corners' values."""
    g, h = grad.cumsum(0).cumsum(1), hess.cumsum(0).cumsum(1)
    a, b = g[:-1, :-1], h[:-1, :-1]
    parts = [(a, b), (g[:-1, -1:] - a, h[:-1, -1:] - b), (g[-1:, :-1] - a, h[-1:, :-1] - b), (g[-1, -1] - g[:-1, -1:] - g[-1:, :-1] + a, h[-1, -1] - h[:-1, -1:] - h[-1:, :-1] + b)]
    gain = sum(x**2 / (y + ridge) for x, y in parts)
    i, j = np.unravel_index(int(gain.argmax()), gain.shape)
    out = np.empty_like(grad)
    for (x, y), rows, cols in zip(parts, (slice(0, i + 1), slice(0, i + 1), slice(i + 1, None), slice(i + 1, None)), (slice(0, j + 1), slice(j + 1, None)) * 2, strict=True):
        out[rows, cols] = x[i, j] / (y[i, j] + ridge)
    return float(gain[i, j]), out


def fit(x: np.ndarray, y: np.ndarray, bins: int = 32, rounds: int = 150, step: float = 0.1, most_pairs: int = 6, pair_rounds: int = 40, ridge: float = 1.0) -> Model:
    share = (y.sum() + 1) / (len(y) + 2)
    model = Model(float(np.log(share / (1 - share))))
    if len(np.unique(y)) < 2:
        return model
    model.edges = [np.unique(np.quantile(c, np.linspace(0, 1, bins + 1)[1:-1])) for c in x.T]
    where = [np.searchsorted(e, c, "right") for e, c in zip(model.edges, x.T, strict=True)]
    model.tables = [np.zeros(len(e) + 1) for e in model.edges]
    f = np.full(len(y), model.base)

    def slopes() -> tuple[np.ndarray, np.ndarray]:
        p = 1 / (1 + np.exp(-f))
        return y - p, np.maximum(p * (1 - p), 1e-6)

    for _ in range(rounds):
        for k, (bin_, table) in enumerate(zip(where, model.tables, strict=True)):
            g, h = slopes()
            tree = step * _tree(np.bincount(bin_, g, len(table)), np.bincount(bin_, h, len(table)), 2, ridge)
            model.tables[k] = table + tree
            f += tree[bin_]
    g, h = slopes()
    ranked = []
    for i in range(len(where)):
        for j in range(i):
            a, b = len(model.tables[i]), len(model.tables[j])
            if a > 1 and b > 1:
                flat = where[i] * b + where[j]
                ranked.append((_corners(np.bincount(flat, g, a * b).reshape(a, b), np.bincount(flat, h, a * b).reshape(a, b), ridge)[0], i, j))
    chosen = [(i, j) for _, i, j in sorted(ranked, reverse=True)[:most_pairs]]
    joint = [np.zeros((len(model.tables[i]), len(model.tables[j]))) for i, j in chosen]
    for _ in range(pair_rounds):
        for k, (i, j) in enumerate(chosen):
            g, h = slopes()
            a, b = joint[k].shape
            flat = where[i] * b + where[j]
            tree = step * _corners(np.bincount(flat, g, a * b).reshape(a, b), np.bincount(flat, h, a * b).reshape(a, b), ridge)[1]
            joint[k] += tree
            f += tree[where[i], where[j]]
    model.pairs = [(i, j, t) for (i, j), t in zip(chosen, joint, strict=True)]
    return model


def scores(x: np.ndarray, model: Model) -> np.ndarray:
    f = np.full(len(x), model.base)
    where = [np.searchsorted(e, c, "right") for e, c in zip(model.edges, x.T, strict=False)]
    for bin_, table in zip(where, model.tables, strict=True):
        f += table[bin_]
    for i, j, table in model.pairs:
        f += table[where[i], where[j]]
    return 1 / (1 + np.exp(-f))


def sample(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str, most_rows: int) -> tuple[np.ndarray, np.ndarray]:
    """Features and labels of at most most_rows labelled rows."""
    rows = labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull()).select(F.col(id_col).alias("_id"), F.col(label_col).cast("double").alias("_y"))
    chosen = rows.orderBy(F.xxhash64("_id", F.lit(11)), "_id", "_y").limit(most_rows)
    few = docs.sparkSession.createDataFrame(chosen.collect(), rows.schema)  # at most most_rows rows of two numbers
    picked = docs.select(F.col(id_col), F.col(text_col).cast("string").alias("text")).join(F.broadcast(few), F.col(id_col) == F.col("_id")).select("_id", "_y", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                x = features(part.column("text"))
                yield pa.RecordBatch.from_arrays([part.column("_id"), part.column("_y"), pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1, dtype=np.int32) * x.shape[1]), pa.array(x.reshape(-1)))], names=["_id", "_y", "x"])

    schema = T.StructType([rows.schema["_id"], T.StructField("_y", T.DoubleType()), T.StructField("x", T.ArrayType(T.DoubleType()))])
    out = mapped(picked, run, schema).orderBy(F.xxhash64("_id", F.lit(11)), "_id", "_y", "x").limit(most_rows).collect()
    return np.array([r[2] for r in out], dtype=float).reshape(len(out), len(NAMES)), np.array([r[1] for r in out], dtype=float)


def learn_and_score(docs: DataFrame, labels: DataFrame, learn: Column | None = None, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", most_rows: int = 20_000, **how) -> DataFrame:
    """(id, score, predicted) of each text; learn: which rows of labels may be learned from."""
    model = fit(*sample(docs, labels if learn is None else labels.where(learn), id_col, text_col, label_col, most_rows), **how)
    shared = docs.sparkSession.sparkContext.broadcast(model)  # bounded by the numbers of features and bins

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                s = scores(features(part.column("text")), shared.value)
                yield pa.RecordBatch.from_arrays([part.column("id"), pa.array(s), pa.array((s >= 0.5).astype(np.int32))], names=["id", "score", "predicted"])

    schema = T.StructType([T.StructField("id", docs.schema[id_col].dataType), T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())])
    return mapped(docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")), run, schema)
