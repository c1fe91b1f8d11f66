"""Language identification by string kernels.

The kernel is the blended spectrum of presence: two texts share 1 for each byte n-gram (n of 1 to 3, ASCII letters folded)
that both have, divided by the roots of their own counts. Nystrom landmarks drawn from the labelled sample span the feature
space; one-versus-rest kernel ridge regression is solved in it. As the kernel is a product of presence vectors, landmark
vectors and ridge weights fold into one matrix (n-grams x languages), and a block of texts is scored by one matrix product
of its presence matrix with it.

Learning reads a sample with a bound for each language in rows (`per_lang`) and in bytes (`most_bytes` for each of them); scoring reads
every whole text. The model has every n-gram of the landmarks, whose number and bytes are bounded, and of at most `most_langs` languages (more
are an error), so it is broadcast; n-grams that no landmark has count in no kernel with a landmark, but for the root of a text's own count, which
is taken over the landmarks' n-grams.

Defined cases: a null text, an empty one and one without a letter get `und` with score 0; with no labelled row at all every
text gets `und`; a letter is what Unicode calls one (not ½ or ²); of languages with equal scores the first by name is taken; rows with a null language aren't learned from; repeated rows get the same prediction; all other columns of
the input are left alone. A table with a single language predicts it with score 1.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import mapped
from .words import slices, text_buffer

UNKNOWN = "und"
BLOCK = 1 << 24  # entries of a presence matrix that is held at once


@dataclass
class Model:
    langs: list[str]
    byte_class: np.ndarray  # 256 -> class; class 0 is every byte that the landmarks lack
    tables: list[np.ndarray]  # for n = 1, 2, 3: code -> column, 0 where the landmarks lack it
    weights: np.ndarray  # columns x languages, row 0 unused
    bias: np.ndarray


def _classes(texts: list[bytes]) -> np.ndarray:
    fold = np.arange(256)
    fold[65:91] += 32
    counts = np.zeros(256, dtype=np.int64)
    for t in texts:
        counts += np.bincount(fold[np.frombuffer(t, dtype=np.uint8)], minlength=256)
    best = np.flatnonzero(counts)
    out = np.zeros(256, dtype=np.int32)
    out[best] = np.arange(1, len(best) + 1)
    return out[fold]


def _codes_of(byte_class: np.ndarray) -> int:
    return int(byte_class.max()) + 1


def _codes(cls: np.ndarray, fresh: np.ndarray, n: int, classes: int) -> tuple[np.ndarray, np.ndarray]:
    """Code of each n-gram that stays in a text, and the position of its last byte. fresh: where texts start."""
    if len(cls) < n:
        return np.zeros(0, dtype=np.int32), np.zeros(0, dtype=np.int64)
    code = cls[n - 1 :].copy()
    for k in range(1, n):
        code += cls[n - 1 - k : len(cls) - k] * np.int32(classes**k)
    ok = np.ones(len(code), dtype=bool)
    for k in range(1, n):
        ok &= ~fresh[k : k + len(code)]
    for k in range(n):
        ok &= cls[n - 1 - k : len(cls) - k] > 0
    at = np.flatnonzero(ok)
    return code[at], at + n - 1


def presence(buf: np.ndarray, offs: np.ndarray, byte_class: np.ndarray, tables: list[np.ndarray], width: int) -> np.ndarray:
    """Texts x columns, 1 where the text has the n-gram. Long texts are read in pieces that overlap."""
    flags = np.zeros((len(offs) - 1, width), dtype=np.float32)
    step, classes = 1 << 20, _codes_of(byte_class)
    flat = flags.reshape(-1)
    for a in range(0, len(buf), step):
        lo = max(0, a - 2)
        part = byte_class[buf[lo : a + step]]
        k = slice(int(np.searchsorted(offs, lo, "right")) - 1, int(np.searchsorted(offs, lo + len(part), "left")))
        fresh = np.zeros(len(part), dtype=bool)
        begins = offs[:-1][k]
        begins = begins[(begins >= lo) & (begins < lo + len(part))]
        fresh[begins - lo] = True
        edges = np.clip(offs[k.start : k.stop + 1] - lo, 0, len(part))
        doc = np.repeat(np.arange(k.start, k.start + len(edges) - 1), np.diff(edges))
        for n, table in enumerate(tables, 1):
            code, at = _codes(part, fresh, n, classes)
            col = table[code]
            flat[doc[at] * width + col] = 1
    flags[:, 0] = 0
    return flags


def _pack(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    return np.frombuffer(b"".join(texts), dtype=np.uint8), np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64)


def fit(texts: list[bytes], langs: list[str], landmarks: int = 256, ridge: float = 0.1, seed: int = 7) -> Model | None:
    """Learns from a bounded sample of labelled texts."""
    rows = [(t, g) for t, g in zip(texts, langs, strict=True) if t and g is not None]
    if not rows:
        return None
    texts, names = [t for t, _ in rows], sorted({g for _, g in rows})
    rng = np.random.default_rng(seed)
    by = [[i for i, (_, g) in enumerate(rows) if g == name] for name in names]
    per = max(1, landmarks // len(names))
    marks = sorted(int(i) for own in by for i in rng.permutation(own)[:per])
    byte_class = _classes([texts[i] for i in marks])
    # columns: the n-grams of the landmarks
    buf, offs = _pack([texts[i] for i in marks])
    classes, tables, width = _codes_of(byte_class), [], 1
    for n in (1, 2, 3):
        have = np.zeros(classes**n, dtype=bool)
        for a, b in zip(offs[:-1], offs[1:], strict=True):
            part = byte_class[buf[a:b]]
            have[_codes(part, np.zeros(len(part), dtype=bool), n, classes)[0]] = True
        table = np.zeros(classes**n, dtype=np.int32)
        own = np.flatnonzero(have)
        table[own] = np.arange(width, width + len(own))
        tables.append(table)
        width += len(own)

    def normed(some: list[bytes]) -> np.ndarray:
        x = presence(*_pack(some), byte_class, tables, width)
        x /= np.sqrt(np.maximum(x.sum(1, keepdims=True), 1))
        return x

    mark = normed([texts[i] for i in marks])
    rows_at_once = max(1, BLOCK // width)
    k_mm = (mark @ mark.T).astype(np.float64)
    val, vec = np.linalg.eigh(k_mm + 1e-6 * np.eye(len(marks)))
    root = vec / np.sqrt(np.maximum(val, 1e-8))  # Nystrom features: k(x, marks) @ root
    kernel = [normed(texts[a : a + rows_at_once]) @ mark.T for a in range(0, len(texts), rows_at_once)]
    z = np.concatenate(kernel).astype(np.float64) @ root
    y = np.where(np.array([g for _, g in rows])[:, None] == np.array(names)[None, :], 1.0, -1.0)
    # each language weighs the same
    w = 1.0 / np.array([len(own) for own in by])[np.searchsorted(names, [g for _, g in rows])]
    w *= len(rows) / w.sum()
    zb = np.hstack([z, np.ones((len(z), 1))])
    penalty = ridge * np.eye(zb.shape[1])
    penalty[-1, -1] = 1e-9
    beta = np.linalg.solve(zb.T @ (zb * w[:, None]) + penalty, zb.T @ (y * w[:, None]))
    weights = mark.T.astype(np.float64) @ (root @ beta[:-1])
    return Model(names, byte_class, tables, weights.astype(np.float32), beta[-1])


def score_block(buf: np.ndarray, offs: np.ndarray, model: Model) -> tuple[list[str], np.ndarray]:
    """Language and score of each text of a block."""
    x = presence(buf, offs, model.byte_class, model.tables, len(model.weights))
    norm = np.sqrt(np.maximum(x.sum(1, keepdims=True), 1))
    f = (x @ model.weights) / norm + model.bias
    p = np.exp(4 * (f - f.max(1, keepdims=True)))
    p /= p.sum(1, keepdims=True)
    best = p.argmax(1)
    score = p[np.arange(len(p)), best].astype(np.float64)
    ascii_letter = np.zeros(256, dtype=bool)
    ascii_letter[[*range(65, 91), *range(97, 123)]] = True
    seen = np.concatenate([[0], np.cumsum(ascii_letter[buf])])
    has = seen[offs[1:]] > seen[offs[:-1]]
    for i in np.flatnonzero(~has):
        has[i] = any(map(str.isalpha, buf[offs[i] : offs[i + 1]].tobytes().decode("utf-8", "replace")))
    return [model.langs[b] if ok else UNKNOWN for b, ok in zip(best, has, strict=True)], np.where(has, score, 0.0)


def sample(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", id_col: str = "doc_id", per_lang: int = 400, most_rows: int = 3000, most_langs: int = 200, most_bytes: int = 1 << 15) -> tuple[list[bytes], list[str]]:
    """A bounded sample of labelled texts: about per_lang, together about most_rows, of each language, chosen by a hash of the id whatever their
    length; fewer where they are longer than most_bytes on average, but one at least. More than most_langs languages are an error."""
    rows = docs.where(F.col(lang_col).isNotNull() & (F.octet_length(text_col) > 0))
    slots = 1 << 40
    chance = F.pmod(F.xxhash64(F.col(id_col), F.lit(17)), F.lit(slots))
    counts = rows.groupBy(lang_col).agg(F.count(F.lit(1)), F.sum(F.octet_length(text_col).cast("long")), F.min(chance)).limit(most_langs + 1).collect()
    if not counts:
        return [], []
    if len(counts) > most_langs:
        raise ValueError(f"more than {most_langs} languages; set most_langs")
    per_lang = max(8, min(per_lang, most_rows // len(counts)))
    room = per_lang * most_bytes
    rate = F.create_map(*[F.lit(x) for g, n, size, least in counts for x in (g, max(int(min(1.0, per_lang / n, room / size) * slots), least + 1))])
    picked = rows.where(chance < F.coalesce(F.try_element_at(rate, F.col(lang_col)), F.lit(0)))
    picked = picked.select(F.col(text_col).alias("t"), F.col(lang_col).alias("g"), chance.alias("c"), F.xxhash64(text_col).alias("h"), F.octet_length(text_col).cast("long").alias("size"))
    so_far = F.sum("size").over(Window.partitionBy("g").orderBy("c", "h").rowsBetween(Window.unboundedPreceding, 0))
    out = picked.withColumn("so_far", so_far).where((F.col("so_far") <= room) | (F.col("so_far") == F.col("size"))).orderBy("c", "h").limit(2 * per_lang * len(counts)).collect()
    return [r[0].encode() for r in out], [r[1] for r in out]


def predict(docs: DataFrame, model: Model | None, text_col: str = "text", block_rows: int = 128) -> DataFrame:
    """docs with lang_pred and score; no other column changes."""
    schema = docs.drop("lang_pred", "score").schema.add("lang_pred", "string").add("score", "double")
    docs = docs.drop("lang_pred", "score")
    if model is None:
        return docs.withColumns({"lang_pred": F.lit(UNKNOWN), "score": F.lit(0.0)})
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for batch in batches:
            for part in slices(batch, text_col, most_rows=max(1, min(block_rows, BLOCK // len(m.weights)))):
                langs, score = score_block(*text_buffer(part.column(text_col)), m)
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(langs, pa.string()), pa.array(score, pa.float64())], names=[*part.schema.names, "lang_pred", "score"])

    return mapped(docs, run, schema)


def identify(docs: DataFrame, learn: Column | None = None, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", keep: list[str] | None = None, **fitting) -> DataFrame:
    """Learns from the rows of docs where `learn` holds, and predicts every row. keep: the columns to carry along (default: the id)."""
    rows = docs.where(learn) if learn is not None else docs
    model = fit(*sample(rows, text_col, lang_col, id_col), **fitting)
    carried = [id_col] if keep is None else keep
    out = predict(docs.select(*dict.fromkeys([*carried, text_col])), model, text_col)
    return out if text_col in carried else out.drop(text_col)


def accepted(docs: DataFrame, learn: Column | None = None, text_col: str = "text", **names) -> DataFrame:
    """docs without those in no language (`und`); the columns stay as they are, also such as are named like ours."""
    clash = {c: f"_in_{c}" for c in ("lang_pred", "score") if c in docs.columns}
    renamed = docs.withColumnsRenamed(clash)
    out = identify(renamed, learn, text_col=text_col, keep=renamed.columns, **names)
    return out.where(F.col("lang_pred") != UNKNOWN).drop("lang_pred", "score").withColumnsRenamed({v: k for k, v in clash.items()}).select(docs.columns)
