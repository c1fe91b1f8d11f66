"""Plain Python versions of the operators, for small tables."""

from __future__ import annotations

import hashlib
import zlib
from collections import Counter, defaultdict
from itertools import combinations
from math import log10

LOW = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))


def lowered(text: str | None) -> list[bytes]:
    return (text or "").encode().translate(LOW).split()


def fold(doc_id, modulus: int) -> int:
    return zlib.crc32(str(doc_id).encode() if doc_id is not None else b"") % modulus


def shingles(text: str | None, width: int) -> frozenset:
    w = lowered(text)
    if len(w) >= width:
        return frozenset(tuple(w[k : k + width]) for k in range(len(w) - width + 1))
    return frozenset([tuple(w)]) if w else frozenset()


def near(docs: dict, width: int, num: int, den: int) -> dict:
    """id -> (size, least id reachable)."""
    sets = {i: shingles(t, width) for i, t in docs.items()}
    up = {i: i for i in docs}

    def top(x):
        while up[x] != x:
            x = up[x]
        return x

    lists, both = defaultdict(list), Counter()
    for i, s in sets.items():
        for g in s:
            lists[g].append(i)
    for own in lists.values():
        both.update(combinations(sorted(own), 2))
    for (a, b), n in both.items():
        if den * n >= num * (len(sets[a]) + len(sets[b]) - n):
            x, y = top(a), top(b)
            up[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), top(i)) for i in docs}


def repeats(docs: dict, window: int = 20) -> dict:
    """id -> (words, removed, digest of the kept words)."""
    seen, gone = set(), {}
    for i in sorted(docs):
        w = (docs[i] or "").encode().split()
        out = set()
        for k in range(len(w) - window + 1):
            key = tuple(w[k : k + window])
            if key in seen:
                out.update(range(k, k + window))
            seen.add(key)
        gone[i] = (len(w), len(out), hashlib.sha256(b" ".join(x for k, x in enumerate(w) if k not in out)).hexdigest())
    return gone


def base_scores(docs: dict, learn) -> dict:
    """id -> (tokens, known, all training tokens, base score)."""
    count = Counter()
    for i, t in docs.items():
        if learn(i):
            count.update([*lowered(t), None])
    n, v = sum(count.values()), len(count)
    out = {}
    for i, t in docs.items():
        own = [*lowered(t), None]
        out[i] = (len(own), sum(count[x] > 0 for x in own), n, sum(log10((count[x] + 0.1) / (n + 0.1 * (v + 1))) for x in own))
    return out


def kneser_ney(docs: dict, learn, order: int) -> dict:
    """id -> score, from n-grams kept as tuples."""
    end, begin = ("end",), ("begin",)
    raw: Counter = Counter()

    def grams(t):
        w = [begin] * (order - 1) + [*lowered(t), end]
        return [tuple(w[k : k + order]) for k in range(len(w) - order + 1)]

    for i, t in docs.items():
        if learn(i):
            raw.update(grams(t))
    levels = {order: raw}
    for k in range(order - 1, 0, -1):
        levels[k] = Counter(g[1:] for g in levels[k + 1])
    disc, ctx = {}, {}
    for k, c in levels.items():
        n1, n2, n3, n4 = (sum(x == i for x in c.values()) for i in (1, 2, 3, 4))
        y = n1 / (n1 + 2 * n2) if n1 else 0.5
        d = [0.0, 1 - 2 * y * n2 / n1 if n1 else 0.5, 2 - 3 * y * n3 / n2 if n2 else 1.0, 3 - 4 * y * n4 / n3 if n3 else 1.5]
        disc[k] = [min(max(x, 0.0), j) if j < 2 else min(max(x, 0.1), j - 0.1) for j, x in enumerate(d)]
        for g, x in c.items():
            s = ctx.setdefault((k, g[:-1]), [0, 0, 0, 0])
            s[0] += x
            s[min(x, 3)] += 1
    v = len(levels[1])

    def p(g):
        k = len(g)
        if k == 0:
            return 1 / (v + 1)
        s = ctx.get((k, g[:-1]))
        if not s:
            return p(g[1:])
        c, d = levels[k][g], disc[k]
        return (c - d[min(c, 3)]) / s[0] + sum(a * b for a, b in zip(d[1:], s[1:], strict=True)) / s[0] * p(g[1:])

    return {i: sum(log10(p(g)) for g in grams(t)) for i, t in docs.items()}
