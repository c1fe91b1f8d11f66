"""Words and their hashes, found over whole Arrow buffers at once.

A word is ``[^\\x20\\x09-\\x0D]+`` over UTF-8 bytes, as ``bytes.split()`` has it. Its hash is a polynomial in an odd base
modulo 2**64 over random byte values, mixed with its length; a prefix sum gives it for every word of a block without a loop.
Work is done in blocks of about a megabyte, cut between words, so memory doesn't follow the batch or the longest text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

BLOCK = 1 << 20
U = np.uint64
MASK = (1 << 64) - 1
BASE = 0x9E3779B97F4A7C15 | 1


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64 bits that spreads every bit."""
    x = np.asarray(x, dtype=U)
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


IS_SPACE = np.zeros(256, dtype=bool)
IS_SPACE[[0x20, *range(0x09, 0x0E)]] = True
NOT_ALNUM = np.ones(256, dtype=bool)  # ASCII but letters and digits
NOT_ALNUM[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = False
PLAIN = mix((np.arange(256, dtype=U) + U(1)) * U(0x9E3779B97F4A7C15))
FOLDED = PLAIN.copy()
FOLDED[65:91] = PLAIN[97:123]

_powers: list[np.ndarray] = []


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse, n of each at least."""
    if not _powers or len(_powers[0]) < n:
        size = max(n, BLOCK + 4096)
        for base in (BASE, pow(BASE, -1, 1 << 64)):
            out = np.ones(1, dtype=U)
            step = base
            while len(out) < size:
                out = np.concatenate([out, out * U(step)])
                step = step * step & MASK
            _powers.append(out)
        del _powers[:-2]
    return _powers[0], _powers[1]


def text_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string or binary column, and len + 1 offsets into them. Null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("" if pa.types.is_string(column.type) or pa.types.is_large_string(column.type) else b"")
    column = column.cast(pa.large_binary())
    if not len(column):
        return np.zeros(0, dtype=np.uint8), np.zeros(1, dtype=np.int64)
    _, offsets, data = column.buffers()
    offs = np.frombuffer(offsets, dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    buf = np.frombuffer(data, dtype=np.uint8)[offs[0] : offs[-1]] if data is not None and data.size else np.zeros(0, dtype=np.uint8)
    return buf, offs - offs[0]


def _cuts(buf: np.ndarray, offs: np.ndarray) -> Iterator[tuple[int, int]]:
    """Ranges of about BLOCK bytes that cut no word: they end at a text's end or at white space."""
    at, n = 0, len(buf)
    while at < n:
        end = min(n, at + BLOCK)
        if end < n:
            k = int(np.searchsorted(offs, end, "right")) - 1
            if offs[k] > at:
                end = int(offs[k])
            else:
                back = np.flatnonzero(IS_SPACE[buf[at:end]])
                if len(back):
                    end = at + int(back[-1]) + 1
                else:  # one long word
                    last = int(offs[k + 1])
                    while end < last and not IS_SPACE[buf[end]]:
                        step = np.flatnonzero(IS_SPACE[buf[end : min(last, end + BLOCK)]])
                        end = end + int(step[0]) if len(step) else min(last, end + BLOCK)
        yield at, end
        at = end


def _hashes(part: np.ndarray, starts: np.ndarray, ends: np.ndarray, values: np.ndarray) -> np.ndarray:
    power, inverse = _power(len(part) + 1)
    sums = values[part]
    sums *= power[: len(part)]
    np.cumsum(sums, out=sums)
    h = sums[ends - 1]
    before = starts > 0
    h[before] -= sums[starts[before] - 1]
    h *= inverse[starts]
    return mix(h + (ends - starts).astype(U) * U(0xD1B54A32D192ED03))


def words(column: pa.Array, lower: bool = True, extra_cuts: bytes = b"", between: np.ndarray = IS_SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(buffer, starts, ends, hashes, counts per text) of all words of a column of texts, in order.

    extra_cuts: a word also ends before one of these bytes where an ASCII letter or digit stands before it.
    between: the bytes that stand between words; white space is always among them.
    """
    buf, offs = text_buffer(column)
    values = FOLDED if lower else PLAIN
    cut_here = np.zeros(256, dtype=bool)
    cut_here[list(extra_cuts)] = True
    alnum = np.zeros(256, dtype=bool)
    alnum[[*range(48, 58), *range(65, 91), *range(97, 123)]] = True
    all_s, all_e, all_h = [], [], []
    for a, b in _cuts(buf, offs):
        part = buf[a:b]
        inside = ~between[part]
        fresh = np.empty(len(part), dtype=bool)
        fresh[0] = True
        np.logical_not(inside[:-1], out=fresh[1:])
        k = slice(np.searchsorted(offs, a, "left"), np.searchsorted(offs, b, "left"))
        fresh[offs[k] - a] = True
        if extra_cuts:
            fresh[1:] |= alnum[part[:-1]] & cut_here[part[1:]]
        starts = np.flatnonzero(fresh & inside)
        last = np.empty(len(part), dtype=bool)
        last[-1] = True
        last[:-1] = fresh[1:] | ~inside[1:]
        ends = np.flatnonzero(last & inside) + 1
        if len(starts):
            all_h.append(_hashes(part, starts, ends, values))
            all_s.append(starts + a)
            all_e.append(ends + a)
    if not all_s:
        none = np.zeros(0, dtype=np.int64)
        return buf, none, none, np.zeros(0, dtype=U), np.zeros(len(offs) - 1, dtype=np.int64)
    starts, ends, hashes = np.concatenate(all_s), np.concatenate(all_e), np.concatenate(all_h)
    counts = np.diff(np.searchsorted(starts, offs, "left"))
    return buf, starts, ends, hashes, counts


def ngram_hashes(h: np.ndarray, n: int) -> np.ndarray:
    """A hash of each run of n entries; len(h) - n + 1 of them."""
    m = len(h) - n + 1
    if m <= 0:
        return np.zeros(0, dtype=U)
    out = h[:m].copy()
    for k in range(1, n):
        out *= U(0x9FB21C651E98DF25)
        out += mix(h[k : k + m] + U(k))
    return mix(out)


def valid_starts(counts: np.ndarray, n: int) -> np.ndarray:
    """Whether a run of n words that starts at each word stays in its text; cut to the runs that exist at all."""
    total = int(counts.sum())
    ends = np.repeat(np.cumsum(counts), counts)
    return (np.arange(total) + n <= ends)[: max(0, total - n + 1)]


def slices(batch: pa.RecordBatch, column: str, most_bytes: int = 4 << 20, most_rows: int = 4096) -> Iterator[pa.RecordBatch]:
    """The rows of a batch in runs with about most_bytes of text (one row at least)."""
    _, offs = text_buffer(batch.column(column))
    at, n = 0, batch.num_rows
    while at < n:
        end = int(np.searchsorted(offs, offs[at] + most_bytes, "right")) - 1
        end = min(n, max(at + 1, end), at + most_rows)
        yield batch.slice(at, end - at)
        at = end
