"""Vectorised word scanning over Arrow string columns (numpy, no per-word Python).

Words are maximal runs of bytes that a 256-entry table marks as word bytes.
All separators used here are ASCII, so scanning UTF-8 bytes equals scanning
characters.  A word's 64-bit hash is a polynomial hash over its bytes, read off
one prefix sum per chunk, then mixed.  Rows are scanned in chunks of about one
megabyte; a longer text is cut at separators, so memory stays bounded unless a
single word is that long.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

CHUNK = 1 << 20
_P = 0x9E3779B97F4A7C15 | 1
_M64 = (1 << 64) - 1
_pow: dict[str, np.ndarray] = {}


def byte_table(separators) -> np.ndarray:
    t = np.ones(256, dtype=bool)
    t[list(separators)] = False
    return t


#: words of the form [^\x20\x09-\x0D]+
SPACED = byte_table([0x20, *range(0x09, 0x0E)])
#: words of the form [^\x00-\x2F\x3A-\x60\x7B-\x7F]+ after lower-casing A-Z
ALNUM = byte_table([*range(0x00, 0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)])
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if "p" not in _pow or len(_pow["p"]) < n:
        n = max(n, CHUNK + (1 << 16))
        for name, base in (("p", _P), ("i", pow(_P, -1, 1 << 64))):
            a = np.full(n, base, dtype=np.uint64)
            a[0] = 1
            _pow[name] = np.multiply.accumulate(a)
    return _pow["p"], _pow["i"]


def mix(h: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (splitmix form) over an unsigned array."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def ordered_set(x: np.ndarray) -> np.ndarray:
    """Distinct values in order, by one sort (``np.unique`` without counts hashes, and is slower)."""
    x = np.sort(x)
    keep = np.ones(len(x), bool)
    keep[1:] = x[1:] != x[:-1]
    return x[keep]


def column_bytes(col) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; a null is an empty text."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    if not pa.types.is_large_string(col.type):
        col = col.cast(pa.large_string())
    if col.null_count:
        col = col.fill_null("")
    off = np.frombuffer(col.buffers()[1], dtype=np.int64, count=len(col) + 1 + col.offset)[col.offset:]
    raw = col.buffers()[2]
    data = np.frombuffer(raw, dtype=np.uint8) if raw is not None and raw.size else np.zeros(0, np.uint8)
    return data, off


def row_slices(off: np.ndarray, limit: int = CHUNK):
    """Row ranges (a, b) of about ``limit`` bytes each."""
    a, n = 0, len(off) - 1
    while a < n:
        b = max(a + 1, int(np.searchsorted(off, off[a] + limit, "right")) - 1)
        yield a, min(b, n)
        a = min(b, n)


def _pieces(lo: int, hi: int, data, table):
    """Cut one long text at separators."""
    while lo < hi:
        e = min(hi, lo + CHUNK)
        while e < hi and table[LOWER[data[e - 1]]] and table[LOWER[data[e]]]:
            e += 1
        yield lo, e
        lo = e


def scan(data: np.ndarray, off: np.ndarray, table: np.ndarray, prefixes=()):
    """Words of the rows ``off`` delimits: (row, hash, prefix hashes...), in order.

    ``row`` counts from 0 within ``off``.  ``prefixes`` asks for hashes of the
    first k bytes of each word (0 where the word is shorter).
    """
    rows, hashes, extra = [], [], [[] for _ in prefixes]
    spans = [(int(off[0]), int(off[-1]))]
    if off[-1] - off[0] > 2 * CHUNK:
        spans = [p for a, b in row_slices(off)
                 for p in (_pieces(int(off[a]), int(off[b]), data, table)
                           if off[b] - off[a] > 2 * CHUNK else [(int(off[a]), int(off[b]))])]
    for lo, hi in spans:
        if hi <= lo:
            continue
        buf = LOWER[data[lo:hi]]
        w = table[buf]
        cut = off[np.searchsorted(off, lo, "right"):np.searchsorted(off, hi, "left")] - lo
        first = w.copy()
        first[1:] &= ~w[:-1]
        first[cut] = w[cut]
        last = w.copy()
        last[:-1] &= ~w[1:]
        inner = cut[cut > 0]
        last[inner - 1] = w[inner - 1]
        s, e = np.flatnonzero(first), np.flatnonzero(last) + 1
        pw, inv = _powers(hi - lo + 1)
        c = np.zeros(hi - lo + 1, np.uint64)
        np.cumsum((buf.astype(np.uint64) + np.uint64(1)) * pw[:hi - lo], out=c[1:])
        n = (e - s).astype(np.uint64)
        hashes.append(mix((c[e] - c[s]) * inv[s] + n * np.uint64(0xD6E8FEB86659FD93)))
        for k, out in zip(prefixes, extra):
            h = mix((c[np.minimum(s + k, hi - lo)] - c[s]) * inv[s] + np.uint64(k << 40 | 1))
            h[n < k] = 0
            out.append(h)
        counts = np.diff(np.searchsorted(s + lo, off))
        rows.append(np.repeat(np.arange(len(off) - 1), counts))
    cat = lambda xs, t: np.concatenate(xs) if xs else np.zeros(0, t)
    return (cat(rows, np.int64), cat(hashes, np.uint64), *(cat(x, np.uint64) for x in extra))


def shingles(row: np.ndarray, h: np.ndarray, k: int = 5):
    """Hashes of k-word shingles as (row, hash); a row of fewer words gives one."""
    q = np.uint64(0xA24BAED4963EE407)
    n = len(h)
    if n == 0:
        return row, h
    acc = np.zeros(n, np.uint64)
    if n >= k:
        full = row[:n - k + 1] == row[k - 1:]
        s = np.zeros(n - k + 1, np.uint64)
        for j in range(k):
            s = s * q + h[j:n - k + 1 + j]
        acc[:n - k + 1][full] = s[full]
        at = np.flatnonzero(full)
    else:
        at = np.zeros(0, np.int64)
    counts = np.bincount(row)
    short = np.flatnonzero((counts > 0) & (counts < k))
    begin = np.concatenate([[0], np.cumsum(counts)])[:-1]
    out_r, out_h = [row[at]], [mix(acc[at] + np.uint64(k))]
    for c in range(1, k):
        r = short[counts[short] == c]
        s = np.zeros(len(r), np.uint64)
        for j in range(c):
            s = s * q + h[begin[r] + j]
        out_r.append(r)
        out_h.append(mix(s + np.uint64(c)))
    r, s = np.concatenate(out_r), np.concatenate(out_h)
    order = np.argsort(r, kind="stable")
    return r[order], s[order]


def distinct(row: np.ndarray, h: np.ndarray):
    """Distinct (row, hash) pairs, ordered by row, then hash."""
    order = np.lexsort((h, row))
    r, x = row[order], h[order]
    keep = np.ones(len(r), bool)
    keep[1:] = (r[1:] != r[:-1]) | (x[1:] != x[:-1])
    return r[keep], x[keep]
