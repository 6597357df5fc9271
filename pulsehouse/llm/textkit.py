"""Vectorised words and shingles of Arrow text columns (inside tasks).

A batch of texts is one byte buffer; words are found with masks and hashed
with a polynomial prefix sum, so no Python loop runs per word or per text.
Work goes in chunks of a few MB of text, which bounds a task's memory.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CHUNK_BYTES = 1 << 20
SHINGLE = 5
_P = np.uint64(0x9E3779B97F4A7C15)
_PINV = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_MIX = np.array([0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0xD6E8FEB86659FD93,
                 0xA0761D6478BD642F, 0xE7037ED1A0B428DB], dtype=np.uint64)
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, 9, 10, 11, 12, 13]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_powers: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every input bit over the 64 output bits."""
    x = (x ^ (x >> np.uint64(30))) * _MIX[0]
    x = (x ^ (x >> np.uint64(27))) * _MIX[1]
    return x ^ (x >> np.uint64(31))


def _pow(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers[0]) < n:
        size = max(n, CHUNK_BYTES + 1)
        for k, base in enumerate((_P, _PINV)):
            a = np.full(size, base, dtype=np.uint64)
            a[0] = 1
            _powers[k] = np.multiply.accumulate(a)
    return _powers[0][:n], _powers[1][:n]


def chunks(texts: pa.Array, limit: int = CHUNK_BYTES
           ) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets) of slices of about ``limit``
    bytes; a longer text is a slice of its own. Null counts as empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    n = len(texts)
    _, off_buf, data_buf = texts.buffers()
    off = np.frombuffer(off_buf, np.int64)[texts.offset:texts.offset + n + 1]
    data = np.frombuffer(data_buf, np.uint8) if data_buf is not None else np.zeros(0, np.uint8)
    a = 0
    while a < n:
        b = max(a + 1, int(np.searchsorted(off, off[a] + limit, side="right")) - 1)
        b = min(b, n)
        yield a, b, data[off[a]:off[b]], off[a:b + 1] - off[a]
        a = b


def words(data: np.ndarray, off: np.ndarray, lower: bool = True,
          hashed: bool = True) -> tuple[np.ndarray, ...]:
    """(row, start byte, end byte, hash) of each word, in text order."""
    n = len(data)
    if n == 0:
        z = np.zeros(0, np.int64)
        return z, z, z, np.zeros(0, np.uint64)
    w = ~_SPACE[data]
    before = np.empty(n, bool)
    before[0] = False
    before[1:] = w[:-1]
    heads = off[:-1]
    heads = heads[heads < n]
    before[heads] = False
    start = np.flatnonzero(w & ~before)
    after = np.empty(n, bool)
    after[-1] = False
    after[:-1] = w[1:]
    after[heads[heads > 0] - 1] = False
    end = np.flatnonzero(w & ~after) + 1
    row = np.searchsorted(off, start, side="right") - 1
    if not hashed:
        return row, start, end, np.zeros(0, np.uint64)
    pw, inv = _pow(n)
    value = (_LOWER[data] if lower else data).astype(np.uint64) + np.uint64(1)
    value *= pw
    total = np.empty(n + 1, np.uint64)
    total[0] = 0
    np.cumsum(value, out=total[1:])
    h = (total[end] - total[start]) * inv[start]
    return row, start, end, mix(h + (end - start).astype(np.uint64) * _MIX[2])


def grams(h: np.ndarray, k: int) -> np.ndarray:
    """Hash of each run of ``k`` hashes (rows are not looked at)."""
    m = len(h) - k + 1
    if m <= 0:
        return np.zeros(0, np.uint64)
    out = np.zeros(m, np.uint64)
    for j in range(k):
        out = out * _P + h[j:j + m] * _MIX[j % 5]
    return mix(out + np.uint64(k))


def shingles(row: np.ndarray, h: np.ndarray, n_rows: int, k: int = SHINGLE
             ) -> tuple[np.ndarray, np.ndarray]:
    """(row, hash) of all k-word shingles; a text of fewer words, but not
    none, is one shingle."""
    g = grams(h, k)
    same = row[:len(g)] == row[k - 1:] if len(g) else np.zeros(0, bool)
    rows, hs = [row[:len(g)][same]], [g[same]]
    count = np.bincount(row, minlength=n_rows)
    first = np.cumsum(count) - count
    for m in range(1, k):
        r = np.flatnonzero(count == m)
        if len(r):
            x = np.zeros(len(r), np.uint64)
            for j in range(m):
                x = x * _P + h[first[r] + j] * _MIX[j % 5]
            rows.append(r)
            hs.append(mix(x + np.uint64(m)))
    return np.concatenate(rows), np.concatenate(hs)


def shingle_sets(data: np.ndarray, off: np.ndarray, k: int = SHINGLE
                 ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, hash, set size of each text) of the distinct shingles, sorted
    by row and hash."""
    n_rows = len(off) - 1
    row, _, _, h = words(data, off)
    r, s = shingles(row, h, n_rows, k)
    order = np.lexsort((s, r))
    r, s = r[order], s[order]
    new = np.ones(len(r), bool)
    new[1:] = (r[1:] != r[:-1]) | (s[1:] != s[:-1])
    r, s = r[new], s[new]
    return r, s, np.bincount(r, minlength=n_rows)


def row_sums(row: np.ndarray, value: np.ndarray, n_rows: int) -> np.ndarray:
    """Wrapping sum of 64-bit values by (sorted) row."""
    total = np.zeros(len(value) + 1, value.dtype)
    np.cumsum(value, out=total[1:])
    edge = np.searchsorted(row, np.arange(n_rows + 1))
    return total[edge[1:]] - total[edge[:-1]]


def span_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hash of the bytes of each span."""
    pw, inv = _pow(max(1, len(data) + 1))
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * pw[:len(data)], out=total[1:])
    return mix((total[end] - total[start]) * inv[np.minimum(start, len(inv) - 1)]
               + (end - start).astype(np.uint64) * _MIX[2])


def seen_before(row: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(has an equal entry earlier in its row, has an equal one at all)."""
    order = np.lexsort((np.arange(len(h)), h, row))
    r, x = row[order], h[order]
    same = np.zeros(len(h), bool)
    same[1:] = (r[1:] == r[:-1]) & (x[1:] == x[:-1])
    any_ = same.copy()
    any_[:-1] |= same[1:]
    earlier, twice = np.empty(len(h), bool), np.empty(len(h), bool)
    earlier[order], twice[order] = same, any_
    return earlier, twice


def counts_at(mask: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """True entries of a mask in each span."""
    total = np.zeros(len(mask) + 1, np.int64)
    np.cumsum(mask, out=total[1:])
    return total[end] - total[start]


def lines(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    r"""(row, start, end) of the \n-split lines; an empty text has one."""
    cut = np.flatnonzero(data == 10)
    row_first = np.searchsorted(cut, off[:-1])
    per_row = np.diff(np.append(row_first, len(cut))) + 1
    row = np.repeat(np.arange(len(off) - 1), per_row)
    # lines of a row are in order; a text that ends in \n ends with an empty line
    first = np.cumsum(per_row) - per_row
    start = np.empty(len(row), np.int64)
    start[first] = off[:-1]
    rest = np.ones(len(row), bool)
    rest[first] = False
    start[rest] = cut + 1
    end = np.empty(len(row), np.int64)
    last = first + per_row - 1
    end[last] = off[1:]
    inner = np.ones(len(row), bool)
    inner[last] = False
    end[inner] = cut
    return row, start, end
