"""Operator 11: periodic runs of words by internal pattern matching.

A run is a maximal stretch of consecutive words with smallest period q that is
at least MIN_LENGTH words and MIN_TIMES periods long. Per text:

1. prefix doubling over word ids gives the suffix array and, for every power
   of two, ranks that are equal exactly where the next 2^k words are;
2. the text is cut into dyadic blocks of L words (8, 16, 32, ...). A run of
   period q in [L, 2L) contains a whole block and its copy q words on, so
   each block asks for its occurrences in the neighbouring window of starts
   [b + L, b + 2L) (blocks of 8 also in [b + 1, b + 8)). The block's suffix
   array interval is known from its rank; a wavelet tree over the array
   answers the range successor queries in it;
3. one or two occurrences are candidate periods themselves. Three or more are
   an arithmetic progression, whose step is a period d of the block: a run of
   larger period must map the end of the d-periodic stretch around the block
   to the end of the stretch around the progression, so its two ends give the
   only two candidates;
4. a candidate is extended both ways by the ranks (longest common extensions)
   and kept if it is long enough; of equal stretches the smallest period is
   the run's.

Words are compared by 64-bit hashes (two different words of a text collide with
probability 2^-64 a pair). A text is handled whole inside one task; memory
is some 4 bytes * log2(words) a word of the chunk of texts at hand, and only
words of texts in the same chunk (about 1 MB, or one longer text) are held.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from pulsehouse.llm.common import map_arrow
from pulsehouse.llm.textkit import chunks, words

MIN_LENGTH = 24
MIN_TIMES = 3
# Smallest block: runs of a smaller period still have MIN_LENGTH words, hence
# a whole block of 8 and its copy.
BLOCK = 8


class Ranks:
    """Suffix array of all texts (texts apart, in order) and the ranks of
    prefix doubling: ``level[k][i] == level[k][j]`` exactly if the 2^k words
    from i and from j are equal and of one text. A rank is the first place of its
    group in ``sa``."""

    def __init__(self, row: np.ndarray, ids: np.ndarray):
        n = len(ids)
        order = np.lexsort((ids, row))
        new = np.ones(n, bool)
        new[1:] = (ids[order][1:] != ids[order][:-1]) | (row[order][1:] != row[order][:-1])
        rank = np.full(n + 1, -1, np.int32)  # the place after the last word equals nothing
        rank[order] = np.flatnonzero(new)[np.cumsum(new) - 1]
        self.sa, self.level = order, [rank]
        end = np.searchsorted(row, row, side="right")
        act, slot = order, np.arange(n)
        h = 1
        while True:
            # only suffixes that are not yet alone in their group go on
            first = np.ones(len(act), bool)
            first[1:] = rank[act[1:]] != rank[act[:-1]]
            alone = first & np.append(first[1:], True)
            act, slot = act[~alone], slot[~alone]
            if not len(act):
                break
            follow = np.where(act + h < end[act], rank[np.minimum(act + h, n)], -1)
            o = np.lexsort((follow, rank[act]))
            act, follow = act[o], follow[o]
            new = np.ones(len(act), bool)
            new[1:] = (rank[act[1:]] != rank[act[:-1]]) | (follow[1:] != follow[:-1])
            rank = rank.copy()
            rank[act] = slot[np.flatnonzero(new)[np.cumsum(new) - 1]]
            self.sa[slot] = act
            self.level.append(rank)
            h *= 2

    def forward(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Words in common from i and from j on (i < j, in one text)."""
        i, j, out = i.copy(), j.copy(), np.zeros(len(i), np.int64)
        for k in range(len(self.level) - 1, -1, -1):
            same = (self.level[k][i] == self.level[k][j]).astype(np.int64) << k
            i, j, out = i + same, j + same, out + same
        return out

    def backward(self, i: np.ndarray, j: np.ndarray, start: np.ndarray) -> np.ndarray:
        """Words in common before i and before j (i < j), not before ``start``."""
        i, j, out = i.copy(), j.copy(), np.zeros(len(i), np.int64)
        for k in range(len(self.level) - 1, -1, -1):
            a, b = i - (1 << k), j - (1 << k)
            at = np.maximum(a, 0)
            same = (a >= start) & (self.level[k][at] == self.level[k][np.maximum(b, 0)])
            step = same.astype(np.int64) << k
            i, j, out = i - step, j - step, out + step
        return out


class WaveletTree:
    """Levels of the values' bits from the top: how many zeros are before
    each place, values with a zero first on the next level."""

    def __init__(self, values: np.ndarray):
        self.bits = max(1, int(values.max(initial=0)).bit_length())
        self.zeros = []
        for b in range(self.bits - 1, -1, -1):
            one = (values >> b) & 1
            z = np.zeros(len(values) + 1, np.int32)
            np.cumsum(one == 0, out=z[1:])
            self.zeros.append(z)
            values = np.concatenate([values[one == 0], values[one == 1]])

    def below(self, lo: np.ndarray, hi: np.ndarray, x: np.ndarray) -> np.ndarray:
        """Values under x in the places [lo, hi)."""
        out = np.zeros(len(lo), np.int64)
        over = x >> self.bits > 0
        for b, z in zip(range(self.bits - 1, -1, -1), self.zeros, strict=True):
            zl, zh = z[lo], z[hi]
            one = (x >> b) & 1 == 1
            out += np.where(one, zh - zl, 0)
            lo, hi = np.where(one, z[-1] + lo - zl, zl), np.where(one, z[-1] + hi - zh, zh)
        return np.where(over, out + hi - lo, out) if over.any() else out

    def nth(self, lo: np.ndarray, hi: np.ndarray, r: np.ndarray) -> np.ndarray:
        """The r-th smallest value (from 0) in the places [lo, hi)."""
        out = np.zeros(len(lo), np.int64)
        for b, z in zip(range(self.bits - 1, -1, -1), self.zeros, strict=True):
            zl, zh = z[lo], z[hi]
            one = r >= zh - zl
            r = np.where(one, r - (zh - zl), r)
            out |= one.astype(np.int64) << b
            lo, hi = np.where(one, z[-1] + lo - zl, zl), np.where(one, z[-1] + hi - zh, zh)
        return out


def _below(tree: WaveletTree, lo, hi, x):
    """``tree.below`` where x may be over every value."""
    top = (1 << tree.bits) - 1
    return np.where(x > top, hi - lo, tree.below(lo, hi, np.minimum(x, top)))


def _candidates(ranks: Ranks, first: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(place b, period q): words b.. and b + q.. agree for a whole block, or
    may do so (ends of progressions). ``first`` and ``last``: start and end
    of the text of each place."""
    n = len(first)
    place = np.arange(n)
    none = np.zeros(0, np.int64)
    k = BLOCK.bit_length() - 1
    if len(ranks.level) <= k:
        return none, none  # no eight words come twice
    # the tree holds only suffixes whose first eight words come again
    group = np.bincount(ranks.level[k][:n], minlength=n + 1)
    held = group[ranks.level[k][ranks.sa]] > 1
    if not held.any():
        return none, none
    tree = WaveletTree(ranks.sa[held])
    at = np.concatenate([[0], np.cumsum(held)])
    bs, qs = [], []
    while k < len(ranks.level):
        size, level = 1 << k, ranks.level[k]
        b = place[((place - first) % size == 0) & (place + size <= last)]
        count = np.bincount(level[:n], minlength=n + 1)
        b = b[count[level[b]] > 1]
        if len(b):
            lo = at[level[b]]
            hi = lo + count[level[b]]
            near = _below(tree, lo, hi, b + size)
            if size == BLOCK:
                c = _below(tree, lo, hi, b + 1)
                some = near > c
                bs.append(b[some])
                qs.append(tree.nth(lo[some], hi[some], c[some]) - b[some])
            times = _below(tree, lo, hi, b + 2 * size) - near
            some = times > 0
            b, lo, hi, near, times = b[some], lo[some], hi[some], near[some], times[some]
            p = tree.nth(lo, hi, near)
            two = times > 1
            p2 = tree.nth(lo[two], hi[two], near[two] + 1)
            pair = times[two] == 2
            bs += [b[times < 3], b[two][pair]]
            qs += [(p - b)[times < 3], (p2 - b[two])[pair]]
            if (~pair).any():
                b, p = b[two][~pair], p[two][~pair]
                d = p2[~pair] - p
                right = p + ranks.forward(p, p + d) - b - ranks.forward(b, b + d)
                left = (p - ranks.backward(p, p + d, first[p])
                        - b + ranks.backward(b, b + d, first[b]))
                for q in (right, left):
                    ok = (q >= size) & (q < 2 * size) & (b + q < last[b])
                    bs.append(b[ok])
                    qs.append(q[ok])
        k += 1
    return np.concatenate([none, *bs]), np.concatenate([none, *qs])


def find_runs(row: np.ndarray, ids: np.ndarray, min_length: int = MIN_LENGTH,
              min_times: int = MIN_TIMES) -> tuple[np.ndarray, ...]:
    """(row, start, length, period) of all runs of the texts, by row, start
    and period; start counts words of the text. ``row`` is sorted. Runs of at
    least 24 words and 3 periods are found whole; the parameters can only ask
    for longer ones."""
    none = np.zeros(0, np.int64)
    if min_length < MIN_LENGTH or min_times < MIN_TIMES:
        raise ValueError(f"runs are of {MIN_LENGTH} words and {MIN_TIMES} periods at least")
    if not len(ids):
        return none, none, none, none
    ranks = Ranks(row, ids)
    first = np.searchsorted(row, row, side="left")
    last = np.searchsorted(row, row, side="right")
    b, q = _candidates(ranks, first, last)
    f = ranks.forward(b, b + q)
    start = b - ranks.backward(b, b + q, first[b])
    end = b + q + f
    ok = end - start >= np.maximum(min_length, min_times * q)
    start, end, q = start[ok], end[ok], q[ok]
    order = np.lexsort((q, end, start))
    start, end, q = start[order], end[order], q[order]
    new = np.ones(len(start), bool)
    new[1:] = (start[1:] != start[:-1]) | (end[1:] != end[:-1])
    start, end, q = start[new], end[new], q[new]
    order = np.lexsort((q, start))
    start, end, q = start[order], end[order], q[order]
    return row[start], start - first[start], end - start, q


def planted(doc_id, n: int) -> np.ndarray | None:
    """Which original word stands at each place of a rebuilt text of n words;
    None if the text stays (nine of ten, empty ones, null ids)."""
    if doc_id is None or n == 0:
        return None
    h = zlib.crc32(str(doc_id).encode())
    if h % 10:
        return None
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    at = np.arange(n)
    at[a:] = a + (at[a:] - a) % p
    return at


SCHEMA = ("doc_id long, n_runs long, start long, length long, period long, exponent_milli long, "
          "runs_sha256 string, collapsed_sha256 string")


def _digest(text: bytes, at: np.ndarray | None, runs: list[tuple[int, int, int]]) -> list:
    w = text.split()  # at the bytes \\x20, \\x09-\\x0D
    if at is not None:
        w = [w[i] for i in at]
    best = None
    if runs:
        gone = np.zeros(len(w) + 1, np.int64)
        for s, length, q in runs:
            gone[s + q] += 1
            gone[s + length] -= 1
            if best is None or length * best[2] > best[1] * q:  # by start, period: ties stay
                best = (s, length, q)
        stays = np.cumsum(gone)[:-1] == 0
        w = [x for x, ok in zip(w, stays.tolist(), strict=True) if ok]
    listed = "".join(f"{s},{length},{q}\n" for s, length, q in runs)
    s, length, q = best or (None, None, None)
    return [len(runs), s, length, q, 1000 * length // q if runs else None,
            hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(b" ".join(w)).hexdigest()]


def _run(plant: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types = [pa.int64()] * 6 + [pa.string()] * 2
        names = [f.split()[0] for f in SCHEMA.split(", ")]
        for batch in batches:
            for lo, hi, data, off in chunks(batch.column(1)):
                row, _, _, ids = words(data, off, lower=False)
                doc_ids = batch.column(0).slice(lo, hi - lo).to_pylist()
                first = np.searchsorted(row, np.arange(hi - lo + 1))
                at = [planted(i, int(first[r + 1] - first[r])) if plant else None
                      for r, i in enumerate(doc_ids)]
                ids = ids.copy()
                for r, x in enumerate(at):
                    if x is not None:
                        ids[first[r]:first[r + 1]] = ids[first[r] + x]
                runs: dict[int, list] = {}
                for r, s, length, q in zip(*(x.tolist() for x in find_runs(row, ids)), strict=True):
                    runs.setdefault(r, []).append((s, length, q))
                rows = [[i, *_digest(data[off[r]:off[r + 1]].tobytes(), at[r], runs.get(r, []))]
                        for r, i in enumerate(doc_ids)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([x[c] for x in rows], t) for c, t in enumerate(types)], names)

    return run


def periodic_runs(docs: DataFrame, plant: bool = False) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): doc_id, n_runs; start (word number), length,
    period and exponent_milli of the run of greatest length / period (ties:
    smallest start, then period; null without a run); runs_sha256 of all runs
    as lines ``start,length,period``; collapsed_sha256 of the words that stay
    if of every run only the first period does.

    Words are cut at \\x20 and \\x09-\\x0D. ``plant`` first rebuilds a tenth of
    the texts, chosen by id, to end in a repeated passage (``planted``). Null
    and empty texts have no words and no runs; a null id is never rebuilt;
    repeated rows give equal rows, no rows none; other columns are ignored.
    """
    return map_arrow(docs.select("doc_id", "text"), _run(plant), SCHEMA)
