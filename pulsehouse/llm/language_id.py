"""Operator 9: language identification with interpolated Kneser-Ney character
models, one per language, kept in sorted hash arrays.

A text is the sequence of its words, lower-cased and reduced to letters; each
word is spelt between boundary marks, so equal words have equal scores and a
batch scores each distinct word once. The language of the lowest
cross-entropy per character wins; a text is rejected when its cross-entropy
lies far outside what the training texts of that language show at its length.

The models are fitted on a bounded sample (``sample`` labelled documents per
language in expectation, chosen by a hash of doc_id, whole texts); everything
else covers all documents. The n-gram table that reaches the driver is
bounded by that sample, not by the corpus.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsehouse.llm.common import bounded, keep, map_arrow
from pulsehouse.llm.textkit import chunks, mix, words

ORDER = 4
SAMPLE_DOCS = 1500
EDGE = 10  # code point of the word boundary; no word contains it
_STEP = np.uint64(0x9E3779B97F4A7C15)
_LETTER: list[np.ndarray] = []


def _letters() -> np.ndarray:
    if not _LETTER:
        _LETTER.append(np.array([chr(i).isalpha() for i in range(0x110000)]))
    return _LETTER[0]


def _spell(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Code points of the words' letters in lower case, each word closed by
    EDGE, with one EDGE in front."""
    raw = data.tobytes()
    text = b"\n".join([raw[a:b] for a, b in zip(start.tolist(), end.tolist(), strict=True)])
    text = "\n" + text.decode("utf-8", "replace").lower() + "\n"
    cp = np.frombuffer(text.encode("utf-32-le", "replace"), np.uint32)
    return cp[_letters()[cp] | (cp == EDGE)]


def _distinct(h: np.ndarray, start: np.ndarray, end: np.ndarray):
    _, first, inv = np.unique(h, return_index=True, return_inverse=True)
    return start[first], end[first], inv


def _reach(cp: np.ndarray) -> np.ndarray:
    """Distance of each position from the last EDGE strictly before it."""
    i = np.arange(len(cp))
    last = np.maximum.accumulate(np.where(cp == EDGE, i, 0))
    before = np.empty_like(last)
    before[0], before[1:] = 0, last[:-1]
    return i - before


def _gram_hashes(cp: np.ndarray, order: int) -> list[np.ndarray]:
    """For n = 1..order the hash of the n-gram that ends at each position."""
    c = cp.astype(np.uint64) + np.uint64(1)
    out, h = [], c
    for n in range(1, order + 1):
        if n > 1:
            prev = np.zeros_like(h)
            prev[1:] = h[:-1]
            h = prev * _STEP + c
        out.append(mix(h + np.uint64(n)))
    return out


def _count_grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, gram, c): n-grams of all orders, counted by chunk."""
    for b in batches:
        langs = b.column(0).to_pylist()
        for lo, hi, data, off in chunks(b.column(1)):
            row, start, end, h = words(data, off, lower=False)
            of = np.array(langs[lo:hi], dtype=object)
            for lang in sorted(set(langs[lo:hi])):
                mine = np.flatnonzero(of == lang)
                sel = np.isin(row, mine)
                if not sel.any():
                    continue
                s, e, inv = _distinct(h[sel], start[sel], end[sel])
                weight = np.bincount(inv)
                cp = _spell(data, s, e)
                which = np.cumsum(cp == EDGE) - 1
                which[1:] -= (cp[1:] == EDGE)
                reach = _reach(cp)
                real = np.arange(len(cp)) > 0
                real[1:] &= ~((cp[1:] == EDGE) & (cp[:-1] == EDGE))
                text = cp.astype("<u4").tobytes().decode("utf-32-le")
                for n in range(1, ORDER + 1):
                    at = np.flatnonzero(real & (reach >= n - 1))
                    at = at[at >= n - 1]
                    grams = pd.Series([text[i - n + 1:i + 1] for i in at.tolist()])
                    got = pd.Series(weight[which[at]]).groupby(grams.values).sum()
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([lang] * len(got)), pa.array(got.index.astype(str), pa.string()),
                         pa.array(got.values.astype(np.int64))], ["lang", "gram", "c"])


class Model:
    """Per order: sorted n-gram hashes, the discounted terms of each language
    and the weight that each n-gram, as a context, leaves to shorter ones."""

    def __init__(self, counts: pd.DataFrame, langs: list[str]):
        self.langs = langs
        at = {x: i for i, x in enumerate(langs)}
        counts = counts.assign(n=counts.gram.str.len(), lang=counts.lang.map(at))
        by = {n: counts[counts.n == n] for n in range(1, ORDER + 1)}
        alphabet = max(2, by[1].gram.nunique() + 1)
        self.hashes, self.terms, self.left = [], [], []
        self.base = np.full(len(langs), 1.0 / alphabet)
        grams = {n: np.array(sorted(by[n].gram.unique()), dtype=object) for n in by}
        for n in range(1, ORDER + 1):
            self.hashes.append(np.array([_gram_hashes(
                np.array([ord(x) for x in g], np.uint32), n)[-1][-1] for g in grams[n]],
                dtype=np.uint64))
            self.terms.append(np.zeros((len(grams[n]), len(langs))))
            self.left.append(np.ones((len(grams[n]), len(langs))))
        place = {n: pd.Series(np.arange(len(grams[n])), index=grams[n]) for n in by}
        for n in range(1, ORDER + 1):
            d = by[n].copy()
            if n < ORDER:  # how many characters precede it; spelt from the edge: as counted
                nxt = by[n + 1]
                kinds = nxt.groupby([nxt.lang, nxt.gram.str[1:]]).size()
                kinds.index.names = ["lang", "gram"]
                d = d.merge(kinds.rename("k").reset_index(), on=["lang", "gram"], how="left")
                edge = (d.gram.str[0] == chr(EDGE)) & (d.n > 1)
                d["a"] = np.where(edge | d.k.isna(), d.c, d.k)
            else:
                d["a"] = d.c
            d["h"] = d.gram.str[:-1]
            ones = d[d.a == 1].groupby("lang").size()
            twos = d[d.a == 2].groupby("lang").size()
            disc = {x: max(0.1, min(0.9, ones.get(x, 1) / max(1, ones.get(x, 1) + 2 * twos.get(x, 1))))
                    for x in range(len(langs))}
            d["D"] = d.lang.map(disc)
            total = d.groupby(["lang", "h"]).agg(A=("a", "sum"), kinds=("a", "size")).reset_index()
            d = d.merge(total, on=["lang", "h"])
            self.terms[n - 1][place[n][d.gram].values, d.lang.values] = (d.a - d.D) / d.A
            total["w"] = total.lang.map(disc) * total.kinds / total.A
            if n == 1:
                self.base[total.lang.values] *= total.w.values
            else:
                total = total[total.h.isin(place[n - 1].index)]
                self.left[n - 2][place[n - 1][total.h].values, total.lang.values] = total.w
        for k in range(ORDER):
            o = np.argsort(self.hashes[k])
            self.hashes[k] = self.hashes[k][o]
            # one more row for n-grams never seen
            self.terms[k] = np.vstack([self.terms[k][o], np.zeros(len(langs))])
            self.left[k] = np.vstack([self.left[k][o], np.ones(len(langs))])

    def log_probs(self, cp: np.ndarray) -> np.ndarray:
        """[position, language] log probability of each character."""
        reach = _reach(cp)
        p = np.broadcast_to(self.base, (len(cp), len(self.langs))).copy()
        prev = None
        for n, h in enumerate(_gram_hashes(cp, ORDER), start=1):
            table = self.hashes[n - 1]
            at = np.minimum(np.searchsorted(table, h), len(table) - 1)
            at = np.where((table[at] == h) & (reach >= n - 1), at, len(table))
            if n == 1:
                p = p + self.terms[0][at]
            else:
                ctx = np.full(len(cp), len(self.hashes[n - 2]))
                ctx[1:] = prev[:-1]
                ctx[reach < n - 1] = len(self.hashes[n - 2])
                p = self.terms[n - 1][at] + self.left[n - 2][ctx] * p
            prev = at
        return np.log(p)

    def texts(self, data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(characters scored, [text, language] log probability)."""
        n_rows = len(off) - 1
        row, start, end, h = words(data, off, lower=False)
        if not len(row):
            return np.zeros(n_rows), np.zeros((n_rows, len(self.langs)))
        s, e, inv = _distinct(h, start, end)
        cp = _spell(data, s, e)
        edges = np.flatnonzero(cp == EDGE)
        length = np.diff(edges)
        lp = self.log_probs(cp)
        per_word = np.add.reduceat(lp, edges[:-1] + 1, axis=0)
        empty = length == 1
        per_word[empty] = 0.0
        n = np.where(empty, 0, length)
        chars = np.bincount(row, weights=n[inv], minlength=n_rows)
        lps = [np.bincount(row, weights=per_word[inv, k], minlength=n_rows)
               for k in range(len(self.langs))]
        return chars, np.stack(lps, axis=1)


def _scorer(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, limits = shared.value
        for b in batches:
            rest = [b.column(i) for i in range(b.num_columns - 1)]
            for lo, hi, data, off in chunks(b.column(b.num_columns - 1)):
                if model is None:
                    m = hi - lo
                    pred, score = ["und"] * m, np.zeros(m)
                    entropy, chars, bad = np.zeros(m), np.zeros(m), np.ones(m, bool)
                else:
                    chars, lp = model.texts(data, off)
                    has = chars > 0
                    ce = -lp / np.maximum(chars, 1)[:, None]
                    best = ce.argmin(axis=1)
                    entropy = np.where(has, ce.min(axis=1), 0.0)
                    gap = (ce - ce.min(axis=1)[:, None]) * np.minimum(chars, 40)[:, None]
                    score = np.where(has, 1.0 / np.exp(-gap).sum(axis=1), 0.0)
                    names = np.array([*model.langs, "und"], dtype=object)
                    pred = names[np.where(has, best, len(model.langs))].tolist()
                    bad = ~has
                    if limits is not None:
                        mid, wide = limits
                        bad |= has & ((entropy - mid[best]) * np.sqrt(np.minimum(chars, 400))
                                      > wide[best])
                yield pa.RecordBatch.from_arrays(
                    [*[c.slice(lo, hi - lo) for c in rest], pa.array(pred, pa.string()),
                     pa.array(score), pa.array(entropy), pa.array(chars.astype(np.int64)),
                     pa.array(bad)],
                    [*[f.name for f in list(b.schema)[:-1]], "lang_pred", "score",
                     "cross_entropy", "chars", "rejected"])

    return run


OUT = "lang_pred string, score double, cross_entropy double, chars long, rejected boolean"


def identify(docs: DataFrame, sample: int = SAMPLE_DOCS) -> DataFrame:
    """doc_id, key, held_out, lang_pred, score, cross_entropy, chars, rejected
    per row of ``docs`` (doc_id, text, lang); key is a hash of id and text.

    Learns from rows with a lang, an id and crc32(doc_id as text) mod 3 <> 1.
    A text that is null or has no letter is ``und`` with score 0, rejected;
    so is every text when nothing could be learned. A null doc_id is never
    learned from and not held out. Ties go to the first language by code
    point. Repeated rows get equal results; other columns are ignored.
    """
    spark = docs.sparkSession
    fold = F.crc32(F.col("doc_id").cast("string")) % 3
    docs = docs.select("doc_id", F.xxhash64("doc_id", "text").alias("key"),
                       F.coalesce(fold == 1, F.lit(False)).alias("held_out"), "lang", "text")
    learn = docs.filter("doc_id IS NOT NULL AND lang IS NOT NULL AND NOT held_out")
    sizes = {r.lang: r["count"] for r in learn.groupBy("lang").count().collect()}
    langs = sorted(sizes)
    model = limits = None
    if langs:
        scale = 1 << 30
        bound = F.create_map(*[F.lit(x) for k in langs for x in (
            k, min(scale, -(-scale * sample // sizes[k])))])
        drawn = learn.filter(F.pmod(F.xxhash64("doc_id", F.lit(9)), F.lit(scale))
                             < F.element_at(bound, F.col("lang")))
        counts = (map_arrow(drawn.select("lang", "text"), _count_grams,
                            "lang string, gram string, c long")
                  .groupBy("lang", "gram").agg(F.sum("c").alias("c")).toPandas())
        if len(counts):
            model = Model(counts, langs)
            tuned = spark.sparkContext.broadcast((model, None))
            fit = (map_arrow(drawn.select("lang", "text"), _scorer(tuned), f"lang string, {OUT}")
                   .filter("lang = lang_pred AND chars > 0"))
            mids = keep(fit).groupBy("lang").agg(
                F.percentile_approx("cross_entropy", 0.5).alias("m"),
                F.collect_list(F.struct("cross_entropy", "chars")).alias("x")).collect()
            mid, wide = np.full(len(langs), 1e9), np.full(len(langs), 1e9)
            for r in mids:  # at most ``sample`` pairs of numbers a language
                k = langs.index(r.lang)
                z = np.array([(x.cross_entropy - r.m) * np.sqrt(min(x.chars, 400)) for x in r.x])
                mid[k] = r.m
                wide[k] = 2.0 * max(np.quantile(z, 0.999), 4 * z.std(), 1.0) + 1.0
            limits = (mid, wide)
    shared = spark.sparkContext.broadcast((model, limits))
    return map_arrow(docs.select("doc_id", "key", "held_out", "text"), _scorer(shared),
                     f"doc_id long, key long, held_out boolean, {OUT}")


def keep_identified(docs: DataFrame) -> DataFrame:
    """Pipeline form: the rows of ``docs`` whose language is not rejected,
    with all their columns."""
    bad = identify(docs).filter("rejected").select(F.col("key").alias("__key")).distinct()
    bad = bounded(keep(bad))
    return (docs.withColumn("__key", F.xxhash64("doc_id", "text"))
            .join(bad, "__key", "left_anti").select(docs.columns))
