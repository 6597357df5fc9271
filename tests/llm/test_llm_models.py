"""The models of operators 5 and 9 against plain versions: every n-gram in a
dictionary, every sum written out."""

from __future__ import annotations

import collections
import math
import random

import brute
import numpy as np
import pytest

from pulsehouse.llm import language_id as L
from pulsehouse.llm import resampling as R
from pulsehouse.llm.common import map_arrow
from pulsehouse.llm.textkit import chunks

SF = "/root/testdata/sf0.001"
EDGE = chr(L.EDGE)


def spelt(text):
    """Each word as its lower-case letters between boundary marks; words
    without a letter are left out."""
    out = []
    for w in brute.WORD.findall(text or ""):
        s = "".join(c for c in w.lower() if c.isalpha())
        if s:
            out.append(EDGE + s + EDGE)
    return out


class Plain:
    """Interpolated Kneser-Ney of one language, by the definition."""

    def __init__(self, texts, alphabet):
        self.c = [None] + [collections.Counter() for _ in range(L.ORDER)]
        for t in texts:
            for s in spelt(t):
                for i in range(1, len(s)):
                    for n in range(1, min(L.ORDER, i + 1) + 1):
                        self.c[n][s[i - n + 1:i + 1]] += 1
        self.a, self.D, self.base = [None], [None], 1 / alphabet
        for n in range(1, L.ORDER + 1):
            a = {}
            kinds = collections.Counter(g[1:] for g in self.c[n + 1]) if n < L.ORDER else {}
            for g, c in self.c[n].items():
                a[g] = kinds[g] if kinds.get(g) and not (n > 1 and g[0] == EDGE) else c
            ones, twos = (sum(x == k for x in a.values()) or 1 for k in (1, 2))
            self.a.append(a)
            self.D.append(max(0.1, min(0.9, ones / max(1, ones + 2 * twos))))

    def p(self, c, h):
        """Probability of c after the context h (at most ORDER - 1 long)."""
        n = len(h) + 1
        lower = self.base if n == 1 else self.p(c, h[1:])
        after = [x for g, x in self.a[n].items() if g[:-1] == h]
        if not after:
            return lower
        total, D = sum(after), self.D[n]
        got = self.a[n].get(h + c, 0)
        return (got - D if got else 0) / total + D * len(after) / total * lower

    def log_prob(self, text):
        return sum(math.log(self.p(s[i], s[max(0, i - L.ORDER + 1):i]))
                   for s in spelt(text) for i in range(1, len(s)))


def test_kneser_ney_equals_the_plain_model(spark):
    r = random.Random(8)
    syllables = {"aa": "ba na ti lo é".split(), "bb": "zu ßk ny rr o".split()}
    word = lambda k: "".join(r.choices(syllables[k], k=r.randint(1, 4)))
    rows = [(k, " ".join(word(k) for _ in range(r.randint(1, 30)))) for k in syllables for _ in range(25)]
    rows += [("aa", "Mixed CASE 123 x9y -- "), ("bb", None), ("bb", "")]
    df = spark.createDataFrame(rows, "lang string, text string")
    counts = (map_arrow(df, L._count_grams, "lang string, gram string, c long")
              .groupBy("lang", "gram").sum("c").withColumnRenamed("sum(c)", "c").toPandas())
    model = L.Model(counts, ["aa", "bb"])
    seen = {g for _, t in rows for s in spelt(t) for g in s[1:]}
    plain = {k: Plain([t for x, t in rows if x == k], len(seen) + 1) for k in syllables}
    texts = ["banati loba", "zunyrro", "unseen words, Quite", "é", "ßk ba", "12 --", "", rows[3][1]]
    import pyarrow as pa
    for _, _, data, off in chunks(pa.array(texts)):
        chars, lp = model.texts(data, off)
    assert chars.tolist() == [sum(len(s) - 1 for s in spelt(t)) for t in texts]
    for i, t in enumerate(texts):
        for j, k in enumerate(model.langs):
            assert lp[i, j] == pytest.approx(plain[k].log_prob(t), rel=1e-9, abs=1e-9)


def bucket(words):
    """The operator's bucket of a word, or of a pair of words."""
    data = " ".join(words).encode()
    b = R._buckets(np.frombuffer(data, np.uint8), np.array([0, len(data)]))[1]
    return int(b[0] if len(words) == 1 else b[2])


def test_weights_equal_a_plain_version(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").limit(60)
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()] + [(10**6, None), (10**6 + 1, ""), (None, "a b a")]
    good = {r.doc_id for r in labels.collect() if r.quality == 1 and not r.toxic}
    good -= {r.doc_id for r in labels.collect() if not (r.quality == 1 and not r.toxic)}
    cache, feats = {}, []
    for _, t in rows:
        w = brute.WORD.findall((t or "").translate(brute.LOWER))
        c = collections.Counter()
        for f in [(x,) for x in w] + list(zip(w, w[1:], strict=False)):
            if f not in cache:
                cache[f] = bucket(f)
            c[cache[f]] += 1
        feats.append(c)
    raw, target = collections.Counter(), collections.Counter()
    for (i, _), c in zip(rows, feats, strict=True):
        raw.update(c)
        if i in good:
            target.update(c)
    assert target
    n_raw, n_target, s = sum(raw.values()), sum(target.values()), R.SMOOTHING
    ratio = {b: math.log((target[b] + s) / (n_target + s * R.BUCKETS))
             - math.log((raw[b] + s) / (n_raw + s * R.BUCKETS)) for b in raw}
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r for r in R.resample(df, labels).collect()}
    for (i, _), c in zip(rows, feats, strict=True):
        assert got[i].n_grams == sum(c.values())
        assert got[i].log_weight == pytest.approx(sum(k * ratio[b] for b, k in c.items()), abs=1e-6)
