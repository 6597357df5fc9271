"""Operator 6: main text of web pages by gradient-boosted trees over DOM
nodes, with hierarchical decoding.

Every element has features of its tag, its class and id tokens, those of its
ancestors, its depth, the density of text and links in its subtree, how much
of it is plain blocks of text, marked as main text or as something else, and
its siblings. Boosted trees give the probability that it belongs to the article.
The decoding picks the most likely labelling of the whole tree in which the
article region is closed: a page region may contain the article, the article
may contain dropped parts (adverts, comments), and nothing inside a dropped
part comes back.

The trees are fitted on a bounded sample: ``LAYOUTS`` generated page layouts
with known regions (with and without wrappers that name the article, down to
bare text), and at most ``SAMPLE_PAGES`` whole pages of the table of up to
``SAMPLE_CHARS`` characters, the first in the order of a hash, whose regions
are told by semantic tags where they have them. All pages are extracted,
whole.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsehouse.llm.common import map_arrow
from pulsehouse.llm.dom import INLINE, RAW, Page

LAYOUTS = 500
SAMPLE_PAGES = 100
SAMPLE_CHARS = 1 << 18
TREES, DEPTH, RATE, BINS = 40, 4, 0.3, 24
PAGES_AT_ONCE = 64

TAGS = (("article", "main"), ("nav", "menu"), ("header",), ("footer",), ("aside", "dialog"),
        ("form", "button", "select", "input", "textarea", "fieldset"),
        (*sorted(RAW), "noscript", "template", "iframe", "svg", "object", "head", "title"),
        ("p", "blockquote", "pre"), ("h1", "h2", "h3", "h4", "h5", "h6"),
        ("ul", "ol", "li", "dl", "dt", "dd"), ("table", "tbody", "thead", "tr", "td", "th"),
        ("figure", "figcaption", "img"), ("div", "section"), ("html", "body"),
        tuple(sorted(INLINE)))
MARKS = ("main content article post entry story body text".split(),
         "nav navigation menu breadcrumb breadcrumbs toolbar tabs pagination pager".split(),
         "ad ads advert adverts advertisement sponsor sponsored promo promotion banner".split(),
         "comment comments reply replies respond disqus discussion reader".split(),
         "sidebar side aside widget related recommended complementary rail more".split(),
         "notice cookie cookies consent gdpr popup modal alert message disclaimer overlay".split(),
         "header masthead top site logo footer bottom copyright legal contentinfo".split(),
         "form search login signup subscribe newsletter share social".split())
_TAG = {t: i for i, group in enumerate(TAGS) for t in group}
_MARK = {t: i for i, group in enumerate(MARKS) for t in group}
N_TAGS, N_MARKS = len(TAGS), len(MARKS)
BAD_TAGS = range(1, 7)
BAD_MARKS = range(1, 8)
N_FEATURES = 2 * (N_TAGS + N_MARKS) + 13
_MAIN_BITS = 1 | 1 << N_TAGS
_BAD_BITS = sum(1 << k for k in BAD_TAGS) | sum(1 << (N_TAGS + k) for k in BAD_MARKS)
# Tag groups of blocks of text, and inline elements.
_TEXT_BITS = sum(1 << k for k in (7, 8, 9, 10, 11, 14))


def features(page: Page) -> np.ndarray:
    """[element, feature]: bits of the element, bits of its ancestors, and
    measures of its subtree, its siblings and its page."""
    n = len(page.tags)
    own = N_TAGS + N_MARKS
    parents, names = page.parents, page.tags
    bits, above = [0] * n, [0] * n
    depth, chars, links, tags, order = [0] * n, [0] * n, [0] * n, [1] * n, [0] * n
    for i, text in page.pieces:
        if text and i >= 0:
            chars[i] += len(text) - text.count(" ")
    direct = list(chars)
    children: dict[int, int] = {}
    alike: dict[tuple[int, str], int] = {}
    for i in range(n):
        p = parents[i]
        order[i] = children.get(p, 0)
        children[p] = order[i] + 1
        alike[p, names[i]] = alike.get((p, names[i]), 0) + 1
        g = _TAG.get(names[i])
        x = 0 if g is None else 1 << g
        if page.attrs[i]:
            for t in page.marks(i):
                k = _MARK.get(t)
                if k is not None:
                    x |= 1 << (N_TAGS + k)
        bits[i] = x
        if p >= 0:
            depth[i] = depth[p] + 1
            above[i] = above[p] | bits[p]
    good, bad, plain = [0] * n, [0] * n, list(direct)
    for i in range(n - 1, -1, -1):
        p, x = parents[i], bits[i]
        if names[i] == "a":
            links[i] = chars[i]
        if x & _BAD_BITS:
            good[i], bad[i] = 0, chars[i]
        elif x & _MAIN_BITS:
            good[i] = chars[i]
        if p >= 0:
            chars[p] += chars[i]
            links[p] += links[i]
            tags[p] += tags[i]
            good[p] += good[i]
            bad[p] += bad[i]
            if x & _TEXT_BITS and not x & _BAD_BITS:
                plain[p] += chars[i]
    marked = sum(good[i] for i in range(n) if parents[i] < 0)
    c, t = np.array(chars, float), np.array(tags, float)
    place = np.arange(own, dtype=np.int64)
    both = np.stack([np.array(bits, np.int64), np.array(above, np.int64)], axis=1)
    x = np.empty((n, N_FEATURES), np.float32)
    x[:, :2 * own] = ((both[:, :, None] >> place) & 1).reshape(n, 2 * own)
    rest = x[:, 2 * own:]
    rest[:, 0] = depth
    rest[:, 1] = np.log1p(c)
    rest[:, 2] = np.log1p(direct)
    rest[:, 3] = c / t
    rest[:, 4] = np.array(links) / np.maximum(c, 1)
    rest[:, 5] = c / max(1.0, c.max(initial=0))
    rest[:, 6] = order
    rest[:, 7] = [children[p] for p in parents]
    rest[:, 8] = [alike[p, t] for p, t in zip(parents, names, strict=True)]
    some = np.maximum(c, 1)
    rest[:, 9], rest[:, 10], rest[:, 11] = good / some, bad / some, plain / some
    rest[:, 12] = marked / max(1.0, sum(chars[i] for i in range(n) if parents[i] < 0))
    return x


class Boosted:
    """Boosted regression trees of fixed depth for a binary label."""

    def __init__(self):
        self.trees: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        self.start = 0.0

    def fit(self, x: np.ndarray, y: np.ndarray) -> Boosted:
        cuts = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, BINS))[:-1])
                for j in range(x.shape[1])]
        binned = np.stack([np.searchsorted(cuts[j], x[:, j], side="left")
                           for j in range(x.shape[1])], axis=1)
        share = np.clip(y.mean(), 0.01, 0.99)
        self.start = float(np.log(share / (1 - share)))
        f = np.full(len(y), self.start)
        for _ in range(TREES):
            p = 1 / (1 + np.exp(-f))
            g, h = y - p, p * (1 - p)
            feat = np.zeros(2 ** DEPTH - 1, np.int64)
            cut = np.full(2 ** DEPTH - 1, np.inf)
            node = np.zeros(len(y), np.int64)
            for d in range(DEPTH):
                for k in range(2 ** d):
                    at = 2 ** d - 1 + k
                    mine = np.flatnonzero(node == k)
                    if len(mine) < 20:
                        continue
                    gain, j, b = self._best(binned[mine], g[mine], h[mine], cuts)
                    if gain > 1e-6:
                        feat[at], cut[at] = j, cuts[j][b]
                at = 2 ** d - 1 + node
                node = 2 * node + (x[np.arange(len(y)), feat[at]] > cut[at])
            leaf = np.zeros(2 ** DEPTH)
            num = np.bincount(node, weights=g, minlength=2 ** DEPTH)
            den = np.bincount(node, weights=h, minlength=2 ** DEPTH)
            leaf = RATE * num / (den + 1.0)
            f = f + leaf[node]
            self.trees.append((feat, cut, leaf))
        return self

    @staticmethod
    def _best(binned, g, h, cuts):
        best = (0.0, 0, 0)
        total_g, total_h = g.sum(), h.sum()
        base = total_g ** 2 / (total_h + 1)
        for j, c in enumerate(cuts):
            if len(c) == 0:
                continue
            sg = np.bincount(binned[:, j], weights=g, minlength=len(c) + 1).cumsum()[:len(c)]
            sh = np.bincount(binned[:, j], weights=h, minlength=len(c) + 1).cumsum()[:len(c)]
            gain = sg ** 2 / (sh + 1) + (total_g - sg) ** 2 / (total_h - sh + 1) - base
            gain[(sh < 0.5) | (total_h - sh < 0.5)] = 0
            b = int(gain.argmax())
            if gain[b] > best[0]:
                best = (float(gain[b]), j, b)
        return best

    def logits(self, x: np.ndarray) -> np.ndarray:
        f = np.full(len(x), self.start)
        rows = np.arange(len(x))
        for feat, cut, leaf in self.trees:
            node = np.zeros(len(x), np.int64)
            for d in range(DEPTH):
                at = 2 ** d - 1 + node
                node = 2 * node + (x[rows, feat[at]] > cut[at])
            f += leaf[node]
        return f


def decode(page: Page, logit: np.ndarray) -> list[bool]:
    """Whether each element is in the article: the best labelling with a page
    region (may hold anything), the article (may hold article and dropped
    parts) and dropped parts (hold dropped parts only)."""
    n = len(page.tags)
    yes = -np.logaddexp(0, -logit)
    no = -np.logaddexp(0, logit)
    best = [[float(no[i]), float(yes[i]), float(no[i])] for i in range(n)]  # page, in, out
    for i in range(n - 1, -1, -1):
        p = page.parents[i]
        if p >= 0:
            a, b, c = best[i]
            best[p][0] += max(a, b, c)
            best[p][1] += max(b, c)
            best[p][2] += c
    state = [0] * n
    for i in range(n):
        p = page.parents[i]
        a, b, c = best[i]
        up = state[p] if p >= 0 else 0
        if up == 0:
            state[i] = 1 if b >= max(a, c) else 0 if a >= c else 2
        elif up == 1:
            state[i] = 1 if b >= c else 2
        else:
            state[i] = 2
    return [s == 1 for s in state]


def text_of(page: Page, inside: list[bool]) -> str:
    """Blocks of the article, white space within them made one space."""
    out: list[str] = []
    for i, text in page.pieces:
        if text is None:
            out.append(" ")
        elif i >= 0 and inside[i]:
            out.append(text)
    return " ".join("".join(out).split())


# Generated layouts: regions of the article are marked keep, the others drop.
_MAIN = ('<article {k}>{c}</article>', '<main {k}>{c}</main>', '<div class="content" {k}>{c}</div>',
         '<div id="main-content" {k}>{c}</div>', '<div class="post-body entry" {k}>{c}</div>',
         '<section role="main" {k}><div>{c}</div></section>',
         '<main {k}><article><div class="text">{c}</div></article></main>')
# Articles that no tag or class names.
_PLAIN = ('<div {k}>{c}</div>', '<div class="c1" {k}>{c}</div>', '<div id="x" {k}><div>{c}</div></div>',
          '<div class="box"><div class="inner" {k}>{c}</div></div>', '<section {k}>{c}</section>',
          '<table><tr><td {d}><ul>{l}</ul></td><td {k}>{c}</td></tr></table>', '<center {k}>{c}</center>')
_DROP = ('<nav {d}><ul>{l}</ul></nav>', '<div class="menu" {d}><ul>{l}</ul></div>',
         '<header {d}><h1>{s}</h1><ul>{l}</ul></header>', '<div id="header" {d}><p>{s}</p></div>',
         '<footer {d}><p>{s}</p></footer>', '<div class="site-footer" {d}>{s} {l}</div>',
         '<footer {d}>{s}</footer>', '<aside {d}><h2>{s}</h2><p>{t}</p></aside>',
         '<div class="sidebar" {d}><ul>{l}</ul><p>{t}</p></div>', '<div class="ad" {d}>{s}</div>',
         '<div class="advertisement" {d}><p>{t}</p></div>', '<div id="sponsored" {d}>{t}</div>',
         '<div class="cookie-notice" {d}><p>{t}</p><button>{s}</button></div>',
         '<div role="alert" {d}>{t}</div>', '<form class="newsletter" {d}><label>{s}</label><input></form>',
         '<form {d}><p>{t}</p><input></form>', '<section id="comments" {d}><h2>{s}</h2><div class="comment"><p>{t}</p></div><div class="comment"><p>{t}</p></div></section>',
         '<div class="comments" {d}><ul><li><p>{t}</p></li><li><p>{t}</p></li></ul></div>',
         '<div class="related" {d}><ul>{l}</ul></div>', '<script>{t}</script>', '<style>{t}</style>')
_BODY = ('<p>{t}</p>', '<p>{t}</p>', '<p>{t}<br>{s}</p>', '<h2>{s}</h2>', '<p><b>{s}</b> {t}</p>',
         '<ul><li>{s}</li><li>{s}</li></ul>', '<blockquote><p>{t}</p></blockquote>',
         '<p>{t} <a href="x">{s}</a></p>', '<table><tr><td>{s}</td><td>{s}</td></tr></table>',
         '<p><b>{s}<br>', '<pre>{t}</pre>', '<div>{t}</div>')
_LOOSE = (' {t} ', '<b>{s}</b> {t}', '<br>{t}', '<p>{t}', '<a href="x">{s}</a> {t}', '<div>{t}</div>')


def layout(rng: np.random.Generator) -> str:
    def text(lo, hi):
        return " ".join("w" * int(k) for k in rng.integers(1, 9, rng.integers(lo, hi)))

    def fill(form, c=""):
        links = "".join(f'<li><a href="/">{text(1, 3)}</a></li>' for _ in range(rng.integers(2, 9)))
        return form.format(t=text(2, 60), s=text(1, 9), l=links, k='data-y="1"', d='data-y="0"', c=c)

    def some(forms, lo, hi):
        return [fill(forms[int(i)]) for i in rng.integers(0, len(forms), rng.integers(lo, hi))]

    def mixed(parts, others):
        for part in others:
            parts.insert(int(rng.integers(1, len(parts) + 1)), part)
        return "".join(parts)

    inner = ([f"<h1>{text(2, 12)}</h1>"] if rng.random() < 0.9 else []) + some(_BODY, 1, 14)
    kind = rng.random()
    if kind < 0.1:  # bare text, with or without some markup in it
        return f'<body data-y="1">{text(5, 300)}' + "".join(some(_LOOSE, 0, 4)) + "</body>"
    if kind < 0.3:  # the body itself is the article
        parts = "".join(some(_DROP, 0, 3)) + mixed(inner, some(_DROP, 0, 4))
        if kind < 0.2:
            return f'<body data-y="1">{parts}</body>'
        return f'<html><head><title>{text(2, 9)}</title></head><body data-y="1">{parts}</body></html>'
    forms = _PLAIN if kind < 0.5 else _MAIN
    main = fill(forms[int(rng.integers(len(forms)))], mixed(inner, some(_DROP[2:19], 0, 3)))
    body = "".join([*some(_DROP, 0, 5), main, *some(_DROP, 0, 4)])
    if rng.random() < 0.4:
        body = f'<div class="{rng.choice(["wrapper", "container", "page", "site"])}">{body}</div>'
    return (f"<!DOCTYPE html><html><head><title>{text(2, 9)}</title><script>{text(2, 9)}</script>"
            f"</head><body>{body}</body></html>")


def told(page: Page) -> np.ndarray:
    """Labels of a generated layout."""
    y = np.zeros(len(page.tags))
    for i, p in enumerate(page.parents):
        y[i] = y[p] if p >= 0 else 0
        if 'data-y="1"' in page.attrs[i]:
            y[i] = 1
        if 'data-y="0"' in page.attrs[i] or page.tags[i] in RAW:
            y[i] = 0
            page.attrs[i] += ' data-end'
        if p >= 0 and 'data-end' in page.attrs[p]:
            y[i] = 0
            page.attrs[i] += ' data-end'
    return y


def guessed(page: Page) -> np.ndarray | None:
    """Labels of a page with semantic tags; None without an article."""
    x = features(page)
    own = N_TAGS + N_MARKS
    inside = (x[:, 0] + x[:, own]) > 0
    if not inside.any():
        return None
    bad = sum(x[:, k] + x[:, own + k] for k in BAD_TAGS)
    bad = bad + sum(x[:, N_TAGS + k] + x[:, own + N_TAGS + k] for k in BAD_MARKS)
    return (inside & (bad == 0)).astype(float)


def train(sample: list[str]) -> Boosted:
    xs, ys = [], []
    rng = np.random.default_rng(6)
    for _ in range(LAYOUTS):
        page = Page(layout(rng))
        ys.append(told(page))
        xs.append(features(page))
    for html in sample:
        page = Page(html)
        y = guessed(page)
        if y is not None:
            xs.append(features(page))
            ys.append(y)
    return Boosted().fit(np.concatenate(xs), np.concatenate(ys))


def _extractor(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for b in batches:
            for lo in range(0, b.num_rows, PAGES_AT_ONCE):
                part = b.slice(lo, PAGES_AT_ONCE)
                pages = [Page(h or "") for h in part.column(2).to_pylist()]
                xs = [features(p) for p in pages]
                logit = model.logits(np.concatenate(xs))
                ends = np.cumsum([len(x) for x in xs])
                texts = [text_of(p, decode(p, logit[e - len(x):e]))
                         for p, x, e in zip(pages, xs, ends, strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(texts, pa.string()),
                     pa.array([len(t) for t in texts], pa.int64())],
                    ["page_id", "url", "text", "n_chars"])

    return run


def _sample(pages: DataFrame) -> list[str]:
    """At most SAMPLE_PAGES whole pages of up to SAMPLE_CHARS characters, the
    first by hash of id and text: the same ones however the table is dealt."""
    fit = pages.filter(F.length("html") <= SAMPLE_CHARS)
    scale = 1 << 30
    limit = min(scale, -(-scale * 2 * SAMPLE_PAGES // max(fit.count(), 1)))
    h = F.xxhash64("page_id", "html", F.lit(6))
    drawn = fit.filter(F.pmod(h, F.lit(scale)) < limit).orderBy(F.pmod(h, F.lit(scale)), h)
    return [r[0] for r in drawn.limit(SAMPLE_PAGES).select("html").collect()]


def extract(pages: DataFrame) -> DataFrame:
    """Per row of ``pages`` (page_id, url, html): page_id, url, text, n_chars.

    A null or empty html, or one without an article, gives the empty text. Bare
    text, and a page whose body is the article, are articles.
    Unclosed and crossing tags are read as browsers do in the common cases;
    repeated rows give equal rows, no rows none; other columns are ignored.
    """
    spark = pages.sparkSession
    pages = pages.select("page_id", "url", "html")
    shared = spark.sparkContext.broadcast(train(sorted(_sample(pages))))
    return map_arrow(pages, _extractor(shared), "page_id long, url string, text string, n_chars long")
