"""Operator 3: quality rules by weak supervision.

Each rule votes good or bad on a document, or abstains where its measure says
little. Expectation-maximisation over all documents estimates how often each
rule is right about good and about bad documents, without labels; the
posterior probability of quality replaces the demand that all rules pass.
Documents with equal votes are alike to the model, so it is fitted on the
counts of the vote patterns (at most 3^rules rows, whatever the corpus).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsehouse.llm.common import keep, map_arrow
from pulsehouse.llm.textkit import (chunks, counts_at, grams, lines, row_sums, seen_before,
                                    span_hashes, words)

WINDOW = 8
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
KEEP_FROM = 0.5
# name: (SQL measure, votes good, votes bad); elsewhere the rule abstains.
# Rules about one kind of damage have nothing to say for a text without it.
RULES = {
    "length": ("n_words", "x BETWEEN 60 AND 100000", "x < 25"),
    "word_length": ("word_chars / n_words", "false", "x < 2 OR x > 15"),
    "symbols": ("n_symbols / n_words", "false", "x > 0.1"),
    "duplicate_lines": ("n_dup_lines / n_lines", "false", "x > 0.3"),
    "repeated_words": ("n_repeat_words / n_words", "false", "x > 0.2"),
    "capitals": ("n_capitals / word_chars", "false", "x > 0.4"),
    "marks": ("n_marks / n_words", "x < 0.3", "x > 0.8"),
    "variety": ("n_distinct / sqrt(n_words)", "x > 4", "x < 2"),
}
_SYMBOLS = np.zeros(256, bool)
_SYMBOLS[list(b"#*$%&|<>")] = True
_MARKS = np.zeros(256, bool)
_MARKS[list(b"!?;:.,")] = True
_CAPITAL = np.zeros(256, bool)
_CAPITAL[65:91] = True
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 9, 10, 11, 12, 13]] = True
MEASURES = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words",
            "n_capitals", "n_marks", "n_distinct")


def measures(data: np.ndarray, off: np.ndarray) -> list[np.ndarray]:
    """MEASURES of each text of a chunk."""
    n = len(off) - 1
    row, start, end, h = words(data, off, lower=False)
    n_words = np.bincount(row, minlength=n)
    chars = end - start - counts_at((data & 0xC0) == 0x80, start, end)
    word_chars = row_sums(row, chars.astype(np.int64), n)
    symbols, capitals, marks = (counts_at(m[data], off[:-1], off[1:])
                                for m in (_SYMBOLS, _CAPITAL, _MARKS))
    lr, ls, le = lines(data, off)
    full = counts_at(~_SPACE[data], ls, le) > 0
    lr, ls, le = lr[full], ls[full], le[full]
    earlier, _ = seen_before(lr, span_hashes(data, ls, le))
    dup_lines = np.bincount(lr[earlier], minlength=n)
    g = grams(h, WINDOW)
    at = np.flatnonzero(row[:len(g)] == row[WINDOW - 1:]) if len(g) else np.zeros(0, np.int64)
    _, twice = seen_before(row[at], g[at])
    cover = np.zeros(len(row) + 1, np.int64)
    np.add.at(cover, at[twice], 1)
    np.add.at(cover, at[twice] + WINDOW, -1)
    repeat = np.bincount(row[np.cumsum(cover[:-1]) > 0], minlength=n)
    first, _ = seen_before(row, h)
    distinct = np.bincount(row[~first], minlength=n)
    return [n_words, word_chars, symbols, np.bincount(lr, minlength=n), dup_lines, repeat,
            capitals, marks, distinct]


def _measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for lo, hi, data, off in chunks(b.column(1)):
            yield pa.RecordBatch.from_arrays(
                [b.column(0).slice(lo, hi - lo),
                 *[pa.array(np.asarray(x, np.int64)) for x in measures(data, off)]],
                ["doc_id", *MEASURES])


def estimate(votes: np.ndarray, weight: np.ndarray, rounds: int = 200,
             trust: float = 0.9) -> tuple[float, np.ndarray, np.ndarray]:
    """EM on vote patterns (1 good, 0 bad, -1 abstain) with their counts:
    (share of good documents, [rule, vote] accuracy of bad and good votes,
    posterior of quality per pattern).

    Rules about different kinds of damage seldom agree on a document, so
    votes alone leave accuracies open; the estimate is therefore the mode
    under a prior: before the data, a vote is right with probability
    ``trust``, and this counts as much as the rule's votes do. Abstaining says
    nothing about a document. Whatever the data, a vote never speaks against
    its own direction.
    """
    told = np.stack([votes == 0, votes == 1], axis=2).astype(float)
    n = np.einsum("i,ijv->jv", weight, told)
    post = np.where((votes == 0).any(axis=1), 1 - trust, trust)
    prior = np.array([1 - trust, trust])  # of a good document, given the vote
    share, good = trust, np.zeros_like(n)
    for _ in range(rounds):
        good = (np.einsum("i,ijv->jv", weight * post, told) + prior * (n + 1)) / (2 * n + 1)
        share = float(np.clip((weight @ post + 1) / (weight.sum() + 2), 0.02, 0.98))
        base = np.log(share / (1 - share))
        ratio = np.log(good / (1 - good)) - base  # what the vote adds to the odds
        ratio[:, 0] = np.minimum(ratio[:, 0], 0)
        ratio[:, 1] = np.maximum(ratio[:, 1], 0)
        new = 1 / (1 + np.exp(-np.clip(base + np.einsum("ijv,jv->i", told, ratio), -700, 700)))
        done = np.abs(new - post).max(initial=0) < 1e-9
        post = new
        if done:
            break
    return share, np.stack([1 - good[:, 0], good[:, 1]], axis=1), post


def judge(docs: DataFrame, keep_from: float = KEEP_FROM) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): doc_id, n_words, word_chars,
    n_symbols, n_dup_lines, n_repeat_words, base_failed, quality (posterior),
    kept.

    A null or empty text has no words; its rules abstain and it fails the
    base. ``kept`` is false where the base fails, else quality >=
    ``keep_from``. Equal texts get equal results, also when rows repeat;
    no rows give no rows. Other columns are ignored.
    """
    rows = map_arrow(docs.select("doc_id", "text"), _measured,
                     "doc_id long, " + ", ".join(f"{m} long" for m in MEASURES))
    rules = [f"(CASE WHEN n_words = 0 THEN -1 WHEN {good.replace('x', f'({m})')} THEN 1 "
             f"WHEN {bad.replace('x', f'({m})')} THEN 0 ELSE -1 END)"
             for m, good, bad in RULES.values()]
    pattern = " + ".join(f"{3 ** i} * (1 + {r})" for i, r in enumerate(rules))
    rows = keep(rows.withColumn("pattern", F.expr(pattern).cast("int")))
    failed = (F.col("n_words") < MIN_WORDS) | (
        100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    # texts that fail the base are not the rules' to judge, nor to learn from
    seen = (rows.groupBy("pattern").agg(F.count_if(~failed).alias("c"))
            .orderBy("pattern").collect())
    codes = np.array([r.pattern for r in seen], dtype=np.int64)
    weight = np.array([r.c for r in seen], dtype=float)
    votes = codes[:, None] // 3 ** np.arange(len(RULES))[None, :] % 3 - 1
    _, _, post = estimate(votes, weight)
    spark = docs.sparkSession
    table = spark.createDataFrame(
        [(int(c), float(p)) for c, p in zip(codes, post, strict=True)],
        "pattern int, quality double")
    rows = rows.join(F.broadcast(table), "pattern")  # at most 3^rules rows
    return rows.select(
        "doc_id", *[m for m in MEASURES[:6] if m != "n_lines"], failed.alias("base_failed"),
        "quality", (~failed & (F.col("quality") >= keep_from)).alias("kept"))
