"""Operator 8: line deduplication over the suffix order of line ids, built by
distributed prefix doubling.

The corpus is one sequence of lines (those with a word) per document. Round
k ranks the runs of 2^k lines that occur twice or more: a run of twice the
length is the pair of two ranks, its rank the rank of its first half plus the
runs before it that share that half. Suffixes whose run has become unique
leave, so later rounds are as small as the repetition in the corpus.

Suffixes that agree on their first l lines form an interval of the suffix
order with a longest common prefix of at least l. A run is worth deleting
from ``min_words`` words on. Windows are the runs that lose this size if their
last line is taken away, and those that lose it if their first line is: at most
two per line, the lengths at one start are consecutive, and equal runs are
windows alike. The interval at a window's length is named by two overlapping
ranks; its first member in document order stays, every other one is deleted.
A maximal repeated run is the union of such windows: the one at its start and,
for each later line, the shortest one that ends there.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pulsehouse.llm.common import (BROADCAST_ROWS, blocks_for, keep_sized, map_arrow,
                                  running_totals)
from pulsehouse.llm.textkit import chunks, lines, span_hashes, words

MIN_WORDS = 50


def _line_words(data: np.ndarray, off: np.ndarray):
    """(row, start, end, words) of all lines of a chunk."""
    row, start, end = lines(data, off)
    _, ws, _, _ = words(data, off, hashed=False)
    return row, start, end, np.searchsorted(ws, end) - np.searchsorted(ws, start)


def _rows(min_words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids, key = b.column(0), b.column(1)
            for lo, hi, data, off in chunks(b.column(2)):
                row, start, end, n = _line_words(data, off)
                full = n > 0
                row, start, end, n = row[full], start[full], end[full], n[full]
                if not len(row):
                    continue
                count = np.bincount(row, minlength=hi - lo)
                first = np.cumsum(count) - count
                total = np.concatenate([[0], np.cumsum(n)])
                # lines until min_words words are reached, 0 if the text ends before
                to = np.searchsorted(total, total[:-1] + min_words, side="left")
                at, last = np.arange(len(row)), (first + count)[row]
                depth = np.where(to <= last, to - at, 0)
                # longer windows: as long as the lines after the first have too few words
                upto = np.where(to <= last, np.maximum(to, np.minimum(np.append(to[1:], len(row)) - 1,
                                                                      last)) - at, 0)
                take = pa.array(row + lo)
                yield pa.RecordBatch.from_arrays(
                    [ids.take(take), key.take(take), pa.array(at - first[row]),
                     pa.array(span_hashes(data, start, end).view(np.int64)), pa.array(depth),
                     pa.array(upto)],
                    ["doc_id", "d", "i", "h", "depth", "upto"])

    return run


def _small(df: DataFrame, n: int) -> DataFrame:
    return F.broadcast(df) if n <= BROADCAST_ROWS else df


def _first_ranks(rows: DataFrame) -> DataFrame:
    """Rows of lines that occur at two places, with the rank of the line."""
    counts, n = keep_sized(rows.groupBy("h").agg(F.count("*").alias("c")).filter("c > 1"))
    blocks = blocks_for(n)
    span = F.floor((F.shiftrightunsigned("h", 1) / F.lit(float(1 << 63))) * blocks).cast("int")
    ranks = running_totals(counts.withColumn("b", span), [], "b", [F.shiftrightunsigned("h", 1), "h"],
                           "c", "rank")
    return rows.join(_small(ranks.select("h", "rank"), n), "h").drop("h")


def _double(cur: DataFrame, length: int) -> DataFrame:
    """Ranks of the repeated runs of twice ``length`` lines."""
    nxt = cur.select("d", (F.col("i") - length).alias("i"), F.col("rank").alias("second"))
    pairs, _ = keep_sized(cur.join(nxt, ["d", "i"]))
    kinds, n = keep_sized(pairs.groupBy("rank", "second").agg(F.count("*").alias("c"))
                          .filter("c > 1"))
    if n <= BROADCAST_ROWS:  # few enough to rank without blocks
        w = Window.partitionBy("rank").orderBy("second").rowsBetween(Window.unboundedPreceding, -1)
        kinds = kinds.withColumn("before", F.coalesce(F.sum("c").over(w), F.lit(0)))
    else:
        kinds = kinds.withColumn("b", F.floor(F.col("second") / 20_000))
        kinds = running_totals(kinds, ["rank"], "b", ["second"], "c", "before")
    kinds = kinds.select("rank", "second", (F.col("rank") + F.col("before")).alias("new"))
    return pairs.join(_small(kinds, n), ["rank", "second"]).select(
        "doc_id", "d", "i", "depth", "upto", F.col("new").alias("rank"))


def repeated_runs(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """d (hash of id and text), i (line with a word, from 0), depth: runs of
    ``depth`` lines that are later copies of an equal run."""
    rows = map_arrow(docs.select("doc_id", F.xxhash64("doc_id", "text").alias("d"), "text"),
                     _rows(min_words), "doc_id long, d long, i long, h long, depth long, upto long")
    # a row given twice is one document
    cur, _ = keep_sized(_first_ranks(rows).dropDuplicates(["d", "i"]))
    found, length = None, 1
    while True:
        here = cur.filter((F.col("depth") > 0) & (F.col("depth") < 2 * length)
                          & (F.col("upto") >= length)).withColumn("depth", F.explode(F.sequence(
                              F.greatest("depth", F.lit(length)),
                              F.least("upto", F.lit(2 * length - 1))))).drop("upto")
        tail = cur.select(F.col("d").alias("td"), F.col("i").alias("ti"), F.col("rank").alias("tail"))
        ends, _ = keep_sized(here.join(tail, (F.col("d") == F.col("td"))
                                       & (F.col("i") + F.col("depth") - length == F.col("ti")))
                             .drop("td", "ti"))
        place = F.struct(F.col("doc_id").isNull(), "doc_id", "d", "i")
        first, n = keep_sized(ends.groupBy("rank", "tail", "depth")
                              .agg(F.min(place).alias("first"), F.count("*").alias("c"))
                              .filter("c > 1")
                              .select("rank", "tail", "depth", F.col("first.d").alias("fd"),
                                      F.col("first.i").alias("fi")))
        later, _ = keep_sized(ends.join(_small(first, n), ["rank", "tail", "depth"])
                              .filter("NOT (d = fd AND i = fi)").select("d", "i", "depth"))
        found = later if found is None else found.unionByName(later)
        if not cur.filter(F.col("upto") >= 2 * length).limit(1).count():
            return found
        cur, _ = keep_sized(_double(cur, length))
        length *= 2


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts without their deleted lines."""
    for b in batches:
        starts, depths = b.column(1), b.column(2)
        for lo, hi, data, off in chunks(b.column(3)):
            row, start, end, n = _line_words(data, off)
            full = np.flatnonzero(n > 0)
            count = np.bincount(row[full], minlength=hi - lo)
            first = np.cumsum(count) - count
            gone = np.zeros(len(full) + 1, np.int64)
            at, by = starts.slice(lo, hi - lo), depths.slice(lo, hi - lo)
            size = np.array([len(x) if x is not None else 0 for x in at.to_pylist()])
            base = np.repeat(first, size)
            s = base + np.array(at.flatten(), np.int64)
            np.add.at(gone, s, 1)
            np.add.at(gone, s + np.array(by.flatten(), np.int64), -1)
            drop = np.zeros(len(row), bool)
            drop[full] = np.cumsum(gone[:-1]) > 0
            raw = data.tobytes()
            texts, runs = [], []
            edge = np.searchsorted(row, np.arange(hi - lo + 1))
            for r in range(hi - lo):
                a, z = edge[r], edge[r + 1]
                d = drop[a:z]
                if not d.any():
                    texts.append(raw[off[r]:off[r + 1]].decode("utf-8", "replace"))
                    runs.append("")
                    continue
                keep_ = np.flatnonzero(~d) + a
                texts.append(b"\n".join([raw[start[k]:end[k]] for k in keep_])
                             .decode("utf-8", "replace"))
                step = np.diff(np.concatenate([[0], d.astype(np.int8), [0]]))
                runs.append(",".join(f"{x}-{y}" for x, y in zip(
                    np.flatnonzero(step == 1), np.flatnonzero(step == -1), strict=True)))
            yield pa.RecordBatch.from_arrays(
                [b.column(0).slice(lo, hi - lo), pa.array(np.bincount(row, minlength=hi - lo)),
                 pa.array(np.bincount(row[drop], minlength=hi - lo)),
                 pa.array(np.bincount(row, weights=n * drop, minlength=hi - lo).astype(np.int64)),
                 pa.array(runs, pa.string()), pa.array(texts, pa.string())],
                ["doc_id", "n_lines", "n_deleted", "deleted_words", "runs", "text"])


def dedup_lines(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    r"""Per row of ``docs`` (doc_id, text): doc_id, n_lines (\n-split),
    n_deleted, deleted_words, runs (deleted "start-end" line ranges, from 0,
    end exclusive, comma-joined) and text without the deleted lines.

    A run is deleted if it has ``min_words`` words or more and an equal run
    stands earlier: in a smaller doc_id (null last, then by a hash), or
    earlier in the text. Lines without a word belong to no run and stay.
    A null text counts as one empty line and comes back empty. Rows equal in
    id and text are one document and get equal results. No rows give none;
    other columns are ignored.
    """
    runs = (repeated_runs(docs, min_words).groupBy("d")
            .agg(F.collect_list(F.struct("i", "depth")).alias("x"))
            .select(F.col("d").alias("key"), F.col("x.i").alias("at"), F.col("x.depth").alias("by")))
    rows = docs.select("doc_id", "text", F.xxhash64("doc_id", "text").alias("key"))
    none = F.array().cast("array<long>")
    rows = rows.join(runs, "key", "left").select(
        "doc_id", F.coalesce("at", none).alias("at"), F.coalesce("by", none).alias("by"), "text")
    return map_arrow(rows, _cut, "doc_id long, n_lines long, n_deleted long, deleted_words long, "
                                 "runs string, text string")
