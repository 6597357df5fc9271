"""Operator 5: quality selection by importance resampling.

Words and word pairs are hashed into buckets; one bag model is counted over
the target texts (labelled good and not toxic), one over all texts. A
document's log importance weight is the sum of its buckets' log ratios, and
the documents are drawn without replacement in proportion to it: Gumbel noise
is added to the log weight and the k largest sums are kept. The k-th largest
is found exactly by narrowing counts, not by sorting on one machine.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsehouse.llm.common import bounded, keep, map_arrow
from pulsehouse.llm.textkit import chunks, grams, words

BUCKETS = 1 << 14
FRACTION = 0.8
SMOOTHING = 0.5
BINS = 4096


def _buckets(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, bucket) of all words and word pairs."""
    row, _, _, h = words(data, off)
    pair = grams(h, 2)
    same = row[:len(pair)] == row[1:] if len(pair) else np.zeros(0, bool)
    mask = np.uint64(BUCKETS - 1)
    return (np.concatenate([row, row[:len(pair)][same]]),
            np.concatenate([h & mask, pair[same] & mask]).astype(np.int64))


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Bucket counts of a whole partition: raw, and of the target rows."""
    raw, target = np.zeros(BUCKETS, np.int64), np.zeros(BUCKETS, np.int64)
    for b in batches:
        good = np.array(b.column(0).to_numpy(zero_copy_only=False), bool)
        for lo, hi, data, off in chunks(b.column(1)):
            row, bucket = _buckets(data, off)
            raw += np.bincount(bucket, minlength=BUCKETS)
            target += np.bincount(bucket[good[lo:hi][row]], minlength=BUCKETS)
    some = np.flatnonzero(raw)
    yield pa.RecordBatch.from_arrays(
        [pa.array(some), pa.array(raw[some]), pa.array(target[some])], ["bucket", "raw", "target"])


def _weigh(ratio):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo, hi, data, off in chunks(b.column(2)):
                row, bucket = _buckets(data, off)
                total = np.bincount(row, weights=ratio.value[bucket], minlength=hi - lo)
                count = np.bincount(row, minlength=hi - lo)
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(lo, hi - lo), b.column(1).slice(lo, hi - lo),
                     pa.array(count.astype(np.int64)), pa.array(total)],
                    ["doc_id", "u", "n_grams", "log_weight"])
    return run


def kth_largest(rows: DataFrame, col: str, k: int, collect_to: int = 20_000) -> float:
    """The k-th largest value of a column without nulls (1 <= k <= rows).
    Each round counts BINS equal bins of the range that holds it; the last
    few rows, or one value however often it repeats, settle it."""
    lo, hi = rows.agg(F.min(col), F.max(col)).first()
    if lo == hi:
        return lo
    inside, left = rows, k
    while True:
        width = (hi - lo) / BINS
        if width <= 0 or lo + width == lo:
            return lo
        b = F.least(F.floor((F.col(col) - lo) / width), F.lit(BINS - 1)).cast("int")
        inside = inside.withColumn("__b", b)
        got = inside.groupBy("__b").agg(F.count("*").alias("n"), F.min(col).alias("lo"),
                                        F.max(col).alias("hi")).orderBy(F.desc("__b")).collect()
        for r in got:  # at most BINS rows
            if left <= r.n:
                break
            left -= r.n
        if r.lo == r.hi:
            return r.lo
        inside = inside.filter(F.col("__b") == r["__b"]).select(col)
        if r.n <= collect_to:
            return sorted((x[0] for x in inside.collect()), reverse=True)[left - 1]
        inside, lo, hi = keep(inside), r.lo, r.hi


def resample(docs: DataFrame, labels: DataFrame, fraction: float = FRACTION,
             seed: int = 5) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): doc_id, n_grams, log_weight, score
    (log weight plus Gumbel noise) and kept: whether it is among the
    ceil(fraction * rows) largest scores.

    ``labels`` has doc_id, quality and toxic; a document with several labels
    is a target if all say so. Without any target text the weights are 0 and
    the draw is uniform. The noise depends on id and text, so reruns agree
    and repeated rows share their fate (also at the boundary, where they may
    exceed k). Null and empty texts weigh 0. No rows give no rows.
    """
    spark = docs.sparkSession
    good = (labels.filter("doc_id IS NOT NULL").groupBy("doc_id").agg(F.min(
        F.expr("coalesce(quality = 1 AND coalesce(toxic, 0) = 0, false)")).alias("good"))
        .filter("good"))
    marked = docs.select("doc_id", "text").join(bounded(keep(good)), "doc_id", "left")
    counted = map_arrow(marked.select(F.coalesce("good", F.lit(False)).alias("good"), "text"),
                        _count, "bucket long, raw long, target long")
    raw, target = np.zeros(BUCKETS), np.zeros(BUCKETS)
    for r in counted.groupBy("bucket").agg(F.sum("raw"), F.sum("target")).collect():
        raw[r[0]], target[r[0]] = r[1], r[2]  # BUCKETS rows at most
    ratio = np.zeros(BUCKETS)
    if target.sum():
        ratio = (np.log((target + SMOOTHING) / (target.sum() + SMOOTHING * BUCKETS))
                 - np.log((raw + SMOOTHING) / (raw.sum() + SMOOTHING * BUCKETS)))
    shared = spark.sparkContext.broadcast(ratio)
    u = (F.pmod(F.xxhash64("doc_id", "text", F.lit(seed)), F.lit(1 << 53)) + 0.5) / float(1 << 53)
    rows = map_arrow(docs.select("doc_id", u.alias("u"), "text"), _weigh(shared),
                     "doc_id long, u double, n_grams long, log_weight double")
    rows = keep(rows.withColumn("score", F.col("log_weight") - F.log(-F.log("u"))))
    n = rows.count()
    k = math.ceil(fraction * n)
    least = kth_largest(rows.select("score"), "score", k) if 0 < k <= n else math.inf
    return rows.select("doc_id", "n_grams", "log_weight", "score",
                       (F.col("score") >= F.lit(least)).alias("kept"))
