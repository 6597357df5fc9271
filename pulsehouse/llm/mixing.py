"""Operator 2: mixing sources to target weights along a curriculum.

Each source's share of the mix is a target number of words; a schedule says
how its weight moves over training (the integral over training is the
target). A source's documents, in a seeded order, lie one after another on
the line of its words; repeats go on where the last pass ended; what lies
beyond the target is not taken. Inverting the source's cumulative demand at
a document's place on that line gives its training position, and a range
sort by position gives the order of training.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pulsehouse.llm.common import WORD, blocks_for, keep, running_totals

WEIGHTS = (1.0, 2.0, 3.0)
MAX_REPEATS = 3
# Weight of a source along training, relative to its mean: (place, factor)
# knots, joined linearly. Sources take the curves in turn.
CURVES = (((0.0, 1.4), (1.0, 0.6)), ((0.0, 1.0), (1.0, 1.0)), ((0.0, 0.6), (0.5, 0.8), (1.0, 1.8)))
SEED = 2


def sizes(docs: DataFrame) -> DataFrame:
    """doc_id, source, key and size in words per row."""
    n = F.regexp_count(F.coalesce("text", F.lit("")), F.lit(WORD)).cast("long")
    return docs.select("doc_id", "source", F.xxhash64("doc_id", "text").alias("key"),
                       n.alias("size"))


def targets(sized: DataFrame, weights: tuple[float, ...] = WEIGHTS,
            max_repeats: int = MAX_REPEATS) -> DataFrame:
    """source, source_size, target, place (rank by code point, null last).

    One row per source. Sharing the excess again and again ends where every
    target is min(cap, level * weight): sources are sorted by cap / weight,
    and the level is the first at which those before are capped and the rest
    share what remains.
    """
    s = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    w = F.array(*[F.lit(float(x)) for x in weights])
    s = s.withColumn("place", F.row_number().over(by_name) - 1).withColumn(
        "weight", F.get(w, F.pmod(F.col("place"), F.lit(len(weights)))))
    s = s.withColumn("cap", F.col("source_size") * max_repeats)
    everything = Window.partitionBy(F.lit(0))
    by_ratio = everything.orderBy(F.col("cap") / F.col("weight"), "place")
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    s = s.select("*", F.sum("source_size").over(everything).alias("total"),
                 F.coalesce(F.sum("cap").over(before), F.lit(0)).alias("capped"),
                 F.sum("weight").over(by_ratio.rowsBetween(0, Window.unboundedFollowing))
                 .alias("open"))
    s = s.withColumn("level", (F.col("total") - F.col("capped")) / F.col("open"))
    fits = F.when(F.col("level") * F.col("weight") <= F.col("cap"), F.col("level"))
    s = s.withColumn("level", F.max(fits).over(everything))
    return s.select("source", "source_size", "place", F.least(
        F.col("cap").cast("double"), F.coalesce(F.col("level") * F.col("weight"),
                                                F.col("cap").cast("double"))).alias("target"))


def _segments(curves) -> str:
    """SQL array, per curve, of segments (t0, t1, w0, w1, d0): the integral d0
    up to t0 is normalised to 1 over the whole curve."""
    out = []
    for knots in curves:
        area = sum((b[0] - a[0]) * (a[1] + b[1]) / 2 for a, b in zip(knots, knots[1:], strict=False))
        done, segs = 0.0, []
        for (t0, w0), (t1, w1) in zip(knots, knots[1:], strict=False):
            segs.append(f"struct({t0}D AS t0, {t1}D AS t1, {w0 / area!r}D AS w0, "
                        f"{w1 / area!r}D AS w1, {done!r}D AS d0)")
            done += (t1 - t0) * (w0 + w1) / 2 / area
        out.append(f"array({', '.join(segs)})")
    return f"array({', '.join(out)})"


# Time at which a share q of the source's words is demanded: in the segment of
# q, w0 x + (w1 - w0) x^2 / (2 T) = q - d0 is solved for x.
_INVERT = """
transform(array(element_at(filter(segs, s -> s.d0 <= q), -1)), s ->
  least(s.t1, s.t0 + 2D * (q - s.d0) /
    greatest(1e-300D, s.w0 + sqrt(greatest(0D, s.w0 * s.w0
                          + 2D * (s.w1 - s.w0) / (s.t1 - s.t0) * (q - s.d0))))))[0]
"""


def plan(docs: DataFrame, curves=CURVES, seed: int = SEED) -> DataFrame:
    """doc_id, key, source, size, source_size, target, taken, at (place on
    the source's line of words), per row of ``docs`` (doc_id, text, source).

    ``taken`` counts words: whole passes, and of the document at which the
    target ends the words before it; so each source's sum is its target,
    rounded. No row takes more than MAX_REPEATS times its size. A null text
    has size 0 and is never taken; a null source is a source of its own, the
    last. Equal rows are interchangeable; no rows give no rows.
    """
    sized = keep(sizes(docs).withColumn("__h", F.xxhash64("key", F.lit(seed))))
    blocks = blocks_for(sized.count())
    sized = sized.withColumn("__block", F.pmod(F.xxhash64("__h"), F.lit(blocks)))
    t = targets(sized)
    line = running_totals(sized, ["source"], "__block", ["__h", "doc_id", "key"], "size", "at")
    t = t.withColumnRenamed("source", "__source")
    rows = line.join(t, F.col("source").eqNullSafe(F.col("__source")))
    goal = F.round("target").cast("long")
    passes = F.expr(" + ".join(
        f"least(size, greatest(0L, __goal - {k} * source_size - at))" for k in range(MAX_REPEATS)))
    return (rows.withColumn("__goal", goal).withColumn("taken", passes.cast("long"))
            .withColumn("segs", F.get(F.expr(_segments(curves)),
                                      F.pmod(F.col("place"), F.lit(len(curves)))))
            .drop("__source", "__h", "__block", "place"))


def mix(docs: DataFrame) -> DataFrame:
    """Per row of ``docs``: doc_id, size, source_size, target, taken, and
    first_position (of its first pass; null if never taken), range-sorted by
    that position."""
    rows = plan(docs).withColumn("words", F.expr("least(size, greatest(0L, __goal - at))"))
    rows = rows.withColumn("q", F.expr("(at + words / 2D) / nullif(__goal, 0)")).withColumn(
        "first_position", F.when(F.col("words") > 0, F.expr(_INVERT)))
    return (rows.select("doc_id", "size", "source_size", "target", "taken", "first_position", "key")
            .repartitionByRange("first_position", "key")
            .sortWithinPartitions("first_position", "key").drop("key"))


def positioned_documents(docs: DataFrame) -> DataFrame:
    """The documents of the mix, whole, one row per pass: all columns of
    ``docs``, __key and __position; in its last pass a document comes if at
    least half of it lies within the target."""
    passes = plan(docs).withColumn("pass", F.explode(F.expr(f"sequence(0, {MAX_REPEATS - 1})")))
    passes = passes.withColumn("words", F.expr(
        "least(size, greatest(0L, __goal - pass * source_size - at))"))
    passes = passes.filter("words > 0 AND 2 * words >= size").withColumn(
        "q", F.expr("(pass * source_size + at + words / 2D) / nullif(__goal, 0)"))
    passes = passes.select(F.col("key").alias("__key"), F.expr(_INVERT).alias("__position"))
    # rows equal in id and text have a place on the line each: one of them
    # meets all their passes
    return (docs.withColumn("__key", F.xxhash64("doc_id", "text")).dropDuplicates(["__key"])
            .join(passes, "__key"))


def mixed_documents(docs: DataFrame) -> DataFrame:
    """Pipeline form: ``positioned_documents`` range-sorted by position, with
    the columns of ``docs``. Written to files, part after part and row after
    row, they stand in training order (``common.file_order`` reads it back)."""
    return (positioned_documents(docs).repartitionByRange("__position", "__key")
            .sortWithinPartitions("__position", "__key").select(docs.columns))
