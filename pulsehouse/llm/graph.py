"""Connected components by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsehouse.llm.common import keep


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Large star: link every larger neighbour of u to the smallest of u's
    closed neighbourhood. Small star: link u and its smaller neighbours."""
    if large:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    else:
        both = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = both.groupBy("u").agg(F.min("v").alias("m"))
    least = least.select(F.col("u").alias("c"), F.least("u", "m").alias("m"))
    near = both.join(least, both.u == least.c)
    if large:
        out = near.filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        out = near.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
            least.select(F.col("c").alias("u"), F.col("m").alias("v")))
    return out.filter("u <> v").distinct()


def components(edges: DataFrame) -> DataFrame:
    """``edges`` (u, v: long) -> (node, root): root is the smallest node
    reachable. Nodes without an edge do not appear; null ends are dropped.

    Rounds grow with the logarithm of the longest path. Each is a few
    shuffles of the edges, checkpointed; the group minimum is combined on the
    map side, so a hub with a third of the edges is a skewed join at most,
    which the adaptive planner splits. Repeated edges, self-links and an
    empty table are fine.
    """
    cur = keep(edges.select("u", "v").filter("u <> v").distinct())
    seen = None
    while True:
        nxt = keep(_star(_star(cur, large=True), large=False))
        mark = nxt.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v")),
                       F.sum(F.xxhash64("v", "u").cast("decimal(38,0)"))).first()
        if mark == seen:
            break
        seen, cur = mark, nxt
    pairs = cur.select(F.col("u").alias("node"), F.col("v").alias("root"))
    roots = pairs.select(F.col("root").alias("node"), "root").distinct()
    return pairs.unionByName(roots)
