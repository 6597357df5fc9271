"""Splitting one hot key into many tasks for event-time rules.

Window functions partitioned by a key run each key in one task, and AQE
does not split skewed window partitions. Every rule in this library that
runs per key in event-time order only looks back a bounded time ``H``
(A1: the last 4 comments within 40 s; A2: 5 s of likes; session starts:
30 min). Such a rule is exact on a contiguous suffix of a key's history
that reaches ``H`` back, so the key can be cut by event-time bucket:

* every row goes to its bucket ``floor(t / B)``;
* rows in the last ``H`` of a bucket are also copied into the next bucket
  as read-only ``halo`` rows;
* the rule is evaluated per (key, bucket) and only own rows are kept.

A key holding a third of all rows is spread over (time span / B) tasks;
the copied share is at most H / B of the rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BUCKET = "_bucket"
HALO = "_halo"


def time_split(df: DataFrame, t: str, bucket: int, halo: int) -> DataFrame:
    """Add ``_bucket`` and ``_halo`` to ``df`` by the integer time column
    ``t``; ``bucket`` and ``halo`` are in the unit of ``t``."""
    if bucket <= 0 or halo < 0 or halo > bucket:
        raise ValueError("need 0 <= halo <= bucket and bucket > 0")
    own = bucket_of(t, bucket)
    next_start = (own + 1) * F.lit(bucket)
    buckets = F.when(
        F.col(t) >= next_start - F.lit(halo), F.array(own, own + 1)
    ).otherwise(F.array(own))
    return df.withColumn("_own_bucket", own).withColumn(BUCKET, F.explode(buckets)).withColumn(
        HALO, F.col(BUCKET) != F.col("_own_bucket")
    ).drop("_own_bucket")


def deal(df: DataFrame, *keys: str) -> DataFrame:
    """``df`` shuffled by ``keys`` into all shuffle partitions of the session.
    Left to itself, adaptive execution merges them by their compressed bytes
    into as few tasks as there are cores, and each then sorts a share of the
    rows, some ten times as large, that grows with the input."""
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(n, *keys)


def bucket_of(t: str, bucket: int) -> Column:
    """floor(t / bucket) for the integer column ``t``, in exact integer
    arithmetic (a double division can round a time just below a bucket
    boundary into the next bucket); correct for t < 0 too."""
    return F.expr(f"(`{t}` - pmod(`{t}`, {int(bucket)})) div {int(bucket)}")


def own_rows() -> Column:
    return ~F.col(HALO)
