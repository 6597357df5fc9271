"""Sessions from raw events (STR-6, batch form).

A session starts with an ``app_open``, or with an event more than ``gap``
after the user's previous one (exactly ``gap`` stays in the session, as
``session_window`` does).

Both forms key events by (user, event-time bucket), so that a hot user is
never one task and no row is copied. Inside a bucket a window ordered by time
finds the starts, except that the bucket's first event may go on a session of
an earlier bucket.

* ``derived_sessions``: the pieces of sessions inside each bucket (start, end,
  count) are stitched per user by time; one scan, no join.
* ``sessionize``: each event with its session number; the number of sessions
  before each bucket, from one row per (user, bucket), is joined back.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pulsehouse import config
from pulsehouse.operators.split import bucket_of

_T = "_t_us"
_B = "_bucket"


def _starts(events: DataFrame, gap_sec: int, bucket_sec: int, user: str) -> DataFrame:
    """Events with time, bucket and ``_start``: 1 where a session certainly
    starts; a bucket's first event that is no app_open is left open (0)."""
    gap_us = gap_sec * 1_000_000
    e = (
        events.where(F.col(user).isNotNull() & F.col("ts").isNotNull())
        .withColumn(_T, F.unix_micros("ts"))
        .withColumn(_B, bucket_of(_T, bucket_sec * 1_000_000))
    )
    prev = F.lag(_T).over(_in_bucket(user))
    opens = F.coalesce(F.col("event_type") == "app_open", F.lit(False))
    later = F.coalesce(F.col(_T) - prev > gap_us, F.lit(False))
    return e.withColumn("_start", F.when(opens | later, 1).otherwise(0))


def _in_bucket(user: str):
    return Window.partitionBy(user, _B).orderBy(_T, "event_id")


def _so_far(user: str):
    return F.sum("_start").over(_in_bucket(user).rowsBetween(Window.unboundedPreceding, 0))


def derived_sessions(
    events: DataFrame,
    gap_sec: int = config.SESSION_GAP_SEC,
    bucket_sec: int = config.DEFAULT_SCALE.split_bucket_sec,
    user: str = "user_id",
    start: str | None = None,
    weight: str | None = None,
    mark_last: bool = False,
) -> DataFrame:
    """One row per session of raw events: user, session_seq (1, 2, ... per
    user), s_start, s_end, s_events; with ``mark_last`` also is_last (of its
    user). A row may stand for the end of a stretch of events: ``start`` names the
    column with its first time, ``weight`` that with its number of events."""
    e = _starts(events, gap_sec, bucket_sec, user).withColumn("_piece", _so_far(user))
    pieces = e.groupBy(user, _B, "_piece").agg(
        F.min(_T).alias("_first_t"), F.max(_T).alias("_last_t"),
        (F.sum(weight) if weight else F.count(F.lit(1))).alias("_n"),
        (F.min(F.unix_micros(start)) if start else F.min(_T)).alias("_start_t"))
    wu = Window.partitionBy(user).orderBy(_B, "_piece")
    prev_last = F.lag("_last_t").over(wu)
    starts = (F.col("_piece") > 0) | prev_last.isNull() \
        | (F.col("_first_t") - prev_last > gap_sec * 1_000_000)
    pieces = pieces.withColumn("_new", F.when(starts, 1).otherwise(0))
    pieces = pieces.withColumn("session_seq", F.sum("_new").over(
        wu.rowsBetween(Window.unboundedPreceding, 0)).cast("bigint"))
    last = []
    if mark_last:
        later = wu.rowsBetween(1, Window.unboundedFollowing)
        pieces = pieces.withColumn("_more", F.coalesce(F.sum("_new").over(later), F.lit(0)))
        last = [(F.min("_more") == 0).alias("is_last")]
    return pieces.groupBy(user, "session_seq").agg(
        F.timestamp_micros(F.min("_start_t")).alias("s_start"),
        F.timestamp_micros(F.max("_last_t")).alias("s_end"),
        F.sum("_n").alias("s_events"),
        *last,
    )


def sessionize(
    events: DataFrame,
    gap_sec: int = config.SESSION_GAP_SEC,
    bucket_sec: int = config.DEFAULT_SCALE.split_bucket_sec,
    user: str = "user_id",
) -> DataFrame:
    """Events with ``session_seq`` (1, 2, ... per user, in time order) and
    ``derived_session_id`` = ``{user}_{seq}``."""
    gap_us = gap_sec * 1_000_000
    e = _starts(events, gap_sec, bucket_sec, user).withColumn("_piece", _so_far(user))
    per_bucket = e.groupBy(user, _B).agg(
        F.min(_T).alias("_first_t"),
        F.max(_T).alias("_last_t"),
        F.min("_piece").alias("_opened"),
        F.sum("_start").alias("_inner"),
    )
    wu = Window.partitionBy(user).orderBy(_B)
    prev_last = F.lag("_last_t").over(wu)
    # The bucket's first event starts a session without being an app_open.
    first = F.when((F.col("_opened") == 0)
                   & (prev_last.isNull() | (F.col("_first_t") - prev_last > gap_us)), 1).otherwise(0)
    per_bucket = per_bucket.withColumn("_extra", first)
    before = F.sum(F.col("_extra") + F.col("_inner")).over(
        wu.rowsBetween(Window.unboundedPreceding, -1))
    per_bucket = per_bucket.select(user, _B, "_extra",
                                   F.coalesce(before, F.lit(0)).alias("_before"))
    seq = (F.col("_before") + F.col("_extra") + F.col("_piece")).cast("bigint")
    out = e.join(per_bucket, [user, _B], "inner").withColumn("session_seq", seq)
    return out.select(
        *events.columns,
        "session_seq",
        F.concat_ws("_", F.col(user).cast("string"), F.col("session_seq").cast("string"))
        .alias("derived_session_id"),
    )
