"""Windowed metrics on a stream (STR-2, STR-3, STR-4).

Counts and sums are partial aggregates in the state store. Distinct users
cannot be a plain ``count_distinct`` on a stream; two forms are given:

* exact - one stateful aggregation ``groupBy(window, dims, user_id)`` in
  append mode; all (window, user) rows of a window leave the state store
  in the same micro-batch (the one whose watermark closes it), so a
  ``foreachBatch`` count per window is exact (``WindowUserCounter``).
  One stateful operator keeps one state store and one watermark.
* approximate - ``approx_count_distinct`` (HyperLogLog++, fixed state per
  group).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulsehouse import config
from pulsehouse.functions import (
    count_if,
    is_c_long_stay,
    is_d1_instant_exit,
    is_e1_fast_swipe,
    is_type,
)


def _stream_counters() -> list[Column]:
    return [
        F.count(F.lit(1)).alias("n_events"),
        count_if(is_type("enter_item")).alias("pv"),
        count_if(is_type("like")).alias("likes"),
        count_if(is_type("fav")).alias("favs"),
        count_if(is_type("share")).alias("shares"),
        count_if(is_type("comment")).alias("comments"),
        count_if(is_type("follow")).alias("follows"),
        count_if(is_type("unfollow")).alias("unfollows"),
        count_if(is_type("dm")).alias("dms"),
        count_if(is_type("enter_profile")).alias("profile_visits"),
        count_if(is_type("leave_item")).alias("n_leave"),
        count_if(is_d1_instant_exit()).alias("d1_instant_exits"),
        count_if(is_e1_fast_swipe()).alias("e1_fast_swipes"),
        count_if(is_c_long_stay()).alias("c_long_stays"),
        F.sum(F.when(is_type("leave_item"), F.col("duration_sec"))).alias("stay_sum"),
        F.count(F.when(is_type("leave_item"), F.col("duration_sec"))).alias("stay_n"),
    ]


def day_window_start(time_zone: str) -> str:
    """``startTime`` that makes 1-day windows cut days at midnight in
    ``time_zone`` (a fixed-offset zone such as Asia/Shanghai; a zone whose
    offset changes over the year has days of other lengths and is refused)."""
    import datetime as _dt
    from zoneinfo import ZoneInfo

    zone = ZoneInfo(time_zone)
    offsets = {_dt.datetime(2024, m, 1, tzinfo=zone).utcoffset() for m in range(1, 13)}
    if len(offsets) > 1:
        raise ValueError(f"daily windows need a zone without daylight saving, not {time_zone}")
    off = offsets.pop()
    minutes = (-int(off.total_seconds()) // 60) % (24 * 60)
    return f"{minutes} minutes"


def _window(window: str, start_time: str | None):
    return F.window("ts", window, startTime=start_time) if start_time \
        else F.window("ts", window)


def stream_activity(
    enriched: DataFrame,
    window: str = config.WINDOW_5M,
    watermark: str = config.METRIC_WATERMARK,
    by: tuple[str, ...] = ("category",),
    start_time: str | None = None,
) -> DataFrame:
    """All count metrics per tumbling window (and ``by``), with watermark.
    In append mode a window is emitted once the watermark passes its end.
    Daily windows take ``start_time=day_window_start(zone)``."""
    return (
        enriched.withWatermark("ts", watermark)
        .groupBy(_window(window, start_time).alias("window"), *by)
        .agg(*_stream_counters())
    )


def stream_window_users(
    events: DataFrame,
    window: str = config.WINDOW_5M,
    watermark: str = config.METRIC_WATERMARK,
    by: tuple[str, ...] = (),
    only_type: str | None = None,
    start_time: str | None = None,
) -> DataFrame:
    """One row per (window, dims, user) once the window closes; the input
    of ``WindowUserCounter``. ``_hits`` counts the user's events of
    ``only_type`` (all events when None).

    The type is counted, not filtered: Catalyst pushes a filter that does
    not read the event time below ``withWatermark``, which would make the
    watermark follow only the filtered events and hold windows open.
    """
    hit = is_type(only_type) if only_type else F.lit(True)
    return (
        events.withWatermark("ts", watermark)
        .groupBy(_window(window, start_time).alias("window"), *by, "user_id")
        .agg(count_if(hit).alias("_hits"))
    )


class WindowUserCounter:
    """``foreachBatch``: distinct users per (window, dims) of the windows
    closed in this micro-batch (0 for a window without a hit), appended under ``batch_id=<n>`` (a replay
    overwrites its own folder)."""

    def __init__(self, path: str, by: tuple[str, ...] = (), name: str = "users"):
        self.path = path.rstrip("/")
        self.by = by
        self.name = name

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        hit = F.col("user_id").isNotNull() & (F.col("_hits") > 0)
        counts = batch.groupBy("window", *self.by).agg(F.count_if(hit).alias(self.name))
        counts.write.mode("overwrite").parquet(f"{self.path}/batch_id={batch_id}")


def stream_approx_users(
    events: DataFrame,
    window: str = config.WINDOW_5M,
    watermark: str = config.METRIC_WATERMARK,
    by: tuple[str, ...] = (),
    rsd: float = 0.05,
) -> DataFrame:
    """Approximate distinct users per window (fixed-size state)."""
    return (
        events.withWatermark("ts", watermark)
        .groupBy(F.window("ts", window).alias("window"), *by)
        .agg(F.approx_count_distinct("user_id", rsd).alias("approx_users"))
    )
