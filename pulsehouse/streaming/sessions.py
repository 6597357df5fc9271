"""Sessions on a stream (STR-6) without a Python worker, in event-time order
(``streaming.ordered``): what is released joins the open sessions.

Beside the pending events there is one more table per batch, the sessions it
knows: closed ones become the batch's result, open ones (start, last time,
number of events per user) go on. Released events and open sessions meet by the
batch rules (``operators.sessions``: split by (user, event-time bucket), no
user is one task).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pulsehouse import config
from pulsehouse.functions import is_type
from pulsehouse.operators.sessions import derived_sessions
from pulsehouse.streaming.enrichment import last_batch, move_path, path_exists, remove_path
from pulsehouse.streaming.ordered import OrderedBatches, interval_us, read_mark

_ROWS = ("user_id bigint, event_id string, event_type string, ts timestamp, first_ts timestamp, "
         "events bigint")
_SESSIONS = "user_id bigint, s_events bigint, s_start timestamp, s_end timestamp"


def _open(spark: SparkSession, state: str, batch_id: int) -> DataFrame:
    """Open sessions as one row each at their last time, which is before every
    event still to come."""
    path = f"{state}/sessions/batch_id={batch_id}/closed=false"
    if not path_exists(spark, path):
        return spark.createDataFrame([], _ROWS)
    return spark.read.schema(_SESSIONS).parquet(path).select(
        "user_id", F.lit(None).cast("string").alias("event_id"), F.lit("other").alias("event_type"),
        F.col("s_end").alias("ts"), F.col("s_start").alias("first_ts"),
        F.col("s_events").alias("events"))


class SessionWriter(OrderedBatches):
    """``foreachBatch``: sessions that closed in this micro-batch, appended to
    ``path`` under ``batch_id=<n>`` (user_id, s_events, s_start, s_end).

    A session starts with an ``app_open`` or after more than ``gap`` without
    an event. The watermark follows the latest event by ``watermark`` and
    ``gap``, so an event is late only once its session could be closed. Events
    without a user or a time belong to no session but move the watermark.
    """

    def __init__(self, path: str, state: str, gap: str = f"{config.SESSION_GAP_SEC} seconds",
                 watermark: str = config.METRIC_WATERMARK):
        self.gap_us = interval_us(gap)
        super().__init__(path, state, interval_us(watermark) + self.gap_us)

    def rows(self, batch: DataFrame) -> DataFrame:
        return batch.select(
            F.col("user_id").cast("bigint").alias("user_id"),
            F.col("event_id").cast("string").alias("event_id"),
            F.when(is_type("app_open"), "app_open").otherwise("other").alias("event_type"), "ts",
            F.col("ts").alias("first_ts"), F.lit(1).cast("bigint").alias("events"))

    def wanted(self, rows: DataFrame) -> DataFrame:
        return rows.where(F.col("user_id").isNotNull())

    def release(self, due: DataFrame, before: int | None, mark: int | None, batch_id: int) -> None:
        spark = due.sparkSession
        if before is not None:
            due = due.unionByName(_open(spark, self.state, batch_id - 1))
        found = derived_sessions(due, self.gap_us // 1_000_000, start="first_ts", weight="events",
                                 mark_last=True)
        closed = F.lit(True) if mark is None else (
            ~F.col("is_last") | (F.unix_micros("s_end") + self.gap_us < F.lit(mark)))
        staged = self.at("sessions", batch_id)
        found.select("user_id", F.col("s_events").cast("bigint").alias("s_events"), "s_start", "s_end",
                     closed.alias("closed")).write.mode("overwrite").partitionBy("closed").parquet(staged)
        # the closed part becomes the batch's result
        remove_path(spark, f"{self.path}/batch_id={batch_id}")
        if path_exists(spark, f"{staged}/closed=true"):
            move_path(spark, f"{staged}/closed=true", f"{self.path}/batch_id={batch_id}")


def open_sessions(spark: SparkSession, state: str,
                  gap: str = f"{config.SESSION_GAP_SEC} seconds") -> DataFrame | None:
    """What ``SessionWriter`` has not closed yet, from its own tables (no event
    file is read again): the open sessions of the last batch joined with the
    events that are still pending. None before the first batch."""
    last = last_batch(spark, f"{state}/mark")
    if last is None:
        return None
    mark, _ = read_mark(spark, state, last)
    pending = spark.read.schema(_ROWS).parquet(f"{state}/pending/batch_id={last}").where(
        F.unix_micros("ts") > mark)
    rows = pending.unionByName(_open(spark, state, last))
    return derived_sessions(rows, interval_us(gap) // 1_000_000, start="first_ts",
                            weight="events").select(
        "user_id", F.col("s_events").cast("bigint").alias("s_events"), "s_start", "s_end")
