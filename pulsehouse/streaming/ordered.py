"""Event-time order on a stream without a Python worker.

``OrderedBatches`` is a ``foreachBatch`` function with a reorder buffer: events
wait in a **pending** table until the watermark has passed them, then they
are released in one piece with the look-back the rule needs, so the batch
form of a rule gives its flags whatever the order of arrival. The rules
split by (key, event-time bucket) themselves, so a user with a third of all
rows is many tasks. Events behind the watermark are kept as rows of a **late**
table and counted.

Everything is a table per batch id: a replayed batch reads its predecessor's
and overwrites its own.
"""

from __future__ import annotations

import json
from collections.abc import Callable

import pandas as pd
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from pulsehouse import config
from pulsehouse.streaming.enrichment import (
    last_batch,
    path_exists,
    read_text,
    remove_path,
    write_text,
)

# A replay needs the tables of the batch before it.
KEEP_BATCHES = 3


def interval_us(interval: str) -> int:
    return int(pd.Timedelta(interval) // pd.Timedelta(1, "us"))


def read_mark(spark: SparkSession, state: str, batch_id: int) -> tuple[int | None, int]:
    """(watermark in us, late events so far) after a batch."""
    path = f"{state}/mark/batch_id={batch_id}"
    if not path_exists(spark, path):
        return None, 0
    found = json.loads(read_text(spark, path))
    return found["mark"], found["late"]


class OrderedBatches:
    """``foreachBatch``: releases events in event-time order. Subclasses say
    what is kept of an event (``rows``) and what becomes of the released ones
    (``release``).

    The watermark follows the latest event time by ``delay_us``. An event at
    or before the watermark of the batches before is late: it goes to
    ``<state>/late/batch_id=<n>`` with all columns of the batch. Events without
    a time are left out. ``look_back_us``: how far behind the watermark released
    events are held for the next batches.
    """

    look_back_us = 0
    schema = None

    def __init__(self, path: str, state: str, delay_us: int):
        self.path, self.state, self.delay_us = path.rstrip("/"), state.rstrip("/"), delay_us

    def rows(self, batch: DataFrame) -> DataFrame:
        """The columns kept, ``ts`` among them; all rows."""
        raise NotImplementedError

    def wanted(self, rows: DataFrame) -> DataFrame:
        """The rows that are released at all; the others only move the watermark."""
        return rows

    def release(self, due: DataFrame, before: int | None, mark: int | None, batch_id: int) -> None:
        """``due``: the pending events up to ``mark`` (all if null); those
        after ``before`` are new."""
        raise NotImplementedError

    def at(self, table: str, batch_id: int) -> str:
        return f"{self.state}/{table}/batch_id={batch_id}"

    def pending(self, spark: SparkSession, batch_id: int) -> DataFrame:
        read = spark.read if self.schema is None else spark.read.schema(self.schema)
        return read.parquet(self.at("pending", batch_id))

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        before, late_before = read_mark(spark, self.state, batch_id - 1)
        rows = self.rows(batch)
        self.schema = rows.schema
        t = F.unix_micros("ts")
        late = F.coalesce(t <= F.lit(before).cast("bigint"), F.lit(False))
        seen = Observation()
        new = self.wanted(rows.observe(seen, F.max(t).alias("last"), F.count_if(late).alias("late"))
                          .where(F.col("ts").isNotNull() & ~late))
        if before is not None:
            new = new.unionByName(self.pending(spark, batch_id - 1).where(
                t > before - self.look_back_us))
        new.write.mode("overwrite").parquet(self.at("pending", batch_id))
        last, n_late = seen.get["last"], seen.get["late"]
        remove_path(spark, self.at("late", batch_id))
        if n_late:
            batch.where(late).write.parquet(self.at("late", batch_id))
        marks = [x for x in (before, None if last is None else last - self.delay_us) if x is not None]
        if marks:
            mark = max(marks)
            self.release(self.pending(spark, batch_id).where(t <= mark), before, mark, batch_id)
            write_text(spark, self.at("mark", batch_id),
                       json.dumps({"mark": mark, "late": late_before + n_late}))
        for old in ("pending", "sessions"):
            remove_path(spark, self.at(old, batch_id - KEEP_BATCHES))

    def finish(self, spark: SparkSession) -> None:
        """Releases all that is pending, as a batch of its own; only after
        the end of a bounded run."""
        last = last_batch(spark, f"{self.state}/mark")
        if last is not None:
            before, _ = read_mark(spark, self.state, last)
            self.release(self.pending(spark, last), before, None, last + 1)

    def late_rows(self, spark: SparkSession) -> int:
        """Events left out behind the watermark so far."""
        last = last_batch(spark, f"{self.state}/mark")
        return 0 if last is None else read_mark(spark, self.state, last)[1]

    def late_table(self, spark: SparkSession) -> DataFrame | None:
        """The late events as rows (and batch_id); None if there was none."""
        path = f"{self.state}/late"
        return spark.read.parquet(path) if last_batch(spark, path) is not None else None


class OrderedRule(OrderedBatches):
    """A look-back rule in event-time order: ``rule`` is a batch form that
    keeps ``ts`` (``operators.cheat.detect_a1``, ``detect_a2``); its rows go to
    ``<path>/batch_id=<n>``, each once, in the batch that releases it.

    ``look_back_ms`` is how far the rule looks back: 4 gaps for A1, the
    window for A2. ``only`` keeps one event type (likes for A2).
    """

    def __init__(self, path: str, state: str, rule: Callable[[DataFrame], DataFrame],
                 look_back_ms: int, columns: tuple[str, ...], only: str | None = None,
                 watermark: str = config.DETECTOR_WATERMARK):
        super().__init__(path, state, interval_us(watermark))
        self.rule, self.columns, self.only = rule, columns, only
        # times are compared in milliseconds by the rules
        self.look_back_us = (look_back_ms + 1) * 1000

    def rows(self, batch: DataFrame) -> DataFrame:
        return batch.select(*self.columns)

    def wanted(self, rows: DataFrame) -> DataFrame:
        return rows.where(F.col("event_type") == self.only) if self.only else rows

    def release(self, due: DataFrame, before: int | None, mark: int | None, batch_id: int) -> None:
        out = self.rule(due)
        if before is not None:
            out = out.where(F.unix_micros("ts") > before)
        out.write.mode("overwrite").parquet(f"{self.path}/batch_id={batch_id}")


def ordered_a1(path: str, state: str, watermark: str = config.DETECTOR_WATERMARK) -> OrderedRule:
    """CEP-1 in event-time order (event_id, user_id, item_id, event_type, ts)."""
    from pulsehouse.operators.cheat import CHEAT_COLUMNS, detect_a1

    return OrderedRule(path, state, detect_a1, (config.A1_MIN_COMMENTS - 1) * config.A1_MAX_GAP_MS,
                       tuple(CHEAT_COLUMNS), watermark=watermark)


def ordered_a2(path: str, state: str, watermark: str = config.DETECTOR_WATERMARK) -> OrderedRule:
    """CEP-2 in event-time order: only flagged likes come out."""
    from pulsehouse.operators.cheat import CHEAT_COLUMNS, detect_a2

    return OrderedRule(path, state, detect_a2, config.A2_WINDOW_MS, tuple(CHEAT_COLUMNS), "like",
                       watermark)


class KeepLate(OrderedBatches):
    """No rule: events are passed on once the watermark has passed them, to
    ``<path>/batch_id=<n>``; late ones are in the late table."""

    def rows(self, batch: DataFrame) -> DataFrame:
        return batch

    def release(self, due: DataFrame, before: int | None, mark: int | None, batch_id: int) -> None:
        out = due if before is None else due.where(F.unix_micros("ts") > before)
        out.write.mode("overwrite").parquet(f"{self.path}/batch_id={batch_id}")
