"""Starting, finishing and measuring streaming queries (STR-9, STR-10,
STR-12, Q-10)."""

from __future__ import annotations

import threading
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener


def start(
    df: DataFrame,
    checkpoint: str,
    sink_path: str | None = None,
    fmt: str = "parquet",
    output_mode: str = "append",
    foreach_batch: Callable[[DataFrame, int], None] | None = None,
    query_name: str | None = None,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Start ``df`` with a checkpoint (always: a restart resumes from it).
    The default trigger processes what is available, then stops."""
    w = df.writeStream.outputMode(output_mode).option("checkpointLocation", checkpoint)
    if query_name:
        w = w.queryName(query_name)
    if foreach_batch is not None:
        w = w.foreachBatch(foreach_batch)
    else:
        w = w.format(fmt)
        if sink_path:
            w = w.option("path", sink_path)
    return w.trigger(**(trigger or {"availableNow": True})).start()


def run_to_end(q: StreamingQuery, timeout_sec: float | None = None) -> StreamingQuery:
    """Wait for an availableNow query to finish and raise if it failed.
    With ``timeout_sec``, a query still running then is stopped and a
    ``TimeoutError`` raised - its sink would be partial, so it is never
    returned as a result. (A timed run that should stop and keep what it
    has is ``app --test --duration``.)"""
    if timeout_sec is None:
        q.awaitTermination()
    elif not q.awaitTermination(timeout_sec):
        q.stop()
        raise TimeoutError(f"streaming query {q.name or q.id} still running after {timeout_sec}s")
    if q.exception() is not None:
        raise RuntimeError(f"streaming query failed: {q.exception()}")
    return q


def dropped_by_watermark(q: StreamingQuery) -> int:
    """Q-10 of a short run: rows the stateful operators discarded behind the
    watermark, over the query's recent progress. Spark keeps the last 100
    progress entries only; ``LateRowsListener`` counts runs of any length.
    For a window aggregate this counts rows after partial aggregation; for a
    keyed-state operator it counts input rows."""
    return sum(_dropped(p) for p in q.recentProgress)


def _dropped(progress) -> int:
    return sum(int(op.numRowsDroppedByWatermark or 0) for op in progress.stateOperators)


def run_closed(
    spark: SparkSession,
    events: DataFrame,
    run: str,
    build: Callable[[DataFrame], DataFrame],
    last: Callable[[], object],
    start_kw: Callable[[], dict] | None = None,
    ahead: str = "2 days",
) -> None:
    """Run ``build(events)`` to the end in append mode, then close what is
    still open: a second run from the same checkpoint reads one tick - a row
    with a time (and user -1, as filters on the user are pushed below the
    watermark), ``ahead`` of ``last()``, the latest event time - which
    moves the watermark past every window and session. The tick's own group
    is never emitted. Only for bounded runs: after it, the checkpoint treats
    further events as late."""
    ticks = f"{run}/ticks"
    none = spark.createDataFrame([], events.schema)
    none.write.parquet(ticks)
    for closing in (False, True):
        if closing:
            latest = last()
            if latest is None:
                return  # no event, nothing is open
            row = spark.range(1).select(*[
                (F.lit(latest).cast("timestamp") + F.expr(f"INTERVAL {ahead}") if f.name == "ts"
                 else F.lit(-1 if f.name == "user_id" else None).cast(f.dataType)).alias(f.name)
                for f in events.schema])
            row.write.mode("append").parquet(ticks)
        both = events.unionByName(spark.readStream.schema(events.schema).parquet(ticks))
        run_to_end(start(build(both), f"{run}/checkpoint", **(
            start_kw() if start_kw else {"sink_path": f"{run}/out"})))


class LateRowsListener(StreamingQueryListener):
    """Q-10 as a live metric: for every micro-batch of every query, the
    rows its stateful operators dropped behind the watermark. Totals per run
    are kept however long it gets; the rows per batch are buffered on the
    driver and written by ``flush`` (call it regularly)."""

    SCHEMA = "query string, batch_id bigint, event_time string, dropped_rows bigint"

    def __init__(self):
        self._rows: list[tuple] = []
        self._totals: dict[str, int] = {}
        self._ended: set[str] = set()
        self._changed = threading.Condition()

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        p = event.progress
        dropped = _dropped(p)
        if p.stateOperators:
            with self._changed:
                run = str(p.runId)
                self._totals[run] = self._totals.get(run, 0) + dropped
                self._rows.append((p.name or str(p.id), int(p.batchId), p.timestamp, dropped))

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        with self._changed:
            self._ended.add(str(event.runId))
            self._changed.notify_all()

    def wait_for(self, queries: list[StreamingQuery], timeout_sec: float = 60) -> None:
        """Until the end of these (stopped) queries has been reported: events
        come in order, so all their progress has been counted by then."""
        runs = {str(q.runId) for q in queries}
        with self._changed:
            if not self._changed.wait_for(lambda: runs <= self._ended, timeout_sec):
                raise TimeoutError("streaming progress events are still queued")

    def total(self, q: StreamingQuery) -> int:
        """Rows dropped in the run of ``q`` (after ``wait_for``)."""
        with self._changed:
            return self._totals.get(str(q.runId), 0)

    def flush(self, spark: SparkSession, path: str) -> int:
        with self._changed:
            rows, self._rows = self._rows, []
        if rows:
            spark.createDataFrame(rows, self.SCHEMA).write.mode("append").parquet(path)
        return len(rows)
