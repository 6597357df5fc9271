"""Named streaming queries over the driver tables.

Each one runs a real Structured Streaming query to completion
(``availableNow``) over a file stream of the given tables, or of data
Spark derives from them, writes to a sink in the shared checkpoint folder
and returns that sink as a DataFrame. Checkpoints and sinks go under
``spark.checkpoint.dir``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pulsehouse import config
from pulsehouse.functions import window_bounds
from pulsehouse.operators.enrich import enrich
from pulsehouse.session import new_run_dir
from pulsehouse.plans.metrics import with_ratios
from pulsehouse.sinks import kv_source
from pulsehouse.sinks.kv import KVStream, latest_kv, to_kv_rows
from pulsehouse.sinks.lake import archive_stream
from pulsehouse.sources import adapters as A
from pulsehouse.sources.events import read_parquet_stream
from pulsehouse.streaming import detectors, metrics, runner
from pulsehouse.streaming.enrichment import EnrichWithReload, last_batch
from pulsehouse.streaming.new_users import (
    BatchNewUserCount,
    first_app_opens,
    new_user_results,
)
from pulsehouse.streaming.ordered import KeepLate, interval_us, ordered_a1, ordered_a2
from pulsehouse.streaming.sessions import SessionWriter
from pulsehouse.streaming.versions import DimensionVersions, enrich_as_of


# Files of a table read by one micro-batch: no batch grows with the table.
FILES_PER_BATCH = 1000


def _event_stream(spark: SparkSession, directory: str, file_glob: str | None = None,
                  max_files: int | None = FILES_PER_BATCH) -> DataFrame:
    """The raw ``events`` table as a file stream, mapped to behaviour events."""
    probe = f"{directory.rstrip('/')}/{file_glob}" if file_glob else directory
    schema = spark.read.parquet(probe).schema
    raw = read_parquet_stream(spark, directory, schema, file_glob, max_files)
    return A.community_events_from(raw)


def _run(df: DataFrame, run: str, **kw):
    kw = kw or {"sink_path": f"{run}/out"}
    return runner.run_to_end(runner.start(df, f"{run}/checkpoint", **kw))


def _run_closed(spark, sf: str, run: str, build, start_kw=None) -> None:
    """``build`` over the event stream, all windows and sessions closed."""
    ev = _event_stream(spark, sf, "events.parquet")
    last = lambda: A.community_events(spark, sf).agg(F.max("ts")).first()[0]
    runner.run_closed(spark, ev, run, build, last, start_kw)


def stream_pv_5m(spark, sf):
    """STR-2/3: PV per 5-minute window and category on the event stream,
    enriched stream-static, 5-minute watermark, append mode: a window is
    written once the watermark passes its end."""
    run = new_run_dir(spark, "stream_pv_5m")
    dim = A.item_dimension(spark, sf)
    _run_closed(spark, sf, run, lambda ev: metrics.stream_activity(enrich(ev, dim)))
    out = spark.read.parquet(f"{run}/out")
    return out.select(*window_bounds("window"), "category", "pv", "likes", "n_events")


def stream_activity_daily(spark, sf):
    """Day-grain counts on the stream: 1-day windows cut at midnight in the
    session zone, written once the watermark passes the day's end."""
    run = new_run_dir(spark, "stream_daily")
    dim = A.item_dimension(spark, sf)
    day0 = metrics.day_window_start(spark.conf.get("spark.sql.session.timeZone"))
    _run_closed(spark, sf, run, lambda ev: metrics.stream_activity(
        enrich(ev, dim), "1 day", by=("category",), start_time=day0))
    out = spark.read.parquet(f"{run}/out")
    return out.select(F.date_format("window.start", "yyyyMMdd").alias("day"), "category",
                      "pv", "likes", "comments", "d1_instant_exits", "n_events")


def _stream_users(spark, sf, run: str, name: str, build, by=()) -> DataFrame:
    _run_closed(spark, sf, run, build, lambda: {
        "foreach_batch": metrics.WindowUserCounter(f"{run}/out", by=by, name=name)})
    out = spark.read.parquet(f"{run}/out")
    return out.select(*window_bounds("window"), *by, name)


def stream_uv_5m_exact(spark, sf):
    """STR-4 exact: distinct enter_item users per 5-minute window - one
    keyed aggregation, counted per micro-batch in ``foreachBatch``."""
    return _stream_users(spark, sf, new_run_dir(spark, "stream_uv_5m"), "uv",
                         lambda ev: metrics.stream_window_users(ev, only_type="enter_item"))


def stream_uv_by_category_30m(spark, sf):
    """U-06/U-07 on the stream: distinct enter_item users per 30-minute
    window and category."""
    dim = A.item_dimension(spark, sf)
    return _stream_users(
        spark, sf, new_run_dir(spark, "stream_uv_cat"), "uv",
        lambda ev: metrics.stream_window_users(enrich(ev, dim), "30 minutes", by=("category",),
                                               only_type="enter_item"), by=("category",))


def stream_dau_5m_exact(spark, sf):
    """U-01 / STR-4 exact on a stream: distinct users over any event per
    5-minute window."""
    return _stream_users(spark, sf, new_run_dir(spark, "stream_dau_5m"), "dau",
                         metrics.stream_window_users)


def _run_in_arrivals(spark: SparkSession, table: DataFrame, order_col: str, run: str,
                     build, min_parts: int = 4, rows_per_batch: int = 5_000_000, **kw) -> None:
    """Feed ``table`` to one streaming run as time-ordered micro-batches of
    about ``rows_per_batch`` rows at most (and at least ``min_parts`` of them), so
    keyed state carries across batches and no batch grows with the table.
    Each part is appended as exactly one file per core of the cluster,
    after the previous part was committed; the file source takes files in
    modification-time order, ``maxFilesPerTrigger`` of them per batch, so
    every batch is one whole part. The table is written once (Spark
    derives it from the given tables) and read back per part with
    pushed-down range filters. ``build(stream)`` makes the query."""
    whole = f"{run}/derived"
    table.write.mode("overwrite").parquet(whole)
    stored = spark.read.parquet(whole)
    n = max(min_parts, -(-stored.count() // rows_per_batch))
    # Parts of about equal rows, whatever the distribution of the order.
    share = F.percentile_approx(order_col, [i / n for i in range(1, n)], 10_000)
    cuts = sorted(set(stored.agg(share).first()[0] or []))
    files_per_part = max(1, spark.sparkContext.defaultParallelism)
    src = f"{run}/source"
    for lo, hi in zip([None, *cuts], [*cuts, None]):
        part = stored
        if lo is not None:
            part = part.where(F.col(order_col) > lo)
        if hi is not None:
            part = part.where(F.col(order_col) <= hi)
        part.repartition(files_per_part).write.mode("append").parquet(src)
    s = (spark.readStream.schema(stored.schema)
         .option("maxFilesPerTrigger", str(files_per_part)).parquet(src))
    _run(build(s), run, **kw)


def stream_cheat_a1(spark, sf):
    """CEP-1 with keyed state on the dense stream, arriving in time-ordered
    micro-batches; in-order arrival, so it equals the batch truth."""
    run = new_run_dir(spark, "stream_a1")
    _run_in_arrivals(spark, A.dense_events(spark, sf), "event_id", run,
                     lambda s: detectors.stream_a1(A.dense_for_a1(s)))
    out = spark.read.parquet(f"{run}/out")
    return out.select("event_id", "user_id", "item_id", "event_type",
                      F.unix_millis("ts").alias("ts_ms"), "is_cheat_a1")


def stream_cheat_a2(spark, sf):
    """CEP-2 with keyed state on the dense stream, in time-ordered
    micro-batches."""
    run = new_run_dir(spark, "stream_a2")
    _run_in_arrivals(spark, A.dense_events(spark, sf), "event_id", run,
                     lambda s: detectors.stream_a2(A.dense_for_a2(s)))
    out = spark.read.parquet(f"{run}/out")
    return out.select("event_id", "user_id", "item_id", "event_type",
                      F.unix_millis("ts").alias("ts_ms"), "is_cheat_a2")


def _late_arrivals(events: DataFrame) -> DataFrame:
    """Events with ``arrival`` (ms): a tenth of them come 30 to 90 s late."""
    h = F.xxhash64("event_id", F.lit(10))
    late = F.when(F.pmod(h, F.lit(10)) == 0, 30_000 + F.pmod(F.shiftright(h, 8), F.lit(60_000)))
    return events.withColumn("arrival", F.unix_millis("ts") + F.coalesce(late, F.lit(0)))


def _ordered_rule(spark, sf, run: str, events: DataFrame, rule) -> DataFrame:
    columns = rule.columns
    _run_in_arrivals(spark, _late_arrivals(events.select(*columns)), "arrival", run,
                     lambda s: s.drop("arrival"), foreach_batch=rule)
    rule.finish(spark)
    return spark.read.parquet(f"{run}/out")


def stream_cheat_a1_ordered(spark, sf):
    """CEP-1 / STR-7 on the dense stream with a tenth of the events 30 to 90 s
    late: events are released in event-time order once the watermark has
    passed them, so every flag equals the batch form."""
    run = new_run_dir(spark, "stream_a1_ordered")
    out = _ordered_rule(spark, sf, run, A.dense_for_a1(A.dense_events(spark, sf)),
                        ordered_a1(f"{run}/out", f"{run}/state"))
    return out.select("event_id", "user_id", "item_id", "event_type",
                      F.unix_millis("ts").alias("ts_ms"), "is_cheat_a1")


def stream_cheat_a2_ordered(spark, sf):
    """CEP-2 / STR-5 likewise: the likes of a user are split by event time, so
    a user with a third of all rows is many tasks."""
    run = new_run_dir(spark, "stream_a2_ordered")
    out = _ordered_rule(spark, sf, run, A.dense_for_a2(A.dense_events(spark, sf)),
                        ordered_a2(f"{run}/out", f"{run}/state"))
    return out.select("event_id", "user_id", "item_id", "event_type",
                      F.unix_millis("ts").alias("ts_ms"), "is_cheat_a2")


def stream_late_rows(spark, sf):
    """Q-10 / STR-7: the second half of the observed days arrives first, the
    first half after it: late events are kept as rows of a layer, beside their
    count, and the others pass in order."""
    run = new_run_dir(spark, "stream_late_rows")
    com = A.community_events(spark, sf).select("event_id", "user_id", "event_type", "ts")
    lo, hi = com.agg(F.min(F.to_date("ts")), F.max(F.to_date("ts"))).first()
    late = F.to_date("ts") <= F.lit(lo + (hi - lo) / 2)
    passed = KeepLate(f"{run}/out", f"{run}/state", interval_us(config.DETECTOR_WATERMARK))
    for part in (com.where(~late), com.where(late)):
        part.write.mode("append").parquet(f"{run}/source")
        schema = spark.read.parquet(f"{run}/source").schema
        _run(spark.readStream.schema(schema).parquet(f"{run}/source"), run, foreach_batch=passed)
    passed.finish(spark)
    rows = passed.late_table(spark)
    rows = com.limit(0) if rows is None else rows
    counted = F.lit(passed.late_rows(spark)).cast("bigint")
    return rows.select("event_id", "user_id", "event_type", F.unix_millis("ts").alias("ts_ms"),
                       counted.alias("late_rows"))


def stream_new_users(spark, sf):
    """NEW-1: new users per micro-batch of the event stream; the seen set is
    the state store of a streaming dropDuplicates. Each user is new in exactly
    one batch, so the total equals the distinct app_open users."""
    run = new_run_dir(spark, "stream_new_users")
    s = _event_stream(spark, sf, "events.parquet")
    counter = BatchNewUserCount(f"{run}/result")
    runner.run_to_end(runner.start(first_app_opens(s), f"{run}/checkpoint",
                                   foreach_batch=counter))
    res = new_user_results(spark, f"{run}/result")
    return res.agg(F.sum("u_04_new_user_count").cast("bigint").alias("new_users"))


def stream_archive(spark, sf):
    """SNK-2: the event stream appended to the lake, partitioned by event
    day, then read back."""
    run = new_run_dir(spark, "stream_archive")
    ev = _event_stream(spark, sf, "events.parquet")
    q = archive_stream(ev, run, "ods_events", fmt="parquet")
    runner.run_to_end(q)
    out = spark.read.parquet(f"{run}/ods_events")
    return out.groupBy("event_day").agg(F.count(F.lit(1)).alias("events")).select(
        F.col("event_day").cast("string").alias("day"), "events"
    )


def stream_late_dropped(spark, sf):
    """Q-10 / STR-7: the second half of the observed days arrives first, the
    first half in a second run from the same checkpoint. Every row of the
    second run is behind the 30-minute watermark and is dropped by the
    keyed-state detector; a listener adds up the drops."""
    run = new_run_dir(spark, "stream_late")
    src = f"{run}/source"
    com = A.community_events(spark, sf)
    lo, hi = com.agg(F.min(F.to_date("ts")), F.max(F.to_date("ts"))).first()
    late = F.to_date("ts") <= F.lit(lo + (hi - lo) / 2)
    listener = runner.LateRowsListener()
    spark.streams.addListener(listener)
    try:
        for i, part in enumerate((com.where(~late), com.where(late))):
            part.write.mode("append").parquet(src)
            if i == 0:
                schema = spark.read.parquet(src).schema
            # A restart from the same checkpoint keeps the watermark.
            s = spark.readStream.schema(schema).parquet(src)
            q = runner.start(detectors.stream_a1(s), f"{run}/checkpoint", f"{run}/out")
            runner.run_to_end(q)
        listener.wait_for([q])
        dropped = listener.total(q)
    finally:
        spark.streams.removeListener(listener)
    flagged = spark.read.parquet(f"{run}/out")
    return flagged.agg(F.count(F.lit(1)).alias("emitted_rows")).select(
        F.lit(dropped).cast("bigint").alias("dropped_rows"), "emitted_rows"
    )


def stream_sessions_gap(spark, sf):
    """STR-6: sessions that start with an app_open or after 30 minutes of
    inactivity, on the stream. Rolled up per day."""
    from pulsehouse.plans.metrics import session_rollup

    run = new_run_dir(spark, "stream_sessions")
    write = SessionWriter(f"{run}/out", f"{run}/state")
    cols = ("event_id", "user_id", "event_type", "ts")
    _run_closed(spark, sf, run, lambda ev: ev.select(*cols), lambda: {"foreach_batch": write})
    return session_rollup(spark.read.parquet(f"{run}/out"))


def stream_enrich_versions(spark, sf):
    """JOIN-2: two batches (the first and the second half of the days) between
    which the dimension is edited, then the whole history enriched again as of
    each batch's version: the same rows as the first time."""
    run = new_run_dir(spark, "stream_versions")
    com = A.community_events(spark, sf)
    lo, hi = com.agg(F.min(F.to_date("ts")), F.max(F.to_date("ts"))).first()
    second = F.to_date("ts") > F.lit(lo + (hi - lo) / 2)
    dim = A.item_dimension(spark, sf)
    even = F.col("dim_item_id") % 2 == 0
    edited = dim.withColumn("category", F.when(even, F.concat("category", F.lit(" v2")))
                            .otherwise(F.col("category"))).withColumn(
        "dim_content_len", F.when(even, F.lit(1)).otherwise(F.col("dim_content_len")).cast("int"))
    state = {"now": dim.withColumn("dim_content_len", F.col("dim_content_len").cast("int"))}
    versions = DimensionVersions(lambda: state["now"], f"{run}/dim")
    write = EnrichWithReload(versions.load, f"{run}/dwd", versions=versions)
    src = f"{run}/source"
    for part, now in ((com.where(~second), state["now"]), (com.where(second), edited)):
        state["now"] = now
        part.write.mode("append").parquet(src)
        schema = spark.read.parquet(src).schema
        _run(spark.readStream.schema(schema).parquet(src), run, foreach_batch=write)
    history = spark.read.parquet(f"{run}/dwd").select(*com.columns, "batch_id")
    return enrich_as_of(history, versions).select("event_id", "batch_id", "category", "content_len")


def stream_kv_update(spark, sf):
    """STR-9 update mode / SNK-1: 5-minute activity refreshed in every
    micro-batch while its windows are open; the store's current values."""
    run = new_run_dir(spark, "stream_kv")
    dim = A.item_dimension(spark, sf)
    com = A.community_events(spark, sf).withColumn("arrival", F.unix_millis("ts"))
    _run_in_arrivals(spark, com, "arrival", run,
                     lambda s: metrics.stream_activity(enrich(s.drop("arrival"), dim)),
                     output_mode="update", foreach_batch=KVStream(f"{run}/kv"))
    return latest_kv(spark, f"{run}/kv").where(F.col("field").isin(*KV_COUNTS))


def stream_kv_sink(spark, sf):
    """SNK-1 / STR-11: the activity of closed 5-minute windows as kv rows into
    the sink with a commit protocol, compacted once, read back."""
    run = new_run_dir(spark, "stream_kv_sink")
    dim = A.item_dimension(spark, sf)
    kv_source.register(spark)

    def rows(ev):
        counts = with_ratios(metrics.stream_activity(enrich(ev, dim))).drop("n_events")
        return to_kv_rows(counts.select("window", "category", *KV_COUNTS))

    _run_closed(spark, sf, run, rows, lambda: {"fmt": kv_source.FORMAT, "sink_path": f"{run}/kv"})
    kv_source.compact_kv(spark, f"{run}/kv")
    return kv_source.read_kv(spark, f"{run}/kv")


# Fields of the serving row that a stream's state holds, and their ratios.
KV_COUNTS = ("pv", "likes", "favs", "shares", "comments", "interactions", "follows", "unfollows",
             "dms", "profile_visits", "n_leave", "d1_instant_exits", "e1_fast_swipes", "c_long_stays",
             "bounce_rate", "interaction_rate", "fav_rate")


class _Replace:
    """``foreachBatch`` of a complete-mode query: the newest whole result under
    ``batch_id=<n>``."""

    def __init__(self, path: str):
        self.path = path

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{self.path}/batch_id={batch_id}")


def stream_totals_complete(spark, sf):
    """STR-9 complete mode: running totals per category (a bounded number of
    groups), the whole result written in every micro-batch."""
    run = new_run_dir(spark, "stream_totals")
    dim = A.item_dimension(spark, sf)
    com = A.community_events(spark, sf).withColumn("arrival", F.unix_millis("ts"))
    _run_in_arrivals(
        spark, com, "arrival", run, lambda s: enrich(s.drop("arrival"), dim).groupBy("category").agg(
            F.count_if(F.col("event_type") == "enter_item").alias("pv"),
            F.count(F.lit(1)).alias("n_events")),
        output_mode="complete", foreach_batch=_Replace(f"{run}/out"))
    last = last_batch(spark, f"{run}/out")
    return spark.read.parquet(f"{run}/out/batch_id={last}")


STREAM_QUERIES = {
    "stream_pv_5m": stream_pv_5m,
    "stream_activity_daily": stream_activity_daily,
    "stream_uv_5m_exact": stream_uv_5m_exact,
    "stream_uv_by_category_30m": stream_uv_by_category_30m,
    "stream_dau_5m_exact": stream_dau_5m_exact,
    "stream_cheat_a1": stream_cheat_a1,
    "stream_cheat_a2": stream_cheat_a2,
    "stream_cheat_a1_ordered": stream_cheat_a1_ordered,
    "stream_cheat_a2_ordered": stream_cheat_a2_ordered,
    "stream_late_rows": stream_late_rows,
    "stream_enrich_versions": stream_enrich_versions,
    "stream_kv_update": stream_kv_update,
    "stream_kv_sink": stream_kv_sink,
    "stream_totals_complete": stream_totals_complete,
    "stream_new_users": stream_new_users,
    "stream_archive": stream_archive,
    "stream_late_dropped": stream_late_dropped,
    "stream_sessions_gap": stream_sessions_gap,
}


def stream_oracle_sql() -> dict[str, str]:
    from pulsehouse.plans.oracle import stream_bodies

    return stream_bodies()
