"""The warehouse as a running application.

    python -m pulsehouse.app --input DIR --dim-item FILE --out BASE
        [--source files|kafka] [--input-format json|parquet]
        [--bootstrap HOST:PORT] [--topic NAME]
        [--once] [--test] [--duration SEC] [--trigger-sec SEC]

Layers under BASE (all with checkpoints under BASE/checkpoint):

* ``ods/events``      decoded events, partitioned by day (SNK-2);
  ``ods/quarantine``  records that failed to decode;
* ``dwd/events``      events enriched with the item dimension, reloaded
  every micro-batch (JOIN-2);
* ``dwd/cheat_a1``, ``dwd/cheat_a2``  detector output (CEP-1/2);
* ``dws/activity_5m``, ``dws/activity_30m``  windowed metrics (append);
* ``dws/activity_daily``, ``dws/dau_daily``  daily counts and exact DAU, days
  cut at midnight in the session zone;
* ``dws/uv_5m``       exact distinct enter_item users per window;
* ``dws/new_users``   new users per micro-batch (NEW-1);
* ``dws/sessions``    sessions by 30 idle minutes, written when closed (S-01..S-03);
* ``dws/late_rows``   rows dropped behind the watermark, per query and batch (Q-10);
* ``kv``              serving rows (key, field, value, ttl) per batch (SNK-1),
  in update mode by default (open windows are refreshed every trigger).

Modes: default runs continuously on a processing-time trigger; ``--test``
stops after ``--duration`` seconds (default 180) and exports every result
as CSV under BASE/export (SNK-5); ``--once`` processes what is available
in every layer, in order, and stops.
"""

from __future__ import annotations

import argparse
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from pulsehouse import config
from pulsehouse.session import build_session
from pulsehouse.sinks.kv import KVStream, latest_kv
from pulsehouse.sinks.lake import export_csv, publish_view
from pulsehouse.sources.dimensions import load_item_dim
from pulsehouse.sources.events import (
    decode_events,
    quarantine,
    read_json_events,
    read_kafka_stream,
    typed_events,
)
from pulsehouse.streaming import detectors, metrics
from pulsehouse.streaming.enrichment import EnrichWithReload, path_exists
from pulsehouse.streaming.sessions import SessionWriter, open_sessions
from pulsehouse.streaming.new_users import BatchNewUserCount, first_app_opens
from pulsehouse.streaming.runner import LateRowsListener
from pulsehouse.streaming.versions import DimensionVersions

ENRICHED_SCHEMA = (
    "event_id string, user_id bigint, event_type string, ts timestamp, session_id string, "
    "platform string, item_id bigint, duration_sec double, target_user_id bigint, "
    "comment_text string, content_len int, category string, batch_id bigint"
)


def _mkdirs(spark: SparkSession, path: str) -> None:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).mkdirs(p)


def _writer(df: DataFrame, base: str, name: str, trigger: dict, path: str | None = None,
            foreach_batch=None, partition_by: list[str] | None = None,
            output_mode: str = "append") -> StreamingQuery:
    w = df.writeStream.queryName(name).option("checkpointLocation", f"{base}/checkpoint/{name}")
    if foreach_batch is not None:
        w = w.foreachBatch(foreach_batch).outputMode(output_mode)
    else:
        w = w.format("parquet").option("path", path).outputMode("append")
        if partition_by:
            w = w.partitionBy(*partition_by)
    return w.trigger(**trigger).start()


def raw_events(spark: SparkSession, args) -> DataFrame:
    if args.source == "kafka":
        return read_kafka_stream(spark, args.bootstrap, args.topic,
                                 max_offsets_per_trigger=args.max_offsets)
    return read_json_events(spark, args.input, stream=True, max_files_per_trigger=args.max_files)


# Typed events as parquet files (``--input-format parquet``).
TYPED_SCHEMA = (
    "event_id string, user_id bigint, event_type string, ts timestamp, session_id string, "
    "platform string, item_id bigint, duration_sec double, target_user_id bigint, "
    "comment_text string, content_len int"
)


def ingest_queries(spark: SparkSession, args, trigger: dict) -> list[StreamingQuery]:
    """Stage 1: decode -> ods + quarantine; enrich with reload -> dwd;
    new users per batch."""
    base = args.out.rstrip("/")
    qs = []
    if args.input_format == "parquet" and args.source == "files":
        typed = (spark.readStream.schema(TYPED_SCHEMA)
                 .option("maxFilesPerTrigger", str(args.max_files)).parquet(args.input))
        ok = (F.col("event_id").isNotNull() & F.col("user_id").isNotNull()
              & F.col("event_type").isNotNull() & F.col("ts").isNotNull())
        good = typed.where(ok)
        qs.append(_writer(typed.where(~ok).select(F.to_json(F.struct("*")).alias("_raw")), base,
                          "ods_quarantine", trigger, f"{base}/ods/quarantine"))
    else:
        decoded = decode_events(raw_events(spark, args))
        good = typed_events(decoded)
        qs.append(_writer(quarantine(decoded), base, "ods_quarantine", trigger,
                          f"{base}/ods/quarantine"))
    qs += [
        _writer(good.withColumn("event_day", F.date_format("ts", "yyyyMMdd")), base,
                "ods_events", trigger, f"{base}/ods/events", partition_by=["event_day"]),
        _writer(good, base, "dwd_enrich", trigger,
                foreach_batch=EnrichWithReload(
                    lambda: load_item_dim(spark, args.dim_item), f"{base}/dwd/events",
                    versions=DimensionVersions(lambda: load_item_dim(spark, args.dim_item),
                                               f"{base}/dim/item"))),
        _writer(first_app_opens(good), base, "dws_new_users", trigger,
                foreach_batch=BatchNewUserCount(f"{base}/dws/new_users")),
    ]
    return qs


def metric_queries(spark: SparkSession, args, trigger: dict) -> list[StreamingQuery]:
    """Stage 2: stream the enriched layer into windows, detectors and kv."""
    base = args.out.rstrip("/")
    dwd = f"{base}/dwd/events"
    if not path_exists(spark, dwd):
        _mkdirs(spark, dwd)
    enriched = spark.readStream.schema(ENRICHED_SCHEMA).parquet(dwd)
    act5 = metrics.stream_activity(enriched, config.WINDOW_5M)
    act30 = metrics.stream_activity(enriched, config.WINDOW_30M)
    # Days cut at midnight in the session's zone (GMT+8 by default).
    day0 = _day0(spark)
    act_day = metrics.stream_activity(enriched, "1 day", by=(), start_time=day0)
    dau_day = metrics.stream_window_users(enriched, "1 day", start_time=day0)
    return [
        _writer(act_day, base, "dws_activity_daily", trigger, f"{base}/dws/activity_daily"),
        _writer(dau_day, base, "dws_dau_daily", trigger,
                foreach_batch=metrics.WindowUserCounter(f"{base}/dws/dau_daily", name="dau")),
        _writer(act5, base, "dws_activity_5m", trigger, f"{base}/dws/activity_5m"),
        _writer(act30, base, "dws_activity_30m", trigger, f"{base}/dws/activity_30m"),
        # Update mode: a window's kv rows are refreshed every trigger while
        # it is open; the store keeps the newest batch's value per field.
        _writer(act5, base, "kv_activity_5m", trigger, foreach_batch=KVStream(f"{base}/kv"),
                output_mode=args.kv_mode),
        _writer(act30, base, "kv_activity_30m", trigger, output_mode=args.kv_mode,
                foreach_batch=KVStream(f"{base}/kv_30m", f"{config.KV_PREFIX}_30m")),
        _writer(metrics.stream_window_users(enriched, only_type="enter_item"), base, "dws_uv_5m",
                trigger, foreach_batch=metrics.WindowUserCounter(f"{base}/dws/uv_5m", name="uv")),
        # S-01..S-03: a session closes after 30 idle minutes.
        _writer(enriched.select("event_id", "user_id", "event_type", "ts"), base, "dws_sessions",
                trigger, foreach_batch=SessionWriter(f"{base}/dws/sessions", f"{base}/state/sessions")),
        _writer(detectors.stream_a1(enriched), base, "dwd_cheat_a1", trigger,
                f"{base}/dwd/cheat_a1"),
        _writer(detectors.stream_a2(enriched), base, "dwd_cheat_a2", trigger,
                f"{base}/dwd/cheat_a2"),
    ]


RESULT_LAYERS = ("dws/activity_5m", "dws/activity_30m", "dws/activity_daily", "dws/dau_daily",
                 "dws/uv_5m", "dws/new_users",
                 "dws/sessions", "dws/late_rows", "dwd/cheat_a1", "dwd/cheat_a2", "kv", "kv_30m")


def open_windows(spark: SparkSession, base: str, layer: str) -> DataFrame | None:
    """Rows of the windows and sessions of ``layer`` that the stream has not
    closed yet: windows from the enriched events from the end of the last closed
    one on (a range that is pushed to the scan; events of an open window are
    never late, so none is missing), sessions from the stream's own tables.
    None for layers without windows."""
    build = {
        "dws/activity_5m": lambda e: metrics.stream_activity(e, config.WINDOW_5M),
        "dws/activity_30m": lambda e: metrics.stream_activity(e, config.WINDOW_30M),
        "dws/activity_daily": lambda e: metrics.stream_activity(
            e, "1 day", by=(), start_time=_day0(spark)),
        "dws/dau_daily": lambda e: _users(metrics.stream_window_users(
            e, "1 day", start_time=_day0(spark)), "dau"),
        "dws/uv_5m": lambda e: _users(metrics.stream_window_users(e, only_type="enter_item"), "uv"),
    }.get(layer)
    if layer == "dws/sessions":
        return open_sessions(spark, f"{base}/state/sessions")
    if build is None or not path_exists(spark, f"{base}/dwd/events"):
        return None
    events = spark.read.schema(ENRICHED_SCHEMA).parquet(f"{base}/dwd/events")
    if path_exists(spark, f"{base}/{layer}"):
        last = spark.read.parquet(f"{base}/{layer}").agg(F.max("window.end")).first()[0]
        if last is not None:  # windows follow each other: only later events are read
            events = events.where(F.col("ts") >= F.lit(last))
    return build(events)


def _day0(spark: SparkSession) -> str:
    return metrics.day_window_start(spark.conf.get("spark.sql.session.timeZone"))


def _users(per_user: DataFrame, name: str) -> DataFrame:
    hit = F.col("user_id").isNotNull() & (F.col("_hits") > 0)
    return per_user.groupBy("window").agg(F.count_if(hit).alias(name))


def export_results(spark: SparkSession, base: str) -> list[str]:
    """SNK-5: every result layer as header CSV under BASE/export, open
    windows and sessions included; of the serving rows the current value of
    each key and field."""
    done = []
    for layer in RESULT_LAYERS:
        src = f"{base}/{layer}"
        if not path_exists(spark, src):
            continue
        if layer.startswith("kv"):
            df = latest_kv(spark, src)
        else:
            df = spark.read.parquet(src)
            tail = open_windows(spark, base, layer)
            if tail is not None:
                df = df.unionByName(tail, allowMissingColumns=True)
        for w in ("window", "session"):
            if w in df.columns:
                df = df.select(F.col(f"{w}.start").alias(f"{w}_start"),
                               F.col(f"{w}.end").alias(f"{w}_end"),
                               *[c for c in df.columns if c != w])
        export_csv(df, f"{base}/export/{layer.replace('/', '_')}")
        done.append(layer)
    return done


def publish_results(spark: SparkSession, base: str) -> list[str]:
    """SNK-3 / SNK-4: the result layers as temp views for SQL users, under
    the names in ``config.RESULT_VIEWS`` plus one per dws layer
    (``dws_activity_5m``, ...). Views read the files; nothing is cached."""
    names = dict(config.RESULT_VIEWS)
    names.update({layer.replace("/", "_"): layer for layer in RESULT_LAYERS
                  if layer.startswith("dws/")})
    done = []
    for view, layer in names.items():
        if path_exists(spark, f"{base}/{layer}"):
            publish_view(spark.read.parquet(f"{base}/{layer}"), view)
            done.append(view)
    return done


def run(spark: SparkSession, args) -> None:
    base = args.out.rstrip("/")
    late = LateRowsListener()  # Q-10, written to dws/late_rows
    spark.streams.addListener(late)
    try:
        _run(spark, args, base, late)
    finally:
        spark.streams.removeListener(late)
        late.flush(spark, f"{base}/dws/late_rows")
    publish_results(spark, base)


def _run(spark: SparkSession, args, base: str, late: LateRowsListener) -> None:
    if args.once:
        for stage in (ingest_queries, metric_queries):
            qs = stage(spark, args, {"availableNow": True})
            for q in qs:
                q.awaitTermination()
                if q.exception():
                    raise RuntimeError(str(q.exception()))
            late.wait_for(qs)
        if args.test:
            late.flush(spark, f"{base}/dws/late_rows")
            export_results(spark, base)
        return
    trigger = {"processingTime": f"{args.trigger_sec} seconds"}
    qs = ingest_queries(spark, args, trigger) + metric_queries(spark, args, trigger)
    deadline = time.time() + args.duration if args.test else None
    last_flush = time.time()
    while all(q.isActive for q in qs) and (deadline is None or time.time() < deadline):
        time.sleep(1)
        if time.time() - last_flush > 60:
            late.flush(spark, f"{base}/dws/late_rows")
            last_flush = time.time()
    for q in qs:
        q.stop()
    failed = [q for q in qs if q.exception()]
    if failed:
        raise RuntimeError(str(failed[0].exception()))
    late.wait_for(qs)
    if args.test:
        late.flush(spark, f"{base}/dws/late_rows")
        export_results(spark, base)


def parse_args(argv=None):
    p = argparse.ArgumentParser(prog="pulsehouse")
    p.add_argument("--source", choices=["files", "kafka"], default="files")
    p.add_argument("--input", help="folder of event files (files source)")
    p.add_argument("--input-format", choices=["json", "parquet"], default="json",
                   help="json: JSON-lines logs, decoded; parquet: typed events")
    p.add_argument("--bootstrap", help="Kafka bootstrap servers")
    p.add_argument("--topic", default=config.KAFKA_TOPIC)
    # Micro-batch bounds: they also bound each key group's frame in the
    # detector state functions when a backlog is replayed.
    p.add_argument("--max-offsets", type=int, default=5_000_000,
                   help="Kafka records per micro-batch")
    p.add_argument("--max-files", type=int, default=1000,
                   help="input files per micro-batch (files source)")
    p.add_argument("--dim-item", required=True)
    p.add_argument("--out", required=True)
    p.add_argument("--once", action="store_true")
    p.add_argument("--test", action="store_true")
    p.add_argument("--duration", type=int, default=180)
    p.add_argument("--trigger-sec", type=int, default=10)
    p.add_argument("--time-zone", default=config.SOURCE_TIME_ZONE)
    p.add_argument("--cluster", action="store_true",
                   help="partition and state-store settings for a large cluster")
    p.add_argument("--kv-mode", choices=["update", "append"], default="update",
                   help="update: refresh open windows every trigger; append: once closed")
    return p.parse_args(argv)


def main(argv=None) -> None:
    args = parse_args(argv)
    spark = build_session(time_zone=args.time_zone, cluster=args.cluster)
    run(spark, args)


if __name__ == "__main__":
    main()


__all__ = ["run", "main", "parse_args", "export_results"]
