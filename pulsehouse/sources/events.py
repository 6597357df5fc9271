"""Event stream sources (SRC-1, SRC-2).

The behaviour log arrives as JSON records (Kafka value or JSON lines).
``decode_events`` turns raw records into typed events; rows that do not
parse are not dropped but returned by ``quarantine``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pulsehouse import config

# Wire schema (fixed: it must match the topic). ``ts`` is an ISO-8601 string with milliseconds.
EVENT_JSON_SCHEMA = T.StructType(
    [
        T.StructField("event_id", T.StringType()),
        T.StructField("user_id", T.LongType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("ts", T.StringType()),
        T.StructField("session_id", T.StringType()),
        T.StructField("platform", T.StringType()),
        T.StructField("item_id", T.LongType()),
        T.StructField("duration_sec", T.DoubleType()),
        T.StructField("target_user_id", T.LongType()),
        T.StructField("comment_text", T.StringType()),
        T.StructField("content_len", T.IntegerType()),
    ]
)

# Column order of a typed event everywhere in the library.
EVENT_COLUMNS = [f.name for f in EVENT_JSON_SCHEMA.fields]

# Accepted forms of ``ts``: date and time joined by 'T' or a space, up to nine
# fraction digits (microseconds are kept), and an offset ("+08:00", "+0800",
# "Z"); without an offset it is wall-clock time in the source zone (GMT+8).
_TS = r"^(\d{4}-\d{2}-\d{2})[T ](\d{2}:\d{2}:\d{2})(\.\d{1,6})?\d{0,3} ?(Z|[+-]\d{2}:?\d{2})?$"


def parse_event_time(s: Column, source_tz: str = config.SOURCE_TIME_ZONE) -> Column:
    """ISO-8601 string -> timestamp; an explicit offset wins, a bare local
    time is read in ``source_tz``; anything else is NULL (quarantined). The
    session's time zone plays no part: every string is parsed with a zone."""
    s = F.trim(s)
    zone = F.regexp_extract(s, _TS, 4)
    plain = F.regexp_replace(s, _TS, "$1 $2$3")
    zone = F.when(zone == "", F.lit(source_tz)).otherwise(
        F.regexp_replace(zone, r"^([+-]\d{2})(\d{2})$", "$1:$2"))
    return F.when(s.rlike(_TS), F.concat(plain, F.lit(" "), zone).try_cast("timestamp"))


def decode_events(
    raw: DataFrame,
    value_col: str = "value",
    source_tz: str = config.SOURCE_TIME_ZONE,
) -> DataFrame:
    """SRC-2: raw records with a JSON ``value`` -> typed events.

    Adds ``_decode_ok``; keep good rows with ``typed_events`` and the rest
    with ``quarantine``. Works on batch and streaming frames alike.
    """
    raw_str = F.col(value_col).cast("string")
    # Parse once per record. ``inline`` of a one-element array is a
    # generator: filters on the parsed fields stay above it, so Catalyst
    # can neither push them below the parse nor split ``from_json`` into
    # one pruned parse per referenced field.
    parsed = raw.select(
        F.inline(F.array(F.struct(
            raw_str.alias("_raw"),
            F.from_json(raw_str, EVENT_JSON_SCHEMA).alias("e"),
        )))
    )
    ts = parse_event_time(F.col("e.ts"), source_tz)
    out = parsed.select(
        "_raw",
        *[
            (ts if c == "ts" else F.col(f"e.{c}")).alias(c)
            for c in EVENT_COLUMNS
        ],
    )
    ok = (
        F.col("event_id").isNotNull()
        & F.col("user_id").isNotNull()
        & F.col("event_type").isNotNull()
        & F.col("ts").isNotNull()
    )
    return out.withColumn("_decode_ok", F.coalesce(ok, F.lit(False)))


def typed_events(decoded: DataFrame) -> DataFrame:
    return decoded.filter("_decode_ok").select(*EVENT_COLUMNS)


def quarantine(decoded: DataFrame) -> DataFrame:
    """Records that failed to decode, kept whole for inspection."""
    return decoded.filter(~F.col("_decode_ok")).select("_raw")


def encode_events(events: DataFrame, source_tz: str = config.SOURCE_TIME_ZONE) -> DataFrame:
    """Typed events -> one JSON ``value`` per row, the wire format of the
    topic (``ts`` written in ``source_tz`` with its offset, whatever the
    session's time zone)."""
    offset = _offset_text(source_tz)
    sign = -1 if offset[0] == "-" else 1
    shift_ms = sign * (int(offset[1:3]) * 60 + int(offset[4:6])) * 60_000
    local_ms = F.unix_millis("ts") + F.lit(shift_ms)
    wall = F.expr("TIMESTAMP_NTZ'1970-01-01 00:00:00'") + F.make_dt_interval(
        secs=F.floor(local_ms / 1000).cast("decimal(18,6)"))
    millis = F.lpad(F.pmod(local_ms, F.lit(1000)).cast("string"), 3, "0")
    ts_str = F.concat(F.replace(wall.cast("string"), F.lit(" "), F.lit("T")), F.lit("."), millis)
    cols = [
        (F.concat(ts_str, F.lit(offset)) if c == "ts" else F.col(c).cast(f.dataType)).alias(c)
        for c, f in zip(EVENT_COLUMNS, EVENT_JSON_SCHEMA.fields)
    ]
    return events.select(F.to_json(F.struct(*cols)).alias("value"))


def _offset_text(tz: str) -> str:
    # Fixed-offset zones only need their offset; Asia/Shanghai has no DST.
    import datetime as _dt
    from zoneinfo import ZoneInfo

    off = _dt.datetime(2024, 1, 1, tzinfo=ZoneInfo(tz)).utcoffset()
    mins = int(off.total_seconds() // 60)
    sign = "+" if mins >= 0 else "-"
    mins = abs(mins)
    return f"{sign}{mins // 60:02d}:{mins % 60:02d}"


def read_kafka_stream(
    spark: SparkSession,
    bootstrap_servers: str,
    topic: str = config.KAFKA_TOPIC,
    starting_offsets: str = config.KAFKA_STARTING_OFFSETS,
    max_offsets_per_trigger: int | None = None,
) -> DataFrame:
    """SRC-1: raw Kafka records of one topic. Needs the Kafka connector
    on the classpath; ``maxOffsetsPerTrigger`` bounds each micro-batch."""
    r = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", bootstrap_servers)
        .option("subscribe", topic)
        .option("startingOffsets", starting_offsets)
    )
    if max_offsets_per_trigger:
        r = r.option("maxOffsetsPerTrigger", str(max_offsets_per_trigger))
    return r.load()


def read_json_events(spark: SparkSession, path: str, stream: bool = False,
                     max_files_per_trigger: int | None = None) -> DataFrame:
    """JSON-lines log files as raw records with a ``value`` column;
    ``max_files_per_trigger`` bounds each micro-batch of a stream."""
    reader = spark.readStream if stream else spark.read
    if stream and max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return reader.format("text").load(path)


def read_parquet_stream(
    spark: SparkSession,
    directory: str,
    schema: T.StructType,
    file_glob: str | None = None,
    max_files_per_trigger: int | None = None,
) -> DataFrame:
    """Files arriving in ``directory`` as a stream (schema given, never
    inferred). ``file_glob`` picks one table out of a shared folder."""
    r = spark.readStream.schema(schema).format("parquet")
    if file_glob:
        r = r.option("pathGlobFilter", file_glob)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return r.load(directory)
