"""Lake archive and file exports (SNK-2, SNK-4, SNK-5)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from pulsehouse.functions import day_key


def lake_format(spark) -> str:
    """``delta`` when its connector is on the classpath, else parquet."""
    try:
        spark.sparkContext._jvm.java.lang.Class.forName("io.delta.sql.DeltaSparkSessionExtension")
        return "delta"
    except Exception:
        return "parquet"


def archive_stream(
    stream: DataFrame,
    base_path: str,
    layer: str,
    query_name: str | None = None,
    output_mode: str = "append",
    fmt: str | None = None,
    partition_by_day: bool = True,
    trigger: dict | None = None,
) -> StreamingQuery:
    """SNK-2: append a stream to ``base/layer`` with its checkpoint at
    ``base/checkpoint/layer``; partitioned by event day so reads prune."""
    base = base_path.rstrip("/")
    df = stream
    if partition_by_day and "ts" in df.columns and "event_day" not in df.columns:
        df = df.withColumn("event_day", day_key("ts"))
    w = (
        df.writeStream.format(fmt or lake_format(stream.sparkSession))
        .outputMode(output_mode)
        .option("checkpointLocation", f"{base}/checkpoint/{layer}")
        .option("path", f"{base}/{layer}")
    )
    if partition_by_day and "event_day" in df.columns:
        w = w.partitionBy("event_day")
    if query_name:
        w = w.queryName(query_name)
    w = w.trigger(**(trigger or {"availableNow": True}))
    return w.start()


def archive_batch(df: DataFrame, base_path: str, layer: str, fmt: str = "parquet") -> None:
    """Batch append to the same layout as ``archive_stream``."""
    out = df
    if "ts" in out.columns and "event_day" not in out.columns:
        out = out.withColumn("event_day", day_key("ts"))
    w = out.write.mode("append").format(fmt)
    if "event_day" in out.columns:
        w = w.partitionBy("event_day")
    w.save(f"{base_path.rstrip('/')}/{layer}")


def export_csv(df: DataFrame, path: str) -> None:
    """SNK-5: header CSV export of a result (end of a timed run). Written by
    the executors, one file per partition."""
    df.write.mode("overwrite").option("header", True).csv(path)


def publish_view(df: DataFrame, name: str) -> None:
    """SNK-4: expose a result as a temp view for SQL users."""
    df.createOrReplaceTempView(name)
