"""Key-value serving output (SNK-1, SNK-6).

A windowed metric row becomes one (key, field, value) row per metric:

* key   ``{prefix}:{start}_{end}[:{category}]`` with window bounds in
  epoch seconds;
* field every column except window, category and session_id;
* value the metric as text, NULL written as "0";
* ttl_sec how long the store keeps the key.

The projection is a plain DataFrame (``unpivot``), so it is distributed.
Writing goes through ``write_kv_partitions``: executors push their own
partition to the store through a client the caller supplies; nothing is
collected to the driver.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from itertools import groupby

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsehouse import config

KV_COLUMNS = ["key", "field", "value", "ttl_sec"]


def kv_key(prefix: str, with_category: bool) -> F.Column:
    start = F.unix_seconds(F.col("window.start")).cast("string")
    end = F.unix_seconds(F.col("window.end")).cast("string")
    parts = [F.lit(prefix), F.concat(start, F.lit("_"), end)]
    if with_category:
        parts.append(F.col("category"))
    return F.concat_ws(":", *parts)


def to_kv_rows(
    metrics: DataFrame,
    prefix: str = config.KV_PREFIX,
    ttl_sec: int = config.KV_TTL_SEC,
    null_value: str = config.KV_NULL_VALUE,
) -> DataFrame:
    """Windowed metric rows -> (key, field, value, ttl_sec)."""
    fields = [c for c in metrics.columns if c not in config.KV_GROUP_COLUMNS]
    with_cat = "category" in metrics.columns
    keyed = metrics.select(
        kv_key(prefix, with_cat).alias("key"),
        *[F.col(c).cast("string").alias(c) for c in fields],
    )
    long = keyed.unpivot(["key"], fields, "field", "value")
    return long.select(
        "key",
        "field",
        F.coalesce(F.col("value"), F.lit(null_value)).alias("value"),
        F.lit(ttl_sec).alias("ttl_sec"),
    )


def to_kv_rows_by(
    metrics: DataFrame,
    prefix: str,
    keys: list[str],
    ttl_sec: int = config.KV_TTL_SEC,
    null_value: str = config.KV_NULL_VALUE,
) -> DataFrame:
    """Metric rows that are not windows (days, users, ...) -> kv rows: key
    ``{prefix}:{key values}``, a field per other column."""
    fields = [c for c in metrics.columns if c not in keys]
    keyed = metrics.select(
        F.concat_ws(":", F.lit(prefix), *[F.col(k).cast("string") for k in keys]).alias("key"),
        *[F.col(c).cast("string").alias(c) for c in fields])
    return keyed.unpivot(["key"], fields, "field", "value").select(
        "key", "field", F.coalesce("value", F.lit(null_value)).alias("value"),
        F.lit(ttl_sec).alias("ttl_sec"))


def write_kv_partitions(
    kv_rows: DataFrame,
    client_factory: Callable[[], object],
    put: Callable[[object, str, dict[str, str], int], None],
) -> dict[str, int]:
    """Push kv rows to an external store from the executors.

    ``client_factory()`` opens a connection on the executor;
    ``put(client, key, fields, ttl)`` writes all fields of one key in one
    call (rows are brought together by key first). A store that is down
    fails its rows, which are counted (SNK-6: degrade, but never silently);
    the batch itself is not retried here. Writes are idempotent; after a
    retried task the counts may exceed the rows.
    """
    from pulsehouse.session import ship_package

    ship_package(kv_rows.sparkSession)
    sc = kv_rows.sparkSession.sparkContext
    written = sc.accumulator(0)
    failed = sc.accumulator(0)

    def _push(rows: Iterable) -> None:
        try:
            client = client_factory()
        except Exception:  # store unreachable: count the partition as failed
            n = sum(1 for _ in rows)
            failed.add(n)
            return
        for key, group in groupby(rows, key=lambda r: r["key"]):
            same = list(group)  # one key's fields: as many as the metric columns
            try:
                put(client, key, {r["field"]: r["value"] for r in same}, same[0]["ttl_sec"])
                written.add(len(same))
            except Exception:
                failed.add(len(same))
        close = getattr(client, "close", None)
        if callable(close):
            close()

    kv_rows.repartition("key").sortWithinPartitions("key").foreachPartition(_push)
    return {"written": written.value, "failed": failed.value}


def upsert_kv_table(kv_rows: DataFrame, path: str, batch_id: int) -> None:
    """File-backed store for the kv rows of one micro-batch: the batch is
    written under ``batch_id=<id>`` (a replay overwrites the same folder)
    with the time at which each row expires, and ``latest_kv`` reads the
    newest value of each (key, field)."""
    expire = F.current_timestamp() + F.make_dt_interval(secs=F.col("ttl_sec").cast("decimal(18,6)"))
    (
        kv_rows.withColumn("batch_id", F.lit(batch_id).cast("bigint"))
        .withColumn("expire_at", expire)
        .write.mode("overwrite")
        .parquet(f"{path.rstrip('/')}/batch_id={batch_id}")
    )


def latest_kv(spark, path: str, at=None) -> DataFrame:
    """Current value of every (key, field) in a table written by
    ``upsert_kv_table``: the value from the highest batch_id, unless it has
    expired by ``at`` (a timestamp; now by default)."""
    t = spark.read.parquet(path)
    now = F.current_timestamp() if at is None else F.lit(at)
    newest = F.max_by(F.struct("value", "ttl_sec", "expire_at"), "batch_id")
    return t.groupBy("key", "field").agg(newest.alias("v")).where(F.col("v.expire_at") > now).select(
        "key", "field", "v.value", "v.ttl_sec"
    )


class KVStream:
    """``foreachBatch`` sink (SNK-1): windowed metric rows of a stream, with
    their ratios where ``ratios`` is set, into the file-backed store under
    ``path``, keyed by ``prefix``. In update mode open windows are refreshed
    every trigger, in append mode written once closed."""

    def __init__(self, path: str, prefix: str = config.KV_PREFIX, ratios: bool = True):
        self.path = path
        self.prefix = prefix
        self.ratios = ratios

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        from pulsehouse.plans.metrics import with_ratios

        rows = with_ratios(batch).drop("n_events") if self.ratios else batch
        upsert_kv_table(to_kv_rows(rows, self.prefix), self.path, batch_id)
