"""Replay-safe new-user counting per micro-batch (NEW-1, NEW-2, STR-8,
STR-11, SNK-4).

Two exact forms:

* ``first_app_opens`` + ``BatchNewUserCount`` (default): a streaming
  ``dropDuplicates(["user_id"])`` keeps every user ever seen in the state
  store (RocksDB, hash-partitioned by user, checkpointed), so each
  micro-batch looks up only its own ids - O(batch), not O(all users) - and
  emits each user's first app_open once; ``foreachBatch`` counts them.
  The checkpoint makes a replayed batch see the same state.
* ``NewUserCounter``: the same over a seen-users table in the shared
  folder, for deployments that want the set as a readable table.

A cardinality sketch cannot stand in for the seen set: "new" is a set
difference, which HLL does not support.

``NewUserCounter``, per micro-batch: distinct app_open users -> those
never seen in earlier batches -> recorded as seen under the batch's id ->
one result row (batch_id, processed_at, "ALL", u_04_new_user_count).
Its seen set is an exact, distributed table (``seen/batch_id=<n>/``)
instead of a Bloom filter on the driver: nothing is collected. A replayed batch_id
compares only against rows of *earlier* batches and overwrites its own
folder, so it gives the same count (at-least-once delivery, idempotent
output).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pulsehouse import config
from pulsehouse.functions import is_type
from pulsehouse.operators.enrich import bounded_broadcast
from pulsehouse.plans.metrics import distinct_app_open_users
from pulsehouse.streaming.enrichment import path_exists

# Hash partitions of the seen-users table.
SEEN_BUCKETS = 64

RESULT_SCHEMA = "batch_id bigint, processed_at timestamp, category string, u_04_new_user_count bigint"


def _read_or_none(spark: SparkSession, path: str) -> DataFrame | None:
    return spark.read.parquet(path) if path_exists(spark, path) else None


def first_app_opens(events: DataFrame) -> DataFrame:
    """Each user's first app_open, once, over the stream's lifetime."""
    return (
        events.where(is_type("app_open") & F.col("user_id").isNotNull())
        .select("user_id", "ts")
        .dropDuplicates(["user_id"])
    )


class BatchNewUserCount:
    """``foreachBatch`` over ``first_app_opens``: one result row per
    micro-batch under ``batch_id=<n>`` (a replay overwrites it)."""

    def __init__(self, result_path: str):
        self.result_path = result_path.rstrip("/")

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        batch.agg(F.count(F.lit(1)).alias("u_04_new_user_count")).select(
            F.current_timestamp().alias("processed_at"),
            F.lit("ALL").alias("category"),
            "u_04_new_user_count",
        ).write.mode("overwrite").parquet(f"{self.result_path}/batch_id={batch_id}")


class NewUserCounter:
    """``foreachBatch`` function; ``seen_path`` and ``result_path`` live in
    the shared checkpoint folder."""

    def __init__(self, seen_path: str, result_path: str,
                 broadcast_max_rows: int = config.DEFAULT_SCALE.broadcast_max_rows):
        self.seen_path = seen_path.rstrip("/")
        self.result_path = result_path.rstrip("/")
        self.broadcast_max_rows = broadcast_max_rows

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        keys = ["user_bucket", "user_id"]
        ids = distinct_app_open_users(batch).withColumn(
            "user_bucket", F.pmod(F.xxhash64("user_id"), F.lit(SEEN_BUCKETS))
        )
        seen = _read_or_none(spark, self.seen_path)
        if seen is not None:
            earlier = seen.where(F.col("batch_id") < batch_id).select(*keys)
            # The batch's ids are bounded by the trigger size: when they fit,
            # broadcast them and semi-join the seen table, which is
            # partitioned by user_bucket, so dynamic partition pruning reads
            # only the buckets the batch's users fall in; otherwise anti-join
            # by shuffle.
            small, is_bc = bounded_broadcast(ids, self.broadcast_max_rows)
            if is_bc:
                already = earlier.join(small, keys, "left_semi")
                new = ids.join(F.broadcast(already.distinct()), keys, "left_anti")
            else:
                new = ids.join(earlier, keys, "left_anti")
        else:
            new = ids
        target = f"{self.seen_path}/batch_id={batch_id}"
        new.write.mode("overwrite").partitionBy("user_bucket").parquet(target)
        written = spark.read.parquet(target)
        # batch_id is the folder's partition value, not a data column.
        result = written.agg(F.count(F.lit(1)).alias("u_04_new_user_count")).select(
            F.current_timestamp().alias("processed_at"),
            F.lit("ALL").alias("category"),
            "u_04_new_user_count",
        )
        result.write.mode("overwrite").parquet(f"{self.result_path}/batch_id={batch_id}")


def new_user_results(spark: SparkSession, result_path: str) -> DataFrame:
    """All result rows so far (one per batch_id)."""
    return spark.read.parquet(result_path).select(
        F.col("batch_id").cast("bigint").alias("batch_id"),
        "processed_at", "category", "u_04_new_user_count",
    )
