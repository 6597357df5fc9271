"""Adapters from the driver's test tables to the warehouse's inputs.

The driver ships TPC-H-like parquet plus an ``events`` table. These
projections map them onto the behaviour model, row for row, so every
query reads the given tables and grows with them:

* ``community_events`` - the 13-type behaviour stream, from ``events``;
* ``item_dimension``   - the item dimension, from ``part``, every row (item-less
  events are the ones that become ``Unknown``);
* ``dense_events``     - a dense per-user stream for the two detectors,
  from ``lineitem`` (the sparse ``events`` table never triggers them).

The same mappings are written as SQL in ``pulsehouse.plans.oracle`` so a
second engine can check every query.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed values of the adapters (dense stream): epoch start and step.
DENSE_EPOCH_MS = 1704067200000   # 2024-01-01T00:00:00Z
DENSE_STEP_MS = 10


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def as_timestamp(c: str | Column) -> Column:
    """The driver's parquet stores TIMESTAMP_NTZ; watermarks need TIMESTAMP."""
    return F.col(c).cast("timestamp") if isinstance(c, str) else c.cast("timestamp")


def community_events_from(events: DataFrame) -> DataFrame:
    """``events`` (event_id, ts, user_id, event_type, value, props) ->
    behaviour events. Stateless, so it applies to a stream as well."""
    k = F.get_json_object("props", "$.k").cast("bigint")
    raw = F.col("event_type")
    signup_type = (
        F.when(k < 40, "app_open")
        .when(k < 55, "follow")
        .when(k < 70, "unfollow")
        .when(k < 85, "dm")
        .otherwise("enter_profile")
    )
    click_type = (
        F.when(k % 3 == 0, "like").when(k % 3 == 1, "fav").otherwise("share")
    )
    other_type = F.when(k < 80, "comment").when(k < 90, "click_tag").otherwise("dislike")
    event_type = (
        F.when(raw == "view", "enter_item")
        .when(raw == "error", "leave_item")
        .when(raw == "signup", signup_type)
        .when(raw == "click", click_type)
        .otherwise(other_type)
    )
    eid3 = F.col("event_id") % 3
    duration = F.when(
        raw == "error",
        F.when(eid3 == 0, F.col("value") * 10)
        .when(eid3 == 1, F.col("value") / 100)
        .otherwise(F.col("value")),
    )
    ts = as_timestamp("ts")
    return events.select(
        F.col("event_id"),
        F.col("user_id"),
        event_type.alias("event_type"),
        ts.alias("ts"),
        F.concat(
            F.lit("sess_"), F.date_format(ts, "yyyyMMdd"), F.lit("_"),
            F.col("user_id").cast("string"),
        ).alias("session_id"),
        F.lit(None).cast("string").alias("platform"),
        F.when(raw != "signup", k).alias("item_id"),
        duration.alias("duration_sec"),
        F.lit(None).cast("bigint").alias("target_user_id"),
        F.when((raw == "purchase") & (k < 80), F.concat(F.lit("c"), (k % 7).cast("string")))
        .alias("comment_text"),
        F.lit(None).cast("int").alias("content_len"),
    )


def community_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return community_events_from(table(spark, sf_dir, "events"))


def item_dimension(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part")
    return part.select(
        F.col("p_partkey").alias("dim_item_id"),
        F.col("p_type").alias("category"),
        (F.col("p_size") * 100).alias("dim_content_len"),
    )


def user_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """User dimension from ``customer``, in the columns of its text file:
    user_id, interest_tags (comma list, empty for every fifth user), level."""
    key = F.col("c_custkey")
    tags = F.when(key % 5 == 0, "").when(key % 3 == 0, F.concat(
        F.lower("c_mktsegment"), F.lit(", nation_"), F.col("c_nationkey").cast("string"))).otherwise(
        F.lower("c_mktsegment"))
    return table(spark, sf_dir, "customer").select(
        key.alias("user_id"), tags.alias("interest_tags"), (key % 10).cast("int").alias("level"))


def dense_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One event per (l_orderkey, l_linenumber) - rows that repeat the pair
    are one event, with the least of their values - 10 ms apart by id,
    8 users, 100 items (``item_id``) or 5 items (``item5``)."""
    li = table(spark, sf_dir, "lineitem")
    g = li.groupBy("l_orderkey", "l_linenumber").agg(
        F.min("l_suppkey").alias("s"),
        F.min("l_partkey").alias("p"),
        F.min("l_quantity").alias("q"),
    )
    eid = F.col("l_orderkey") * 8 + F.col("l_linenumber")
    return g.select(
        eid.alias("event_id"),
        F.timestamp_millis(F.lit(DENSE_EPOCH_MS) + eid * DENSE_STEP_MS).alias("ts"),
        (F.col("s") % 8).alias("user_id"),
        (F.col("p") % 100).alias("item_id"),
        (F.col("p") % 5).alias("item5"),
        F.when(F.col("q") <= 25, "like")
        .when(F.col("q") <= 45, "comment")
        .otherwise("enter_item")
        .alias("event_type"),
    )


def dense_for_a1(dense: DataFrame) -> DataFrame:
    """A1 runs on the 5-item key so that comment runs form."""
    return dense.select(
        "event_id", "user_id", F.col("item5").alias("item_id"), "event_type", "ts",
        F.lit(None).cast("string").alias("comment_text"),
    )


def dense_for_a2(dense: DataFrame) -> DataFrame:
    return dense.select("event_id", "user_id", "item_id", "event_type", "ts")
