"""Metrics by the interests of users (SRC-4): events joined with the user
profile, a user counting under each of their tags."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsehouse import config
from pulsehouse.functions import count_if, is_type
from pulsehouse.operators.enrich import bounded_broadcast
from pulsehouse.plans.metrics import grain_column
from pulsehouse.sources.dimensions import user_interest_rows

NO_TAG = "Unknown"


def profile_of(users: DataFrame, user_dim: DataFrame,
               max_rows: int = config.DEFAULT_SCALE.broadcast_max_rows) -> DataFrame:
    """``users`` (user_id, ...) with tag and level: one row per tag of the user;
    a user without tags or without a profile keeps one row, tag ``Unknown``
    (level null without a profile). A user given twice in the dimension counts
    once, with the smallest level and every tag of that row."""
    one = user_dim.where(F.col("user_id").isNotNull()).groupBy("user_id").agg(
        F.min(F.struct("level", "interest_tags")).alias("p")).select(
        "user_id", "p.interest_tags", "p.level")
    tags = user_interest_rows(one).distinct()
    plain = one.select("user_id", "level").withColumnRenamed("level", "_level")
    small_tags, _ = bounded_broadcast(tags.drop("level"), max_rows)
    small_one, _ = bounded_broadcast(plain, max_rows)
    return (users.join(small_tags, "user_id", "left").join(small_one, "user_id", "left")
            .withColumn("tag", F.coalesce("tag", F.lit(NO_TAG)))
            .withColumnRenamed("_level", "level"))


def interest_metrics(events: DataFrame, user_dim: DataFrame, grain: str = "day") -> DataFrame:
    """Per grain and interest tag: users, events, pv, interactions, avg_level
    of the users seen. Events without a user are left out.

    Events are summed per (grain, user) before they meet the profile, so a hot
    user is one row per task and grain by then."""
    g = grain_column(grain)
    key = "day" if grain == "day" else "window"
    some = is_type(config.INTERACTION_TYPES[0])
    for t in config.INTERACTION_TYPES[1:]:
        some = some | is_type(t)
    per_user = (events.where(F.col("user_id").isNotNull() & F.col("ts").isNotNull())
                .select(g, "user_id", "event_type").groupBy(key, "user_id")
                .agg(F.count(F.lit(1)).alias("events"), count_if(is_type("enter_item")).alias("pv"),
                     count_if(some).alias("interactions")))
    return profile_of(per_user, user_dim).groupBy(key, "tag").agg(
        F.count(F.lit(1)).alias("users"), F.sum("events").alias("events"), F.sum("pv").alias("pv"),
        F.sum("interactions").alias("interactions"),
        F.try_divide(F.sum("level"), F.count("level")).alias("avg_level"))
