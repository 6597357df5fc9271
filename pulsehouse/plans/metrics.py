"""The metric catalogue (U, I, S, Q) as aggregation plans.

All count and ratio metrics come out of ONE two-level aggregation:

1. ``groupBy(grain, [dims], user_id)`` - per-user partial counts
   (map-side combine collapses a hot user or a hot item to one row per
   task before the shuffle);
2. ``groupBy(grain, [dims])`` - sums of those counts, plus exact
   distinct-user counts (DAU, UV) as counts of level-1 rows.

This avoids Spark's ``Expand`` rewrite that several ``count(DISTINCT)``
over different columns would need (one copy of every row per distinct
column). Metrics a query does not select are pruned by Catalyst from
both levels, so every named metric query shares this one plan shape.

Distinct counts are never summed across grains: each grain recomputes
them from level 1.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pulsehouse import config
from pulsehouse.functions import (
    count_if,
    day_key,
    is_c_long_stay,
    is_d1_instant_exit,
    is_e1_fast_swipe,
    is_type,
    safe_ratio,
    window_bounds,
)

GRAINS = ("day", "5m", "30m")
_WINDOW_OF = {"5m": config.WINDOW_5M, "30m": config.WINDOW_30M}

def _counters() -> dict[str, Column]:
    """Level-1 per-user counters: name -> condition."""
    return {
        "n_events": F.lit(True),
        "n_app_open": is_type("app_open"),
        "pv": is_type("enter_item"),
        "n_leave": is_type("leave_item"),
        "likes": is_type("like"),
        "favs": is_type("fav"),
        "shares": is_type("share"),
        "comments": is_type("comment"),
        "follows": is_type("follow"),
        "unfollows": is_type("unfollow"),
        "dms": is_type("dm"),
        "profile_visits": is_type("enter_profile"),
        "d1_instant_exits": is_d1_instant_exit(),
        "e1_fast_swipes": is_e1_fast_swipe(),
        "c_long_stays": is_c_long_stay(),
    }


def grain_column(grain: str, ts: str = "ts") -> Column:
    """``day`` -> yyyyMMdd string; ``5m`` / ``30m`` -> tumbling window."""
    if grain == "day":
        return day_key(ts).alias("day")
    if grain in _WINDOW_OF:
        return F.window(ts, _WINDOW_OF[grain]).alias("window")
    raise ValueError(f"unknown grain {grain!r}; expected one of {GRAINS}")


def _grain_name(grain: str) -> str:
    return "day" if grain == "day" else "window"


def activity_metrics(
    enriched: DataFrame,
    grain: str = "day",
    by: tuple[str, ...] = (),
    flatten_window: bool = True,
    distinct_users: bool = True,
    users: str = "exact",
    rsd: float = 0.01,
) -> DataFrame:
    """All U/I/Q count and ratio metrics at ``grain`` and ``by`` columns.

    ``enriched`` is the output of ``operators.enrich.enrich`` (E1 needs
    content_len). Columns: grain key(s), ``by``, then dau, dau_app_open,
    pv, uv (these four only with ``distinct_users``), likes, favs,
    shares, comments, interactions, follows, unfollows, dms,
    profile_visits, n_app_open, n_leave, n_events, avg_stay_sec,
    d1_instant_exits, e1_fast_swipes, c_long_stays, bounce_rate,
    interaction_rate, exposure_conversion, fav_rate.

    Without ``distinct_users`` the plan is a single aggregation on
    (grain, dims): no per-user level, so the partial aggregation and the
    shuffle carry one row per group and task instead of one per user.
    ``users="approx"`` keeps that single level and estimates DAU / UV with
    HyperLogLog++ (``approx_count_distinct``, relative error ``rsd``):
    fixed-size buffers, no per-user shuffle - the option for very large
    inputs where an estimate is acceptable.
    """
    if users not in ("exact", "approx"):
        raise ValueError("users must be 'exact' or 'approx'")
    g = grain_column(grain)
    gname = _grain_name(grain)
    keys = [gname, *by]
    leave = is_type("leave_item")
    stay = F.when(leave, F.col("duration_sec"))
    src = enriched.select(g, *by, "user_id", "event_type", "duration_sec", "content_len")

    if distinct_users and users == "approx":
        agg = src.groupBy(*keys).agg(
            F.approx_count_distinct("user_id", rsd).alias("dau"),
            F.approx_count_distinct(F.when(is_type("app_open"), F.col("user_id")), rsd)
            .alias("dau_app_open"),
            F.approx_count_distinct(F.when(is_type("enter_item"), F.col("user_id")), rsd)
            .alias("uv"),
            *[count_if(c).alias(n) for n, c in _counters().items()],
            F.sum(stay).alias("stay_sum"),
            F.count(stay).alias("stay_n"),
        )
        users_cols = ["dau", "dau_app_open", "pv", "uv"]
    elif distinct_users:
        level1 = src.groupBy(*keys, "user_id").agg(
            *[count_if(c).alias(n) for n, c in _counters().items()],
            F.sum(stay).alias("stay_sum"),
            F.count(stay).alias("stay_n"),
        )
        sums = [F.sum(n).cast("bigint").alias(n) for n in _counters()]
        agg = level1.groupBy(*keys).agg(
            F.count("user_id").alias("dau"),
            count_if(F.col("user_id").isNotNull() & (F.col("n_app_open") > 0)).alias("dau_app_open"),
            count_if(F.col("user_id").isNotNull() & (F.col("pv") > 0)).alias("uv"),
            *sums,
            F.sum("stay_sum").alias("stay_sum"),
            F.sum("stay_n").alias("stay_n"),
        )
        users_cols = ["dau", "dau_app_open", "pv", "uv"]
    else:
        agg = src.groupBy(*keys).agg(
            *[count_if(c).alias(n) for n, c in _counters().items()],
            F.sum(stay).alias("stay_sum"),
            F.count(stay).alias("stay_n"),
        )
        users_cols = ["pv"]
    interactions = sum(F.col(c) for c in _interaction_columns())
    out = agg.select(
        *keys,
        *users_cols,
        "likes",
        "favs",
        "shares",
        "comments",
        interactions.alias("interactions"),
        "follows",
        "unfollows",
        "dms",
        "profile_visits",
        "n_app_open",
        "n_leave",
        "n_events",
        F.try_divide(F.col("stay_sum"), F.col("stay_n")).alias("avg_stay_sec"),
        "d1_instant_exits",
        "e1_fast_swipes",
        "c_long_stays",
        safe_ratio("d1_instant_exits", "pv").alias("bounce_rate"),
        safe_ratio(interactions, "pv").alias("interaction_rate"),
        # I-06 is defined as interactions / enter_item, literally the same
        # ratio as I-05; both are kept under their own names.
        safe_ratio(interactions, "pv").alias("exposure_conversion"),
        safe_ratio("favs", "pv").alias("fav_rate"),
    )
    if grain != "day" and flatten_window:
        rest = [c for c in out.columns if c != "window"]
        out = out.select(*window_bounds("window"), *rest)
    return out


def _interaction_columns() -> tuple[str, ...]:
    return tuple(f"{t}s" for t in config.INTERACTION_TYPES)


def with_ratios(counts: DataFrame) -> DataFrame:
    """Ratio metrics from a row of counts (pv, likes, favs, shares,
    comments, d1_instant_exits, stay_sum, stay_n): the serving rows of a
    stream, whose state holds only sums."""
    inter = sum(F.col(c) for c in _interaction_columns())
    return counts.select(
        *[c for c in counts.columns if c not in ("stay_sum", "stay_n")],
        inter.alias("interactions"),
        F.try_divide(F.col("stay_sum"), F.col("stay_n")).alias("avg_stay_sec"),
        safe_ratio("d1_instant_exits", "pv").alias("bounce_rate"),
        safe_ratio(inter, "pv").alias("interaction_rate"),
        safe_ratio(inter, "pv").alias("exposure_conversion"),
        safe_ratio("favs", "pv").alias("fav_rate"),
    )


def anomalies_unpivoted(metrics: DataFrame, keys: list[str]) -> DataFrame:
    """Q-08: one row per (keys, anomaly) from the D1/E1/C counters. The tags
    overlap, so an event may count under several anomalies."""
    tags = metrics.select(
        *keys,
        F.col("d1_instant_exits").alias("D1"),
        F.col("e1_fast_swipes").alias("E1"),
        F.col("c_long_stays").alias("C"),
    )
    return tags.unpivot(keys, ["D1", "E1", "C"], "anomaly", "events")


def session_metrics(events: DataFrame, grain: str = "day") -> DataFrame:
    """S-01..S-03 from the given ``session_id``.

    S-01 counts the distinct sessions with an event in the grain, so one that
    crosses midnight counts on both days. Its length and its number of
    events (S-02, S-03) belong to the grain of its first event; a grain in
    which no session starts has no averages.

    One scan: events are summed per (session, grain) (a hot session is one
    row per task and grain), a window over a session's few grains gives its
    start, end and size, and the grains are summed.
    """
    gname = _grain_name(grain)
    per = (
        events.where(F.col("session_id").isNotNull() & F.col("ts").isNotNull())
        .groupBy("session_id", grain_column(grain))
        .agg(F.min("ts").alias("first"), F.max("ts").alias("last"),
             F.count(F.lit(1)).alias("n"))
    )
    w = Window.partitionBy("session_id")
    per = per.select(
        gname, (F.min("first").over(w) == F.col("first")).alias("starts"),
        (F.unix_micros(F.max("last").over(w)) - F.unix_micros(F.min("first").over(w))).alias("us"),
        F.sum("n").over(w).alias("events"))
    return _session_grains(per, gname, grain)


def _session_grains(per: DataFrame, gname: str, grain: str) -> DataFrame:
    """Rows (grain, starts, us, events) of sessions -> S-01..S-03."""
    # Integer sums divided once: the same value in every engine.
    started = F.count_if("starts")
    out = per.groupBy(gname).agg(
        F.count(F.lit(1)).alias("sessions"),
        (F.try_divide(F.sum(F.when(F.col("starts"), F.col("us"))), started)
         / F.lit(1_000_000.0)).alias("avg_session_sec"),
        F.try_divide(F.sum(F.when(F.col("starts"), F.col("events"))), started)
        .alias("avg_events_per_session"),
    )
    if grain != "day":
        out = out.select(*window_bounds(gname), "sessions", "avg_session_sec",
                         "avg_events_per_session")
    return out


def session_rollup(per_session: DataFrame) -> DataFrame:
    """Per-session rows (s_start, s_end, s_events) -> S-01..S-03 per day,
    with the rules of ``session_metrics``. Within a session events are less
    than a day apart, so it has one on every day it spans."""
    days = F.sequence(F.to_date("s_start"), F.to_date("s_end"))
    per = per_session.select(
        F.posexplode(days).alias("i", "d"),
        (F.unix_micros("s_end") - F.unix_micros("s_start")).alias("us"), "s_events")
    per = per.select(F.date_format("d", "yyyyMMdd").alias("day"), (F.col("i") == 0).alias("starts"),
                     "us", F.col("s_events").alias("events"))
    return _session_grains(per, "day", "day")


def new_users(events: DataFrame, grain: str = "day") -> DataFrame:
    """U-04 / NEW-3 (batch): users whose first-ever app_open falls in the
    grain. "Seen" means an earlier app_open, over the whole history given."""
    first_open = (
        events.where(is_type("app_open") & F.col("user_id").isNotNull() & F.col("ts").isNotNull())
        .groupBy("user_id")
        .agg(F.min("ts").alias("first_open"))
    )
    g = grain_column(grain, "first_open")
    gname = _grain_name(grain)
    out = first_open.groupBy(g).agg(F.count(F.lit(1)).alias("new_users"))
    if grain != "day":
        out = out.select(*window_bounds(gname), "new_users")
    return out


def distinct_app_open_users(events: DataFrame) -> DataFrame:
    """Distinct user_ids with an app_open (the per-batch step of NEW-1)."""
    return events.where(is_type("app_open") & F.col("user_id").isNotNull()).select("user_id").distinct()
