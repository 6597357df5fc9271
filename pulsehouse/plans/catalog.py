"""Named queries over the driver tables.

Each entry is ``f(spark, sf_dir) -> DataFrame`` and reads the given
tables through ``sources.adapters``. Output columns are flat (window
bounds in epoch seconds, days as yyyyMMdd, event times in epoch ms) so
that a second engine can compare values exactly.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pulsehouse.functions import behaviour_tags, day_key, stable_round
from pulsehouse.operators import cheat, sessions
from pulsehouse.operators.enrich import enrich
from pulsehouse.operators.interests import interest_metrics
from pulsehouse.plans import grains as G
from pulsehouse.plans import metrics as M
from pulsehouse.plans import rollups as R
from pulsehouse.sinks.kv import to_kv_rows, to_kv_rows_by
from pulsehouse.session import new_run_dir
from pulsehouse.sources import adapters as A
from pulsehouse.sources.dimensions import load_item_dim, load_user_dim
from pulsehouse.sources.events import decode_events, encode_events, typed_events

Query = Callable[[SparkSession, str], DataFrame]


def _com(spark: SparkSession, sf: str) -> DataFrame:
    return A.community_events(spark, sf)


def _enriched(spark: SparkSession, sf: str) -> DataFrame:
    return enrich(_com(spark, sf), A.item_dimension(spark, sf))


def _stay_rounded(df: DataFrame) -> DataFrame:
    # avg of doubles depends on summation order; 6 digits is exact enough
    # for every engine to agree. Ratios of counts need no rounding.
    if "avg_stay_sec" in df.columns:
        df = df.withColumn("avg_stay_sec", stable_round("avg_stay_sec"))
    return df


def _item_key():
    # Row-level outputs carry the conventional unknown-member key -1 for
    # events without an item, so the column has no NULLs.
    return F.coalesce("item_id", F.lit(-1).cast("bigint")).alias("item_key")


def _with_item(df: DataFrame) -> DataFrame:
    """Per-item metrics are over events that have an item."""
    return df.where(F.col("item_id").isNotNull())


# -- sources / enrichment -----------------------------------------------------

def event_decode(spark, sf):
    """SRC-2: events serialised to the topic's JSON format, then decoded."""
    wire = encode_events(_com(spark, sf))
    ev = typed_events(decode_events(wire))
    return ev.select(
        "event_id", "user_id", "event_type",
        F.unix_millis("ts").alias("ts_ms"),
        "session_id", _item_key(), "duration_sec", "comment_text",
    )


def event_decode_local_time(spark, sf):
    """SRC-2 for producers that write bare local times: the same events with
    the offset cut off, read in the source zone."""
    wire = encode_events(_com(spark, sf).withColumn("event_id", F.col("event_id").cast("string")))
    bare = wire.select(F.regexp_replace("value", r"\+08:00\"", "\"").alias("value"))
    return typed_events(decode_events(bare)).select(
        "event_id", F.unix_millis("ts").alias("ts_ms"))


def enrich_left_unknown(spark, sf):
    """JOIN-1 + PRJ-3/4: every event kept, misses are Unknown / 0."""
    return _enriched(spark, sf).select(
        "event_id", _item_key(), "event_type", "category", "content_len"
    )


def event_tags(spark, sf):
    """PRJ-6: every event with its behaviour tags."""
    return _enriched(spark, sf).select("event_id", *behaviour_tags())


def enrich_from_file(spark, sf):
    """SRC-3 + JOIN-1: the dimension written as the '|' text file it comes
    as, read back and joined."""
    path = f"{new_run_dir(spark, 'dim_file')}/dim_item"
    A.item_dimension(spark, sf).write.option("delimiter", "|").csv(path)
    return enrich(_com(spark, sf), load_item_dim(spark, path)).select(
        "event_id", "category", "content_len")


# -- U metrics ------------------------------------------------------------------

def pv_by_category_30m(spark, sf):
    """U-05/U-07: PV per 30-minute window and category (flagship)."""
    m = M.activity_metrics(_enriched(spark, sf), "30m", ("category",), distinct_users=False)
    return m.select("window_start", "window_end", "category", "pv")


def pv_uv_5m(spark, sf):
    """U-05/U-06 per 5-minute window."""
    m = M.activity_metrics(_com(spark, sf), "5m")
    return m.select("window_start", "window_end", "pv", "uv")


def pv_uv_by_category_daily(spark, sf):
    """U-07: PV / UV per day and category."""
    m = M.activity_metrics(_enriched(spark, sf), "day", ("category",))
    return m.select("day", "category", "pv", "uv")


def dau_daily(spark, sf):
    """U-01: distinct users over any event, and over app_open only."""
    m = M.activity_metrics(_com(spark, sf), "day")
    return m.select("day", "dau", "dau_app_open")


def avg_stay_by_category(spark, sf):
    """U-08 per day and category."""
    m = M.activity_metrics(_enriched(spark, sf), "day", ("category",), distinct_users=False)
    return _stay_rounded(m.select("day", "category", "n_leave", "avg_stay_sec"))


def avg_stay_by_item(spark, sf):
    """U-08 per day and item."""
    m = M.activity_metrics(_with_item(_enriched(spark, sf)), "day", ("item_id",), distinct_users=False)
    return _stay_rounded(m.select("day", "item_id", "n_leave", "avg_stay_sec"))


def bounce_rate_by_item(spark, sf):
    """U-10: D1 exits / enter_item per day and item."""
    m = M.activity_metrics(_with_item(_enriched(spark, sf)), "day", ("item_id",), distinct_users=False)
    return m.select("day", "item_id", "pv", "d1_instant_exits", "bounce_rate")


def bounce_rate_by_category(spark, sf):
    """U-12: D1 exits / enter_item per day and category."""
    m = M.activity_metrics(_enriched(spark, sf), "day", ("category",), distinct_users=False)
    return m.select("day", "category", "pv", "d1_instant_exits", "bounce_rate")


def new_users_daily(spark, sf):
    """U-04 / NEW-3: users whose first-ever app_open is that day."""
    return M.new_users(_com(spark, sf), "day")


def new_users_30m(spark, sf):
    """U-04 per 30-minute window of the first app_open."""
    return M.new_users(_com(spark, sf), "30m")


# -- I metrics ------------------------------------------------------------------

def interactions_daily(spark, sf):
    """I-01..I-07 per day and category."""
    m = M.activity_metrics(_enriched(spark, sf), "day", ("category",), distinct_users=False)
    return m.select(
        "day", "category", "likes", "favs", "shares", "comments", "interactions",
        "interaction_rate", "exposure_conversion", "fav_rate",
    )


def interaction_rates_by_category(spark, sf):
    """I-05..I-07 per day and category: interaction rate, exposure
    conversion and favourite rate, with their counts."""
    m = M.activity_metrics(_enriched(spark, sf), "day", ("category",), distinct_users=False)
    return m.select("day", "category", "pv", "interactions", "favs",
                    "interaction_rate", "exposure_conversion", "fav_rate")


def interactions_30m(spark, sf):
    """I-01..I-07 per 30-minute window (all categories)."""
    m = M.activity_metrics(_com(spark, sf), "30m", distinct_users=False)
    return m.select(
        "window_start", "window_end", "pv", "likes", "favs", "shares", "comments",
        "interactions", "interaction_rate", "exposure_conversion", "fav_rate",
    )


def social_counts_daily(spark, sf):
    """I-08..I-11 per day."""
    m = M.activity_metrics(_com(spark, sf), "day", distinct_users=False)
    return m.select("day", "follows", "unfollows", "dms", "profile_visits")


# -- S metrics ------------------------------------------------------------------

def sessions_daily(spark, sf):
    """S-01..S-03 from the given session_id."""
    return M.session_metrics(_com(spark, sf), "day")


def sessionize_gap(spark, sf):
    """S-01..S-03 over sessions that start with an app_open or after 30
    minutes of inactivity."""
    return M.session_rollup(sessions.derived_sessions(_com(spark, sf)))


# -- Q metrics ------------------------------------------------------------------

def quality_daily(spark, sf):
    """Q-05..Q-07 per day."""
    m = M.activity_metrics(_enriched(spark, sf), "day", distinct_users=False)
    return m.select("day", "n_leave", "d1_instant_exits", "e1_fast_swipes", "c_long_stays")


def long_stay_daily(spark, sf):
    """Q-07: leave_item events with 1800 <= duration <= 3600 s, per day."""
    m = M.activity_metrics(_com(spark, sf), "day", distinct_users=False)
    return m.select("day", "n_leave", "c_long_stays")


def anomalies_by_category(spark, sf):
    """Q-08: D1 / E1 / C counts per day and category, one row per anomaly."""
    m = M.activity_metrics(_enriched(spark, sf), "day", ("category",), distinct_users=False)
    return M.anomalies_unpivoted(m, ["day", "category"])


def _a1(spark, sf):
    return cheat.detect_a1(A.dense_for_a1(A.dense_events(spark, sf)))


def _a2(spark, sf):
    return cheat.detect_a2(A.dense_for_a2(A.dense_events(spark, sf)))


def cheat_a1(spark, sf):
    """CEP-1 on the dense stream: every event with its A1 flag."""
    return _a1(spark, sf).select(
        "event_id", "user_id", "item_id", "event_type",
        F.unix_millis("ts").alias("ts_ms"), "is_cheat_a1",
    )


def cheat_a2(spark, sf):
    """CEP-2 on the dense stream: the flagged likes."""
    return _a2(spark, sf).select(
        "event_id", "user_id", "item_id", "event_type",
        F.unix_millis("ts").alias("ts_ms"), "is_cheat_a2",
    )


def cheat_events(spark, sf):
    """The combined cheat record: every keyed event of the dense stream
    with both flags (A1 on the 5-item key, A2 on the user)."""
    out = cheat.cheat_flags(A.dense_events(spark, sf), a1_item="item5")
    return out.select("event_id", "user_id", "event_type",
                      F.unix_millis("ts").alias("ts_ms"), "is_cheat_a1", "is_cheat_a2")


def cheat_a1_ids(spark, sf):
    """Q-01: distinct users / items with A1-flagged comments, per day."""
    return cheat.a1_ids(_a1(spark, sf), day_key("ts"))


def cheat_a2_users(spark, sf):
    """Q-02: distinct users with A2-flagged likes, per day."""
    return cheat.a2_users(_a2(spark, sf), day_key("ts"))


def interests_daily(spark, sf):
    """SRC-4: activity per day and interest of the users, from the profile
    written as the '|' text file it comes as and read back."""
    path = f"{new_run_dir(spark, 'dim_user')}/dim_user"
    A.user_profile(spark, sf).write.option("delimiter", "|").option("emptyValue", "").csv(path)
    return interest_metrics(_com(spark, sf), load_user_dim(spark, path))


# -- all grains -----------------------------------------------------------------

def activity_all_grains(spark, sf):
    """U, I and Q metrics per 5 minutes, 30 minutes and day, with and without
    category, out of one expansion."""
    return _stay_rounded(G.activity_all_grains(_enriched(spark, sf)))


def sessions_all_grains(spark, sf):
    """S-01..S-03 from the given session_id at all grains."""
    return G.sessions_all_grains(_com(spark, sf))


def new_users_all_grains(spark, sf):
    """U-04 / NEW-3 at all grains."""
    return G.new_users_all_grains(_com(spark, sf))


def cheat_all_grains(spark, sf):
    """Q-01 and Q-02 at all grains."""
    return G.cheat_all_grains(_a1(spark, sf), _a2(spark, sf))


def users_sketch_rollup(spark, sf):
    """U-01 / U-06 estimated: HLL sketches stored per 5 minutes and category,
    read back and merged to all grains (some hundred users a group, as in
    the small tables, are counted exactly)."""
    stored = R.store(R.user_sketches(_enriched(spark, sf)), f"{new_run_dir(spark, 'sketches')}/users")
    return R.roll_up_sketches(stored)


def users_bitmap_rollup(spark, sf):
    """U-01 / U-06 exact: users numbered densely, bitmaps stored per 5 minutes
    and category, merged to all grains."""
    run = new_run_dir(spark, "bitmaps")
    ev = _enriched(spark, sf)
    ids = R.IdDictionary(spark, f"{run}/ids").add(ev.select("user_id"), 0)
    stored = R.store(R.user_bitmaps(ev, ids), f"{run}/users")
    return R.roll_up_bitmaps(stored, tuple(R.KINDS), ("category",))


def sessions_bitmap_rollup(spark, sf):
    """S-01 exact by bitmaps: sessions with an event in each window and day."""
    run = new_run_dir(spark, "session_bitmaps")
    ev = _com(spark, sf)
    ids = R.IdDictionary(spark, f"{run}/ids", "string").add(ev.select("session_id"), 0)
    stored = R.store(R.distinct_bitmaps(ev, ids, "session_id", {"sessions": F.lit(True)}),
                     f"{run}/sessions")
    return R.roll_up_bitmaps(stored, ("sessions",))


# -- serving ----------------------------------------------------------------------

_ACTIVITY_FIELDS = [
    "dau", "pv", "uv", "likes", "favs", "shares", "comments", "interactions",
    "follows", "unfollows", "dms", "profile_visits", "n_leave",
    "d1_instant_exits", "e1_fast_swipes", "c_long_stays",
    "bounce_rate", "interaction_rate", "fav_rate",
]


def user_activity_5m(spark, sf):
    """The serving row: all activity metrics per 5-minute window and
    category."""
    m = M.activity_metrics(_enriched(spark, sf), "5m", ("category",), flatten_window=False)
    out = m.select("window", "category", *_ACTIVITY_FIELDS)
    from pulsehouse.functions import window_bounds
    return out.select(*window_bounds("window"), "category", *_ACTIVITY_FIELDS)


def user_activity_30m(spark, sf):
    """The serving row per 30-minute window and category."""
    m = M.activity_metrics(_enriched(spark, sf), "30m", ("category",))
    return m.select("window_start", "window_end", "category", *_ACTIVITY_FIELDS)


def metrics_kv(spark, sf):
    """SNK-1 projection: (key, field, value, ttl_sec) of the serving row."""
    m = M.activity_metrics(_enriched(spark, sf), "5m", ("category",), flatten_window=False)
    return to_kv_rows(m.select("window", "category", *_ACTIVITY_FIELDS))


def daily_kv(spark, sf):
    """SNK-1 beyond the activity rows: DAU, new users, sessions and cheat
    counts of each day as (key, field, value, ttl_sec)."""
    com = _com(spark, sf)
    out = to_kv_rows_by(dau_daily(spark, sf), "dws:dau", ["day"])
    for prefix, df in (
            ("dws:new_users", M.new_users(com, "day")),
            ("dws:sessions", M.session_metrics(com, "day").select("day", "sessions")),
            ("dws:cheat_a1", cheat_a1_ids(spark, sf)), ("dws:cheat_a2", cheat_a2_users(spark, sf))):
        out = out.unionByName(to_kv_rows_by(df, prefix, ["day"]))
    return out


QUERIES: dict[str, Query] = {
    "event_decode": event_decode,
    "event_decode_local_time": event_decode_local_time,
    "enrich_left_unknown": enrich_left_unknown,
    "event_tags": event_tags,
    "enrich_from_file": enrich_from_file,
    "pv_by_category_30m": pv_by_category_30m,
    "pv_uv_5m": pv_uv_5m,
    "pv_uv_by_category_daily": pv_uv_by_category_daily,
    "dau_daily": dau_daily,
    "avg_stay_by_category": avg_stay_by_category,
    "avg_stay_by_item": avg_stay_by_item,
    "bounce_rate_by_item": bounce_rate_by_item,
    "bounce_rate_by_category": bounce_rate_by_category,
    "new_users_daily": new_users_daily,
    "new_users_30m": new_users_30m,
    "interactions_daily": interactions_daily,
    "interaction_rates_by_category": interaction_rates_by_category,
    "interactions_30m": interactions_30m,
    "social_counts_daily": social_counts_daily,
    "sessions_daily": sessions_daily,
    "sessionize_gap": sessionize_gap,
    "quality_daily": quality_daily,
    "long_stay_daily": long_stay_daily,
    "anomalies_by_category": anomalies_by_category,
    "cheat_a1": cheat_a1,
    "cheat_a2": cheat_a2,
    "cheat_events": cheat_events,
    "cheat_a1_ids": cheat_a1_ids,
    "cheat_a2_users": cheat_a2_users,
    "interests_daily": interests_daily,
    "activity_all_grains": activity_all_grains,
    "sessions_all_grains": sessions_all_grains,
    "new_users_all_grains": new_users_all_grains,
    "cheat_all_grains": cheat_all_grains,
    "users_sketch_rollup": users_sketch_rollup,
    "users_bitmap_rollup": users_bitmap_rollup,
    "sessions_bitmap_rollup": sessions_bitmap_rollup,
    "user_activity_5m": user_activity_5m,
    "user_activity_30m": user_activity_30m,
    "metrics_kv": metrics_kv,
    "daily_kv": daily_kv,
}
