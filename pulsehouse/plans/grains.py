"""Every metric at every grain in one pass: 5 minutes, 30 minutes and day,
each over all events and per dimension (``category``).

The raw rows are expanded once, by ``GROUPING SETS``, and aggregated on the
map side before anything is shuffled. Exact distinct users add one level: rows
per (group, user), then rows per group; the second exchange carries one
row per group and task. ``users="sketch"`` counts users by mergeable HLL sketches
in the first level, which leaves a single exchange.

Result keys: ``grain``, ``window_start`` / ``window_end`` (epoch seconds; days
are cut in the session time zone), ``by_category`` and ``category`` (null where
``by_category`` is false).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pulsehouse.functions import count_if, is_type, safe_ratio
from pulsehouse.plans.metrics import _counters, _interaction_columns

GRAINS = ("5m", "30m", "day")
SECONDS = {"5m": 300, "30m": 1800}
LG_K = 12


def grain_start(grain: str, ts: str | Column = "ts") -> Column:
    """Epoch second at which the window or day of ``ts`` starts."""
    ts = F.col(ts) if isinstance(ts, str) else ts
    if grain == "day":
        return F.unix_seconds(F.date_trunc("day", ts))
    n = SECONDS[grain]
    return (F.floor(F.unix_seconds(ts) / n) * n).cast("long")


def grain_end(grain: Column, start: Column) -> Column:
    """End of the window, next midnight for a day."""
    midnight = F.unix_seconds(F.date_add(F.to_date(F.timestamp_seconds(start)), 1).cast("timestamp"))
    return (F.when(grain == "5m", start + SECONDS["5m"]).when(grain == "30m", start + SECONDS["30m"])
            .otherwise(midnight))


def _grouped(rows: DataFrame, by: tuple[str, ...], more: list[str], aggs: list[Column],
             grains: tuple[str, ...] = GRAINS, whole: bool = True) -> DataFrame:
    """``aggs`` per (grain, start), ``by`` or all, and ``more`` keys, out of
    one expansion. ``rows`` has the columns g_<grain>."""
    starts = [f"g_{g}" for g in grains]
    splits = [by, ()] if by and whole else [by]
    sets = [[s, *dims, *more] for s in starts for dims in splits]
    cols = [*starts, *by, *more]
    out = rows.groupingSets([[F.col(c) for c in s] for s in sets], *[F.col(c) for c in cols]).agg(
        *aggs, *[F.grouping(s).alias(f"_{s}") for s in starts],
        *[F.grouping(b).alias(f"_by_{b}") for b in by])
    grain = F.lit(grains[-1])
    start = F.col(starts[-1])
    for g, s in list(zip(grains, starts, strict=True))[-2::-1]:
        grain = F.when(F.col(f"_{s}") == 0, g).otherwise(grain)
        start = F.when(F.col(f"_{s}") == 0, F.col(s)).otherwise(start)
    flags = [(F.col(f"_by_{b}") == 0).alias(f"by_{b}") for b in by]
    names = [c for c in out.columns if c not in starts and not c.startswith("_")
             and c not in by and c not in more]
    return out.select(grain.alias("grain"), start.alias("window_start"), *flags, *by, *more, *names)


def _keys(by: tuple[str, ...]) -> list[str]:
    return ["grain", "window_start", *[f"by_{b}" for b in by], *by]


def _with_end(df: DataFrame) -> DataFrame:
    rest = [c for c in df.columns if c not in ("grain", "window_start")]
    return df.select("grain", "window_start",
                     grain_end(F.col("grain"), F.col("window_start")).alias("window_end"), *rest)


def _with_starts(df: DataFrame, grains: tuple[str, ...], ts: str = "ts") -> DataFrame:
    return df.where(F.col(ts).isNotNull()).withColumns(
        {f"g_{g}": grain_start(g, ts) for g in grains})


def activity_all_grains(enriched: DataFrame, by: tuple[str, ...] = ("category",),
                        grains: tuple[str, ...] = GRAINS, users: str = "exact") -> DataFrame:
    """U-01, U-05..U-12, I-01..I-11 and Q-05..Q-08 at all ``grains``, per
    ``by`` and over everything, from the output of ``operators.enrich``."""
    if users not in ("exact", "sketch"):
        raise ValueError("users must be 'exact' or 'sketch'")
    rows = _with_starts(enriched, grains).select(
        *[f"g_{g}" for g in grains], *by, "user_id", "event_type", "duration_sec", "content_len")
    stay = F.when(is_type("leave_item"), F.col("duration_sec"))
    counts = [count_if(c).alias(n) for n, c in _counters().items()]
    counts += [F.sum(stay).alias("stay_sum"), F.count(stay).alias("stay_n")]
    if users == "sketch":
        def sketch(cond: Column, name: str) -> Column:
            return F.hll_sketch_estimate(F.hll_sketch_agg(
                F.when(cond, F.col("user_id")), LG_K)).alias(name)

        agg = _grouped(rows, by, [], [
            sketch(F.lit(True), "dau"), sketch(is_type("app_open"), "dau_app_open"),
            sketch(is_type("enter_item"), "uv"), *counts], grains)
    else:
        per_user = _grouped(rows, by, ["user_id"], counts, grains)
        someone = F.col("user_id").isNotNull()
        agg = per_user.groupBy(*_keys(by)).agg(
            F.count("user_id").alias("dau"),
            count_if(someone & (F.col("n_app_open") > 0)).alias("dau_app_open"),
            count_if(someone & (F.col("pv") > 0)).alias("uv"),
            *[F.sum(n).alias(n) for n in _counters()],
            F.sum("stay_sum").alias("stay_sum"), F.sum("stay_n").alias("stay_n"))
    inter = sum(F.col(c) for c in _interaction_columns())
    out = agg.select(
        *_keys(by), "dau", "dau_app_open", "uv", *_counters(), inter.alias("interactions"),
        F.try_divide("stay_sum", "stay_n").alias("avg_stay_sec"),
        safe_ratio("d1_instant_exits", "pv").alias("bounce_rate"),
        safe_ratio(inter, "pv").alias("interaction_rate"),
        safe_ratio(inter, "pv").alias("exposure_conversion"),
        safe_ratio("favs", "pv").alias("fav_rate"))
    return _with_end(out)


def sessions_all_grains(events: DataFrame, grains: tuple[str, ...] = GRAINS) -> DataFrame:
    """S-01..S-03 by the given ``session_id`` at all ``grains``: a session
    counts in every window and day with one of its events; its length and size
    belong to those of its first event.

    Rows are first summed per (session, 5 minutes); only those go through the
    window over a session and the expansion."""
    rows = events.where(F.col("session_id").isNotNull() & F.col("ts").isNotNull())
    per = rows.groupBy("session_id", grain_start("5m").alias("_five")).agg(
        F.min("ts").alias("ts"), F.max("ts").alias("_last"), F.count(F.lit(1)).alias("_n"))
    w = Window.partitionBy("session_id")
    per = per.select(
        "session_id", "ts", (F.min("ts").over(w) == F.col("ts")).alias("_first"),
        (F.unix_micros(F.max("_last").over(w)) - F.unix_micros(F.min("ts").over(w))).alias("_us"),
        F.sum("_n").over(w).alias("_events"))
    one = _grouped(_with_starts(per, grains), (), ["session_id"], [
        F.max("_first").alias("starts"), F.max("_us").alias("us"), F.max("_events").alias("events")],
        grains)
    started = F.count_if("starts")
    return _with_end(one.groupBy("grain", "window_start").agg(
        F.count(F.lit(1)).alias("sessions"),
        (F.try_divide(F.sum(F.when(F.col("starts"), F.col("us"))), started)
         / F.lit(1_000_000.0)).alias("avg_session_sec"),
        F.try_divide(F.sum(F.when(F.col("starts"), F.col("events"))), started)
        .alias("avg_events_per_session")))


def new_users_all_grains(events: DataFrame, grains: tuple[str, ...] = GRAINS) -> DataFrame:
    """U-04 at all ``grains``: users by the window and day of their first
    app_open."""
    first = (events.where(is_type("app_open") & F.col("user_id").isNotNull() & F.col("ts").isNotNull())
             .groupBy("user_id").agg(F.min("ts").alias("ts")))
    return _with_end(_grouped(_with_starts(first, grains), (), [],
                              [F.count(F.lit(1)).alias("new_users")], grains))


def cheat_all_grains(flagged_a1: DataFrame, flagged_a2: DataFrame,
                     grains: tuple[str, ...] = GRAINS) -> DataFrame:
    """Q-01 and Q-02 at all ``grains``: distinct users and items with comments
    flagged by A1, distinct users with likes flagged by A2.

    Each flagged event gives a row per counted thing (user, item); things are
    made distinct per window, then counted, so no hot user or item is a task
    of its own."""
    a1 = flagged_a1.where("is_cheat_a1").select("ts", F.explode(F.array(
        F.struct(F.lit("a1_users").alias("what"), F.col("user_id").alias("id")),
        F.struct(F.lit("a1_items").alias("what"), F.col("item_id").alias("id")))).alias("x"))
    a2 = flagged_a2.where("is_cheat_a2").select("ts", F.struct(
        F.lit("a2_users").alias("what"), F.col("user_id").alias("id")).alias("x"))
    rows = _with_starts(a1.unionByName(a2), grains).select(
        *[f"g_{g}" for g in grains], "x.what", "x.id")
    one = _grouped(rows, (), ["what", "id"], [F.count(F.lit(1)).alias("n")], grains)
    count = lambda what: F.count_if(
        (F.col("what") == what) & F.col("id").isNotNull()).alias(what)
    events = lambda what, name: F.coalesce(
        F.sum(F.when(F.col("what") == what, F.col("n"))), F.lit(0)).alias(name)
    return _with_end(one.groupBy("grain", "window_start").agg(
        count("a1_users"), count("a1_items"), events("a1_users", "a1_events"),
        count("a2_users"), events("a2_users", "a2_events")))
