"""Hand-made rows at every threshold (FIXTURES.md §4)."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from pulsehouse.functions import is_c_long_stay, is_d1_instant_exit, is_e1_fast_swipe
from pulsehouse.operators import cheat, sessions
from pulsehouse.operators.enrich import bounded_broadcast, enrich
from pulsehouse.plans import metrics as M
from pulsehouse.sinks.kv import to_kv_rows

SCHEMA = (
    "event_id bigint, user_id bigint, item_id bigint, event_type string, ts timestamp, "
    "comment_text string, duration_sec double, session_id string, content_len int"
)
BASE = datetime(2024, 1, 1, 12, 0, 0)


def at(ms):
    return None if ms is None else BASE + timedelta(milliseconds=ms)


def events(spark, rows):
    """rows: (event_id, user_id, item_id, event_type, t_ms[, text, duration])"""
    full = []
    for r in rows:
        eid, uid, item, et, t = r[:5]
        text = r[5] if len(r) > 5 else None
        dur = r[6] if len(r) > 6 else None
        full.append((eid, uid, item, et, at(t), text, dur, f"s{uid}", None))
    return spark.createDataFrame(full, SCHEMA)


def a1_flags(spark, rows):
    out = cheat.detect_a1(events(spark, rows)).where("is_cheat_a1")
    return sorted(r.event_id for r in out.collect())


def a2_flags(spark, rows):
    return sorted(r.event_id for r in cheat.detect_a2(events(spark, rows)).collect())


# -- A1 ----------------------------------------------------------------------

def test_a1_exact(spark):
    rows = [(i + 1, 1, 7, "comment", i * 10_000) for i in range(5)]
    assert a1_flags(spark, rows) == [5]


def test_a1_gap_too_long(spark):
    rows = [(i + 1, 1, 7, "comment", i * 10_000) for i in range(4)]
    rows.append((5, 1, 7, "comment", 40_001))
    assert a1_flags(spark, rows) == []


def test_a1_reset_by_other_event_same_key(spark):
    rows = [(i + 1, 1, 7, "comment", i * 10_000) for i in range(4)]
    rows += [(9, 1, 7, "like", 35_000), (5, 1, 7, "comment", 40_000)]
    assert a1_flags(spark, rows) == []


def test_a1_other_key_does_not_reset(spark):
    rows = [(i + 1, 1, 7, "comment", i * 10_000) for i in range(4)]
    rows += [(9, 1, 8, "like", 35_000), (5, 1, 7, "comment", 40_000)]
    assert a1_flags(spark, rows) == [5]


def test_a1_sixth_and_later_flagged(spark):
    rows = [(i + 1, 1, 7, "comment", i * 5_000) for i in range(7)]
    assert a1_flags(spark, rows) == [5, 6, 7]


def test_a1_emits_every_keyed_event(spark):
    rows = [(1, 1, 7, "comment", 0), (2, 1, 7, "like", 1), (3, 1, None, "app_open", 2)]
    out = cheat.detect_a1(events(spark, rows))
    assert sorted(r.event_id for r in out.collect()) == [1, 2]


# -- A2 ----------------------------------------------------------------------

def _storm(last_ms, items=None, n=15):
    items = items or list(range(1, n + 1))
    step = last_ms / (n - 1)
    return [(i + 1, 2, items[i], "like", round(i * step)) for i in range(n)]


def test_a2_exact_5000ms(spark):
    assert a2_flags(spark, _storm(5000)) == [15]


def test_a2_5001ms_too_slow(spark):
    assert a2_flags(spark, _storm(5001)) == []


def test_a2_repeat_item(spark):
    items = list(range(1, 15)) + [3]
    assert a2_flags(spark, _storm(4000, items)) == []


def test_a2_equal_time_tie_break(spark):
    rows = _storm(4000)
    # 14th and 15th distinct items liked at the same instant.
    rows[14] = (15, 2, 15, "like", rows[13][4])
    assert a2_flags(spark, rows) == [15]


def test_null_time_skipped_and_counted(spark):
    rows = [(i + 1, 1, 7, "comment", i * 1000) for i in range(5)]
    rows.append((6, 1, 7, "comment", None))
    ev = events(spark, rows)
    assert cheat.detect_a1(ev).count() == 5
    assert cheat.skipped_events(ev).first().skipped == 1


def test_split_buckets_do_not_change_flags(spark):
    from pulsehouse.sources import adapters as A
    from tests.conftest import SF_SMALL

    den = A.dense_events(spark, SF_SMALL).cache()
    big1 = cheat.detect_a1(A.dense_for_a1(den)).where("is_cheat_a1").select("event_id")
    small1 = cheat.detect_a1(A.dense_for_a1(den), bucket_ms=41_000).where("is_cheat_a1")
    assert sorted(big1.toPandas().event_id) == sorted(small1.toPandas().event_id)
    big2 = cheat.detect_a2(A.dense_for_a2(den)).select("event_id")
    small2 = cheat.detect_a2(A.dense_for_a2(den), bucket_ms=5_000).select("event_id")
    try:
        assert sorted(big2.toPandas().event_id) == sorted(small2.toPandas().event_id)
    finally:
        den.unpersist()


# -- behaviour tags ------------------------------------------------------------

@pytest.mark.parametrize(
    "dur,d1,c",
    [(0.19, False, False), (0.2, True, False), (1.2, True, False), (1.21, False, False),
     (1799.0, False, False), (1800.0, False, True), (3600.0, False, True),
     (3601.0, False, False)],
)
def test_d1_and_c_bounds(spark, dur, d1, c):
    df = spark.createDataFrame([("leave_item", dur)], "event_type string, duration_sec double")
    r = df.select(is_d1_instant_exit().alias("d1"), is_c_long_stay().alias("c")).first()
    assert (r.d1, r.c) == (d1, c)


@pytest.mark.parametrize("dur,length,e1", [(0.8, 3000, False), (0.5, 2000, False), (0.5, 2001, True)])
def test_e1_strict(spark, dur, length, e1):
    df = spark.createDataFrame(
        [("leave_item", dur, length)], "event_type string, duration_sec double, content_len int"
    )
    assert df.select(is_e1_fast_swipe().alias("e1")).first().e1 is e1


# -- enrichment ------------------------------------------------------------------

def test_enrich_fills_unknown(spark):
    ev = events(spark, [(1, 1, None, "app_open", 0), (2, 1, 99, "like", 1), (3, 1, 5, "like", 2),
                        (4, 1, 6, "like", 3)])
    dim = spark.createDataFrame(
        [(5, None, 1500), (6, "food", 2500)], "dim_item_id bigint, category string, dim_content_len int"
    )
    got = {r.event_id: (r.category, r.content_len) for r in enrich(ev, dim).collect()}
    assert got == {1: ("Unknown", 0), 2: ("Unknown", 0), 3: ("Unknown", 1500), 4: ("food", 2500)}


def test_enrich_duplicate_dimension_keys_never_fan_out(spark):
    ev = events(spark, [(1, 1, 5, "like", 0)])
    dim = spark.createDataFrame(
        [(5, "b", 10), (5, "a", 20)], "dim_item_id bigint, category string, dim_content_len int"
    )
    rows = enrich(ev, dim).collect()
    assert len(rows) == 1 and rows[0].category == "a"


def test_enrich_without_broadcast_same_result(spark):
    ev = events(spark, [(i, 1, (i % 7) if i % 3 else None, "like", i) for i in range(50)]
                + [(99, 1, -5, "like", 0)])
    # Negative ids exist in the dimension: salted item-less keys must not
    # match them.
    dim = spark.createDataFrame(
        [(i, f"c{i}", i * 100) for i in range(1, 6)] + [(-j, "neg", 1) for j in range(1, 1100)],
        "dim_item_id bigint, category string, dim_content_len int",
    )
    a = sorted(enrich(ev, dim).collect())
    b = sorted(enrich(ev, dim, broadcast_max_rows=2).collect())
    assert a == b and len(a) == 51
    assert sum(1 for r in a if r.category == "neg") == 1
    _, is_bc = bounded_broadcast(dim, 2)
    assert not is_bc
    _, is_bc = bounded_broadcast(dim, 10_000, max_bytes=100)
    assert not is_bc
    _, is_bc = bounded_broadcast(dim, 10_000)
    assert is_bc


# -- sessions ------------------------------------------------------------------------

@pytest.mark.parametrize("idle,n", [(1799, 1), (1800, 1), (1801, 2)])
def test_session_gap(spark, idle, n):
    ev = events(spark, [(1, 1, None, "app_open", 0), (2, 1, None, "dm", idle * 1000)])
    assert sessions.derived_sessions(ev).count() == n
    assert sessions.sessionize(ev).select("session_seq").distinct().count() == n
    sw = ev.groupBy(F.session_window("ts", "1800 seconds"), "user_id").count()
    assert sw.count() == n


def test_sessionize_small_buckets_equal_lag_form(spark):
    from pulsehouse.sources import adapters as A
    from tests.conftest import SF_SMALL

    com = A.community_events(spark, SF_SMALL)
    # Spread the month's events over a few hours so sessions span buckets.
    squeezed = com.withColumn(
        "ts", F.timestamp_micros(F.floor((F.unix_micros("ts") - F.lit(1704067200000000)) / 20)
                                 + F.lit(1704067200000000))
    )
    got = sessions.sessionize(squeezed, bucket_sec=1800).select("event_id", "session_seq")
    tiny = sessions.sessionize(squeezed, bucket_sec=600).select("event_id", "session_seq")
    assert sorted(tiny.collect()) == sorted(got.collect())
    w = Window.partitionBy("user_id").orderBy("ts", "event_id")
    prev = F.lag("ts").over(w)
    start = F.when(prev.isNull() | (F.col("event_type") == "app_open")
                   | (F.unix_micros("ts") - F.unix_micros(prev) > 1800 * 10**6), 1)
    ref = squeezed.withColumn("st", F.coalesce(start, F.lit(0))).withColumn(
        "session_seq", F.sum("st").over(w.rowsBetween(Window.unboundedPreceding, 0))
    ).select("event_id", "session_seq")
    assert sorted(got.collect()) == sorted(ref.collect())
    assert got.select("session_seq").distinct().count() > 3


def test_session_starts_on_app_open(spark):
    ev = events(spark, [(1, 1, None, "dm", 0), (2, 1, None, "app_open", 120_000),
                        (3, 1, None, "dm", 130_000), (4, 1, None, "app_open", 240_000)])
    rows = sorted(sessions.derived_sessions(ev).select("session_seq", "s_events").collect())
    assert [tuple(r) for r in rows] == [(1, 1), (2, 2), (3, 1)]
    assert [r.session_seq for r in sessions.sessionize(ev).orderBy("event_id").collect()] == [1, 2, 2, 3]


def test_session_over_midnight_counts_on_both_days(spark):
    from pulsehouse.plans.metrics import session_metrics, session_rollup

    day = 43_200_000  # BASE is noon
    ev = events(spark, [(1, 1, None, "app_open", day - 60_000), (2, 1, None, "dm", day + 60_000),
                        (3, 2, None, "app_open", day + 3_600_000)])
    ev = ev.withColumn("session_id", F.concat(F.lit("s"), F.col("user_id").cast("string")))
    for m in (session_metrics(ev), session_rollup(sessions.derived_sessions(ev))):
        got = {r.day[-2:]: (r.sessions, r.avg_session_sec, r.avg_events_per_session)
               for r in m.collect()}
        assert sorted(got.values()) == [(1, 120.0, 2.0), (2, 0.0, 1.0)]


def test_cheat_record_keeps_repeated_events(spark):
    rows = [(i, 1, i % 4, "like", i * 100) for i in range(16)]
    ev = events(spark, rows + rows)
    assert cheat.cheat_flags(ev).count() == 32


# -- serving rows ---------------------------------------------------------------------

def test_kv_key_and_null_value(spark):
    df = spark.createDataFrame(
        [(1781092200, 1781092500, "家庭生活", 3, None)],
        "s bigint, e bigint, category string, likes bigint, fav_rate double",
    ).select(
        F.struct(F.timestamp_seconds("s").alias("start"),
                 F.timestamp_seconds("e").alias("end")).alias("window"),
        "category", "likes", "fav_rate",
    )
    rows = {r.field: r for r in to_kv_rows(df).collect()}
    assert rows["likes"].key == "dws:user_activity:1781092200_1781092500:家庭生活"
    assert rows["likes"].value == "3"
    assert rows["fav_rate"].value == "0"
    assert rows["likes"].ttl_sec == 3600


def test_zero_pv_ratio_is_null(spark):
    ev = events(spark, [(1, 1, 5, "like", 0), (2, 1, 5, "fav", 1)])
    ev = ev.withColumn("category", F.lit("x"))
    m = M.activity_metrics(ev, "day").first()
    assert m.pv == 0 and m.interaction_rate is None and m.fav_rate is None
    assert m.interactions == 2


def test_approx_users_close_to_exact(spark):
    from pulsehouse.sources import adapters as A
    from tests.conftest import SF_MID

    com = A.community_events(spark, SF_MID)
    exact = {r.day: (r.dau, r.uv, r.pv) for r in
             M.activity_metrics(com, "day").select("day", "dau", "uv", "pv").collect()}
    approx = {r.day: (r.dau, r.uv, r.pv) for r in
              M.activity_metrics(com, "day", users="approx").select("day", "dau", "uv", "pv").collect()}
    assert set(exact) == set(approx)
    for d, (dau, uv, pv) in exact.items():
        a_dau, a_uv, a_pv = approx[d]
        assert a_pv == pv
        assert abs(a_dau - dau) <= max(2, 0.05 * dau) and abs(a_uv - uv) <= max(2, 0.05 * uv)
