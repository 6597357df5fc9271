"""Multi-grain metrics and mergeable distinct counts: hand-made rows, plan
shapes, error bounds, replays."""

import contextlib
import io

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from pulsehouse.plans import grains as G
from pulsehouse.plans import metrics as M
from pulsehouse.plans import rollups as R
from pulsehouse.plans.catalog import _enriched
from pulsehouse.session import new_run_dir
from scripts.plan_report import summarise
from tests.conftest import SF_SMALL

COLUMNS = ("ts timestamp, user_id long, event_type string, category string, duration_sec double, "
           "content_len int, session_id string")


def events(spark, rows):
    return spark.createDataFrame(rows, "ts string, user_id long, event_type string, category string, "
                                 "duration_sec double, content_len int, session_id string").withColumn(
        "ts", F.to_timestamp("ts"))


ROWS = [
    ("2024-01-01 00:04:59.999999", 1, "enter_item", "a", None, 0, "s1"),
    ("2024-01-01 00:05:00", 1, "enter_item", "a", None, 0, "s1"),
    ("2024-01-01 00:29:59", 2, "leave_item", "b", 1.0, 0, "s2"),
    ("2024-01-01 00:30:00", 2, "enter_item", "b", None, 0, "s2"),
    ("2024-01-01 23:59:59", 1, "app_open", "Unknown", None, 0, "s3"),
    ("2024-01-02 00:00:00", 1, "like", "a", None, 0, "s3"),
    ("2024-01-02 00:00:01", None, "like", "a", None, 0, None),
    (None, 9, "like", "a", None, 0, "s9"),
]


def test_grains_of_hand_made_rows(spark):
    out = {(r.grain, r.window_start, r.by_category, r.category): r
           for r in G.activity_all_grains(events(spark, ROWS)).collect()}
    d1, d2 = 1704067200, 1704153600
    day = out["day", d1, False, None]
    assert (day.dau, day.dau_app_open, day.uv, day.pv, day.n_events) == (2, 1, 2, 3, 5)
    assert day.window_end == d2 and day.avg_stay_sec == 1.0 and day.d1_instant_exits == 1
    assert (out["day", d2, False, None].dau, out["day", d2, False, None].likes) == (1, 2)
    assert {k[1] for k in out if k[:1] == ("5m",)} == {d1, d1 + 300, d1 + 1500, d1 + 1800, d2 - 300, d2}
    half = out["30m", d1, True, "a"]
    assert (half.dau, half.pv, half.window_end) == (1, 2, d1 + 1800)
    assert out["30m", d1, False, None].bounce_rate == 0.5
    assert G.activity_all_grains(events(spark, ROWS).limit(0)).count() == 0


@pytest.mark.parametrize("grain", ["5m", "30m", "day"])
def test_each_grain_equals_its_own_query(spark, grain):
    ev = _enriched(spark, SF_SMALL)
    cols = ["category", "dau", "dau_app_open", "uv", "pv", "interactions", "n_leave", "bounce_rate"]
    one = M.activity_metrics(ev, grain, ("category",))
    key = "day" if grain == "day" else "window_start"
    want = {(r[key], *[r[c] for c in cols]) for r in one.collect()}
    both = G.activity_all_grains(ev).where(F.col("by_category") & (F.col("grain") == grain))
    if grain == "day":
        both = both.withColumn("day", F.date_format(F.timestamp_seconds("window_start"), "yyyyMMdd"))
    assert {(r[key], *[r[c] for c in cols]) for r in both.collect()} == want


def test_days_follow_the_session_zone(spark):
    ev = events(spark, [("2024-01-01 20:00:00", 1, "like", "a", None, 0, "s")])
    spark.conf.set("spark.sql.session.timeZone", "Asia/Shanghai")
    try:
        ev = ev.select("*")
        (day,) = G.activity_all_grains(ev, (), ("day",)).collect()
        cut = spark.sql("select unix_seconds(timestamp'2024-01-02 00:00:00') a").first().a
        ts = ev.first().ts
        assert day.window_end - day.window_start == 86400
        assert (cut - day.window_start) % 86400 == 0 and ts is not None
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def exchanges(df):
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return summarise(buf.getvalue()), buf.getvalue()


def test_one_expansion_and_one_exchange_of_rows(spark):
    ev = events(spark, ROWS)
    s, text = exchanges(G.activity_all_grains(ev, users="sketch"))
    assert s["exchanges"] == 1 and text.count(") Expand") <= 2
    s, _ = exchanges(G.activity_all_grains(ev))
    assert s["exchanges"] == 2  # (group, user) rows, then one row per group and task


def test_sketches_stay_within_their_error(spark):
    ev = spark.range(200_000).select(
        F.timestamp_seconds(F.lit(1704067200) + F.col("id") % 3600).alias("ts"),
        F.pmod(F.xxhash64("id"), F.lit(30_000)).alias("user_id"),
        F.element_at(F.array(F.lit("enter_item"), F.lit("app_open"), F.lit("like")),
                     (F.col("id") % 3 + 1).cast("int")).alias("event_type"),
        F.concat(F.lit("c"), F.col("id") % 4).alias("category"))
    stored = R.store(R.user_sketches(ev), f"{new_run_dir(spark, 'test_sketch')}/s")
    est = {(r.grain, r.window_start, r.by_category, r.category): r
           for r in R.roll_up_sketches(stored).collect()}
    ids = R.IdDictionary(spark, f"{new_run_dir(spark, 'test_ids')}/ids").add(ev.select("user_id"), 0)
    exact = R.roll_up_bitmaps(R.user_bitmaps(ev, ids), tuple(R.KINDS), ("category",)).collect()
    assert len(exact) == len(est) == (12 + 2 + 1) * 5
    for r in exact:
        e = est[r.grain, r.window_start, r.by_category, r.category]
        for k in R.KINDS:  # 1.04 / sqrt(4096) is 1.6 %
            assert abs(e[k] - r[k]) <= max(1, 0.05 * r[k])
    (day,) = [r for r in exact if r.grain == "day" and not r.by_category]
    assert day.dau == ev.select("user_id").distinct().count()
    assert day.uv == ev.where("event_type = 'enter_item'").select("user_id").distinct().count()


def test_ids_are_dense_and_replays_keep_them(spark):
    d = R.IdDictionary(spark, f"{new_run_dir(spark, 'test_ids')}/ids")
    assert d.table().count() == 0
    first = spark.range(1000).union(spark.range(500)).selectExpr("id * 7 as u")
    d.add(first, 0, block_rows=64)
    d.add(spark.range(900, 1500).selectExpr("id * 7 as u").union(spark.sql("select null")), 1, 64)
    before = {r.id: r.num for r in d.table().collect()}
    assert sorted(before.values()) == list(range(1500))
    assert all(before[i * 7] < 1000 for i in range(1000))
    d.add(spark.range(900, 1500).selectExpr("id * 7 as u"), 1, 64)  # replayed
    assert {r.id: r.num for r in d.table().collect()} == before
    assert d.add(first, 0, 64).count() == 1000
    assert d.add(first.limit(0), 2).count() == 1500


def test_sessions_over_midnight(spark):
    out = {(r.grain, r.window_start): r for r in G.sessions_all_grains(events(spark, ROWS)).collect()}
    d1, d2 = 1704067200, 1704153600
    assert (out["day", d1].sessions, out["day", d2].sessions) == (3, 1)
    assert out["day", d2].avg_session_sec is None
    assert out["5m", d1].avg_events_per_session == 2.0
    assert out["30m", d1 + 1800].sessions == 1


def test_bitmaps_are_merged_without_sorts(spark):
    """Stored bitmaps are words that hash aggregates merge, at most one per
    event and exact at the ends of words; every kind counts, also those without
    an event in a window."""
    ev = spark.range(3_000).select(
        F.timestamp_seconds(F.lit(1704067200) + F.col("id") % 1200).alias("ts"),
        (F.col("id") * 131).alias("user_id"), F.lit("app_open").alias("event_type"),
        F.lit("a").alias("category"))
    ids = ev.select(F.col("user_id").alias("id"), F.row_number().over(
        Window.orderBy("user_id")).cast("bigint").alias("num"))
    ids = ids.withColumn("num", F.col("num") - 1)
    stored = R.store(R.user_bitmaps(ev, ids), f"{new_run_dir(spark, 'test_words')}/u")
    assert dict(stored.dtypes)["dau"] == "bigint"
    assert stored.agg(F.sum(F.bit_count("dau"))).first()[0] == 3_000
    out = R.roll_up_bitmaps(stored, tuple(R.KINDS), ("category",))
    got = {(r.grain, r.by_category, r.window_start): (r.dau, r.dau_app_open, r.uv) for r in out.collect()}
    assert got["day", False, 1704067200] == got["30m", True, 1704067200] == (3_000, 3_000, 0)
    assert sum(v[0] for k, v in got.items() if k[:2] == ("5m", True)) == 3_000
    assert "SortAggregate" not in out._jdf.queryExecution().executedPlan().toString()
