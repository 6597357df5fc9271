"""Stream forms: state model vs window form, restart, replay, late rows."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from pulsehouse.operators import cheat
from pulsehouse.session import new_run_dir
from pulsehouse.streaming import detectors, runner
from pulsehouse.streaming.metrics import WindowUserCounter, stream_activity, stream_window_users
from pulsehouse.streaming.new_users import NewUserCounter, new_user_results

SCHEMA = (
    "event_id bigint, user_id bigint, item_id bigint, event_type string, ts timestamp, "
    "comment_text string"
)
BASE = datetime(2024, 3, 1, 8, 0, 0)


def random_events(seed, n=600, users=2, items=2):
    """In-order events with bursts of comments, and like storms."""
    rng = random.Random(seed)
    t = 0
    rows = []
    while len(rows) < n:
        t += rng.choices([0, 100, 250, 1500, 4000, 9000, 10000, 10001, 40000],
                         [2, 6, 6, 3, 3, 2, 1, 1, 1])[0]
        uid = rng.randrange(users)
        if rng.random() < 0.02:
            # A storm: 13-22 likes, 100-400 ms apart, a few items repeated.
            k = rng.randrange(13, 23)
            items_ = rng.sample(range(40), k)
            for j in rng.sample(range(k), 2):
                items_[j] = items_[0]
            for it in items_:
                t += rng.choice([0, 100, 250, 400])
                rows.append((len(rows) + 1, uid, it, "like",
                             BASE + timedelta(milliseconds=t), None))
            continue
        et = rng.choices(["comment", "like", "enter_item"], [6, 6, 1])[0]
        rows.append((len(rows) + 1, uid, rng.randrange(items) if et != "like"
                     else rng.randrange(40), et, BASE + timedelta(milliseconds=t),
                     rng.choice(["a", "b", None])))
    return rows


def state_model_a1(rows):
    """Pure-Python run of the A1 state machine, in (time, id) order."""
    held = {}
    flagged = set()
    for eid, uid, item, et, ts, text in sorted(rows, key=lambda r: (r[4], r[0])):
        k = (uid, item)
        t = int(ts.timestamp() * 1000)
        if et == "comment":
            h = [x for x in held.get(k, []) if x[0] >= t - 60_000] + [(t, text or "")]
            held[k] = h
            if detectors.a1_is_cheat(h):
                flagged.add(eid)
        else:
            held[k] = []
    return flagged


def state_model_a2(rows):
    held = {}
    flagged = set()
    for eid, uid, item, et, ts, _ in sorted(rows, key=lambda r: (r[4], r[0])):
        if et != "like":
            continue
        t = int(ts.timestamp() * 1000)
        h = [x for x in held.get(uid, []) if x[0] >= t - 5000] + [(t, item)]
        held[uid] = h
        if len({i for _, i in h}) >= 15:
            flagged.add(eid)
    return flagged


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_window_form_equals_state_model(spark, seed):
    rows = random_events(seed)
    df = spark.createDataFrame(rows, SCHEMA)
    a1 = {r.event_id for r in cheat.detect_a1(df).where("is_cheat_a1").collect()}
    a2 = {r.event_id for r in cheat.detect_a2(df).collect()}
    assert a1 == state_model_a1(rows)
    assert a2 == state_model_a2(rows)
    assert a1 and a2


def test_stream_state_across_restarts_equals_batch(spark):
    """Three in-order arrivals, each run from the same checkpoint: the
    keyed state carries over and the result equals the batch form."""
    rows = random_events(7, n=900)
    df = spark.createDataFrame(rows, SCHEMA)
    run = new_run_dir(spark, "test_restart")
    src = f"{run}/src"
    chunks = [rows[:300], rows[300:600], rows[600:]]
    for chunk in chunks:
        spark.createDataFrame(chunk, SCHEMA).write.mode("append").parquet(src)
        s = spark.readStream.schema(SCHEMA).parquet(src)
        q1 = runner.start(detectors.stream_a1(s), f"{run}/ck1", f"{run}/a1")
        runner.run_to_end(q1)
        q2 = runner.start(detectors.stream_a2(s), f"{run}/ck2", f"{run}/a2")
        runner.run_to_end(q2)
    got1 = {r.event_id for r in spark.read.parquet(f"{run}/a1").where("is_cheat_a1").collect()}
    got2 = {r.event_id for r in spark.read.parquet(f"{run}/a2").collect()}
    want1 = {r.event_id for r in cheat.detect_a1(df).where("is_cheat_a1").collect()}
    want2 = {r.event_id for r in cheat.detect_a2(df).collect()}
    assert got1 == want1 and got2 == want2
    assert spark.read.parquet(f"{run}/a1").count() == df.where("item_id is not null").count()


def test_out_of_order_text_clause(spark):
    """Arrival out of order: a comment older than the held ones. The held
    list's latest is newer than the row, so the window clause can fail and
    the duplicate-text clause decides."""
    held = [(0, "x"), (9_000, "x"), (18_000, "x"), (27_000, "x"), (100_000, "y")]
    assert detectors.a1_is_cheat(held, window_ms=60_000) is False
    held = [(50_000, "x"), (59_000, "x"), (68_000, "x"), (77_000, "x"), (20_000, "x")]
    # sorted: 20k,50k,59k,68k,77k -> gap 30s fails
    assert detectors.a1_is_cheat(held) is False
    held = [(40_000, "z"), (49_000, "x"), (58_000, "x"), (67_000, "x"), (76_000, "x")]
    assert detectors.a1_is_cheat(held) is True


def test_new_users_replay_is_stable(spark):
    run = new_run_dir(spark, "test_replay")
    counter = NewUserCounter(f"{run}/seen", f"{run}/result")
    mk = lambda ids: spark.createDataFrame(
        [(i, "app_open") for i in ids] + [(99, "like")], "user_id bigint, event_type string"
    )
    counter(mk([1, 2, 3, 3]), 0)
    counter(mk([2, 3, 4]), 1)
    counter(mk([2, 3, 4]), 1)  # replay of batch 1
    counter(mk([5]), 2)
    got = {r.batch_id: r.u_04_new_user_count for r in new_user_results(spark, f"{run}/result").collect()}
    assert got == {0: 3, 1: 1, 2: 1}


def test_late_rows_dropped_and_counted(spark):
    """Three late events of one closed window: not in the result; the
    window aggregate counts 1 dropped row (after partial aggregation), the
    keyed-state detector counts 3."""
    run = new_run_dir(spark, "test_late")
    src = f"{run}/src"
    first = [(1, 1, 1, "enter_item", BASE, None), (2, 1, 1, "enter_item", BASE + timedelta(hours=2), None)]
    late = [(10 + i, 1, 1, "enter_item", BASE + timedelta(seconds=10 * i), None) for i in range(3)]
    sch = SCHEMA
    dim = spark.createDataFrame([(1, "c", 10)], "dim_item_id bigint, category string, dim_content_len int")
    from pulsehouse.operators.enrich import enrich

    q_agg = q_state = None
    for i, chunk in enumerate([first, late]):
        spark.createDataFrame(chunk, sch).coalesce(1).write.mode("append").parquet(src)
        s = spark.readStream.schema(sch).parquet(src)
        agg = stream_activity(enrich(s.withColumn("duration_sec", F.lit(None).cast("double"))
                                     .withColumn("content_len", F.lit(None).cast("int")), dim))
        q_agg = runner.start(agg, f"{run}/ck_agg", f"{run}/agg")
        runner.run_to_end(q_agg)
        q_state = runner.start(detectors.stream_a1(s, watermark="5 minutes"), f"{run}/ck_st",
                               f"{run}/st")
        runner.run_to_end(q_state)
    assert runner.dropped_by_watermark(q_agg) == 1
    assert runner.dropped_by_watermark(q_state) == 3
    out = spark.read.parquet(f"{run}/agg")
    # The 08:00 window holds only the first event; late rows never enter it.
    first_window = out.where(F.col("window.start") == F.lit(BASE)).collect()
    assert len(first_window) == 1 and first_window[0].pv == 1


def test_exact_stream_distinct_equals_batch(spark):
    from pulsehouse.sources import adapters as A
    from tests.conftest import SF_SMALL

    run = new_run_dir(spark, "test_uv")
    schema = spark.read.parquet(f"{SF_SMALL}/events.parquet").schema
    raw = (spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet")
           .parquet(SF_SMALL))
    ev = A.community_events_from(raw)
    counter = WindowUserCounter(f"{run}/out", name="dau")
    runner.run_to_end(runner.start(stream_window_users(ev), f"{run}/ck", foreach_batch=counter))
    got = {(r.window.start, r.dau) for r in spark.read.parquet(f"{run}/out").collect()}
    batch = A.community_events(spark, SF_SMALL).groupBy(F.window("ts", "5 minutes")).agg(
        F.count_distinct("user_id").alias("dau"))
    wm = A.community_events(spark, SF_SMALL).agg(F.max("ts")).first()[0] - timedelta(minutes=5)
    want = {(r.window.start, r.dau) for r in batch.collect() if r.window.end <= wm}
    assert got == want


def test_a2_dense_storm_equals_state_model(spark):
    """One user, 2,000 likes in a few seconds over 25 items, many equal
    timestamps: the linear batch form equals the state machine."""
    rng = random.Random(11)
    t = 0
    rows = []
    for i in range(2000):
        t += rng.choice([0, 0, 1, 2, 5])
        rows.append((i + 1, 9, rng.randrange(25), "like", BASE + timedelta(milliseconds=t), None))
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, SCHEMA)
    got = {r.event_id for r in cheat.detect_a2(df, bucket_ms=5_000).collect()}
    want = state_model_a2(rows)
    assert got == want and 0 < len(want) < 2000


def test_state_store_new_users_across_restarts(spark):
    """The seen set lives in the state store: three arrivals, each run
    from the same checkpoint, count each user once, in its first batch."""
    from pulsehouse.streaming.new_users import BatchNewUserCount, first_app_opens

    run = new_run_dir(spark, "test_new_users_state")
    src = f"{run}/src"
    sch = "user_id bigint, event_type string, ts timestamp"
    arrivals = [[1, 2, 2, 3], [2, 3, 4], [5, 1]]
    for ids in arrivals:
        spark.createDataFrame([(i, "app_open", BASE) for i in ids] + [(7, "like", BASE)], sch) \
            .write.mode("append").parquet(src)
        s = spark.readStream.schema(sch).parquet(src)
        runner.run_to_end(runner.start(first_app_opens(s), f"{run}/ck",
                                       foreach_batch=BatchNewUserCount(f"{run}/res")))
    got = sorted(r.u_04_new_user_count for r in new_user_results(spark, f"{run}/res").collect())
    assert got == [1, 1, 3]


def test_approx_stream_distinct_close_to_exact(spark):
    from pulsehouse.sources import adapters as A
    from pulsehouse.streaming.metrics import stream_approx_users
    from tests.conftest import SF_MID

    run = new_run_dir(spark, "test_approx")
    schema = spark.read.parquet(f"{SF_MID}/events.parquet").schema
    raw = (spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet")
           .parquet(SF_MID))
    ev = A.community_events_from(raw)
    agg = stream_approx_users(ev, window="1 day", watermark="1 hour")
    runner.run_to_end(runner.start(agg, f"{run}/ck", f"{run}/out"))
    got = {r.window.start: r.approx_users for r in spark.read.parquet(f"{run}/out").collect()}
    exact = {r.window.start: r.n for r in A.community_events(spark, SF_MID)
             .groupBy(F.window("ts", "1 day")).agg(F.count_distinct("user_id").alias("n")).collect()}
    assert got and all(abs(v - exact[k]) <= max(2, 0.15 * exact[k]) for k, v in got.items())


def test_stream_ratios_equal_batch(spark):
    from pulsehouse.operators.enrich import enrich
    from pulsehouse.plans.metrics import activity_metrics, with_ratios
    from pulsehouse.sources import adapters as A
    from tests.conftest import SF_SMALL

    run = new_run_dir(spark, "test_ratios")
    schema = spark.read.parquet(f"{SF_SMALL}/events.parquet").schema
    raw = (spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet")
           .parquet(SF_SMALL))
    dim = A.item_dimension(spark, SF_SMALL)
    agg = stream_activity(enrich(A.community_events_from(raw), dim), window="30 minutes")
    runner.run_to_end(runner.start(agg, f"{run}/ck", f"{run}/out"))
    cols = ["bounce_rate", "interaction_rate", "fav_rate", "avg_stay_sec", "interactions"]
    got = with_ratios(spark.read.parquet(f"{run}/out")).select(
        F.col("window.start").alias("w"), "category", *cols)
    batch = activity_metrics(enrich(A.community_events(spark, SF_SMALL), dim), "30m",
                             ("category",), flatten_window=False, distinct_users=False)
    want = batch.select(F.col("window.start").alias("w"), "category", *cols)
    g = {(r.w, r.category): tuple(r)[2:] for r in got.collect()}
    w = {(r.w, r.category): tuple(r)[2:] for r in want.collect()}
    assert g and all(k in w for k in g)
    for k, v in g.items():
        for a, b in zip(v, w[k]):
            assert (a is None and b is None) or abs(a - b) < 1e-9


def test_out_of_order_within_watermark_is_counted(spark):
    """B1: an event 2 minutes late (the watermark allows 5) arrives in a
    later micro-batch and still counts in its window."""
    from pulsehouse.operators.enrich import enrich

    run = new_run_dir(spark, "test_b1")
    src = f"{run}/src"
    t0 = BASE
    first = [(1, 1, 1, "enter_item", t0 + timedelta(seconds=30), None),
             (2, 1, 1, "enter_item", t0 + timedelta(minutes=6), None)]
    second = [(3, 2, 1, "enter_item", t0 + timedelta(minutes=4), None),
              (4, 2, 1, "enter_item", t0 + timedelta(minutes=30), None)]
    dim = spark.createDataFrame([(1, "c", 10)], "dim_item_id bigint, category string, dim_content_len int")
    for chunk in (first, second):
        spark.createDataFrame(chunk, SCHEMA).coalesce(1).write.mode("append").parquet(src)
        s = spark.readStream.schema(SCHEMA).parquet(src)
        agg = stream_activity(enrich(s.withColumn("duration_sec", F.lit(None).cast("double"))
                                     .withColumn("content_len", F.lit(None).cast("int")), dim))
        q = runner.start(agg, f"{run}/ck", f"{run}/out")
        runner.run_to_end(q)
    out = {r.window.start: r.pv for r in spark.read.parquet(f"{run}/out").collect()}
    assert out[t0] == 2 and runner.dropped_by_watermark(q) == 0


def test_daily_windows_cut_at_local_midnight(spark):
    """Days in GMT+8: streaming 1-day windows with the zone's startTime
    equal the batch day grain computed under the same session zone."""
    from pulsehouse.plans.metrics import activity_metrics
    from pulsehouse.sources import adapters as A
    from pulsehouse.streaming.metrics import day_window_start
    from tests.conftest import SF_SMALL

    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "Asia/Shanghai")
    try:
        run = new_run_dir(spark, "test_days")
        schema = spark.read.parquet(f"{SF_SMALL}/events.parquet").schema
        raw = (spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet")
               .parquet(SF_SMALL))
        ev = A.community_events_from(raw).withColumn("category", F.lit("x"))
        agg = stream_activity(ev, "1 day", by=(), start_time=day_window_start("Asia/Shanghai"))
        runner.run_to_end(runner.start(agg, f"{run}/ck", f"{run}/out"))
        got = {r.d: r.n_events for r in spark.read.parquet(f"{run}/out").select(
            F.date_format("window.start", "yyyyMMdd").alias("d"), "n_events").collect()}
        batch = activity_metrics(A.community_events(spark, SF_SMALL), "day", distinct_users=False)
        want = {r.day: r.n_events for r in batch.select("day", "n_events").collect()}
        hours = {r.h for r in spark.read.parquet(f"{run}/out").select(
            F.hour("window.start").alias("h")).collect()}
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert hours == {0} and len(got) >= 28
    assert all(want[d] == v for d, v in got.items())


def test_drops_are_counted_over_more_than_100_batches(spark, tmp_path):
    """Spark keeps the progress of the last 100 micro-batches only; the
    listener counts them all (Q-10)."""
    import os

    schema = "user_id bigint, event_type string, ts timestamp, content_len int, duration_sec double"
    late = 104
    for i in range(late + 1):
        f = tmp_path / f"{i:04d}.json"
        f.write_text('{"user_id":1,"event_type":"enter_item","ts":"2024-01-0%dT00:00:00Z"}'
                     % (2 if i == 0 else 1))
        os.utime(f, (1_700_000_000 + i, 1_700_000_000 + i))
    s = spark.readStream.schema(schema).option("maxFilesPerTrigger", "1").json(str(tmp_path))
    run = new_run_dir(spark, "test_many_batches")
    listener = runner.LateRowsListener()
    spark.streams.addListener(listener)
    partitions = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "1")
    try:
        q = runner.start(stream_activity(s, by=()), f"{run}/ck", f"{run}/out")
        runner.run_to_end(q)
        listener.wait_for([q])
        # rows count as late from the second batch after the one that moved
        # the watermark
        assert listener.total(q) == late - 1
        assert runner.dropped_by_watermark(q) <= 100
    finally:
        spark.streams.removeListener(listener)
        spark.conf.set("spark.sql.shuffle.partitions", partitions)


def test_enrichment_batch_that_failed_half_way(spark):
    """Nothing of a failed batch is visible; its replay writes it once."""
    from pulsehouse.streaming.enrichment import EnrichWithReload

    run = new_run_dir(spark, "test_half")
    batch = spark.createDataFrame([(1, 10, "like")], "event_id bigint, item_id bigint, event_type string")
    dim = spark.createDataFrame([(10, "food", 5)], "dim_item_id bigint, category string, dim_content_len int")
    state = {"fail": True}

    def load():
        if state["fail"]:
            return dim.withColumn("category", F.raise_error(F.lit("disk gone")).cast("string"))
        return dim

    write = EnrichWithReload(load, f"{run}/events", broadcast_max_rows=None)
    with pytest.raises(Exception, match="disk gone"):
        write(batch, 3)
    state["fail"] = False
    write(batch, 3)
    write(batch, 3)  # replay of a committed batch
    assert [r.category for r in spark.read.parquet(f"{run}/events").collect()] == ["food"]


def _session_rows(spark):
    rnd, t0 = random.Random(3), 1_704_067_200
    rows = [(i, 1, "app_open" if i % 97 == 50 else "like", t0 + 40 * i) for i in range(600)]
    t = t0
    for i in range(600, 900):
        t += rnd.choice([0, 1, 59, 60, 900, 1799, 1800, 1801, 4000])
        rows.append((i, 2 + i % 2, rnd.choice(["like", "like", "app_open", None]), t))
    rows += [(900, None, "like", t0 + 5), (901, 7, "like", None)]
    return spark.createDataFrame(rows, "event_id long, user_id long, event_type string, s long").select(
        "event_id", "user_id", "event_type", F.timestamp_seconds("s").alias("ts"))


def test_sessions_in_batches_equal_the_batch_form(spark):
    """A user without a pause, ties, late-opening sessions: over several
    micro-batches and two runs (the second closes the open sessions), with
    arrival out of order inside the watermark, and a replayed batch."""
    from pulsehouse.operators.sessions import derived_sessions
    from pulsehouse.streaming.sessions import SessionWriter, open_sessions

    df = _session_rows(spark)
    run = new_run_dir(spark, "test_sessions")
    cols = ["user_id", "s_events", "s_start", "s_end"]
    want = sorted(derived_sessions(df).select(cols).collect())
    # arrival: time shuffled within 20 minutes, less than watermark and gap
    late = F.pmod(F.xxhash64("event_id"), F.lit(1200))
    arrival = df.withColumn("at", F.unix_seconds("ts") + late).orderBy("at")
    bounds = [None, 1_704_070_000, 1_704_076_000, 1_704_090_000, None]
    write = SessionWriter(f"{run}/out", f"{run}/state")
    for i, (lo, hi) in enumerate(zip(bounds, bounds[1:], strict=False)):
        part = arrival
        if lo is not None:
            part = part.where(F.col("at") >= lo)
        if hi is not None:
            part = part.where(F.col("at") < hi)
        write(part, i)
        if i == 2:
            write(part, i)  # replayed
    assert write.late_rows(spark) == 0
    done = spark.read.parquet(f"{run}/out").select(cols)
    rest = open_sessions(spark, f"{run}/state").select(cols)
    assert rest.count() > 0
    assert sorted(done.unionByName(rest).collect()) == want
    write(df.where("event_id = 0"), 4)  # hours behind the watermark
    assert write.late_rows(spark) == 1
    assert sorted(spark.read.parquet(f"{run}/out").select(cols).unionByName(
        open_sessions(spark, f"{run}/state").select(cols)).collect()) == want
    assert "Python" not in done._jdf.queryExecution().executedPlan().toString()


def test_session_stream_closes_at_the_end(spark):
    from pulsehouse.operators.sessions import derived_sessions
    from pulsehouse.streaming.sessions import SessionWriter

    df = _session_rows(spark)
    run = new_run_dir(spark, "test_sessions")
    for part in range(3):
        df.where(F.col("event_id") % 3 == part).coalesce(1).write.mode("append").parquet(f"{run}/in")
    write = SessionWriter(f"{run}/out", f"{run}/state")
    runner.run_closed(spark, spark.readStream.schema(df.schema).option("maxFilesPerTrigger", "3")
                      .parquet(f"{run}/in"), run, lambda e: e, lambda: df.agg(F.max("ts")).first()[0],
                      lambda: {"foreach_batch": write})
    cols = ["user_id", "s_events", "s_start", "s_end"]
    got = spark.read.parquet(f"{run}/out").where("user_id > 0").select(cols).collect()
    assert sorted(got) == sorted(derived_sessions(df).select(cols).collect())
