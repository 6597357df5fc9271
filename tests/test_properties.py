"""Property tests: the scale-minded batch forms equal brute force."""

from datetime import datetime, timedelta

from hypothesis import given, settings
from hypothesis import strategies as st

from pulsehouse.operators import cheat, sessions

BASE = datetime(2024, 5, 1)
SCHEMA = ("event_id bigint, user_id bigint, item_id bigint, event_type string, ts timestamp, "
          "comment_text string")

likes_st = st.lists(
    st.tuples(st.integers(0, 1), st.integers(0, 17), st.integers(0, 1500)),
    min_size=1, max_size=120,
)


def brute_a2(rows, window=5000, k=15):
    """Direct reading of the rule: for each like, the distinct items of the
    user's likes with time in [t - 5 s, t] and earlier in (t, id) order."""
    out = set()
    for eid, uid, item, _, t in rows:
        seen = {i for e2, u2, i, _, t2 in rows
                if u2 == uid and t - window <= t2 <= t and (t2, e2) <= (t, eid)}
        if len(seen) >= k:
            out.add(eid)
    return out


@settings(max_examples=15, deadline=None)
@given(steps=likes_st, bucket=st.sampled_from([5_000, 60_000, 3_600_000]))
def test_a2_linear_form_equals_brute_force(spark, steps, bucket):
    rows, t = [], 0
    for i, (uid, item, dt) in enumerate(steps):
        t += dt // 10  # many equal and close times
        rows.append((i + 1, uid, item, "like", t))
    df = spark.createDataFrame(
        [(e, u, i, et, BASE + timedelta(milliseconds=tt), None) for e, u, i, et, tt in rows],
        SCHEMA)
    got = {r.event_id for r in cheat.detect_a2(df, bucket_ms=bucket).collect()}
    assert got == brute_a2(rows)


gaps_st = st.lists(
    st.tuples(st.integers(0, 2), st.sampled_from([0, 1, 600, 1799, 1800, 1801, 4000, 90000])),
    min_size=1, max_size=60,
)


@settings(max_examples=15, deadline=None)
@given(steps=gaps_st, bucket=st.sampled_from([600, 1800, 3600, 86400]))
def test_sessionize_equals_lag_form(spark, steps, bucket):
    t, rows = 0, []
    for i, (uid, dt) in enumerate(steps):
        t += dt
        rows.append((i + 1, uid, None, "dm", BASE + timedelta(seconds=t), None))
    df = spark.createDataFrame(rows, SCHEMA)
    got = {r.event_id: r.session_seq for r in sessions.sessionize(df, bucket_sec=bucket).collect()}
    want, last, seq = {}, {}, {}
    for eid, uid, _, _, ts, _ in sorted(rows, key=lambda r: (r[4], r[0])):
        if uid not in last or (ts - last[uid]).total_seconds() > 1800:
            seq[uid] = seq.get(uid, 0) + 1
        last[uid] = ts
        want[eid] = seq[uid]
    assert got == want


def test_a2_against_plain_counts_without_added_rows(spark):
    """Repeated ids, equal times, hot buckets: the flags are those of a plain
    count, and no row is added for the start or end of an item's likes."""
    import random

    from pyspark.sql import functions as F

    from pulsehouse.operators.cheat import flag_a2

    r = random.Random(3)
    rows = [(r.choice([i, i, i - i % 3, None]), r.randrange(2), r.randrange(9),
             r.choice(["like", "like", "like", "fav", None]), r.randrange(60_000)) for i in range(900)]
    ev = spark.createDataFrame(rows, "event_id long, user_id long, item_id long, event_type string, "
                               "ms long").withColumn("ts", F.timestamp_millis("ms"))
    flags = flag_a2(ev, window_ms=700, min_items=5, bucket_ms=2_000)

    def flag(x):
        if x[3] is None:
            n = len(held(x))
            return None if n >= 5 else False
        return x[3] == "like" and len(held(x)) >= 5

    def order(x):
        return x[4], x[0] is not None, x[0] or 0

    def held(x):
        return {y[2] for y in rows if y[1] == x[1] and y[3] == "like"
                and y[4] >= x[4] - 700 and order(y) <= order(x)}

    got = [(x.event_id, x.user_id, x.item_id, x.event_type, x.ms, x.is_cheat_a2)
           for x in flags.collect()]
    assert sorted(got, key=repr) == sorted([(*x, flag(x)) for x in rows], key=repr)
    assert {x[-1] for x in got} >= {True, False}
    plan = flags._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    # the only expansion is that into buckets; one sort by item, one by user
    assert plan.count("Generate explode") == 1 and plan.count("Sort [") == 2
