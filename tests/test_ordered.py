"""Event-time order on a stream: flags equal the batch rules whatever the
arrival, late rows stay rows, replays and restarts change nothing."""

import random

import pytest
from pyspark.sql import functions as F

from pulsehouse.operators.cheat import detect_a1, detect_a2, flag_a2
from pulsehouse.operators.interests import profile_of
from pulsehouse.session import new_run_dir
from pulsehouse.streaming.ordered import KeepLate, interval_us, ordered_a1, ordered_a2

T0 = 1_704_067_200_000


def storm(seed, n=1500, users=2, step=60):
    """Likes and comments of few users, so dense that both rules flag."""
    r, t, rows = random.Random(seed), T0, []
    for i in range(n):
        t += r.choice([0, 1, step, 2 * step]) if i % 200 else 60_000
        rows.append((i, r.randrange(users), r.randrange(25),
                     r.choice(["like", "like", "like", "comment", "comment", "share"])
                     if i % 400 < 200 else "comment", t))
    return rows


def frame(spark, rows):
    return spark.createDataFrame(rows, "event_id long, user_id long, item_id long, event_type string, "
                                 "ms long").select("event_id", "user_id", "item_id", "event_type",
                                                   F.timestamp_millis("ms").alias("ts"))


def batches(spark, rows, late_ms, seed, n=4):
    """The rows in order of arrival (up to ``late_ms`` late), cut in n parts."""
    r = random.Random(seed)
    arrival = sorted(rows, key=lambda x: x[4] + r.choice([0, 0, 0, r.randint(0, late_ms)]))
    size = -(-len(rows) // n)
    return [frame(spark, arrival[i:i + size]) for i in range(0, len(rows), size)]


def flags(df, flag):
    return sorted((r.event_id, r[flag]) for r in df.select("event_id", flag).collect())


@pytest.mark.parametrize("make,batch_form,flag", [
    (ordered_a1, detect_a1, "is_cheat_a1"), (ordered_a2, detect_a2, "is_cheat_a2")])
def test_shuffled_arrival_gives_the_batch_flags(spark, make, batch_form, flag):
    rows = [x if i % 50 else (*x[:2], None, *x[3:]) for i, x in enumerate(storm(5))]
    run = new_run_dir(spark, "test_ordered")
    rule = make(f"{run}/out", f"{run}/state", watermark="2 minutes")
    parts = batches(spark, rows, 110_000, 6)
    for i, part in enumerate(parts):
        rule(part, i)
        if i == 1:
            rule(part, i)  # replayed
        if i == 2:  # a new process goes on from the tables alone
            rule = make(f"{run}/out", f"{run}/state", watermark="2 minutes")
    assert rule.late_rows(spark) == 0 and rule.late_table(spark) is None
    early = flags(spark.read.parquet(f"{run}/out"), flag)
    rule.finish(spark)
    want = flags(batch_form(frame(spark, rows)), flag)
    assert flags(spark.read.parquet(f"{run}/out"), flag) == want
    assert 0 < len(early) < len(want) and sum(f for _, f in want) > 20


def test_a_hot_user_is_many_tasks(spark):
    rows = [(i, 1, i % 40, "like", T0 + i * 20_000) for i in range(3_000)]  # 16 hours of one user
    run = new_run_dir(spark, "test_ordered")
    rule = ordered_a2(f"{run}/out", f"{run}/state")
    rule(frame(spark, rows), 0)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # small data
    try:
        parts = flag_a2(rule.pending(spark, 0)).select(F.spark_partition_id().alias("p"))
        counts = [r["count"] for r in parts.groupBy("p").count().collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert len(counts) >= 4 and max(counts) < 0.6 * len(rows)


def test_late_rows_are_kept_as_rows(spark):
    run = new_run_dir(spark, "test_ordered")
    keep = KeepLate(f"{run}/out", f"{run}/state", interval_us("1 minute"))
    keep(frame(spark, [(1, 1, 1, "like", T0), (2, 1, 1, "like", T0 + 600_000)]), 0)
    late = [(3, 1, 1, "like", T0 + 10_000), (4, 2, 1, "like", T0 + 540_000)]
    part = frame(spark, [*late, (5, 1, 1, "like", T0 + 540_001), (6, None, None, "like", T0 + 900_000)])
    part = part.unionByName(part.limit(1).withColumn("ts", F.lit(None).cast("timestamp")))
    keep(part, 1)
    keep(part, 1)  # replayed
    assert keep.late_rows(spark) == 2
    table = keep.late_table(spark)
    assert sorted(r.event_id for r in table.collect()) == [3, 4]
    assert table.columns == ["event_id", "user_id", "item_id", "event_type", "ts", "batch_id"]
    assert sorted(r.event_id for r in spark.read.parquet(f"{run}/out").collect()) == [1, 2, 5]
    keep.finish(spark)
    assert sorted(r.event_id for r in spark.read.parquet(f"{run}/out").collect()) == [1, 2, 5, 6]


def test_profiles(spark):
    dim = spark.createDataFrame(
        [(1, ["a", "b", "a"], 3), (2, [], 5), (3, ["a"], 9), (3, ["c"], 1), (None, ["x"], 1)],
        "user_id long, interest_tags array<string>, level int")
    users = spark.createDataFrame([(1,), (2,), (3,), (4,)], "user_id long")
    got = sorted((r.user_id, r.tag, r.level) for r in profile_of(users, dim).collect())
    assert got == [(1, "a", 3), (1, "b", 3), (2, "Unknown", 5), (3, "c", 1), (4, "Unknown", None)]
    assert sorted(map(tuple, profile_of(users, dim, max_rows=0).select(
        "user_id", "tag", "level").collect())) == got


def test_a_replayed_batch_meets_the_dimension_it_had(spark):
    """JOIN-2: the dimension is edited between batches; computing a batch
    again, or the whole history, gives the rows of the first time."""
    from pulsehouse.streaming.enrichment import EnrichWithReload, remove_path
    from pulsehouse.streaming.versions import DimensionVersions, enrich_as_of

    run = new_run_dir(spark, "test_versions")
    now = {}

    def edit(rows):
        now["dim"] = spark.createDataFrame(rows, "dim_item_id long, category string, dim_content_len int")

    versions = DimensionVersions(lambda: now["dim"], f"{run}/dim")
    write = EnrichWithReload(versions.load, f"{run}/dwd", versions=versions)
    batch = frame(spark, [(1, 1, 1, "like", T0), (2, 1, 2, "like", T0), (3, 1, None, "like", T0)])
    edit([(1, "old", 10), (2, None, 20)])
    write(batch, 0)
    write(batch, 1)  # same content: no new version
    edit([(1, "new", 11), (3, "more", 30)])
    write(batch, 2)
    edit([(1, "newest", 12)])
    remove_path(spark, f"{run}/dwd/batch_id=0")  # a lost batch is computed again
    write(batch, 0)
    cols = ["batch_id", "event_id", "category", "content_len"]
    got = sorted(map(tuple, spark.read.parquet(f"{run}/dwd").select(cols).collect()))
    assert got == sorted([(b, 1, "old", 10) for b in (0, 1)] + [(b, 2, "Unknown", 20) for b in (0, 1)]
                         + [(b, 3, "Unknown", 0) for b in (0, 1, 2)]
                         + [(2, 1, "new", 11), (2, 2, "Unknown", 0)])
    assert [(r.batch_id, r.version) for r in versions.by_batch(spark).orderBy("batch_id").collect()] == [
        (0, 0), (1, 0), (2, 2)]
    history = spark.read.parquet(f"{run}/dwd").drop("category", "content_len")
    for limit in (1000, None):  # broadcast and shuffle join
        again = enrich_as_of(history, versions, limit)
        assert sorted(map(tuple, again.select(cols).collect())) == got
        assert dict(again.dtypes)["item_id"] == "bigint"
    never = history.limit(1).withColumn("batch_id", F.lit(99).cast("bigint"))
    assert enrich_as_of(never, versions).first().category == "Unknown"
