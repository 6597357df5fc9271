"""Sources: JSON decode with quarantine, '|' dimensions, sinks."""

import datetime
import os

from pyspark.sql import functions as F

from pulsehouse.session import new_run_dir
from pulsehouse.sinks.kv import latest_kv, to_kv_rows, upsert_kv_table, write_kv_partitions
from pulsehouse.sinks.lake import archive_batch, export_csv
from pulsehouse.sources.dimensions import load_item_dim, load_user_dim, user_interest_rows
from pulsehouse.sources.events import decode_events, encode_events, quarantine, typed_events


def _raw(spark, lines):
    return spark.createDataFrame([(x,) for x in lines], "value string")


def test_decode_offsets_and_quarantine(spark):
    lines = [
        '{"event_id":"e1","user_id":1,"event_type":"like","ts":"2024-01-01T08:00:00.123+08:00",'
        '"session_id":"s","platform":"ios","item_id":5}',
        '{"event_id":"e2","user_id":2,"event_type":"app_open","ts":"2024-01-01T08:00:00.000Z"}',
        '{"event_id":"e3","user_id":3,"event_type":"dm","ts":"2024-01-01T08:00:00.000"}',
        "not json",
        '{"event_id":"e4","user_id":4,"event_type":"like","ts":"yesterday"}',
    ]
    dec = decode_events(_raw(spark, lines))
    good = {r.event_id: r for r in typed_events(dec).collect()}
    assert set(good) == {"e1", "e2", "e3"}
    ms = {k: v.ts.timestamp() for k, v in good.items()}
    # +08:00 and bare local (read as GMT+8) are the same instant; Z is 8 h later.
    assert round(ms["e1"] - ms["e3"], 3) == 0.123
    assert ms["e2"] - ms["e3"] == 8 * 3600
    assert quarantine(dec).count() == 2


def test_decode_time_variants(spark):
    base = '{"event_id":"%s","user_id":1,"event_type":"like","ts":"%s"}'
    forms = {
        "a": "2024-01-01T08:00:00+08:00",
        "b": "2024-01-01T00:00:00Z",
        "c": "2024-01-01 08:00:00",
        "d": "2024-01-01T08:00:00.000000",
        "e": "2024-01-01 08:00:00.000+08:00",
        "f": "2024-01-01T08:00:00.000+0800",
        "g": "2024-01-01T00:00:00.000000000Z",
        "h": "2023-12-31 19:00:00-0500",
    }
    bad = {"x": "2024-01-01", "y": "2024-13-01T00:00:00", "z": "2024-01-01T08:00:00 Mars"}
    raw = _raw(spark, [base % (k, v) for k, v in {**forms, **bad}.items()])
    want = 1704067200000
    for zone in ("UTC", "Asia/Shanghai", "America/New_York"):
        spark.conf.set("spark.sql.session.timeZone", zone)
        try:
            dec = decode_events(raw)
            got = typed_events(dec).select("event_id", F.unix_millis("ts").alias("t")).collect()
            assert {r.event_id: r.t for r in got} == dict.fromkeys(forms, want)
            assert quarantine(dec).count() == len(bad)
            again = decode_events(encode_events(typed_events(dec)))
            assert {r.t for r in typed_events(again).select(
                F.unix_millis("ts").alias("t")).collect()} == {want}
            text = encode_events(typed_events(dec)).first().value
            assert '"ts":"2024-01-01T08:00:00.000+08:00"' in text
        finally:
            spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_item_and_user_dimensions(spark, tmp_path):
    item = tmp_path / "dim_item.csv"
    item.write_text("200001|food|1500\n200002||800\n200003|travel|\n")
    d = {r.dim_item_id: (r.category, r.dim_content_len) for r in load_item_dim(spark, str(item)).collect()}
    assert d == {200001: ("food", 1500), 200002: (None, 800), 200003: ("travel", None)}
    user = tmp_path / "dim_user.csv"
    user.write_text("100001|food,travel|3\n100002||1\n")
    u = {r.user_id: (r.interest_tags, r.level) for r in load_user_dim(spark, str(user)).collect()}
    assert u == {100001: (["food", "travel"], 3), 100002: ([], 1)}
    assert user_interest_rows(load_user_dim(spark, str(user))).count() == 2


def test_kv_store_writers(spark):
    df = spark.createDataFrame(
        [(1781092200, 1781092500, "c", 1, 0.5)], "s bigint, e bigint, category string, pv bigint, r double"
    ).select(F.struct(F.timestamp_seconds("s").alias("start"),
                      F.timestamp_seconds("e").alias("end")).alias("window"), "category", "pv", "r")
    kv = to_kv_rows(df)

    class Client:
        def close(self):
            pass

    res = write_kv_partitions(kv, Client, lambda c, k, fields, t: None)
    assert res == {"written": 2, "failed": 0}

    def down():
        raise ConnectionError("store away")

    res = write_kv_partitions(kv, down, lambda c, k, fields, t: None)
    assert res == {"written": 0, "failed": 2}

    run = new_run_dir(spark, "test_kv")
    upsert_kv_table(kv, run, 0)
    upsert_kv_table(kv.withColumn("value", F.lit("9")), run, 1)
    vals = {r.field: r.value for r in latest_kv(spark, run).collect()}
    assert vals == {"pv": "9", "r": "9"}
    # one put per key, with all its fields
    sizes = write_kv_partitions(kv, Client, lambda c, k, fields, t: 1 / (len(fields) == 2))
    assert sizes == {"written": 2, "failed": 0}
    # expired rows are not served
    later = datetime.datetime.now() + datetime.timedelta(days=2)
    assert latest_kv(spark, run, at=later).count() == 0


def test_archive_and_export(spark):
    run = new_run_dir(spark, "test_archive")
    df = spark.createDataFrame(
        [(1, "2024-01-01 10:00:00"), (2, "2024-01-02 10:00:00")], "event_id bigint, ts string"
    ).withColumn("ts", F.to_timestamp("ts"))
    archive_batch(df, run, "ods")
    archive_batch(df, run, "ods")
    back = spark.read.parquet(f"{run}/ods")
    assert back.count() == 4
    assert {str(r.event_day) for r in back.select("event_day").distinct().collect()} == {
        "20240101", "20240102"}
    export_csv(back, f"{run}/csv")
    assert any(p.endswith(".csv") for p in os.listdir(f"{run}/csv"))


def test_memory_sink_and_temp_view(spark):
    """SNK-3 / SNK-4: a test-only memory table and a temp view."""
    from pulsehouse.sinks.lake import publish_view
    from pulsehouse.streaming import runner

    run = new_run_dir(spark, "test_memory")
    src = f"{run}/src"
    spark.createDataFrame([(1, "a"), (2, "b")], "id bigint, v string").write.parquet(src)
    s = spark.readStream.schema("id bigint, v string").parquet(src)
    q = runner.start(s, f"{run}/ck", fmt="memory", query_name="cheat_a1_result")
    runner.run_to_end(q)
    assert spark.sql("select count(*) as n from cheat_a1_result").first().n == 2
    publish_view(spark.table("cheat_a1_result").where("id = 2"), "new_user_result")
    assert spark.sql("select v from new_user_result").first().v == "b"
