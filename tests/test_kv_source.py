"""The key-value sink with a commit protocol: replayed, failed and restarted
batches, newest values, compaction."""

import os

import pytest
from pyspark.sql import functions as F

from pulsehouse.session import new_run_dir
from pulsehouse.sinks import kv_source as K
from pulsehouse.streaming import runner


def feed(spark, run, rows):
    df = spark.createDataFrame(rows, K.ROWS)
    df.coalesce(1).write.mode("append").parquet(f"{run}/in")


def run_once(spark, run):
    K.register(spark)
    s = spark.readStream.schema(K.ROWS).option("maxFilesPerTrigger", "1").parquet(f"{run}/in")
    runner.run_to_end(runner.start(s.repartition(3), f"{run}/ckpt", f"{run}/kv", fmt=K.FORMAT))


def values(spark, run):
    return {(r.key, r.field): r.value for r in K.read_kv(spark, f"{run}/kv").collect()}


def files(run, sub):
    at = f"{run.removeprefix('file:')}/kv/{sub}"
    return sorted(x for x in os.listdir(at) if not x.startswith(".")) if os.path.isdir(at) else []


def test_newest_value_of_each_key(spark):
    run = new_run_dir(spark, "test_kv")
    feed(spark, run, [("a", "pv", "1", 3600), ("a", "uv", "1", 3600), ("old", "pv", "7", 0)])
    run_once(spark, run)
    feed(spark, run, [("a", "pv", "2", 3600), ("b", "pv", None, 3600)])
    run_once(spark, run)  # a new query from the same checkpoint
    want = {("a", "pv"): "2", ("a", "uv"): "1", ("b", "pv"): None}
    assert values(spark, run) == want
    assert files(run, "commits") == ["0.json", "1.json"]
    assert K.compact_kv(spark, f"{run}/kv") == 1
    assert values(spark, run) == want
    assert files(run, "commits") == files(run, "data") == [] and files(run, "snapshots") == ["upto=1"]
    feed(spark, run, [("a", "pv", "3", 3600)])
    run_once(spark, run)
    assert values(spark, run) == {**want, ("a", "pv"): "3"}
    assert K.compact_kv(spark, f"{run}/kv") == 2 and files(run, "snapshots") == ["upto=2"]
    assert K.compact_kv(spark, f"{run}/kv") == 2
    assert values(spark, run) == {**want, ("a", "pv"): "3"}


def test_a_replayed_batch_is_in_the_store_once(spark):
    """Killed after the sink's commit and before Spark noted it: the batch
    runs again."""
    run = new_run_dir(spark, "test_kv")
    feed(spark, run, [(f"k{i}", "pv", str(i), 3600) for i in range(50)])
    run_once(spark, run)
    before = values(spark, run)
    local = run.removeprefix("file:")
    for name in os.listdir(f"{local}/ckpt/commits"):
        os.rename(f"{local}/ckpt/commits/{name}", f"{local}/ckpt/{name}.gone")
    kept = files(run, "data")
    run_once(spark, run)
    assert files(run, "data") == kept and files(run, "commits") == ["0.json"]
    assert values(spark, run) == before and len(before) == 50
    K.compact_kv(spark, f"{run}/kv")
    for name in os.listdir(f"{local}/ckpt/commits"):
        os.rename(f"{local}/ckpt/commits/{name}", f"{local}/ckpt/{name}.gone2")
    run_once(spark, run)  # also once the batch is folded into a snapshot
    assert files(run, "data") == files(run, "commits") == [] and values(spark, run) == before


def test_a_failed_batch_leaves_nothing(spark):
    run = new_run_dir(spark, "test_kv")
    feed(spark, run, [(f"k{i}", "pv", str(i), 3600) for i in range(40)])
    K.register(spark)
    s = spark.readStream.schema(K.ROWS).parquet(f"{run}/in").repartition(4, "key")
    broken = s.withColumn("value", F.when(F.col("key") == "k7", F.raise_error(F.lit("no"))
                                          .cast("string")).otherwise(F.col("value")))
    with pytest.raises(Exception, match="no"):
        runner.run_to_end(runner.start(broken, f"{run}/ckpt", f"{run}/kv", fmt=K.FORMAT))
    assert files(run, "commits") == [] and K.read_kv(spark, f"{run}/kv").count() == 0
    runner.run_to_end(runner.start(s, f"{run}/ckpt", f"{run}/kv", fmt=K.FORMAT))
    assert K.read_kv(spark, f"{run}/kv").count() == 40


def test_an_empty_store(spark):
    assert K.read_kv(spark, f"{new_run_dir(spark, 'test_kv')}/kv").count() == 0
    assert K.compact_kv(spark, f"{new_run_dir(spark, 'test_kv')}/kv") == -1
