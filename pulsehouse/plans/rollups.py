"""Distinct counts that roll up: what is stored per 5 minutes is merged to
30 minutes, days and totals without reading events again (U-01, U-06, S-01).

* sketches: one HLL sketch per window, dimension and kind of user; a few kB
  at most, relative error about 1.04 / sqrt(2^lg_k); merged by union;
* bitmaps: exact. Ids get dense numbers from a dictionary that grows batch by
  batch; a bitmap is a word of 64 numbers, so a window has one row per range
  of numbers it meets and never more rows than ids; merged by bitwise or,
  counted by ``bit_count``. (Spark's ``bitmap_*`` functions have 4 kB for a
  range of 32,768, nearly empty where ids are many and windows short, and sort
  them.)
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pulsehouse import config
from pulsehouse.functions import is_type
from pulsehouse.operators.enrich import bounded_broadcast
from pulsehouse.plans.grains import GRAINS, LG_K, _grouped, _keys, _with_end, grain_start
from pulsehouse.streaming.enrichment import path_exists

# Kinds of distinct users: any event, app_open, enter_item.
KINDS = {"dau": None, "dau_app_open": "app_open", "uv": "enter_item"}


def _is_kind(event_type: str | None) -> Column:
    return is_type(event_type) if event_type else F.lit(True)


# -- sketches

def user_sketches(enriched: DataFrame, by: tuple[str, ...] = ("category",),
                  lg_k: int = LG_K) -> DataFrame:
    """Per 5 minutes and ``by``: a sketch of the users of each kind, and the
    day for partitioning. One aggregation; events without a time have no
    window, events without a user leave the sketches as they are."""
    rows = enriched.where(F.col("ts").isNotNull()).select(
        grain_start("5m").alias("window_start"), *by, "user_id", "event_type")
    return (rows.groupBy("window_start", *by)
            .agg(*[F.hll_sketch_agg(F.when(_is_kind(t), F.col("user_id")), lg_k).alias(n)
                   for n, t in KINDS.items()])
            .withColumn("day", F.to_date(F.timestamp_seconds("window_start"))))


def _stored_starts(stored: DataFrame, grains: tuple[str, ...]) -> DataFrame:
    """g_<grain> of stored 5-minute rows (days and 30 minutes are whole
    numbers of them in every time zone in use)."""
    ts = F.timestamp_seconds("window_start")
    return stored.withColumns({f"g_{g}": grain_start(g, ts) for g in grains})


def roll_up_sketches(stored: DataFrame, by: tuple[str, ...] = ("category",),
                     grains: tuple[str, ...] = GRAINS, lg_k: int = LG_K) -> DataFrame:
    """Estimated users of each kind at all ``grains``, per ``by`` and over
    everything, from stored ``user_sketches``."""
    rows = _stored_starts(stored, grains).drop("window_start")
    out = _grouped(rows, by, [], [F.hll_sketch_estimate(F.hll_union_agg(n, False)).alias(n)
                                  for n in KINDS], grains)
    return _with_end(out)


# -- dense numbers

class IdDictionary:
    """Dense numbers 0, 1, 2, ... of ids, as a table in ``path``: one
    ``batch_id`` folder per batch with the ids first seen in it. A replayed
    batch overwrites its own folder with the same set of ids and range of
    numbers, later batches are unchanged. One writer at a time."""

    def __init__(self, spark: SparkSession, path: str, id_type: str = "bigint"):
        self.spark, self.path = spark, path.rstrip("/")
        self.schema = f"id {id_type}, num bigint, batch_id bigint"

    def table(self) -> DataFrame:
        """id, num, batch_id of all ids."""
        if not path_exists(self.spark, self.path):
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(self.path)

    def add(self, ids: DataFrame, batch_id: int, block_rows: int = 100_000) -> DataFrame:
        """Numbers the ids (first column, null left out) that no earlier
        batch has and returns the table as of this batch.

        New ids are made distinct, dealt to blocks of about ``block_rows`` by
        hash and numbered inside their block; the few block sizes give the
        offsets. Nothing is sorted or numbered in one task."""
        known = self.table().where(F.col("batch_id") < batch_id)
        new = (ids.select(F.col(ids.columns[0]).alias("id")).where("id IS NOT NULL").distinct()
               .join(known, "id", "left_anti"))
        staged = f"{self.path}_staged/batch_id={batch_id}"
        new.write.mode("overwrite").parquet(staged)
        new = self.spark.read.parquet(staged).select("id")
        first = known.agg(F.coalesce(F.max("num") + 1, F.lit(0)).alias("n")).first().n
        blocks = max(1, -(-new.count() // block_rows))
        new = new.withColumn("block", F.pmod(F.xxhash64("id"), F.lit(blocks)))
        sizes = new.groupBy("block").count()
        before = Window.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
        offsets = sizes.select("block", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("at"))
        rank = F.row_number().over(Window.partitionBy("block").orderBy("id")) - 1
        numbered = new.withColumn("rank", rank).join(F.broadcast(offsets), "block").select(
            "id", (F.lit(first) + F.col("at") + F.col("rank")).cast("bigint").alias("num"))
        numbered.write.mode("overwrite").parquet(f"{self.path}/batch_id={batch_id}")
        return self.table().where(F.col("batch_id") <= batch_id)


# -- bitmaps

WORD_BITS = 64


def distinct_bitmaps(rows: DataFrame, ids: DataFrame, key: str, kinds: dict[str, Column],
                     by: tuple[str, ...] = ()) -> DataFrame:
    """Per 5 minutes, ``by`` and range of 64 numbers: a bitmap of the
    ``key`` values of each kind (name -> condition on the row), and the day.

    Rows are reduced to one per (window, by, key) before they meet the
    dictionary ``ids`` (id, num), so a hot key is a few rows by then. Rows
    without a time or a key are in no bitmap."""
    rows = rows.where(F.col("ts").isNotNull() & F.col(key).isNotNull())
    one = rows.groupBy(grain_start("5m").alias("window_start"), *by, F.col(key).alias("id")).agg(
        *[F.max(F.coalesce(c, F.lit(False))).alias(n) for n, c in kinds.items()])
    numbers, _ = bounded_broadcast(ids.select("id", "num"), config.DEFAULT_SCALE.broadcast_max_rows)
    numbered = one.join(numbers, "id")
    bit = F.expr(f"shiftleft(1L, cast(num % {WORD_BITS} as int))")
    return (numbered.groupBy("window_start", *by, F.expr(f"num div {WORD_BITS}").alias("bucket"))
            .agg(*[F.bit_or(F.when(F.col(n), bit).otherwise(F.lit(0))).alias(n) for n in kinds])
            .withColumn("day", F.to_date(F.timestamp_seconds("window_start"))))


def user_bitmaps(enriched: DataFrame, ids: DataFrame, by: tuple[str, ...] = ("category",)) -> DataFrame:
    """``distinct_bitmaps`` of the users of each kind."""
    return distinct_bitmaps(enriched, ids, "user_id", {n: _is_kind(t) for n, t in KINDS.items()}, by)


def roll_up_bitmaps(stored: DataFrame, names: tuple[str, ...], by: tuple[str, ...] = (),
                    grains: tuple[str, ...] = GRAINS) -> DataFrame:
    """Exact distinct counts at all ``grains``, per ``by`` and over
    everything, from stored bitmaps: bitmaps of a range are merged, then the
    counts of a group's ranges are added."""
    rows = _stored_starts(stored, grains).drop("window_start")
    merged = _grouped(rows, by, ["bucket"], [F.bit_count(F.bit_or(n)).alias(n)
                                             for n in names], grains)
    return _with_end(merged.groupBy(*_keys(by)).agg(*[F.sum(n).cast("bigint").alias(n) for n in names]))


def store(df: DataFrame, path: str) -> DataFrame:
    """Written by day and read back."""
    df.write.mode("overwrite").partitionBy("day").parquet(path)
    return df.sparkSession.read.parquet(path)
