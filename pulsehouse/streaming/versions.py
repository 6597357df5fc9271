"""Versions of a dimension by micro-batch (JOIN-2): which rows a batch was
enriched with can be looked up again, so a replayed or recomputed batch gives
the same rows although the dimension has been edited since.

``DimensionVersions`` keeps a snapshot per content (``<path>/version=<n>``, n
the first batch that saw it) and per batch the version it used
(``<path>_batches/batch_id=<n>``). ``enrich_as_of`` joins events of many batches
with the version each of them had: the as-of lookup batch -> version is a
small table, the rest is an equality join.
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pulsehouse import config
from pulsehouse.operators.enrich import enrich
from pulsehouse.streaming.enrichment import (
    last_batch,
    list_batches,
    move_path,
    path_exists,
    read_text,
    write_text,
)


class DimensionVersions:
    """``load`` reads the dimension as it is now (dim_item_id, category,
    dim_content_len). One writer at a time."""

    def __init__(self, load: Callable[[], DataFrame], path: str):
        self.load, self.path = load, path.rstrip("/")

    def _note(self, batch_id: int) -> str:
        return f"{self.path}_batches/batch_id={batch_id}"

    def _noted(self, spark: SparkSession, batch_id: int) -> dict:
        return json.loads(read_text(spark, self._note(batch_id)))

    def for_batch(self, spark: SparkSession, batch_id: int) -> DataFrame:
        """The dimension of this batch: as noted if the batch is known, else
        as it is now, kept as a new version if its content has changed.

        Contents are compared by row count and order-free sums of row hashes;
        a dimension is some kilobytes to gigabytes and read once for it."""
        if not path_exists(spark, self._note(batch_id)):
            now = self.load()
            h = F.xxhash64(*now.columns)
            got = now.agg(F.count(F.lit(1)), F.bit_xor(h), F.sum(F.pmod(h, F.lit(1 << 40)))).first()
            mark = [None if x is None else int(x) for x in got]
            before = last_batch(spark, f"{self.path}_batches")
            last = None if before is None else self._noted(spark, before)
            if last is None or last["content"] != mark:
                staged = f"{self.path}_staged/version={batch_id}"
                now.write.mode("overwrite").parquet(staged)
                move_path(spark, staged, f"{self.path}/version={batch_id}")
                last = {"version": batch_id, "content": mark}
            write_text(spark, self._note(batch_id), json.dumps(last))
        version = self._noted(spark, batch_id)["version"]
        return spark.read.parquet(f"{self.path}/version={version}")

    def by_batch(self, spark: SparkSession) -> DataFrame:
        """batch_id, version of all batches seen (one small file each)."""
        rows = [(n, self._noted(spark, n)["version"]) for n in
                list_batches(spark, f"{self.path}_batches")]
        return spark.createDataFrame(rows, "batch_id bigint, version bigint")

    def table(self, spark: SparkSession) -> DataFrame:
        """All versions: the dimension's columns and ``version``."""
        return spark.read.parquet(self.path)


def enrich_as_of(events: DataFrame, versions: DimensionVersions,
                 broadcast_max_rows: int | None = config.DEFAULT_SCALE.broadcast_max_rows) -> DataFrame:
    """``events`` (with batch_id) left-joined with the version each batch had;
    misses and batches never seen are Unknown / 0, no event is dropped."""
    spark = events.sparkSession
    of_batch = F.broadcast(versions.by_batch(spark))  # one narrow row per batch
    rows = events.join(of_batch, "batch_id", "left")
    # one key for the equality join: an item in a version
    key = F.concat_ws(":", F.col("version").cast("string"), F.col("item_id").cast("string"))
    known = F.col("version").isNotNull() & F.col("item_id").isNotNull()
    rows = rows.withColumn("_item", F.col("item_id")).withColumn("item_id", F.when(known, key))
    dim = versions.table(spark).select(
        F.concat_ws(":", F.col("version").cast("string"), F.col("dim_item_id").cast("string"))
        .alias("dim_item_id"), "category", "dim_content_len")
    out = enrich(rows, dim, broadcast_max_rows=broadcast_max_rows)
    return out.withColumn("item_id", F.col("_item")).drop("_item", "version")
