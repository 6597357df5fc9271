"""Enrichment with dimension hot reload (JOIN-2, STR-8, STR-11).

A stream-static join keeps the dimension's file listing from the moment
the query was defined, so an edited dimension file is not reliably seen.
Here the enrichment runs in ``foreachBatch``: every micro-batch loads the
dimension anew and appends the enriched rows to a layer table
(``batch_id=<n>`` folders). Stateful metrics then stream from that layer.

A batch is written to a staging folder, which a file source does not list
(its name starts with an underscore), and renamed into place when it is
complete; a replayed batch whose folder is there is skipped. So the layer
stays exactly-once under at-least-once delivery, and readers never see half a
batch.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from pulsehouse import config
from pulsehouse.functions import behaviour_tags
from pulsehouse.operators.enrich import enrich


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether ``path`` exists on the cluster file system."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs.exists(p)


def _on_fs(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def remove_path(spark: SparkSession, path: str) -> None:
    """Removes ``path`` (a folder this library wrote) if it exists."""
    fs, p = _on_fs(spark, path)
    fs.delete(p, True)


def move_path(spark: SparkSession, source: str, target: str) -> None:
    """Renames a folder; what was at ``target`` must be gone."""
    _rename(spark, source, target)


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small file (a batch's bookkeeping), written whole under another name
    and renamed."""
    fs, p = _on_fs(spark, f"{path}.new")
    out = fs.create(p, True)
    out.write(bytearray(text.encode()))
    out.close()
    remove_path(spark, path)
    _rename(spark, f"{path}.new", path)


def read_text(spark: SparkSession, path: str) -> str:
    fs, p = _on_fs(spark, path)
    size = fs.getFileStatus(p).getLen()
    stream = fs.open(p)
    try:
        return bytes(stream.readNBytes(int(size))).decode()
    finally:
        stream.close()


def list_files(spark: SparkSession, path: str) -> list[str]:
    """The names of the entries in ``path``; none if it does not exist."""
    fs, p = _on_fs(spark, path)
    return [s.getPath().getName() for s in fs.listStatus(p)] if fs.exists(p) else []


def list_batches(spark: SparkSession, path: str) -> list[int]:
    """The n of the entries ``batch_id=<n>`` in ``path``, in order."""
    return sorted(int(n.removeprefix("batch_id=")) for n in list_files(spark, path)
                  if n.startswith("batch_id=") and n.removeprefix("batch_id=").isdecimal())


def last_batch(spark: SparkSession, path: str) -> int | None:
    """The largest of ``list_batches``, None if there is none."""
    return max(list_batches(spark, path), default=None)


def _rename(spark: SparkSession, source: str, target: str) -> None:
    jvm = spark.sparkContext._jvm
    a, b = jvm.org.apache.hadoop.fs.Path(source), jvm.org.apache.hadoop.fs.Path(target)
    fs = b.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    fs.mkdirs(b.getParent())
    if not fs.rename(a, b):
        raise OSError(f"cannot move {source} to {target}")


class EnrichWithReload:
    """``foreachBatch`` function: enrich with a freshly loaded dimension
    and append to ``out_path``. With ``versions`` the dimension comes from
    there, so a batch that has to be computed again meets the one it had."""

    def __init__(
        self,
        load_dim: Callable[[], DataFrame],
        out_path: str,
        broadcast_max_rows: int = config.DEFAULT_SCALE.broadcast_max_rows,
        versions=None,
    ):
        self.load_dim, self.versions = load_dim, versions
        self.out_path = out_path.rstrip("/")
        self.broadcast_max_rows = broadcast_max_rows

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        target = f"{self.out_path}/batch_id={batch_id}"
        if path_exists(spark, target):
            return  # replay of a committed batch
        dim = self.versions.for_batch(spark, batch_id) if self.versions else self.load_dim()
        enriched = enrich(batch, dim, broadcast_max_rows=self.broadcast_max_rows)
        staged = f"{self.out_path}/_staging/batch_id={batch_id}"
        if "duration_sec" in enriched.columns:  # what the tags are about
            enriched = enriched.select("*", *behaviour_tags())
        enriched.write.mode("overwrite").parquet(staged)
        _rename(spark, staged, target)
