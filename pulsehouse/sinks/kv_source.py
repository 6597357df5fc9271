"""Key-value rows of a stream in a store with a commit protocol (SNK-1,
STR-11), as a streaming sink of its own (``format("pulsehouse_kv")``).

Two phases per micro-batch: every task writes its rows to a new file under
``data/``, which nobody reads yet; when all tasks are done the driver writes
the list of files as ``commits/<batch id>.json``, by a rename. A failed batch
removes its files, a replayed batch finds its list and removes what it has
written again, so each batch is in the store once. ``read_kv`` gives the newest
value of each (key, field); ``compact_kv`` folds committed batches into a
snapshot, so readers never scan the whole history.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource,
    DataSourceStreamArrowWriter,
    WriterCommitMessage,
)

from pulsehouse.session import ship_package
from pulsehouse.streaming.enrichment import (
    list_files,
    move_path,
    path_exists,
    read_text,
    remove_path,
)

FORMAT = "pulsehouse_kv"
ROWS = "key string, field string, value string, ttl_sec int"
# Rows of one row group: what a task holds at a time.
GROUP_ROWS = 100_000


def _fs(path: str) -> tuple[pafs.FileSystem, str]:
    """The file system and the path in it, from a path as Spark takes it."""
    if path.startswith("file:"):
        path = "/" + path.removeprefix("file:").lstrip("/")
    return pafs.FileSystem.from_uri(path)


@dataclass
class Written(WriterCommitMessage):
    """The file of a task (none if it had no rows) and its rows."""

    file: str | None
    rows: int


class KVWriter(DataSourceStreamArrowWriter):
    def __init__(self, path: str):
        self.path = path.rstrip("/")

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        fs, base = _fs(self.path)
        name, rows, out = f"{uuid.uuid4().hex}.parquet", 0, None
        try:
            for batch in iterator:
                if not batch.num_rows:
                    continue
                if out is None:
                    fs.create_dir(f"{base}/data", recursive=True)
                    out = pq.ParquetWriter(f"{base}/data/{name}", batch.schema, filesystem=fs)
                out.write_batch(batch, row_group_size=GROUP_ROWS)
                rows += batch.num_rows
        finally:
            if out is not None:
                out.close()
        return Written(name if out is not None else None, rows)

    def _drop(self, messages) -> None:
        fs, base = _fs(self.path)
        for m in messages:
            if m is not None and m.file is not None:
                found = fs.get_file_info(f"{base}/data/{m.file}")
                if found.type == pafs.FileType.File:
                    fs.delete_file(found.path)

    def commit(self, messages, batchId: int) -> None:
        fs, base = _fs(self.path)
        done = f"{base}/commits/{batchId}.json"
        if fs.get_file_info(done).type == pafs.FileType.File or batchId <= _folded(fs, base):
            self._drop(messages)  # a replay: the batch is in the store
            return
        fs.create_dir(f"{base}/commits", recursive=True)
        entry = {"batch_id": batchId, "at": time.time(),
                 "files": [m.file for m in messages if m is not None and m.file is not None],
                 "rows": sum(m.rows for m in messages if m is not None)}
        staged = f"{base}/commits/_{batchId}-{uuid.uuid4().hex}"
        with fs.open_output_stream(staged) as f:
            f.write(json.dumps(entry).encode())
        fs.move(staged, done)

    def abort(self, messages, batchId: int) -> None:
        self._drop(messages)


def _folded(fs: pafs.FileSystem, base: str) -> int:
    """The last batch that is part of a snapshot, -1 without one."""
    found = fs.get_file_info(pafs.FileSelector(f"{base}/snapshots", allow_not_found=True))
    return max((int(x.base_name.removeprefix("upto=")) for x in found
                if x.base_name.startswith("upto=")), default=-1)


class KVSource(DataSource):
    """Option ``path``: the folder of the store."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return ROWS

    def streamWriter(self, schema, overwrite: bool) -> KVWriter:
        return KVWriter(self.options["path"])


def register(spark: SparkSession) -> None:
    """Makes the sink known to the session (``writeStream.format(FORMAT)``)."""
    ship_package(spark)
    spark.dataSource.register(KVSource)


def _committed(spark: SparkSession, path: str) -> tuple[int, list[dict]]:
    """(last batch of the newest snapshot or -1, later commits)."""
    names = list_files(spark, f"{path}/snapshots")
    folded = max((int(n.removeprefix("upto=")) for n in names if n.startswith("upto=")), default=-1)
    ids = [int(n.removesuffix(".json")) for n in list_files(spark, f"{path}/commits")
           if n.endswith(".json") and not n.startswith("_")]
    return folded, [json.loads(read_text(spark, f"{path}/commits/{i}.json"))
                    for i in sorted(ids) if i > folded]


def _versions(spark: SparkSession, path: str) -> DataFrame:
    """key, field, value, ttl_sec, batch_id, expire_at of the newest snapshot
    and all batches committed since."""
    folded, commits = _committed(spark, path)
    out = spark.createDataFrame([], f"{ROWS}, batch_id bigint, expire_at timestamp")
    if folded >= 0:
        out = spark.read.schema(out.schema).parquet(f"{path}/snapshots/upto={folded}")
    files = [(f, c["batch_id"], c["at"]) for c in commits for f in c["files"]]
    if files:
        rows = spark.read.schema(ROWS).parquet(*[f"{path}/data/{f}" for f, _, _ in files])
        rows = rows.select("*", rows.metadataColumn("_metadata").getField("file_name").alias("_f"))
        of_batch = spark.createDataFrame(files, "_f string, batch_id bigint, _at double")
        rows = rows.join(F.broadcast(of_batch), "_f")  # one narrow row per file since the snapshot
        out = out.unionByName(rows.select(
            "key", "field", "value", "ttl_sec", "batch_id",
            F.timestamp_seconds(F.col("_at") + F.col("ttl_sec")).alias("expire_at")))
    return out


def _newest(versions: DataFrame) -> DataFrame:
    return versions.groupBy("key", "field").agg(F.max_by(
        F.struct("value", "ttl_sec", "batch_id", "expire_at"),
        F.struct("batch_id", "value")).alias("v")).select("key", "field", "v.*")


def read_kv(spark: SparkSession, path: str) -> DataFrame:
    """key, field, value, ttl_sec: the value of the newest committed batch,
    unless it has expired. Of two values of a batch the larger text stays."""
    path = path.rstrip("/")
    return _newest(_versions(spark, path)).where(F.col("expire_at") > F.current_timestamp()).select(
        "key", "field", "value", "ttl_sec")


def compact_kv(spark: SparkSession, path: str) -> int:
    """Folds all batches committed so far into one snapshot of the values that
    have not expired, then removes what it replaces. Returns the last batch in
    it (-1: nothing committed). To be run beside the stream by one process;
    readers that started before may have to read again."""
    path = path.rstrip("/")
    folded, commits = _committed(spark, path)
    if not commits:
        return folded
    upto = commits[-1]["batch_id"]
    now = _newest(_versions(spark, path)).where(F.col("expire_at") > F.current_timestamp())
    staged = f"{path}/staged/upto={upto}"
    now.write.mode("overwrite").parquet(staged)
    if not path_exists(spark, f"{path}/snapshots/upto={upto}"):
        move_path(spark, staged, f"{path}/snapshots/upto={upto}")
    for c in commits:
        remove_path(spark, f"{path}/commits/{c['batch_id']}.json")
        for f in c["files"]:
            remove_path(spark, f"{path}/data/{f}")
    if folded >= 0:
        remove_path(spark, f"{path}/snapshots/upto={folded}")
    return upto
