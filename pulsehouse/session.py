"""Session construction and shared-folder helpers."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

from pyspark.sql import SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"


# Settings for a large cluster (100 TB input): partitions sized for the
# data rather than the core count, AQE coalescing small ones and splitting
# skewed ones, and state-store checkpoints that write only changes.
CLUSTER_CONF = {
    "spark.sql.files.maxPartitionBytes": str(256 * 1024 * 1024),
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(256 * 1024 * 1024),
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(512 * 1024 * 1024),
    "spark.sql.shuffle.partitions": "4000",
    "spark.sql.streaming.stateStore.rocksdb.compactOnCommit": "false",
}


def build_session(
    app_name: str = "pulsehouse",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    time_zone: str = "UTC",
    extra: dict[str, str] | None = None,
    cluster: bool = False,
) -> SparkSession:
    """A session with AQE, skew-join splitting, Arrow and the RocksDB
    state store (changelog checkpointing) enabled.

    ``time_zone`` is the zone that day cuts use. Production runs pass
    ``Asia/Shanghai`` (the source's GMT+8); comparisons against DuckDB
    keep UTC. ``cluster`` adds ``CLUSTER_CONF``.
    """
    b = SparkSession.builder.appName(app_name)
    if master:
        b = b.master(master)
    conf = {
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.session.timeZone": time_zone,
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.sql.streaming.stateStore.providerClass": (
            "org.apache.spark.sql.execution.streaming.state."
            "RocksDBStateStoreProvider"
        ),
    }
    conf["spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled"] = "true"
    if cluster:
        conf.update(CLUSTER_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    return b.getOrCreate()


def shared_dir(spark: SparkSession, *parts: str) -> str:
    """A path under the cluster's shared checkpoint folder.

    The folder comes from ``spark.checkpoint.dir``. Only when it is unset
    (tests, a laptop) is a private folder created and recorded, so every
    later call in the session agrees on it - and only with a local master:
    executors on other machines would not share it.
    """
    base = spark.conf.get(CHECKPOINT_CONF, None)
    if not base:
        base = _LOCAL_DIRS.get(id(spark.sparkContext))
    if not base:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise RuntimeError(f"set {CHECKPOINT_CONF} to a folder that all machines share")
        base = tempfile.mkdtemp(prefix="pulsehouse-ckpt-")
        _LOCAL_DIRS[id(spark.sparkContext)] = base
        spark.sparkContext.setCheckpointDir(base)
    return os.path.join(base, *parts) if parts else base


# Folders made for sessions that have no shared checkpoint folder (tests).
_LOCAL_DIRS: dict[int, str] = {}


def new_run_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder for one streaming run under the shared folder."""
    base = shared_dir(spark, "runs").rstrip("/")
    return f"{base}/{name}-{uuid.uuid4().hex[:12]}"


def ship_package(spark: SparkSession) -> None:
    """Make ``pulsehouse`` importable in the Python workers of every
    executor (as ``--py-files`` would): the pandas state functions of the
    streaming detectors run there. The package is zipped once per
    SparkContext on the driver and distributed by Spark."""
    sc = spark.sparkContext
    if getattr(sc, "_pulsehouse_shipped", False):
        return
    pkg_dir = os.path.dirname(os.path.abspath(__file__))
    root = os.path.dirname(pkg_dir)
    zpath = os.path.join(tempfile.mkdtemp(prefix="pulsehouse-pkg-"), "pulsehouse.zip")
    with zipfile.ZipFile(zpath, "w", zipfile.ZIP_DEFLATED) as z:
        for dirpath, _, files in os.walk(pkg_dir):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(dirpath, f)
                    z.write(full, os.path.relpath(full, root))
    sc.addPyFile(zpath)
    sc._pulsehouse_shipped = True
