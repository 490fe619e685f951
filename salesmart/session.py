"""Session construction and the shared scratch area.

Round-trip outputs and lineage cuts go to the folder the cluster names in
``spark.checkpoint.dir``.  A private folder is created only when that setting
is unset (local runs and tests).
"""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings that matter at scale; all are public Spark SQL configuration keys.
SCALE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Rebalanced partitioned writes: let AQE split hot partitions and merge
    # small ones, but not below 64 KB so a tiny input still writes in parallel.
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions": "true",
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "64KB",
    "spark.sql.session.timeZone": "UTC",
    # Checkpoint files (header probe, seller-month totals) are removed once unreferenced.
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(
    master: str | None = None,
    app_name: str = "salesmart",
    shuffle_partitions: int | None = None,
    extra_conf: dict[str, str] | None = None,
) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(SCALE_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra_conf or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("WARN")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the session's checkpoint folder, creating a private one if unset."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if not configured and not sc.master.split("[")[0] == "local":
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    if not configured:
        configured = tempfile.mkdtemp(prefix="salesmart-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def work_dir(spark: SparkSession, label: str) -> str:
    """A fresh, never-reused folder under the shared checkpoint area."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    # setCheckpointDir appends a per-application uuid folder; stay inside it.
    return f"{base}/salesmart/{label}-{uuid.uuid4().hex[:12]}"


_FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def freed_shuffles(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of the queries run inside go away as each query ends."""
    before = spark.conf.get(_FREE_SHUFFLES, "false")
    spark.conf.set(_FREE_SHUFFLES, "true")
    try:
        yield
    finally:
        spark.conf.set(_FREE_SHUFFLES, before)


def local_path(uri: str) -> str:
    """Strip a ``file:`` scheme so Python can address a local path (tests only)."""
    if uri.startswith("file:"):
        rest = uri[len("file:"):]
        while rest.startswith("//"):
            rest = rest[1:]
        return os.path.normpath(rest)
    return uri
