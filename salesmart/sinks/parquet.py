"""K1–K3, K6 — parquet marts.

Partitioned writes go through a ``rebalance`` hint on the partition columns:
with AQE on, Spark hash-partitions by those columns, merges small partitions
and *splits* a hot one (``optimizeSkewsInRebalancePartitions``), so the file
count stays bounded without putting a third of the data into one task.
"""

from __future__ import annotations

import re
import time
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager

from pyspark import inheritable_thread_target
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from salesmart.session import freed_shuffles

SALES_TEAM_PARTITIONS = ("sales_month", "store_id")


def write_mart(df: DataFrame, path: str, mode: str = "overwrite") -> str:
    """K1 — flat parquet mart."""
    df.write.mode(mode).parquet(path)
    return path


_FLOOR_KEY = "spark.sql.adaptive.coalescePartitions.minPartitionSize"
_FLOOR_BYTES = 64 * 1024


def _bytes(text: str) -> int:
    units = {"b": 1, "k": 1 << 10, "kb": 1 << 10, "m": 1 << 20, "mb": 1 << 20, "g": 1 << 30, "gb": 1 << 30}
    m = re.fullmatch(r"\s*(\d+)\s*([a-zA-Z]*)\s*", text)
    return int(m.group(1)) * units.get(m.group(2).lower(), 1) if m else _FLOOR_BYTES


@contextmanager
def parallel_small_writes(spark: SparkSession):
    """Within the block, AQE keeps rebalanced partitions of at least 64 KB apart.

    AQE's default floor (1 MB) merges a small input into one task, which then
    writes every partition folder alone (thousands of files for
    ``sales_month × store_id``).  Only lowers the floor, restores it after; data
    large enough to matter at scale is unaffected (and hot partitions are
    still split).
    """
    current = spark.conf.get(_FLOOR_KEY, None)
    effective = _bytes(current or spark.conf.get(_FLOOR_KEY))
    if effective <= _FLOOR_BYTES:
        yield
        return
    spark.conf.set(_FLOOR_KEY, str(_FLOOR_BYTES))
    try:
        yield
    finally:
        if current is None:
            spark.conf.unset(_FLOOR_KEY)
        else:
            spark.conf.set(_FLOOR_KEY, current)


def side_by_side(spark: SparkSession, writes: list[Callable[[], object]]) -> list:
    """Independent writes as jobs of one application at the same time; the first failure is raised."""
    with parallel_small_writes(spark), ThreadPoolExecutor(max(1, len(writes))) as pool:
        return [done.result() for done in [pool.submit(inheritable_thread_target(spark)(f)) for f in writes]]


def write_partitioned(
    df: DataFrame,
    path: str,
    partition_cols=SALES_TEAM_PARTITIONS,
    overwrite: str = "static",
    mode: str = "overwrite",
    rebalance=None,
    after=None,
    sort_by=(),
) -> str:
    """K2 — Hive-style partitioned parquet.

    ``rebalance`` names the columns that rows are brought together by (default: the partition columns),
    ``sort_by`` those by which a file's rows lie; ``after`` adds to the rows, in their order, once they are together.
    The rows' shuffle goes away as the write ends.

    ``overwrite="static"`` replaces the whole tree; ``"dynamic"`` replaces only
    the partitions present in ``df`` (others are kept).
    """
    if overwrite not in ("static", "dynamic"):
        raise ValueError("overwrite must be 'static' or 'dynamic'")
    cols = list(partition_cols)
    rows = df.hint("rebalance", *(rebalance or cols))
    if sort_by:
        # the one sort that the write needs for its partitions, by more columns and before rows grow
        rows = rows.sortWithinPartitions(*cols, *sort_by)
    if after is not None:
        rows = after(rows)
    with parallel_small_writes(df.sparkSession), freed_shuffles(df.sparkSession):
        (
            rows.write.mode(mode)
            .option("partitionOverwriteMode", overwrite)
            .partitionBy(*cols)
            .parquet(path)
        )
    return path


def snapshot_version(now: float | None = None) -> int:
    """Epoch version of a snapshot: whole seconds × 1000."""
    return int(now if now is not None else time.time()) * 1000


def publish_snapshot(
    df: DataFrame,
    prefix: str,
    version: int | None = None,
    partition_cols=SALES_TEAM_PARTITIONS,
) -> int:
    """K3 — publish ``df`` as ``{prefix}/version={v}/{partitions}/…`` (no local copy)."""
    v = snapshot_version() if version is None else int(version)
    prefix = prefix.rstrip("/")
    write_partitioned(df, f"{prefix}/version={v}", partition_cols, mode="errorifexists")
    # Named after the data is there, by an append: no moment without a latest version.
    named = df.sparkSession.createDataFrame([(str(v),)], "value string")
    named.coalesce(1).write.mode("append").text(f"{prefix}/{PUBLISHED}")
    return v


# Hidden from partition discovery (leading underscore).
PUBLISHED = "_published"


def _newest(spark: SparkSession, prefix: str) -> int | None:
    try:
        named = spark.read.text(f"{prefix}/{PUBLISHED}")
    except AnalysisException as exc:
        if exc.getCondition() != "PATH_NOT_FOUND":
            raise
        return None  # nothing named yet
    return named.selectExpr("max(cast(value as bigint))").first()[0]


_VERSION = re.compile(r"/version=(\d+)/")


def snapshot_versions(spark: SparkSession, prefix: str) -> list[int]:
    """Published versions, from the file listing only (no data is read)."""
    files = spark.read.option("basePath", prefix).parquet(prefix).inputFiles()
    return sorted({int(m.group(1)) for f in files if (m := _VERSION.search(f))})


def latest_snapshot(spark: SparkSession, prefix: str, schema: T.StructType | None = None) -> DataFrame:
    """S7 + K3 — the newest published snapshot, read from its own folder only.

    The version comes from the names that publications append under ``_published``;
    without any the versions' folders are listed.
    """
    prefix = prefix.rstrip("/")
    v = _newest(spark, prefix)
    if v is None:  # nothing named: fall back to listing the versions
        versions = snapshot_versions(spark, prefix)
        if not versions:
            raise FileNotFoundError(f"no snapshot under {prefix}")
        v = versions[-1]
    reader = spark.read.schema(schema) if schema is not None else spark.read
    return reader.parquet(f"{prefix}/version={v}")


def read_mart(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """S7 — read a parquet mart back (partition columns are discovered; filters prune)."""
    reader = spark.read.schema(schema) if schema is not None else spark.read
    return reader.parquet(path)


def preview(df: DataFrame, n: int = 20) -> DataFrame:
    """K6/T2 — first ``n`` rows (the limit is the feature)."""
    return df.limit(n)
