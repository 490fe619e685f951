"""Helpers that several operators of the subpackage share."""

from __future__ import annotations

import math
from collections.abc import Callable
from functools import wraps

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from salesmart.session import freed_shuffles, work_dir

#: ASCII white space of the word pattern ``[^\x20\x09-\x0D]+``.
WORD = "[^\\x20\\x09-\\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Arrow data of a batch, for operators that hold several things made of one.
BATCH = "8m"
_BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"


def in_small_batches(build: Callable) -> Callable:
    """``build(docs, …)`` whose jobs hand tasks ``BATCH`` of Arrow data at once: what a worker and its executor hold with it."""

    @wraps(build)
    def within(docs: DataFrame, *args, **kwargs):
        conf = docs.sparkSession.conf
        before = conf.get(_BATCH_BYTES)
        conf.set(_BATCH_BYTES, BATCH)
        try:
            return build(docs, *args, **kwargs)
        finally:
            conf.set(_BATCH_BYTES, before)

    return within


def staged(df: DataFrame, label: str, partition_by: str | None = None) -> DataFrame:
    """``df`` written to the shared folder and read back: cuts lineage, survives lost executors."""
    spark = df.sparkSession
    path = work_dir(spark, label)
    writer = df.write if partition_by is None else df.write.partitionBy(partition_by)
    with freed_shuffles(spark):
        writer.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def word_count(text: Column) -> Column:
    """Words of a text; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def ascii_lower(text: Column) -> Column:
    """Lower-cases A-Z and nothing else."""
    return F.translate(text, UPPER, LOWER)


def root_buckets(n_rows: int) -> int:
    """Buckets into which a total order over ``n_rows`` rows splits: as many as rows in each."""
    return max(1, math.isqrt(max(0, n_rows - 1)) + 1)


def running_start(df: DataFrame, key: str, order: str, value: str, n_rows: int, out: str) -> DataFrame:
    """Adds ``out``: the sum of ``value`` over the rows of ``key`` that stand before a row by ``order``.

    ``order`` is a double in [0, 1), spread evenly. No task holds a whole key: a
    key's rows fall into sqrt(n) buckets by order; the buckets' totals are summed
    along the key, then the rows along their bucket. Equal orders go by the
    remaining columns, so repeated rows get places one after another.
    """
    buckets = root_buckets(n_rows)
    bucket = F.least(F.floor(F.col(order) * buckets), F.lit(buckets - 1)).cast("long")
    rows = df.withColumn("_b", bucket)
    along = Window.partitionBy("_k").orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    totals = (
        rows.groupBy(F.col(key).alias("_k"), "_b")
        .agg(F.sum(value).alias("_t"))
        .select("_k", "_b", F.coalesce(F.sum("_t").over(along), F.lit(0)).alias("_base"))
    )
    rest = [c for c in df.columns if c not in (key, order)]
    inside = Window.partitionBy(key, "_b").orderBy(order, *rest).rowsBetween(Window.unboundedPreceding, -1)
    placed = rows.withColumn("_in", F.coalesce(F.sum(value).over(inside), F.lit(0)))
    joined = placed.alias("r").join(
        totals.alias("t"), F.col(f"r.{key}").eqNullSafe(F.col("t._k")) & (F.col("r._b") == F.col("t._b"))
    )
    return joined.select(*[F.col(f"r.{c}") for c in df.columns], (F.col("_base") + F.col("_in")).alias(out))
