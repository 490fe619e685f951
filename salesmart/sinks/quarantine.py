"""K7 — quarantine of rejected files, as a dataset partitioned by reason.

The reference moves rejected files to an error folder; here every line of a
rejected file is kept with its file name, reason and missing columns, so the
error area is queryable and nothing is moved on the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from salesmart.functions.columns import normalise_path
from salesmart.operators.audit import REASON_NOT_CSV
from salesmart.operators.joins import hint_small
from salesmart.sources.files import paths_of

QUARANTINE_SCHEMA = T.StructType(
    [
        T.StructField("file_name", T.StringType()),
        T.StructField("path", T.StringType()),
        T.StructField("reason", T.StringType()),
        T.StructField("missing", T.StringType()),
        T.StructField("is_header", T.BooleanType()),
        T.StructField("line", T.StringType()),
    ]
)


def quarantined_lines(spark: SparkSession, audit: DataFrame) -> DataFrame:
    """Every line of every rejected file; ``is_header`` marks a CSV file's header line.

    One scan of the rejected files: the header text is already in the audit, so
    a line is a header when it sits in the file's first split and equals it.
    A file without a byte has no lines; it has one row here, whose ``line`` is null.
    """
    size = F.col("file_size") if "file_size" in audit.columns else F.lit(None).cast("bigint")
    rejected = audit.where(~F.col("accepted")).select(
        "path", "file_name", "reason", F.array_join("missing", ",").alias("missing"), "header", size.alias("_size")
    )
    empty = rejected.where("_size = 0").select(
        "file_name", "path", "reason", "missing", F.lit(False).alias("is_header"), F.lit(None).cast("string").alias("line")
    )
    rejected = rejected.where("_size is null or _size > 0").drop("_size")
    paths = paths_of(rejected)
    if not paths:
        return spark.createDataFrame([], QUARANTINE_SCHEMA).unionByName(empty)
    lines = spark.read.text(paths).select(
        normalise_path(F.col("_metadata.file_path")).alias("path"),
        F.col("_metadata.file_block_start").alias("_start"),
        F.col("value").alias("line"),
    )
    (meta,) = hint_small([rejected])
    is_header = (
        (F.col("reason") != REASON_NOT_CSV) & (F.col("_start") == 0) & F.coalesce(F.col("line") == F.col("header"),
                                                                                  F.lit(False))
    )
    told = lines.join(meta, "path").select("file_name", "path", "reason", "missing", is_header.alias("is_header"), "line")
    return told.unionByName(empty)


def quarantine(spark: SparkSession, audit: DataFrame, path: str, mode: str = "overwrite") -> DataFrame:
    """Write the quarantine dataset under ``path`` partitioned by ``reason``.

    There are a handful of reasons, so the scan's tasks write them as they read: no shuffle of all lines.
    """
    q = quarantined_lines(spark, audit)
    q.write.mode(mode).partitionBy("reason").parquet(path)
    return q
