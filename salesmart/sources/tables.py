"""S5, S6 — dimension / ledger tables and the typed empty fact."""

from __future__ import annotations

import decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from salesmart.schema import FACT_SCHEMA


def _literal(value) -> str:
    if isinstance(value, bool) or isinstance(value, (int, float, decimal.Decimal)):
        return str(value)
    return "'" + str(value).replace("'", "''") + "'"


def equal_depth_predicates(source: DataFrame, column: str, partitions: int, accuracy: int = 10_000) -> list[str]:
    """Disjoint predicates on ``column`` that hold about as many rows each and together all rows, nulls included.

    Split points of numbers and dates come from Spark's quantile sketch over the whole
    column (map-side sketches, merged); those of strings from about ``accuracy`` rows that
    a hash draws.  A value is never split, so a
    predicate holds at least the rows of the commonest value in it.
    """
    kind = source.schema[column].dataType
    shares = [i / partitions for i in range(1, partitions)]
    known = source.where(F.col(column).isNotNull())
    if not shares:
        return ["1 = 1"]
    if isinstance(kind, T.StringType):
        # as many strings as the sketch would keep, evenly drawn by hash, give the points
        n = known.count()
        every = max(1, n // accuracy)
        drawn = known.where(F.pmod(F.xxhash64(column, F.monotonically_increasing_id()), F.lit(every)) == 0)
        ranked = sorted(r[0] for r in drawn.select(column).collect())
        points = [ranked[int(s * len(ranked))] for s in shares] if ranked else []
    else:
        row = known.agg(F.percentile_approx(column, shares, accuracy).alias("p")).first()
        points = row.p or []
    points = sorted(set(points))
    if not points:
        return ["1 = 1"]
    at = [f"{column} < {_literal(points[0])} or {column} is null"]
    at += [f"{column} >= {_literal(a)} and {column} < {_literal(b)}" for a, b in zip(points, points[1:])]
    return [*at, f"{column} >= {_literal(points[-1])}"]


def read_table(
    spark: SparkSession,
    table: str,
    url: str | None = None,
    properties: dict[str, str] | None = None,
    partition_column: str | None = None,
    lower_bound: int | None = None,
    upper_bound: int | None = None,
    num_partitions: int | None = None,
) -> DataFrame:
    """S5 — a table from JDBC (``url``) or from the session catalog.

    A JDBC read is one partition unless ``partition_column`` is given.  With bounds
    its range is cut into steps of equal width; without, into predicates of equal
    depth (one more pass over that column finds them), so that a skewed key does not
    put most rows into one partition.  Catalog tables are read by Spark's own splits.
    """
    if not url:
        return spark.table(table)
    options = properties or {}
    if partition_column is None:
        return spark.read.jdbc(url, table, properties=options)
    n = num_partitions or 8
    if lower_bound is None or upper_bound is None:
        keys = spark.read.jdbc(url, table, properties=options).select(partition_column)
        return spark.read.jdbc(url, table, predicates=equal_depth_predicates(keys, partition_column, n), properties=options)
    return spark.read.jdbc(
        url, table, column=partition_column, lowerBound=lower_bound, upperBound=upper_bound, numPartitions=n, properties=options
    )


def empty_sales(spark: SparkSession) -> DataFrame:
    """S6 — typed empty frame in the fact layout."""
    return spark.createDataFrame([], FACT_SCHEMA)
