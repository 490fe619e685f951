"""K4 — aggregate mart to a SQL table (JDBC database or the session catalog).

A catalog table is published in two phases: the rows are written to a folder of their
own and counted, then the table's location is set to that folder.  Whatever fails before
the second phase leaves the table as it was; readers see the old rows or the new ones.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


class CountMismatch(RuntimeError):
    """The staged rows are not those that were written."""


def _quoted(table: str) -> str:
    return ".".join(f"`{part.replace('`', '``')}`" for part in table.split("."))


def _same_columns(spark: SparkSession, table: str, df: DataFrame) -> bool:
    return [(f.name, f.dataType) for f in spark.table(table).schema] == [(f.name, f.dataType) for f in df.schema]


def publish_table(df: DataFrame, table: str, path: str | None = None) -> str:
    """Replace a catalog table's rows in two phases; old versions' folders stay under ``path``.

    Without ``path`` versions lie beside the warehouse's tables.
    """
    spark = df.sparkSession
    base = (path or f"{spark.conf.get('spark.sql.warehouse.dir')}/{table}__versions").rstrip("/")
    staged = f"{base}/version={uuid.uuid4().hex}"
    seen = Observation()
    df.observe(seen, F.count(F.lit(1)).alias("n")).write.parquet(staged)
    written = spark.read.schema(df.schema).parquet(staged)
    n = written.count()
    # a task that ran twice is observed twice: only too few rows are certainly wrong
    if n != seen.get["n"] and n != df.count():
        raise CountMismatch(f"{n} rows staged for {table}, {seen.get['n']} written")
    name, place = _quoted(table), staged.replace("'", "\\'")
    if spark.catalog.tableExists(table):
        if not _same_columns(spark, table, written):
            spark.sql(f"DROP TABLE {name}")
            spark.catalog.createTable(table, staged, "parquet", written.schema)
        else:
            spark.sql(f"ALTER TABLE {name} SET LOCATION '{place}'")
            spark.catalog.refreshTable(table)
    else:
        spark.catalog.createTable(table, staged, "parquet", written.schema)
    return table


def write_table(
    df: DataFrame,
    table: str,
    mode: str = "overwrite",
    url: str | None = None,
    properties: dict[str, str] | None = None,
    path: str | None = None,
    num_partitions: int | None = None,
) -> str:
    """Write ``df`` to ``table``.

    With ``url``: JDBC (``numPartitions`` bounds concurrent connections).
    Without: a table in the session catalog, whose versions lie under ``path`` when given.
    Default mode is ``overwrite`` so a re-run never double-appends; a catalog table
    is replaced in two phases (``publish_table``).
    """
    if mode not in ("overwrite", "append"):
        raise ValueError("mode must be 'overwrite' or 'append'")
    if url:
        # an overwritten table keeps its definition, indexes and grants
        w = df.write.mode(mode).option("truncate", "true")
        if num_partitions:
            w = w.option("numPartitions", str(num_partitions))
        w.jdbc(url, table, mode=mode, properties=properties or {})
        return table
    if mode == "overwrite" or not df.sparkSession.catalog.tableExists(table):
        return publish_table(df, table, path)
    df.write.mode("append").format("parquet").saveAsTable(table)
    return table
