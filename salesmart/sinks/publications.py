"""One write, many publications: units of the marts, and which of them count.

A run writes its part of every dataset once, under ``{dataset}/run_id=N/sales_month=M/``.
Such a (run, month) is a *unit*: immutable, and the same in every dataset of the job.
Each run logs what it did to units in ``_units/run_id=N``: ``+1`` for those it added,
``-1`` for those it replaced, ``0`` for months that it had begun to write when it died.
The log counts once the ledger says that the run is finished, so a single append, the
ledger's finish events, publishes the run in all datasets at once.

* live units = units whose logged signs of the finished runs add up to one;
* a snapshot version names a run: its units are those live after that run, so that a
  version is a row, not a copy of the data;
* a unit that a newer one replaces is *retired*: moved to ``{dataset}/_retired/``, out
  of sight of plain reads of the dataset's path, where older versions still find it.

A run that died leaves units which no finished run logged: they count nowhere, and the
run's successor takes its number and overwrites them.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salesmart.sinks import storage

UNIT = ("run_id", "sales_month")
RETIRED = "_retired"
_LOG = "run_id long, unit_run long, sales_month string, sign int"
_VERSIONS = "version long, run_id long"
#: Folder of a null month.
_NULL_FOLDER = "__HIVE_DEFAULT_PARTITION__"


def month_folder(month: str | None) -> str:
    return f"sales_month={_NULL_FOLDER if month is None else month}"


def log_units(ops: DataFrame, log: str, run_id: int) -> None:
    """Write run ``run_id``'s log (``unit_run``, ``sales_month``, ``sign``), in place of one that it left when it died."""
    ops.select("unit_run", "sales_month", "sign").coalesce(1).write.mode("overwrite").parquet(f"{log}/run_id={run_id}")


def read_log(spark: SparkSession, log: str) -> DataFrame:
    try:
        return spark.read.schema(_LOG).parquet(log)
    except AnalysisException as exc:
        if exc.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], _LOG)


def live_units(log: DataFrame, finished: DataFrame, upto: int | None = None) -> DataFrame:
    """``run_id``, ``sales_month`` of the units that count, now or after run ``upto``."""
    known = log.join(finished.withColumnRenamed("run_id", "_done"), F.col("run_id") == F.col("_done"), "left_semi")
    if upto is not None:
        known = known.where(F.col("run_id") <= upto)
    signs = known.where("sign <> 0").groupBy(F.col("unit_run").alias("run_id"), "sales_month").agg(F.sum("sign").alias("n"))
    return signs.where("n > 0").select(*UNIT)


def in_units(rows: DataFrame, units: DataFrame) -> DataFrame:
    """Rows of a dataset that belong to ``units``; with broadcast units Spark prunes the other folders at run time."""
    u = units.select(F.col("run_id").alias("_u_run"), F.col("sales_month").alias("_u_month"))
    same = (F.col("run_id") == F.col("_u_run")) & F.col("sales_month").eqNullSafe(F.col("_u_month"))
    return rows.join(u, same, "left_semi")


def retire(spark: SparkSession, dataset: str, units: list[tuple[int, str | None]]) -> None:
    """Move replaced units out of plain reads; units that are gone already are passed over."""
    for run, month in units:
        unit = f"run_id={run}/{month_folder(month)}"
        storage.move(spark, f"{dataset}/{unit}", f"{dataset}/{RETIRED}/{unit}", replace=True)


def publish_version(spark: SparkSession, prefix: str, version: int, run_id: int) -> int:
    """Append a version that names a run; nothing is overwritten, so there is no moment without a latest version."""
    row = spark.createDataFrame([(version, run_id)], _VERSIONS)
    row.coalesce(1).write.mode("append").parquet(f"{prefix}/_versions")
    return version


def versions(spark: SparkSession, prefix: str) -> DataFrame:
    """``version``, ``run_id`` of every publication under ``prefix``."""
    try:
        return spark.read.schema(_VERSIONS).parquet(f"{prefix}/_versions")
    except AnalysisException as exc:
        if exc.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], _VERSIONS)


def read_version(
    spark: SparkSession, dataset: str, prefix: str, log: DataFrame, finished: DataFrame, version: int | None = None
) -> DataFrame:
    """K3 + S7 — a dataset as of a published version (the newest by default), retired units included."""
    known = versions(spark, prefix)
    chosen = known.where(F.col("version") == version) if version is not None else known.orderBy(F.desc("version")).limit(1)
    row = chosen.first()
    if row is None:
        raise FileNotFoundError(f"no version {version or ''} under {prefix}".replace("  ", " "))
    units = F.broadcast(live_units(log, finished, upto=row.run_id))
    parts = [in_units(spark.read.parquet(dataset), units)]
    if storage.exists(spark, f"{dataset}/{RETIRED}"):
        old = spark.read.option("basePath", f"{dataset}/{RETIRED}").parquet(f"{dataset}/{RETIRED}")
        parts.append(in_units(old, units))
    out = parts[0]
    for more in parts[1:]:
        out = out.unionByName(more)
    return out
