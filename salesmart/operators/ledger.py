"""L1–L4, F3, F4, A5, K8 — the file ledger as an append-only event table.

The modelled system inserts one row per file with status ``A`` when a run
starts and updates it to ``I`` when the run finishes.  Here both are appended
events; the current state of a file is its latest event.  A run that dies
between start and finish leaves its files in ``A``, which is exactly what the
re-run guard reports next time.  A file is its full path and modification time,
so equal names in dated folders are different files.  All operators are joins /
aggregates keyed on the path (partial aggregation absorbs a file with many events).
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salesmart.functions.columns import ts_literal
from salesmart.schema import (
    LEDGER_FILE_SCHEMA,
    LEDGER_SCHEMA,
    STATUS_FINISHED,
    STATUS_REJECTED,
    STATUS_STARTED,
)


def _location(files: DataFrame) -> F.Column:
    return F.col("file_location") if "file_location" in files.columns else F.col("path")


def _modified(files: DataFrame) -> F.Column:
    c = F.col("file_modified_ms") if "file_modified_ms" in files.columns else F.lit(None)
    return c.cast("bigint").alias("file_modified_ms")


def ledger_start(files: DataFrame, ts) -> DataFrame:
    """L1 — one ``A`` event per file (``file_location`` is the file's real path)."""
    return files.select(
        "file_name",
        _location(files).alias("file_location"),
        ts_literal(ts).alias("created_date"),
        F.lit(None).cast("timestamp_ntz").alias("updated_date"),
        F.lit(STATUS_STARTED).alias("status"),
        _modified(files),
    )


def ledger_finish(batch: DataFrame, ts, status: str = STATUS_FINISHED) -> DataFrame:
    """L2 — one event per file of the batch, stamped with the *end* time.

    ``status`` is ``I`` for files whose sales are in the marts, ``E`` for files that
    the audit rejected, ``R`` for versions that a newer one replaces.
    """
    return batch.select(
        "file_name",
        _location(batch).alias("file_location"),
        F.lit(None).cast("timestamp_ntz").alias("created_date"),
        ts_literal(ts).alias("updated_date"),
        F.lit(status).alias("status"),
        _modified(batch),
    )


def ledger_current(ledger: DataFrame) -> DataFrame:
    """L4 — latest status per landed file version (path + modification time).

    First start and last finish times; events at the same instant order ``A``
    before all others.
    """
    order = F.struct(
        F.coalesce("updated_date", "created_date").alias("t"),
        (F.col("status") != F.lit(STATUS_STARTED)).alias("fin"),
    )
    return ledger.select(*LEDGER_SCHEMA.fieldNames()).groupBy(
        "file_name", "file_location", "file_modified_ms"
    ).agg(
        F.min("created_date").alias("created_date"),
        F.max("updated_date").alias("updated_date"),
        F.max_by("status", order).alias("status"),
    )


def _same_file(files: DataFrame, states: DataFrame) -> list[F.Column]:
    """Join condition: same path and same version (null-safe: no metadata on one side matches by path)."""
    return [
        files["_f_path"] == states["_s_path"],
        F.coalesce(files["_f_mod"], states["_s_mod"]).eqNullSafe(F.coalesce(states["_s_mod"], files["_f_mod"])),
    ]


def _states(ledger: DataFrame, *status: str) -> DataFrame:
    return (
        ledger_current(ledger)
        .where(F.col("status").isin(*status))
        .select(F.col("file_location").alias("_s_path"), F.col("file_modified_ms").alias("_s_mod"))
    )


def ledger_pending(files: DataFrame, ledger: DataFrame) -> DataFrame:
    """L3 + F3 + A5 — distinct names of landed files whose current status is unfinished."""
    f = files.select("file_name", _location(files).alias("_f_path"), _modified(files).alias("_f_mod"))
    unfinished = _states(ledger, STATUS_STARTED)
    return f.join(unfinished, _same_file(f, unfinished), "left_semi").select("file_name").distinct()


def unprocessed(files: DataFrame, ledger: DataFrame) -> DataFrame:
    """K8 — landed files (versions) neither finished nor rejected: the re-aimed "processed" and "error" moves."""
    f = files.withColumn("_f_path", _location(files)).withColumn("_f_mod", _modified(files))
    done = _states(ledger, STATUS_FINISHED, STATUS_REJECTED)
    return f.join(done, _same_file(f, done), "left_anti").drop("_f_path", "_f_mod")


def superseded(accepted: DataFrame, ledger: DataFrame) -> DataFrame:
    """Finished versions that another version of the same path among ``accepted`` replaces.

    ``file_name``, ``file_location``, ``file_modified_ms`` of the old versions; their
    sales leave the marts with the run that brings the new version.
    """
    new = accepted.select(_location(accepted).alias("_n_path"), _modified(accepted).alias("_n_mod"))
    old = ledger_current(ledger).where(F.col("status") == F.lit(STATUS_FINISHED))
    replaced = (old["file_location"] == new["_n_path"]) & ~old["file_modified_ms"].eqNullSafe(new["_n_mod"])
    return old.join(new, replaced, "left_semi").select("file_name", "file_location", "file_modified_ms")


def finished_runs(ledger: DataFrame) -> DataFrame:
    """``run_id`` of every run that came to its end: only their parts of the marts count."""
    ended = F.col("status").isin(STATUS_FINISHED, STATUS_REJECTED)
    return ledger.where(ended & F.col("run_id").isNotNull()).select("run_id").distinct()


def next_run(ledger: DataFrame) -> int:
    """Number of the next run: one above the last finished one.

    A run that died has no finish events, so its successor takes its number and
    replaces what it left.
    """
    return (finished_runs(ledger).agg(F.max("run_id")).first()[0] or 0) + 1


def append_ledger(events: DataFrame, path: str, run_id: int | None = None) -> str:
    """Persist ledger events (append-only parquet)."""
    run = F.lit(run_id).cast("bigint").alias("run_id")
    events.select(*LEDGER_SCHEMA.fieldNames(), run).write.mode("append").parquet(path)
    return path


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    """The ledger events at ``path``; an empty ledger when nothing was written yet."""
    try:
        return spark.read.schema(LEDGER_FILE_SCHEMA).parquet(path)
    except AnalysisException as exc:
        if exc.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], LEDGER_FILE_SCHEMA)  # no ledger yet
