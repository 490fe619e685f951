"""Incremental landing ingest with Structured Streaming (re-aims the file ledger
and the "move to processed" step).

The streaming file source lists new files and records every file it has handed
out in its checkpoint — an exactly-once processed-file ledger that survives
driver and executor loss.  ``cleanSource="archive"`` moves finished files to an
archive folder, which is the modelled system's "processed" prefix (Spark moves
completed files lazily, at a later batch commit).

Micro-batches (``foreachBatch``) run the batch operators on *their* files
and keep every write idempotent, so a batch replayed after a failure gives
the same result:

* a drain's batch notes its files, ``_batches/batch_id=N``; the publication that it waits for audits,
  ingests and enriches the files of all noted batches in one go, under the newest one's number.  Files stay where
  they landed until then, so a drain with ``archive_dir``, and a query that keeps running, does this in the batch itself
* enriched rows -> ``enriched/batch_id=N/sales_month=…`` (overwrite of the batch's own folder)
* a *publication* sums the enriched rows of the batches since the last one, once, into its own
  ``_totals/…/upto=N`` and rebuilds the aggregate marts for those batches' months only, from all
  publications' totals of the months (partition-pruned read), with dynamic partition overwrite — monthly
  totals and the top performer stay right however the files are spread over batches.  The
  files' finish events follow, and the marker ``_published/upto=N`` makes its totals count.

A drain publishes when as many batches wait as are published, and at its end: a sale is read once
and the marts are written some log2(batches) times, not once for each batch of four files.  What a
drain that died left waiting is published by the next.  A query that keeps running publishes
each batch.

The file list is read through the ``binaryFile`` source with the ``content``
column pruned, so listing never reads file bodies.  Zero-byte files produce
no row in a streaming file source; they are not quarantined in this mode.
"""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salesmart.functions.columns import file_base_name, month_key, normalise_path, ts_literal
from salesmart.operators import audit as AU
from salesmart.operators import enrich as EN
from salesmart.operators import ingest as IN
from salesmart.operators import ledger as LG
from salesmart.operators import marts as MA
from salesmart.session import ensure_checkpoint_dir
from salesmart.sinks import parquet as PQ
from salesmart.sinks import quarantine as QU
from salesmart.sinks import storage
from salesmart.sources.files import listed_files


@dataclass
class StreamPaths:
    out: str

    @property
    def enriched(self) -> str:
        return f"{self.out}/enriched"

    @property
    def batches(self) -> str:
        return f"{self.out}/_batches"

    @property
    def audit(self) -> str:
        return f"{self.out}/_audit"

    @property
    def quarantine(self) -> str:
        return f"{self.out}/sales_data_error"

    @property
    def ledger(self) -> str:
        return f"{self.out}/_ledger"

    @property
    def customer_day_totals(self) -> str:
        return f"{self.out}/_totals/customer_day"

    @property
    def seller_month_totals(self) -> str:
        return f"{self.out}/_totals/seller_month"

    @property
    def published(self) -> str:
        return f"{self.out}/_published"

    @property
    def customers_data_mart(self) -> str:
        return f"{self.out}/customers_data_mart"

    @property
    def customer_day_mart(self) -> str:
        return f"{self.out}/customer_day_mart"

    @property
    def sales_team_month_mart(self) -> str:
        return f"{self.out}/sales_team_month_mart"


def _write_months(df: DataFrame, path: str, dynamic: bool = True) -> None:
    PQ.write_partitioned(df, path, ("sales_month",), overwrite="dynamic" if dynamic else "static")


def _ids(spark: SparkSession, folder: str, key: str) -> list[int]:
    """Numbers of the ``key=N`` entries of a folder, ascending."""
    names = [n.split("=", 1) for n in storage.children(spark, folder)]
    return sorted(int(n[1]) for n in names if n[0] == key and len(n) == 2)


def _read_parts(spark: SparkSession, base: str, key: str, ids: list[int]) -> DataFrame | None:
    """The ``key=N`` folders of a dataset; None where none of them has a row."""
    try:
        return spark.read.option("basePath", base).parquet(*[f"{base}/{key}={i}" for i in ids])
    except AnalysisException as exc:
        if exc.getCondition() != "UNABLE_TO_INFER_SCHEMA":
            raise
        return None


@dataclass
class Enricher:
    """What the sales of landed files are joined with."""

    customer: DataFrame
    store: DataFrame
    sales_team: DataFrame
    how: str = "inner"

    def ingest(self, spark: SparkSession, paths: StreamPaths, found: list, number: int) -> None:
        """Audit -> quarantine, ledger start and enriched rows of some files (``path``, ``file_modified_ms``), as batch ``number``."""
        files = listed_files(spark, {c: [r[c] for r in found] for c in ("path", "file_modified_ms")})
        files = files.select("path", file_base_name("path").alias("file_name"), "file_modified_ms")
        audit_dir = f"{paths.audit}/batch_id={number}"
        AU.audit_landing(spark, files).write.mode("overwrite").parquet(audit_dir)
        audit = spark.read.schema(AUDIT_SCHEMA).parquet(audit_dir)

        def refused() -> None:
            QU.quarantined_lines(spark, audit).write.mode("overwrite").parquet(f"{paths.quarantine}/batch_id={number}")

        def accepted() -> None:
            files = audit.where(F.col("accepted")).select("path", "file_name", "file_modified_ms")
            if files.isEmpty():
                return
            LG.append_ledger(LG.ledger_start(files, ts_literal(F.current_timestamp())), paths.ledger)
            enriched = EN.enrich(IN.ingest_sales(spark, audit), self.customer, self.store, self.sales_team, how=self.how)
            enriched = enriched.withColumn("sales_month", month_key("sales_date"))
            _write_months(enriched, f"{paths.enriched}/batch_id={number}", dynamic=False)

        PQ.side_by_side(spark, [refused, accepted])


def _ingest_noted(spark: SparkSession, paths: StreamPaths, noted: list[int], enricher: Enricher) -> None:
    """The files of the noted batches, as the newest of them."""
    for n in noted[:-1]:  # what a publication that died made of them
        for folder in (paths.enriched, paths.audit, paths.quarantine):
            storage.delete(spark, f"{folder}/batch_id={n}")
    notes = spark.read.schema(NOTE_SCHEMA).json([f"{paths.batches}/batch_id={n}" for n in noted])
    enricher.ingest(spark, paths, notes.collect(), noted[-1])


def publish_batches(
    spark: SparkSession, paths: StreamPaths, enricher: Enricher, upto: int | None = None, scope: str = "store_month",
    ties: str = "all", doubling: bool = False,
) -> bool:
    """Bring the marts up to batch ``upto`` (by default the newest); False when there was nothing to do.

    ``doubling`` does so only when at least as many batches wait as are published.
    """
    noted, ingested = _ids(spark, paths.batches, "batch_id"), _ids(spark, paths.enriched, "batch_id")
    batches = sorted({*noted, *ingested})
    if upto is None:
        upto = batches[-1] if batches else -1
    done = [n for n in _ids(spark, paths.published, "upto") if n < upto + 1]
    last = done[-1] if done else -1
    waiting = [n for n in batches if last < n <= upto]
    if not waiting or (doubling and 2 * len(waiting) < sum(n <= upto for n in batches)):
        return False
    due = [n for n in noted if n in waiting]
    if due:
        _ingest_noted(spark, paths, due, enricher)
    # the totals' folder is named after the newest batch in it
    name = waiting[-1]
    parts = [n for n in _ids(spark, paths.enriched, "batch_id") if n in waiting]
    rows = _read_parts(spark, paths.enriched, "batch_id", parts) if parts else None
    if rows is not None:
        cdet, sdet = MA.customer_mart_detail(rows), MA.sales_team_mart_detail(rows)
        days = MA.customer_day_totals(cdet).withColumn("sales_month", month_key("sales_date"))
        totals = [(days, paths.customer_day_totals), (MA.sales_person_month_totals(sdet), paths.seller_month_totals)]
        PQ.side_by_side(spark, [lambda d=d, p=p: _write_months(d, f"{p}/upto={name}", dynamic=False) for d, p in totals])
        _write_marts(spark, paths, [*done, name], name, scope, ties)
    if parts:
        audits = spark.read.schema(AUDIT_SCHEMA).parquet(*[f"{paths.audit}/batch_id={n}" for n in parts])
        accepted = audits.where(F.col("accepted")).select("path", "file_name", "file_modified_ms")
        LG.append_ledger(LG.ledger_finish(accepted, ts_literal(F.current_timestamp())), paths.ledger)
    storage.create_new(spark, f"{paths.published}/upto={name}", "")
    return True


def _write_marts(spark: SparkSession, paths: StreamPaths, published: list[int], newest: int, scope: str, ties: str) -> None:
    """The aggregate marts of the newest totals' months, from all published totals."""
    own = _read_parts(spark, paths.seller_month_totals, "upto", [newest])
    touched = [r.sales_month for r in own.select("sales_month").distinct().collect()]
    some = F.col("sales_month").isin([m for m in touched if m is not None])
    if None in touched:
        some = some | F.col("sales_month").isNull()

    def totals(path: str) -> DataFrame:
        # a publication of batches without a sale has no folder
        there = set(_ids(spark, path, "upto"))
        return _read_parts(spark, path, "upto", [n for n in published if n in there]).where(some).drop("upto")

    def customer_months() -> None:
        months = MA.customer_month_from_days(totals(paths.customer_day_totals))
        _write_months(months.withColumn("sales_month", month_key("sales_date_month")), paths.customers_data_mart)

    def customer_days() -> None:
        days = MA.customer_day_from_days(totals(paths.customer_day_totals))
        _write_months(days.withColumn("sales_month", month_key("sales_date")), paths.customer_day_mart)

    def sales_team() -> None:
        merged = MA.merged_seller_totals(totals(paths.seller_month_totals)).checkpoint(eager=True)
        _write_months(MA.sales_team_month_from_totals(merged, scope=scope, ties=ties), paths.sales_team_month_mart)

    ensure_checkpoint_dir(spark)
    PQ.side_by_side(spark, [customer_months, customer_days, sales_team])


AUDIT_SCHEMA = (
    "path string, file_name string, file_modified_ms bigint, file_size bigint, header string, columns array<string>, "
    "missing array<string>, extra array<string>, accepted boolean, reason string"
)


NOTE_SCHEMA = "path string, file_modified_ms bigint"


def make_batch_handler(
    paths: StreamPaths,
    enricher: Enricher,
    scope: str = "store_month",
    ties: str = "all",
    each_batch: bool = True,
    note_only: bool = False,
):
    """The ``foreachBatch`` function: audit -> ingest -> enrich, then the month-scoped marts when a publication is due.

    ``each_batch`` publishes every batch; without it as many batches must wait as are published.
    ``note_only`` leaves the files of a batch to the publication that it waits for.
    """

    def handle(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        # a replayed batch counts with the publication that follows, not with one that it died in
        storage.delete(spark, f"{paths.published}/upto={batch_id}")
        found = batch.select("path", F.unix_millis("modificationTime").alias("file_modified_ms")).collect()
        if note_only:
            storage.delete(spark, f"{paths.batches}/batch_id={batch_id}")
            note = "\n".join(json.dumps(r.asDict()) for r in found)
            storage.create_new(spark, f"{paths.batches}/batch_id={batch_id}", note)
        else:
            enricher.ingest(spark, paths, found, batch_id)
        publish_batches(spark, paths, enricher, batch_id, scope, ties, doubling=not each_batch)

    return handle


def process_landing_stream(
    spark: SparkSession,
    landing: str,
    out: str,
    checkpoint: str,
    customer: DataFrame,
    store: DataFrame,
    sales_team: DataFrame,
    max_files_per_trigger: int | None = None,
    archive_dir: str | None = None,
    available_now: bool = True,
    how: str = "inner",
    **mart_options,
) -> StreamPaths:
    """Process every file landed under ``landing`` that this checkpoint has not seen.

    ``available_now=True`` drains what is there and stops (a scheduled job);
    ``False`` keeps the query running and returns at once (``spark.streams``).
    """
    paths = StreamPaths(out.rstrip("/"))
    reader = (
        spark.readStream.format("binaryFile")
        .schema("path string, modificationTime timestamp, length bigint, content binary")
        .option("recursiveFileLookup", True)
    )
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    if archive_dir:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive_dir)
    files = reader.load(landing).select("path", "modificationTime")
    enricher = Enricher(customer, store, sales_team, how)
    # a batch's files are archived from the next batch on
    note_only = available_now and not archive_dir
    handler = make_batch_handler(paths, enricher, each_batch=not available_now, note_only=note_only, **mart_options)
    writer = files.writeStream.foreachBatch(handler).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    query = writer.start()
    if available_now:
        query.awaitTermination()
        if query.exception():
            raise query.exception()
        # every batch is committed now
        publish_batches(spark, paths, enricher, **mart_options)
    return paths
