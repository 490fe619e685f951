"""The whole job: landed CSVs -> audited fact -> enriched fact -> marts.

1. claim a run number; finish what the last run left to tidy up
2. discover landed files; report files a previous run left unfinished (``A``);
   ``strict=True`` refuses to run while such files exist
3. skip files the ledger marks finished (``I``) or rejected (``E``)
4. audit headers once, staged; quarantine the lines of rejected files
5. append ledger ``A`` events for the accepted files
6. one scan of the accepted files and one shuffle: every line is checked, enriched and
   written once, accepted lines by month, all others with a reason.  Landed lines must
   equal accepted plus rejected lines, or the run stops (a dimension key twice shows here)
7. publish from that one write: detail marts, pre-aggregates, and for the months that this
   run touched the aggregate marts and the CSV report
8. append the ledger's finish events, which make the run count everywhere at once; name a
   snapshot version; move replaced units aside; give the claim back

**Corrected files.**  A file that lands again under its path replaces its old version.  The
old version's sales sit in units, (run, month) parts of the datasets; the run carries the
other files' rows of those units into its own parts and logs the units as replaced, so that
every mart and the newest snapshot hold the new version only.  Months that lose their last
sale lose their mart rows too.  Only units of corrected files are written again, and months
in more than ``fold_after`` parts are folded into one.

**Died runs.**  A run's parts live under ``run_id=N`` and count only when the ledger says
that run N is finished.  A successor takes the same number, overwrites those folders whole,
and computes again the months which the dead run had begun to write as well as its own.
"""

from __future__ import annotations

import datetime as dt
import time
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from salesmart.functions.columns import file_base_name, month_key
from salesmart.operators import audit as AU
from salesmart.operators import enrich as EN
from salesmart.operators import ingest as IN
from salesmart.operators import ledger as LG
from salesmart.operators import marts as MA
from salesmart.schema import STATUS_REJECTED, STATUS_RETRACTED
from salesmart.session import ensure_checkpoint_dir
from salesmart.sinks import parquet as PQ
from salesmart.sinks import publications as PB
from salesmart.sinks import quarantine as QU
from salesmart.sinks import reports as RP
from salesmart.sinks import storage
from salesmart.sinks import tables as TB
from salesmart.sources import files as FS


ALL_OUTPUTS = frozenset(
    {
        "customer_data_mart",
        "sales_team_data_mart",
        "sales_partitioned_data_mart",
        "snapshots",
        "customers_data_mart",
        "customer_day_mart",
        "sales_team_month_mart",
        "monthly_report",
    }
)

#: Live parts of a month beyond which a run folds them into its own.
FOLD_AFTER = 64


#: Files of a run up to which their paths are broadcast.
BROADCAST_FILES = 100_000


class RerunRequired(RuntimeError):
    """A previous run left files unfinished and ``strict=True`` was asked."""


class RunClaimed(RuntimeError):
    """Another job holds this run number, or was killed while it did (``takeover=True`` then)."""


class LinesLost(RuntimeError):
    """Landed lines are not accepted plus rejected lines."""


@dataclass
class PipelineResult:
    out: str
    ledger: str
    pending_before: int
    accepted_files: int
    rejected_files: int
    snapshot_version: int
    paths: dict[str, str] = field(default_factory=dict)
    timings: dict[str, float] = field(default_factory=dict)
    run_id: int = 0
    landed_lines: int = 0
    accepted_lines: int = 0
    rejected_lines: int = 0
    retracted_files: int = 0


def _now() -> str:
    return dt.datetime.now(dt.timezone.utc).strftime("%Y-%m-%d %H:%M:%S")


def output_paths(out: str) -> dict[str, str]:
    """Where a job under ``out`` keeps its datasets.

    The sales team's detail is one dataset: read flat, by partition, or as of a snapshot version.
    """
    team = f"{out}/sales_partitioned_data_mart"
    return {
        "lines": f"{out}/_staging/lines",
        "enriched": f"{out}/_staging/lines/rejected=false",
        "unit_files": f"{out}/_staging/unit_files",
        "customer_day_totals": f"{out}/_staging/customer_day_totals",
        "seller_month_totals": f"{out}/_staging/seller_month_totals",
        "units": f"{out}/_units",
        "quarantine": f"{out}/sales_data_error",
        "rejected_rows": f"{out}/sales_data_error_rows",
        "customer_data_mart": f"{out}/customer_data_mart",
        "sales_team_data_mart": team,
        "sales_partitioned_data_mart": team,
        "snapshots": f"{out}/sales_partitioned_snapshots",
        "customers_data_mart": f"{out}/customers_data_mart",
        "customer_day_mart": f"{out}/customer_day_mart",
        "sales_team_month_mart": f"{out}/sales_team_month_mart",
        "monthly_report": f"{out}/monthly_report",
    }


#: Datasets made of units.
_UNIT_DATASETS = ("enriched", "customer_day_totals", "seller_month_totals", "customer_data_mart", "sales_partitioned_data_mart")


@contextmanager
def run_claim(spark: SparkSession, ledger_path: str, run_id: int, takeover: bool = False) -> Iterator[None]:
    """L1 — hold run ``run_id``: a file that only one job can create, given back when the block ends, failed or not.

    A job that was killed leaves its claim; ``takeover=True`` says that it is known to be dead.
    """
    claim = f"{ledger_path}/_claims/run_id={run_id}"
    app = spark.sparkContext.applicationId
    if not storage.create_new(spark, claim, f"{app} {_now()}"):
        if not takeover:
            raise RunClaimed(f"run {run_id} is held by {storage.read_small(spark, claim)}; takeover=True if that job is dead")
        storage.delete(spark, claim)
        if not storage.create_new(spark, claim, f"{app} {_now()}"):
            raise RunClaimed(f"run {run_id} was taken over by another job")
    try:
        yield
    finally:
        storage.delete(spark, claim)


def _read_or_none(spark: SparkSession, path: str) -> DataFrame | None:
    try:
        return spark.read.parquet(path)
    except AnalysisException as exc:
        if exc.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return None


def _retire(spark: SparkSession, paths: dict[str, str], units: list[tuple[int, str | None]]) -> None:
    for name in _UNIT_DATASETS:
        PB.retire(spark, paths[name], units)


def _tidy_up(spark: SparkSession, paths: dict[str, str], last_run: int, snapshots: bool) -> None:
    """What follows a run's finish events, in case the last run died right after them."""
    log = PB.read_log(spark, paths["units"]).where(F.col("run_id") == last_run)
    replaced = [(r.unit_run, r.sales_month) for r in log.where("sign < 0").collect()]
    _retire(spark, paths, replaced)
    if snapshots and last_run and not log.isEmpty():
        _name_version(spark, paths["snapshots"], last_run)


def _name_version(spark: SparkSession, prefix: str, run_id: int) -> int:
    """The snapshot version of a run, named now unless it was before; versions rise with runs."""
    known = PB.versions(spark, prefix)
    row = known.agg(F.max("version").alias("v"), F.max(F.when(F.col("run_id") == run_id, F.col("version"))).alias("own")).first()
    if row.own is not None:
        return row.own
    return PB.publish_version(spark, prefix, max(PQ.snapshot_version(), (row.v or 0) + 1000), run_id)


def read_snapshot(spark: SparkSession, out: str, version: int | None = None, ledger_path: str | None = None) -> DataFrame:
    """K3 + S7 — the sales team's detail as of a snapshot version (the newest by default): all sales live then."""
    paths = output_paths(out.rstrip("/"))
    ledger = LG.read_ledger(spark, ledger_path or f"{out.rstrip('/')}/_ledger")
    log = PB.read_log(spark, paths["units"])
    finished = LG.finished_runs(ledger)
    return PB.read_version(spark, paths["sales_partitioned_data_mart"], paths["snapshots"], log, finished, version)


def _check_conserved(landed: int, checked: int, recount, dims: dict[str, tuple[DataFrame | None, str]]) -> None:
    """Landed lines are accepted plus rejected lines; observed counts that differ are counted again exactly."""
    if landed == checked:
        return
    landed, checked = recount()
    if landed == checked:
        return
    for name, (dim, key) in dims.items():
        twice = dim.groupBy(key).count().where("count > 1").first() if dim is not None else None
        if twice is not None:
            raise LinesLost(f"{landed} lines landed and {checked} came out: {name} has {key} {twice[0]} {twice[1]} times")
    raise LinesLost(f"{landed} lines landed and {checked} came out")


def run_pipeline(
    spark: SparkSession,
    landing: str,
    out: str,
    customer: DataFrame,
    store: DataFrame,
    sales_team: DataFrame,
    product: DataFrame | None = None,
    ledger_path: str | None = None,
    how: str = "inner",
    scope: str = "store_month",
    ties: str = "all",
    strict: bool = False,
    table_options: dict | None = None,
    outputs: frozenset[str] | None = None,
    clock=_now,
    takeover: bool = False,
    multi_line: bool = True,
    fold_after: int = FOLD_AFTER,
) -> PipelineResult:
    """Run the job once over ``landing``; outputs go under ``out``.

    ``table_options`` (e.g. ``{"url": ..., "properties": {...}}``, or ``{}`` for catalog
    tables) sends the two aggregate marts to SQL tables as well (K4).  ``outputs`` limits which marts
    are written (default: all of ``ALL_OUTPUTS``).  ``takeover`` passes over the claim
    of a job that was killed.  ``multi_line`` as in ``ingest.read_cells``.
    """
    want = ALL_OUTPUTS if outputs is None else frozenset(outputs)
    unknown = want - ALL_OUTPUTS
    if unknown:
        raise ValueError(f"unknown outputs: {sorted(unknown)}")
    out = out.rstrip("/")
    ledger_path = ledger_path or f"{out}/_ledger"
    paths = output_paths(out)
    timings: dict[str, float] = {}

    @contextmanager
    def step(name: str):
        t0 = time.perf_counter()
        yield
        timings[name] = round(time.perf_counter() - t0, 3)

    ledger = LG.read_ledger(spark, ledger_path)
    run_id = LG.next_run(ledger)
    with run_claim(spark, ledger_path, run_id, takeover):

        def part(name: str) -> str:
            """This run's part of a dataset."""
            return f"{paths[name]}/run_id={run_id}"

        # 1–3. landed files, re-run guard, skip finished files
        with step("discover"):
            _tidy_up(spark, paths, run_id - 1, "snapshots" in want)
            files = FS.discover_files(spark, landing)
            pending = LG.ledger_pending(files, ledger).count()
        if pending and strict:
            raise RerunRequired(f"{pending} file(s) from an unfinished run are waiting; re-run without strict")
        todo = AU.require_csv(LG.unprocessed(files, ledger))

        # 4. one header audit, staged (one row per file); quarantine
        with step("audit"):
            paths["audit"] = f"{out}/_staging/audit/run_id={run_id}"
            AU.audit_landing(spark, todo).write.mode("overwrite").parquet(paths["audit"])
            audit = spark.read.parquet(paths["audit"])
            n_accepted, rejected = audit.agg(
                F.count_if("accepted").alias("a"), F.count_if(~F.col("accepted")).alias("r")
            ).first()
        with step("quarantine"):
            QU.quarantine(spark, audit, part("quarantine"))
        refused = LG.ledger_finish(
            audit.where(~F.col("accepted")).select("path", "file_name", "file_modified_ms"), clock(), STATUS_REJECTED
        )
        if not n_accepted:
            LG.append_ledger(refused, ledger_path, run_id)
            raise FS.NoDataError("No Data available with correct files")

        # 5. ledger start
        with step("ledger_start"):
            accepted = audit.where(F.col("accepted")).select("path", "file_name", "file_modified_ms")
            LG.append_ledger(LG.ledger_start(accepted, clock()), ledger_path, run_id)
            old_path = f"{out}/_staging/superseded/run_id={run_id}"
            LG.superseded(accepted, ledger).write.mode("overwrite").parquet(old_path)
            old = spark.read.parquet(old_path)
            n_old = old.count()

        # 6. one scan, one shuffle: checked and enriched lines, and the rows of replaced units that stay
        with step("ingest_enrich"):
            finished = LG.finished_runs(ledger)
            log = PB.read_log(spark, paths["units"])
            live = PB.live_units(log, finished)
            # months that a dead run of this number has touched
            stale = [r.sales_month for r in log.where(F.col("run_id") == run_id).select("sales_month").distinct().collect()]
            replaced = _replaced_units(spark, paths["unit_files"], live, old, fold_after)
            seen, done = Observation(), Observation()
            # what a file or a small dimension says of its lines is not shuffled with each of them
            files = _numbered_files(audit, n_accepted)
            lines = _without_files(IN.checked_lines(spark, audit, multi_line, seen), files)
            line_dims = EN.line_dims(customer, store, sales_team, product)
            checked = EN.enrich_lines(lines, line_dims, how=how)
            bare = EN.without_small(_partitioned_lines(checked), line_dims)
            bare = bare.observe(done, F.count(F.lit(1)).alias("n"), F.count("reason").alias("rejected"))
            if replaced:
                bare = bare.unionByName(_carried_rows(spark, paths["enriched"], replaced, old), allowMissingColumns=True)
            like = bare.drop("_file")
            # what a dead run of this number left goes, whatever months it had
            refused_part = f"{paths['lines']}/rejected=true/run_id={run_id}"
            for left in (part("enriched"), refused_part):
                storage.delete(spark, left)
            # no literal, which Spark would leave out of the sort, to sort again for the write
            run = F.col("rejected").cast("int") * 0 + F.lit(run_id)
            PQ.write_partitioned(
                bare.withColumn("run_id", run), paths["lines"], ("rejected", "run_id", "sales_month"), mode="append",
                rebalance=("rejected", "sales_month"), sort_by=("customer_id",),
                after=lambda rows: _with_files(EN.with_small(rows, line_dims, F.col("_file").isNotNull()), files),
            )
            n_lines, n_rejected = done.get["n"], done.get["rejected"]
            dims = {
                "sales_team": (sales_team, "id"), "store": (store, "id"), "customer": (customer, "customer_id"),
                "product": (product, "name"),
            }
            _check_conserved(seen.get["n"], n_lines, lambda: (lines.count(), checked.count()), dims)
            enriched = _read_part(spark, part("enriched"), like).drop("rejected", "reason", "line")
            told = _read_part(spark, refused_part, like)
            told = told.select(file_base_name("path").alias("file_name"), "path", "reason", "line")
            told.write.mode("overwrite").parquet(part("rejected_rows"))
            storage.delete(spark, refused_part)  # they lie under rejected_rows now

        # 7. publications of that one write
        with step("units"):
            by_file = enriched.groupBy("sales_month", "path", "file_modified_ms").agg(
                F.count("*").alias("n_rows"), F.sum("total_cost").alias("total_cost")
            )
            by_file.write.mode("overwrite").parquet(part("unit_files"))
            added = [r.sales_month for r in spark.read.parquet(part("unit_files")).select("sales_month").distinct().collect()]
            ops = [(run_id, m, 1) for m in added] + [(r, m, -1) for r, m in replaced]
            ops += [(run_id, m, 0) for m in stale if m not in added]
            PB.log_units(spark.createDataFrame(ops, "unit_run long, sales_month string, sign int"), paths["units"], run_id)
        cdet, sdet = MA.customer_mart_detail(enriched), MA.sales_team_mart_detail(enriched)
        with step("detail_marts"):
            # Pre-aggregates are kept for every run, whatever its outputs: later runs merge them.
            month = month_key("sales_date")
            totals = [
                (MA.customer_day_totals(cdet).withColumn("sales_month", month), "customer_day_totals"),
                (MA.sales_person_month_totals(sdet), "seller_month_totals"),
            ]
            writes = []
            if "customer_data_mart" in want:
                writes.append((cdet.withColumn("sales_month", month), "customer_data_mart", PB.UNIT[1:]))
            if {"sales_team_data_mart", "sales_partitioned_data_mart", "snapshots"} & want:
                # the staged rows lie by month already
                writes.append((sdet, "sales_partitioned_data_mart", PQ.SALES_TEAM_PARTITIONS))
            # Sums lie by their keys; brought together by month, a month is a file or few, not one of every task.
            jobs = [lambda d=d, n=n: PQ.write_partitioned(d, part(n), PB.UNIT[1:]) for d, n in totals]
            jobs += [lambda d=d, n=n, by=by: d.write.mode("overwrite").partitionBy(*by).parquet(part(n)) for d, n, by in writes]
            PQ.side_by_side(spark, jobs)
        with step("aggregate_marts"):
            touched = sorted({m for _, m, _ in ops}, key=lambda m: (m is not None, m))
            own = spark.createDataFrame([(run_id,)], "run_id long")
            live = PB.live_units(PB.read_log(spark, paths["units"]), finished.union(own))
            _aggregate_marts(spark, paths, want, live, touched, scope, ties, table_options is not None)
        if table_options is not None:
            with step("tables"):
                TB.write_table(spark.read.parquet(paths["customers_data_mart"]), "customers_data_mart", **table_options)
                TB.write_table(spark.read.parquet(paths["sales_team_month_mart"]), "sales_team_data_mart", **table_options)

        # 8. finish events in one append: from here on the run counts
        with step("ledger_finish"):
            ended = clock()
            events = LG.ledger_finish(accepted, ended).unionByName(refused)
            gone = old.withColumnRenamed("file_location", "path")
            events = events.unionByName(LG.ledger_finish(gone, ended, STATUS_RETRACTED))
            LG.append_ledger(events, ledger_path, run_id)
        version = 0
        with step("publish"):
            if "snapshots" in want:
                version = _name_version(spark, paths["snapshots"], run_id)
            _retire(spark, paths, replaced)
    return PipelineResult(
        out, ledger_path, pending, n_accepted, rejected, version, paths, timings, run_id,
        n_lines, n_lines - n_rejected, n_rejected, n_old,
    )


def _read_part(spark: SparkSession, path: str, like: DataFrame) -> DataFrame:
    """A run's part of a dataset with the columns of ``like``; empty where the run wrote none."""
    if not storage.exists(spark, path):
        return spark.createDataFrame([], like.schema)
    return spark.read.schema(like.schema).parquet(path)


def _partitioned_lines(checked: DataFrame) -> DataFrame:
    rejected = F.col("reason").isNotNull()
    month = F.when(~rejected, month_key("sales_date"))
    return checked.withColumn("rejected", rejected).withColumn("sales_month", month)


def _numbered_files(audit: DataFrame, n_accepted: int) -> DataFrame | None:
    """``_key``, ``_path``, ``_ms`` of the accepted files; None where they are many, or where two have one number."""
    files = audit.where("accepted").select(
        F.xxhash64("path", "file_modified_ms").alias("_key"), F.col("path").alias("_path"), F.col("file_modified_ms").alias("_ms")
    )
    if n_accepted > BROADCAST_FILES or files.select("_key").distinct().count() < n_accepted:
        return None
    return F.broadcast(files)


def _without_files(lines: DataFrame, files: DataFrame | None) -> DataFrame:
    """Lines with a number of their file, ``_file``, in place of its path and version."""
    if files is None:
        return lines.withColumn("_file", F.lit(0).cast("bigint"))
    kind = lines.schema["path"].dataType
    return lines.withColumn("_file", F.xxhash64("path", "file_modified_ms")).withColumns(
        {"path": F.lit(None).cast(kind), "file_modified_ms": F.lit(None).cast("bigint")}
    )


def _with_files(lines: DataFrame, files: DataFrame | None) -> DataFrame:
    """``_without_files`` undone; lines without a number keep what they have."""
    if files is None:
        return lines.drop("_file")
    own = {"path": F.coalesce("path", "_path"), "file_modified_ms": F.coalesce("file_modified_ms", "_ms")}
    joined = lines.join(files, F.col("_file") == F.col("_key"), "left").withColumns(own)
    return joined.select(*[c for c in lines.columns if c != "_file"])


def _replaced_units(
    spark: SparkSession, unit_files: str, live: DataFrame, old: DataFrame, fold_after: int
) -> list[tuple[int, str | None]]:
    """Units that hold rows of superseded versions, and units of months in more than ``fold_after`` parts.

    From one row per unit and file; as many units come back as the corrected files have months.
    """
    files = _read_or_none(spark, unit_files)
    if files is None:
        return []
    current = PB.in_units(files, live)
    same = (F.col("path") == F.col("file_location")) & F.col("file_modified_ms").eqNullSafe(F.col("_old_ms"))
    corrected = current.join(old.select("file_location", F.col("file_modified_ms").alias("_old_ms")), same, "left_semi")
    many = live.groupBy("sales_month").agg(F.count("*").alias("n")).where(F.col("n") > fold_after).select(
        F.col("sales_month").alias("_m")
    )
    folded = live.join(many, F.col("sales_month").eqNullSafe(F.col("_m")), "left_semi")
    units = corrected.select(*PB.UNIT).union(folded.select(*PB.UNIT)).distinct()
    return [(r.run_id, r.sales_month) for r in units.collect()]


def _carried_rows(
    spark: SparkSession, enriched: str, replaced: list[tuple[int, str | None]], old: DataFrame
) -> DataFrame:
    """Accepted rows of the replaced units that do not come from a superseded version."""
    folders = [f"{enriched}/run_id={run}/{PB.month_folder(month)}" for run, month in replaced]
    rows = spark.read.option("basePath", enriched).parquet(*folders)
    gone = old.select(F.col("file_location").alias("_old_path"), F.col("file_modified_ms").alias("_old_ms"))
    same = (F.col("path") == F.col("_old_path")) & F.col("file_modified_ms").eqNullSafe(F.col("_old_ms"))
    return rows.join(gone, same, "left_anti").drop("run_id").withColumn("rejected", F.lit(False))


def _aggregate_marts(
    spark: SparkSession, paths: dict[str, str], want: frozenset[str], live: DataFrame, touched: list[str | None],
    scope: str, ties: str, for_tables: bool,
) -> None:
    """A1–A4, W1, K5 for the touched months, from all live units' pre-aggregates of those months.

    Other months' folders are neither read nor written.  A touched month without live
    sales loses its folder.
    """
    some = F.col("sales_month").isin([m for m in touched if m is not None])
    if None in touched:
        some = some | F.col("sales_month").isNull()
    units = F.broadcast(live)

    def totals(name: str) -> DataFrame:
        return PB.in_units(spark.read.parquet(paths[name]).where(some), units).drop("run_id")

    if _read_or_none(spark, paths["seller_month_totals"]) is None:
        return  # no run has had an accepted line

    def write(df: DataFrame, name: str, by: str) -> None:
        PQ.write_partitioned(df, paths[name], (by,), overwrite="dynamic")

    kept = {r.sales_month for r in live.where(some).select("sales_month").distinct().collect()}
    emptied = [m for m in touched if m not in kept]

    def clear(name: str) -> None:
        for m in emptied:
            storage.delete(spark, f"{paths[name]}/{PB.month_folder(m)}")

    def customer_months() -> None:
        write(MA.customer_month_from_days(totals("customer_day_totals")), "customers_data_mart", "sales_date_month")
        for m in emptied:
            folder = PB.month_folder(None).split("=")[1] if m is None else f"{m}-01"
            storage.delete(spark, f"{paths['customers_data_mart']}/sales_date_month={folder}")

    def customer_days() -> None:
        days = MA.customer_day_from_days(totals("customer_day_totals"))
        write(days.withColumn("sales_month", month_key("sales_date")), "customer_day_mart", "sales_month")
        clear("customer_day_mart")

    def sales_team() -> None:
        merged = MA.merged_seller_totals(totals("seller_month_totals")).checkpoint(eager=True)
        mart = MA.sales_team_month_from_totals(merged, scope=scope, ties=ties)
        write(mart, "sales_team_month_mart", "sales_month")
        clear("sales_team_month_mart")
        if "monthly_report" in want:
            RP.write_monthly_report(MA.monthly_billing_report(mart), paths["monthly_report"], overwrite="dynamic")
            clear("monthly_report")

    ensure_checkpoint_dir(spark)
    wanted = [
        (customer_months, "customers_data_mart" in want or for_tables),
        (customer_days, "customer_day_mart" in want),
        (sales_team, bool({"sales_team_month_mart", "monthly_report"} & want) or for_tables),
    ]
    PQ.side_by_side(spark, [f for f, asked in wanted if asked])
