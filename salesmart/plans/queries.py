"""Registered queries: each takes ``(spark, sf_dir)`` and returns a DataFrame.

They run the library's operators over the driver's tables (mapped onto the
sales model by ``sources.testdata``); ``plans.oracle`` holds the matching SQL.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from salesmart.functions.columns import line_total
from salesmart.operators import enrich as E
from salesmart.operators import marts as M
from salesmart.sources import testdata as TD

Query = Callable[[SparkSession, str], DataFrame]


def sales_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return TD.sales_fact(spark, sf_dir)


def enriched_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    return E.enrich(
        TD.sales_fact(spark, sf_dir),
        TD.customers(spark, sf_dir),
        TD.stores(spark, sf_dir),
        TD.sales_team(spark, sf_dir),
    )


def customer_mart_detail(spark: SparkSession, sf_dir: str) -> DataFrame:
    return M.customer_mart_detail(enriched_sales(spark, sf_dir))


def sales_team_mart_detail(spark: SparkSession, sf_dir: str) -> DataFrame:
    return M.sales_team_mart_detail(enriched_sales(spark, sf_dir))


def customer_month_mart(spark: SparkSession, sf_dir: str) -> DataFrame:
    return M.customer_month_mart(customer_mart_detail(spark, sf_dir))


def customer_day_mart(spark: SparkSession, sf_dir: str) -> DataFrame:
    return M.customer_day_mart(customer_mart_detail(spark, sf_dir))


def sales_team_month_mart(spark: SparkSession, sf_dir: str) -> DataFrame:
    return M.sales_team_month_mart(sales_team_mart_detail(spark, sf_dir), scope="store_month", materialize=True)


def sales_team_month_mart_by_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    return M.sales_team_month_mart(sales_team_mart_detail(spark, sf_dir), scope="month", materialize=True)


def sales_team_month_mart_one_winner(spark: SparkSession, sf_dir: str) -> DataFrame:
    return M.sales_team_month_mart(
        sales_team_mart_detail(spark, sf_dir), scope="store_month", ties="one", materialize=True
    )


def product_enriched_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    return E.enrich_product(TD.sales_fact(spark, sf_dir), TD.products(spark, sf_dir))


def line_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P12 over the whole fact."""
    total = line_total("price", "quantity").alias("line_total")
    return TD.sales_fact(spark, sf_dir).select(
        "customer_id", "store_id", "product_name", "sales_date", "price", "quantity", total
    )


QUERIES: dict[str, Query] = {
    "sales_fact": sales_fact,
    "line_totals": line_totals,
    "enriched_sales": enriched_sales,
    "customer_mart_detail": customer_mart_detail,
    "sales_team_mart_detail": sales_team_mart_detail,
    "customer_month_mart": customer_month_mart,
    "customer_day_mart": customer_day_mart,
    "sales_team_month_mart": sales_team_month_mart,
    "sales_team_month_mart_by_month": sales_team_month_mart_by_month,
    "sales_team_month_mart_one_winner": sales_team_month_mart_one_winner,
    "product_enriched_sales": product_enriched_sales,
}


# ---------------------------------------------------------------- CSV ingest
from salesmart.operators import audit as AU  # noqa: E402
from salesmart.operators import ingest as IN  # noqa: E402
from salesmart.sinks import quarantine as QU  # noqa: E402
from salesmart.session import work_dir  # noqa: E402
from salesmart.sources import files as FS  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402


def _landing(spark: SparkSession, sf_dir: str) -> str:
    return TD.land_sales(spark, sf_dir, work_dir(spark, "landing"))


def _landing_dir(path_col: str = "path") -> F.Column:
    return F.element_at(F.split(F.col(path_col), "/"), -2)


def _audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = _landing(spark, sf_dir)
    return AU.audit_landing(spark, FS.discover_files(spark, root))


def discovered_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = FS.discover_files(spark, _landing(spark, sf_dir))
    return files.select(
        _landing_dir().alias("landing_dir"),
        F.regexp_extract("file_name", r"\.([^.]+)$", 1).alias("file_ext"),
    ).distinct()


def header_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _audit(spark, sf_dir).select(
        _landing_dir().alias("landing_dir"),
        F.array_join("columns", ",").alias("header_columns"),
        F.array_join("missing", ",").alias("missing"),
        F.array_join("extra", ",").alias("extra"),
        "accepted",
        "reason",
    ).distinct()


def ingested_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    return IN.ingest_sales(spark, _audit(spark, sf_dir))


def quarantined_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    q = QU.quarantined_lines(spark, _audit(spark, sf_dir)).where(~F.col("is_header"))
    return q.groupBy(_landing_dir().alias("landing_dir"), "reason", "missing").agg(F.count("*").alias("n_lines"))


QUERIES.update(
    {
        "discovered_files": discovered_files,
        "header_audit": header_audit,
        "ingested_sales": ingested_sales,
        "quarantined_lines": quarantined_lines,
    }
)

# ---------------------------------------------------------------- sinks
from salesmart.sinks import parquet as PQ  # noqa: E402
from salesmart.sinks import reports as RP  # noqa: E402
from salesmart.sinks import tables as TB  # noqa: E402
from salesmart.sources import tables as ST  # noqa: E402


def flat_mart_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = PQ.write_mart(customer_mart_detail(spark, sf_dir), work_dir(spark, "customer_data_mart"))
    return PQ.read_mart(spark, path)


def partitioned_mart_pruned(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = PQ.write_partitioned(sales_team_mart_detail(spark, sf_dir), work_dir(spark, "sales_partitioned"))
    return PQ.read_mart(spark, path).where(F.col("sales_month").between("1996-01", "1996-12"))


def latest_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    detail = sales_team_mart_detail(spark, sf_dir)
    prefix = work_dir(spark, "sales_snapshots")
    # An older publication (sales before 1997) and the current one.
    PQ.publish_snapshot(detail.where(F.col("sales_date") < F.lit("1997-01-01").cast("date")), prefix, 1_000)
    PQ.publish_snapshot(detail, prefix, 2_000)
    return PQ.latest_snapshot(spark, prefix)


def seeded_sales_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S6 + U1 — the fact on the typed empty seed."""
    return ST.empty_sales(spark).unionByName(TD.sales_fact(spark, sf_dir))


def sales_preview(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K6/T2 — the 20 largest sales (the limit is the feature)."""
    fact = TD.sales_fact(spark, sf_dir)
    order = ["customer_id", "store_id", "product_name", "sales_date", "sales_person_id", "price", "quantity"]
    return PQ.preview(fact.orderBy(F.desc("total_cost"), *order))


def monthly_billing_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    report = M.monthly_billing_report(sales_team_month_mart(spark, sf_dir))
    path = RP.write_monthly_report(report, work_dir(spark, "monthly_report"))
    return RP.read_monthly_report(spark, path)


def sales_team_mart_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    wd = work_dir(spark, "sales_team_data_mart")
    table_name = "sales_team_data_mart_" + wd.rsplit("-", 1)[-1]
    if spark.conf.get("spark.sql.catalogImplementation", "in-memory") != "in-memory":
        # A Hive catalog would bring up its metastore database; use the path table instead.
        PQ.write_mart(sales_team_month_mart(spark, sf_dir), wd)
        return PQ.read_mart(spark, wd)
    TB.write_table(sales_team_month_mart(spark, sf_dir), table_name, path=wd)
    return ST.read_table(spark, table_name)


QUERIES.update(
    {
        "flat_mart_roundtrip": flat_mart_roundtrip,
        "partitioned_mart_pruned": partitioned_mart_pruned,
        "latest_snapshot": latest_snapshot,
        "seeded_sales_fact": seeded_sales_fact,
        "sales_preview": sales_preview,
        "monthly_billing_report": monthly_billing_report,
        "sales_team_mart_table": sales_team_mart_table,
    }
)

# ---------------------------------------------------------------- ledger
from salesmart.operators import ledger as LG  # noqa: E402

# A run history over the landed files (one per order month):
#   run 1 started and finished every month up to 1996-12;
#   run 2 re-started 1996-07 .. 1998-12 and died before finishing;
#   later months were never started.
RUN1_START, RUN1_END = "2024-01-01 00:00:00", "2024-01-01 01:30:00"
RUN2_START = "2024-02-01 00:00:00"


def _ledger_history(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    files = TD.ledger_files(spark, sf_dir)
    run1 = files.where(F.col("m") <= "1996-12")
    run2 = files.where(F.col("m").between("1996-07", "1998-12"))
    events = (
        LG.ledger_start(run1, RUN1_START)
        .unionByName(LG.ledger_finish(run1, RUN1_END))
        .unionByName(LG.ledger_start(run2, RUN2_START))
    )
    return files.drop("m"), events


def ledger_started(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = TD.ledger_files(spark, sf_dir)
    return LG.ledger_start(files, RUN2_START)


def ledger_current(spark: SparkSession, sf_dir: str) -> DataFrame:
    return LG.ledger_current(_ledger_history(spark, sf_dir)[1])


def ledger_pending(spark: SparkSession, sf_dir: str) -> DataFrame:
    files, events = _ledger_history(spark, sf_dir)
    return LG.ledger_pending(files, events)


def unprocessed_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    files, events = _ledger_history(spark, sf_dir)
    return LG.unprocessed(files, events).select("file_name", "path")


QUERIES.update(
    {
        "ledger_started": ledger_started,
        "ledger_current": ledger_current,
        "ledger_pending": ledger_pending,
        "unprocessed_files": unprocessed_files,
    }
)

# ---------------------------------------------------------------- whole job
from salesmart.plans.pipeline import read_snapshot, run_pipeline  # noqa: E402
from salesmart.schema import MANDATORY_COLUMNS  # noqa: E402


def _pipeline(spark: SparkSession, sf_dir: str):
    root = _landing(spark, sf_dir)
    return run_pipeline(
        spark,
        root,
        work_dir(spark, "pipeline"),
        TD.customers(spark, sf_dir),
        TD.stores(spark, sf_dir),
        TD.sales_team(spark, sf_dir),
    )


def pipeline_sales_team_mart(spark: SparkSession, sf_dir: str) -> DataFrame:
    res = _pipeline(spark, sf_dir)
    return spark.read.parquet(res.paths["sales_team_month_mart"])


def pipeline_customer_month_mart(spark: SparkSession, sf_dir: str) -> DataFrame:
    res = _pipeline(spark, sf_dir)
    return spark.read.parquet(res.paths["customers_data_mart"])


def _corrected_job(spark: SparkSession, sf_dir: str, outputs: set[str]):
    """All sales land by month and run; the files of 1996 land again, corrected; a second run."""
    wd = work_dir(spark, "corrected")
    fact = TD.sales_fact(spark, sf_dir)
    dims = TD.customers(spark, sf_dir), TD.stores(spark, sf_dir), TD.sales_team(spark, sf_dir)
    root = TD.land_by_month(fact, f"{wd}/landing")
    first = run_pipeline(spark, root, f"{wd}/out", *dims, outputs=outputs)
    edition = TD.corrected(fact.where(F.year("sales_date") == 1996))
    TD.reland_months(spark, edition, root, f"{wd}/edition")
    return first, run_pipeline(spark, root, f"{wd}/out", *dims, outputs=outputs)


def pipeline_corrected_file_sales_team_mart(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, second = _corrected_job(spark, sf_dir, {"sales_team_month_mart"})
    return spark.read.parquet(second.paths["sales_team_month_mart"])


def corrected_file_snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both publications of a corrected landing: the first as it was, the newest with the new editions."""
    first, second = _corrected_job(spark, sf_dir, {"snapshots"})

    def months(label: str, version: int) -> DataFrame:
        rows = read_snapshot(spark, second.out, version).groupBy("sales_month")
        summed = rows.agg(F.count("*").alias("n_sales"), F.sum("total_cost").cast("decimal(20,2)").alias("total_cost"))
        return summed.select(F.lit(label).alias("publication"), "*")

    return months("first", first.snapshot_version).unionByName(months("newest", second.snapshot_version))


def rejected_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What became of every landed line: accepted, or rejected with a reason."""
    wd = work_dir(spark, "faulty")
    fact = TD.sales_fact(spark, sf_dir)
    customers = TD.customers(spark, sf_dir).where(F.col("customer_id") % 7 != 0)
    stores = TD.stores(spark, sf_dir).where(F.col("id") % 19 != 0)
    team = TD.sales_team(spark, sf_dir).where(F.col("id") % 17 != 0)
    res = run_pipeline(
        spark, TD.land_faulty(fact, f"{wd}/landing"), f"{wd}/out", customers, stores, team, outputs={"sales_team_month_mart"}
    )
    kept = spark.read.parquet(res.paths["enriched"]).select(F.lit("accepted").alias("reason"), "sales_person_id")
    seller = F.split("line", ",")[MANDATORY_COLUMNS.index("sales_person_id")].cast("bigint")
    told = spark.read.parquet(res.paths["rejected_rows"]).select("reason", seller.alias("sales_person_id"))
    return kept.unionByName(told).groupBy("reason").agg(
        F.count("*").alias("n_lines"), F.count_distinct("sales_person_id").alias("n_sellers")
    )


QUERIES.update(
    {
        "pipeline_sales_team_mart": pipeline_sales_team_mart,
        "pipeline_customer_month_mart": pipeline_customer_month_mart,
        "pipeline_corrected_file_sales_team_mart": pipeline_corrected_file_sales_team_mart,
        "corrected_file_snapshots": corrected_file_snapshots,
        "rejected_rows": rejected_rows,
    }
)

# ---------------------------------------------------------------- incremental (Structured Streaming)
from salesmart.streaming.landing import process_landing_stream  # noqa: E402


def streaming_sales_team_mart(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Same mart as ``pipeline_sales_team_mart``, built incrementally four files per micro-batch."""
    root = _landing(spark, sf_dir)
    wd = work_dir(spark, "stream")
    paths = process_landing_stream(
        spark,
        root,
        f"{wd}/out",
        f"{wd}/checkpoint",
        TD.customers(spark, sf_dir),
        TD.stores(spark, sf_dir),
        TD.sales_team(spark, sf_dir),
        max_files_per_trigger=4,
    )
    return spark.read.parquet(paths.sales_team_month_mart)


QUERIES["streaming_sales_team_mart"] = streaming_sales_team_mart
