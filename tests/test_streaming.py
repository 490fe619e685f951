"""Incremental landing processing: new files only, month totals across batches, archive."""

import os
import tempfile
from decimal import Decimal

from salesmart.streaming.landing import process_landing_stream
from tests.seed import dimensions
from tests.test_ingest import BASE


def _write(root, name, text):
    with open(os.path.join(root, name), "w") as f:
        f.write(text)


def test_incremental_batches(spark):
    customer, store, _, team = dimensions(spark)
    land = tempfile.mkdtemp(prefix="salesmart-sland-")
    work = tempfile.mkdtemp(prefix="salesmart-swork-")
    archive = tempfile.mkdtemp(prefix="salesmart-sarch-")
    _write(land, "d1.csv", f"{BASE}\n1,121,sugar,2023-03-03,1,50,2,100\n")
    _write(land, "d2.csv", f"{BASE}\n2,121,sugar,2023-03-04,2,50,1,50\n")
    _write(land, "bad.csv", "customer_id\n1\n")
    kw = dict(customer=customer, store=store, sales_team=team, max_files_per_trigger=1)
    paths = process_landing_stream(spark, land, work + "/out", work + "/ckpt", **kw)
    mart = {r.sales_person_id: r for r in spark.read.parquet(paths.sales_team_month_mart).collect()}
    assert mart[1].incentive == Decimal("1.00") and mart[2].incentive == Decimal("0.00")

    # A later file in the same month changes the top performer; earlier files are not re-read.
    _write(land, "d3.csv", f"{BASE}\n3,121,besan,2023-03-05,2,52,4,208\n")
    paths = process_landing_stream(spark, land, work + "/out", work + "/ckpt", archive_dir=archive, **kw)
    mart = {r.sales_person_id: r for r in spark.read.parquet(paths.sales_team_month_mart).collect()}
    assert mart[2].total_sales == Decimal("258.00") and mart[2].incentive == Decimal("2.58")
    assert mart[1].incentive == Decimal("0.00")
    assert spark.read.parquet(paths.enriched).count() == 3
    assert spark.read.parquet(paths.quarantine).where("not is_header").count() == 1
    cm = spark.read.parquet(paths.customers_data_mart)
    assert sum(r.total_sales for r in cm.collect()) == Decimal("358.00")
    # archive mode moves completed files (Spark does it at a later batch commit)
    archived = [f for _, _, fs in os.walk(archive) for f in fs]
    assert archived and set(archived) <= {"d1.csv", "d2.csv", "d3.csv", "bad.csv"}


def test_a_drain_reads_each_sale_once(spark):
    """Marts are written when as many batches wait as are published, and at the end; a drain that died is made up for."""
    from salesmart.sinks import storage

    customer, store, _, team = dimensions(spark)
    land = tempfile.mkdtemp(prefix="salesmart-sland-")
    work = tempfile.mkdtemp(prefix="salesmart-swork-")
    for i in range(6):
        _write(land, f"d{i}.csv", f"{BASE}\n1,121,sugar,2023-0{3 + i % 2}-0{i + 1},1,50,{i + 1},{50 * (i + 1)}\n")
        os.utime(f"{land}/d{i}.csv", (1_700_000_000 + i, 1_700_000_000 + i))
    kw = dict(customer=customer, store=store, sales_team=team, max_files_per_trigger=1)
    paths = process_landing_stream(spark, land, work + "/out", work + "/ckpt", **kw)
    published = lambda: sorted(int(n.split("=")[1]) for n in storage.children(spark, paths.published))
    totals = lambda: {r.sales_month: int(r.total_sales) for r in spark.read.parquet(paths.sales_team_month_mart).collect()}
    assert published() == [0, 1, 3, 5] and totals() == {"2023-03": 450, "2023-04": 600}
    assert spark.read.parquet(paths.ledger).groupBy("status").count().collect() in (
        [("A", 6), ("I", 6)], [("I", 6), ("A", 6)],
    )

    # the drain died while it wrote the last publication: its marker is missing, its months half written
    storage.delete(spark, f"{paths.published}/upto=5")
    storage.delete(spark, f"{paths.sales_team_month_mart}/sales_month=2023-04")
    process_landing_stream(spark, land, work + "/out", work + "/ckpt", **kw)
    assert published() == [0, 1, 3, 5] and totals() == {"2023-03": 450, "2023-04": 600}


def test_a_drain_ingests_all_waiting_batches_at_once(spark):
    """Files of noted batches are read by the publication they wait for, and again where that died half-way."""
    from salesmart.sinks import storage

    customer, store, _, team = dimensions(spark)
    land = tempfile.mkdtemp(prefix="salesmart-sland-")
    work = tempfile.mkdtemp(prefix="salesmart-swork-")
    for i in range(6):
        text = f"{BASE}\n1,121,sugar,2023-03-0{i + 1},1,50,{i + 1},{50 * (i + 1)}\n" if i != 2 else "customer_id\n1\n"
        _write(land, f"d {i}.csv", text)
        os.utime(f"{land}/d {i}.csv", (1_700_000_000 + i, 1_700_000_000 + i))
    kw = dict(customer=customer, store=store, sales_team=team, max_files_per_trigger=1)
    paths = process_landing_stream(spark, land, work + "/out", work + "/ckpt", **kw)

    def found():
        ingested = sorted(int(n.split("=")[1]) for n in storage.children(spark, paths.enriched) if "=" in n)
        refused = spark.read.parquet(paths.quarantine).where("not is_header").count()
        sold = [int(r.total_sales) for r in spark.read.parquet(paths.sales_team_month_mart).collect()]
        return ingested, spark.read.parquet(paths.enriched).count(), refused, sold

    assert found() == ([0, 1, 3, 5], 5, 1, [50 + 100 + 200 + 250 + 300])
    # the last publication died, and an earlier try of it had fewer batches
    storage.delete(spark, f"{paths.published}/upto=5")
    spark.read.parquet(f"{paths.enriched}/batch_id=5").write.parquet(f"{paths.enriched}/batch_id=4/sales_month=2023-03")
    process_landing_stream(spark, land, work + "/out", work + "/ckpt", **kw)
    assert found() == ([0, 1, 3, 5], 5, 1, [50 + 100 + 200 + 250 + 300])
