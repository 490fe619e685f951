"""Parquet / CSV / table sinks and their read-back."""

import tempfile

import pytest
from pyspark.sql import functions as F

from salesmart.sinks import parquet as PQ
from salesmart.sinks import reports as RP
from salesmart.sinks import tables as TB
from salesmart.sources import tables as ST


@pytest.fixture()
def out():
    return tempfile.mkdtemp(prefix="salesmart-sink-")


def _mart(spark):
    return spark.createDataFrame(
        [(121, 1, "2023-03", 10), (121, 2, "2023-03", 20), (122, 4, "2023-04", 30)],
        "store_id int, sales_person_id int, sales_month string, v int",
    )


def test_partitioned_roundtrip_and_pruning(spark, out):
    df = _mart(spark)
    PQ.write_partitioned(df, out + "/p")
    back = PQ.read_mart(spark, out + "/p")
    assert sorted(map(tuple, back.select(*df.columns).collect())) == sorted(map(tuple, df.collect()))
    pruned = back.where(F.col("sales_month") == "2023-03")
    plan = pruned._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(sales_month" in plan
    assert pruned.count() == 2


def test_static_vs_dynamic_overwrite(spark, out):
    df = _mart(spark)
    PQ.write_partitioned(df, out + "/s")
    PQ.write_partitioned(df.where("sales_month = '2023-04'"), out + "/s", overwrite="dynamic")
    assert PQ.read_mart(spark, out + "/s").count() == 3  # March kept
    PQ.write_partitioned(df.where("sales_month = '2023-04'"), out + "/s", overwrite="static")
    assert PQ.read_mart(spark, out + "/s").count() == 1  # whole tree replaced


def test_snapshots_latest_wins(spark, out):
    df = _mart(spark)
    PQ.publish_snapshot(df.where("v < 20"), out + "/snap", version=1000)
    PQ.publish_snapshot(df, out + "/snap", version=2000)
    assert PQ.snapshot_versions(spark, out + "/snap") == [1000, 2000]
    assert PQ.latest_snapshot(spark, out + "/snap").count() == 3
    assert PQ.snapshot_version(1700000000.9) == 1700000000000


def test_monthly_report_one_folder_per_month(spark, out):
    from decimal import Decimal

    rep = spark.createDataFrame(
        [("A B", 121, "2023-03", Decimal("10.00"), Decimal("0.10")), ("C D", 122, "2023-04", Decimal("5"), Decimal(0))],
        "sales_person_name string, sales_person_store_id int, sales_month string, "
        "sales_person_total_billing_done_for_each_month decimal(10,2), total_incentive decimal(10,2)",
    )
    RP.write_monthly_report(rep, out + "/r")
    import os

    months = sorted(d for d in os.listdir(out + "/r") if d.startswith("sales_month="))
    assert months == ["sales_month=2023-03", "sales_month=2023-04"]
    for m in months:
        assert len([f for f in os.listdir(f"{out}/r/{m}") if f.endswith(".csv")]) == 1
    assert RP.read_monthly_report(spark, out + "/r").count() == 2


def test_catalog_table_roundtrip(spark, out):
    df = _mart(spark)
    TB.write_table(df, "t_sales_mart_test", path=out + "/t")
    TB.write_table(df, "t_sales_mart_test", path=out + "/t")  # overwrite: no double rows
    assert ST.read_table(spark, "t_sales_mart_test").count() == 3
    TB.write_table(df, "t_sales_mart_test", mode="append", path=out + "/t")
    assert ST.read_table(spark, "t_sales_mart_test").count() == 6


def test_empty_sales_and_preview(spark):
    from salesmart.schema import FACT_SCHEMA

    e = ST.empty_sales(spark)
    assert e.schema == FACT_SCHEMA and e.count() == 0
    assert PQ.preview(spark.range(100), 20).count() == 20


def test_latest_snapshot_without_pointer_lists(spark, out):
    df = _mart(spark)
    PQ.write_partitioned(df.where("v < 20"), out + "/snap2/version=5")
    PQ.write_partitioned(df, out + "/snap2/version=7")
    assert PQ.latest_snapshot(spark, out + "/snap2").count() == 3


def test_pointer_never_moves_back(spark, out):
    df = _mart(spark)
    PQ.publish_snapshot(df, out + "/snap3", version=2000)
    PQ.publish_snapshot(df.where("v < 20"), out + "/snap3", version=1000)  # late, older publication
    assert PQ.latest_snapshot(spark, out + "/snap3").count() == 3


def test_parallel_small_writes_restores_conf(spark):
    key = "spark.sql.adaptive.coalescePartitions.minPartitionSize"
    before = spark.conf.get(key, None)
    spark.conf.set(key, "2MB")
    try:
        with PQ.parallel_small_writes(spark):
            assert spark.conf.get(key) in ("65536", "65536b")
        assert spark.conf.get(key) == "2MB"
        spark.conf.set(key, "16KB")  # already lower: left alone
        with PQ.parallel_small_writes(spark):
            assert spark.conf.get(key) == "16KB"
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def test_failed_publication_leaves_the_old_table(spark, out):
    df = _mart(spark)
    name = "t_sales_mart_two_phases"
    TB.write_table(df, name, path=out + "/t")
    before = spark.sql(f"DESCRIBE EXTENDED {name}").where("col_name = 'Location'").first()[1]

    def failing(n):
        if n == 2:
            raise ValueError("no such row")
        return n

    broken = df.withColumn("v", F.udf(failing, "int")(F.lit(2)))
    with pytest.raises(Exception, match="no such row"):
        TB.write_table(broken, name, path=out + "/t")
    assert spark.table(name).count() == 3
    TB.write_table(df.where("v > 10"), name, path=out + "/t")
    assert spark.table(name).count() == 2
    after = spark.sql(f"DESCRIBE EXTENDED {name}").where("col_name = 'Location'").first()[1]
    assert after != before and spark.read.parquet(before).count() == 3
    TB.write_table(df.withColumn("w", F.lit(1)), name, path=out + "/t")  # other columns
    assert spark.table(name).columns[-1] == "w" and spark.table(name).count() == 3


def test_equal_depth_predicates_cover_every_row_once(spark, out):
    """A key with a third of the rows, nulls, and few different values: each row in one partition, depths even."""
    rows = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, F.lit(7)).when(F.col("id") % 100 == 1, F.lit(None)).otherwise(F.col("id")).alias("k"), "id"
    )
    TB.write_table(rows, "t_equal_depth", path=out + "/e")
    source = spark.table("t_equal_depth")
    predicates = ST.equal_depth_predicates(source, "k", 8)
    assert 4 <= len(predicates) <= 8
    parts = [source.where(p) for p in predicates]
    sizes = [p.count() for p in parts]
    assert sum(sizes) == 3000 and max(sizes) <= 1000 + 2 * 3000 / 8  # the hot key is one value
    ids = parts[0].select("id")
    for p in parts[1:]:
        ids = ids.union(p.select("id"))
    assert ids.distinct().count() == 3000
    read = ST.read_table(spark, "t_equal_depth", partition_column="k", num_partitions=8)
    assert read.count() == 3000 and sorted(read.columns) == ["id", "k"]
    names = spark.createDataFrame([("a'b",), ("c",), (None,), ("z",)] * 5, "k string")
    predicates = ST.equal_depth_predicates(names, "k", 3)
    assert sum(names.where(p).count() for p in predicates) == 20
    assert ST.equal_depth_predicates(names.limit(0), "k", 3) == ["1 = 1"]
    assert ST.equal_depth_predicates(names.where("k is null"), "k", 3) == ["1 = 1"]
