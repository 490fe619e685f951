"""A hot key holding a third of all rows: joins split it, writes split it, results stay whole."""

import os
import tempfile
from contextlib import contextmanager
from decimal import Decimal

from pyspark.sql import functions as F

from salesmart.operators import enrich as E
from salesmart.operators import marts as M
from salesmart.sinks import parquet as PQ


@contextmanager
def conf(spark, **kv):
    old = {k: spark.conf.get(k, None) for k in kv}
    for k, v in kv.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def _skewed_fact(spark, n=300_000):
    hot = (F.col("id") % 3) == 0  # a third of all sales belong to customer 1, store 121, seller 1
    return spark.range(n).select(
        F.when(hot, F.lit(1)).otherwise(F.col("id") % 20000 + 2).cast("int").alias("customer_id"),
        F.when(hot, F.lit(121)).otherwise(F.col("id") % 50 + 122).cast("int").alias("store_id"),
        F.md5(F.col("id").cast("string")).alias("product_name"),  # incompressible: bytes follow rows
        F.when(hot, F.lit("2023-03-03")).otherwise(F.lit("2023-04-04")).cast("date").alias("sales_date"),
        F.when(hot, F.lit(1)).otherwise(F.col("id") % 500 + 2).cast("int").alias("sales_person_id"),
        F.lit(Decimal("50.00")).cast("decimal(10,2)").alias("price"),
        F.lit(1).alias("quantity"),
        F.lit(Decimal("50.00")).cast("decimal(10,2)").alias("total_cost"),
        F.lit(None).cast("string").alias("additional_column"),
    )


def _dims(spark):
    customer = spark.range(1, 20002).select(
        F.col("id").cast("int").alias("customer_id"), F.lit("F").alias("first_name"), F.lit("L").alias("last_name"),
        F.lit("addr").alias("address"), F.lit("1").alias("pincode"), F.lit("91").alias("phone_number"),
        F.lit(None).cast("date").alias("customer_joining_date"),
    )
    store = spark.range(121, 172).select(
        F.col("id").cast("int").alias("id"), F.lit("a").alias("address"), F.lit("p").alias("store_pincode"),
        F.lit("m").alias("store_manager_name"), F.lit(None).cast("date").alias("store_opening_date"),
        F.lit(None).cast("string").alias("reviews"),
    )
    team = spark.range(1, 502).select(
        F.col("id").cast("int").alias("id"), F.lit("S").alias("first_name"), F.col("id").cast("string").alias("last_name"),
        F.lit(None).cast("int").alias("manager_id"), F.lit("N").alias("is_manager"), F.lit("a").alias("address"),
        F.lit("p").alias("pincode"), F.lit(None).cast("date").alias("joining_date"),
    )
    return customer, store, team


def test_hot_customer_join_is_split_and_whole(spark):
    customer, store, team = _dims(spark)
    fact = _skewed_fact(spark)
    with conf(
        spark,
        **{
            "spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64KB",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64KB",
            "spark.sql.adaptive.coalescePartitions.enabled": "false",
            "spark.sql.shuffle.partitions": "16",
        },
    ):
        enriched = E.enrich(fact, customer, store, team, broadcast_max_rows=None).select(
            "customer_id", "first_name", "product_name"
        )
        rows = enriched.collect()
        plan = enriched._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert len(rows) == 300_000
    assert sum(1 for r in rows if r.customer_id == 1) == 100_000
    assert "SortMergeJoin(skew=true)" in plan and "AQEShuffleRead skewed" in plan


def test_hot_group_incentive_whole(spark):
    customer, store, team = _dims(spark)
    det = M.sales_team_mart_detail(E.enrich(_skewed_fact(spark), customer, store, team))
    mart = M.sales_team_month_mart(det, materialize=True)
    hot = mart.where("store_id = 121 and sales_person_id = 1").first()
    assert hot.total_sales == Decimal("5000000.00") and hot.incentive == Decimal("50000.00")
    assert mart.agg(F.sum("total_sales")).first()[0] == Decimal("15000000.00")


def test_hot_partition_write_is_split(spark):
    out = tempfile.mkdtemp(prefix="salesmart-skew-") + "/p"
    det = _skewed_fact(spark).withColumn("sales_month", F.substring(F.col("sales_date").cast("string"), 1, 7))
    with conf(
        spark,
        **{
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256KB",
            "spark.sql.adaptive.coalescePartitions.minPartitionSize": "64KB",
            "spark.sql.shuffle.partitions": "16",
        },
    ):
        PQ.write_partitioned(det, out)
    hot_dir = os.path.join(out, "sales_month=2023-03", "store_id=121")
    files = [f for f in os.listdir(hot_dir) if f.endswith(".parquet")]
    assert len(files) > 1  # the hot partition was written by several tasks
    assert PQ.read_mart(spark, out).count() == 300_000
