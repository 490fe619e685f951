"""Synthetic generators: domains, determinism, layouts."""

from pyspark.sql import functions as F

from salesmart.operators.synth import synth_customers, synth_sales


def test_base_domains(spark):
    df = synth_sales(spark.range(2000))
    r = df.agg(
        F.min("customer_id"), F.max("customer_id"), F.min("store_id"), F.max("store_id"),
        F.min("quantity"), F.max("quantity"), F.min("sales_date"), F.max("sales_date"),
        F.countDistinct("product_name"),
    ).first()
    assert tuple(r)[:6] == (1, 20, 121, 123, 1, 10)
    assert str(r[6]) >= "2023-03-03" and str(r[7]) <= "2023-08-20" and r[8] == 8
    # each seller belongs to its store
    bad = df.where(((F.col("sales_person_id") - 1) / 3).cast("int") + 121 != F.col("store_id")).count()
    assert bad == 0
    assert df.where(F.col("total_cost") != F.col("price") * F.col("quantity")).count() == 0


def test_deterministic_across_partitioning(spark):
    a = synth_sales(spark.range(0, 500, 1, 1)).collect()
    b = synth_sales(spark.range(0, 500, 1, 7)).collect()
    assert sorted(map(tuple, a)) == sorted(map(tuple, b))


def test_layouts(spark):
    assert "payment_mode" in synth_sales(spark.range(5), layout="extra").columns
    miss = synth_sales(spark.range(50), layout="missing")
    assert "store_id" not in miss.columns
    assert {r.sales_person_id for r in miss.collect()} <= {"[1, 2, 3]", "[4, 5, 6]", "[7, 8, 9]"}
    day = synth_sales(spark.range(50), start="2023-08-20", end="2023-08-20")
    assert {str(r.sales_date) for r in day.collect()} == {"2023-08-20"}


def test_customers(spark):
    c = synth_customers(spark.range(25)).collect()
    assert [r.customer_id for r in c] == list(range(1, 26))
    assert all(len(r.phone_number) == 10 and r.phone_number.startswith("91") for r in c)
    assert all("2020-01-01" <= str(r.customer_joining_date) <= "2023-08-20" for r in c)
