"""Adapters from the driver's TPC-H-style tables onto the sales-mart model.

| model       | table(s)                                  |
|-------------|-------------------------------------------|
| sales fact  | lineitem ⋈ orders ⋈ part ⋈ supplier       |
| customer    | customer                                  |
| store       | nation                                    |
| sales_team  | supplier                                  |
| product     | part, one row per distinct ``p_name``      |

Keys keep the source widths (``BIGINT`` customer / seller ids, ``INT`` store
ids).  The fact joins ``supplier`` last, on ``l_suppkey``; ``enrich`` joins the
sales team first on the same key, so at scale the second join reuses the
first join's hash partitioning instead of shuffling the fact again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salesmart.functions.columns import money
from salesmart.schema import FACT_SCHEMA
from salesmart.session import freed_shuffles

FACT_COLUMNS = FACT_SCHEMA.fieldNames()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def sales_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The sales fact in the fixed fact layout (§1.2), one row per line item."""
    return sales_fact_with_line(spark, sf_dir).select(
        *[c for c in FACT_COLUMNS if c != "additional_column"],
        F.lit(None).cast("string").alias("additional_column"),
    )


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customer dimension (``customer`` table)."""
    c = table(spark, sf_dir, "customer")
    return c.select(
        F.col("c_custkey").alias("customer_id"),
        F.split_part("c_name", F.lit("#"), F.lit(1)).alias("first_name"),
        F.split_part("c_name", F.lit("#"), F.lit(2)).alias("last_name"),
        F.col("c_mktsegment").alias("address"),
        F.lpad(F.col("c_nationkey").cast("string"), 6, "0").alias("pincode"),
        F.concat(F.lit("91"), F.lpad(F.col("c_custkey").cast("string"), 8, "0")).alias("phone_number"),
        F.date_add(F.lit("2020-01-01").cast("date"), F.pmod("c_custkey", F.lit(1328)).cast("int")).alias(
            "customer_joining_date"
        ),
    )


def stores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Store dimension (``nation`` table; 25 rows by construction)."""
    n = table(spark, sf_dir, "nation")
    return n.select(
        F.col("n_nationkey").alias("id"),
        F.concat(F.lit("region "), F.col("n_regionkey").cast("string")).alias("address"),
        F.lpad(F.col("n_regionkey").cast("string"), 6, "0").alias("store_pincode"),
        F.col("n_name").alias("store_manager_name"),
        F.lit(None).cast("date").alias("store_opening_date"),
        F.lit(None).cast("string").alias("reviews"),
    )


def sales_team(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sales-team dimension (``supplier`` table); each seller works in one store."""
    s = table(spark, sf_dir, "supplier")
    return s.select(
        F.col("s_suppkey").alias("id"),
        F.split_part("s_name", F.lit("#"), F.lit(1)).alias("first_name"),
        F.split_part("s_name", F.lit("#"), F.lit(2)).alias("last_name"),
        F.lit(None).cast("bigint").alias("manager_id"),
        F.lit("N").alias("is_manager"),
        F.concat(F.lit("nation "), F.col("s_nationkey").cast("string")).alias("address"),
        F.lpad(F.col("s_nationkey").cast("string"), 6, "0").alias("pincode"),
        F.lit(None).cast("date").alias("joining_date"),
    )


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Product dimension: ``p_name`` is not unique in ``part``, so one row per name."""
    p = table(spark, sf_dir, "part")
    return p.groupBy("p_name").agg(
        F.min("p_partkey").alias("id"),
        money(F.min("p_retailprice")).alias("current_price"),
        money(F.max("p_retailprice")).alias("old_price"),
    ).select(
        "id",
        F.col("p_name").alias("name"),
        "current_price",
        "old_price",
        F.lit(None).cast("timestamp_ntz").alias("created_date"),
        F.lit(None).cast("timestamp_ntz").alias("updated_date"),
        F.lit(None).cast("date").alias("expiry_date"),
    )


# Landing layouts assigned from the line number (1–7) of each line item.
LANDING_LAYOUTS = {"base": (1, 3), "extra": (4, 5), "missing": (6, 6), "json": (7, 7)}


def landing_layout(line: F.Column) -> F.Column:
    expr = None
    for name, (lo, hi) in LANDING_LAYOUTS.items():
        cond = line.between(lo, hi)
        expr = F.when(cond, F.lit(name)) if expr is None else expr.when(cond, F.lit(name))
    return expr.otherwise(F.lit("json"))


def payment_mode(quantity: F.Column) -> F.Column:
    return F.when(F.pmod(quantity, F.lit(2)) == 0, F.lit("cash")).otherwise(F.lit("UPI"))


def sales_fact_with_line(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``sales_fact`` plus ``_line`` (``l_linenumber``), used to assign landing layouts."""
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice"
    )
    od = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    pt = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_retailprice")
    sp = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    return (
        li.join(od, li.l_orderkey == od.o_orderkey)
        .join(pt, li.l_partkey == pt.p_partkey)
        .join(sp, li.l_suppkey == sp.s_suppkey)
        .select(
            F.col("o_custkey").alias("customer_id"),
            F.col("s_nationkey").alias("store_id"),
            F.col("p_name").alias("product_name"),
            F.col("o_orderdate").cast("date").alias("sales_date"),
            F.col("l_suppkey").alias("sales_person_id"),
            money("p_retailprice").alias("price"),
            F.col("l_quantity").cast("int").alias("quantity"),
            money("l_extendedprice").alias("total_cost"),
            F.col("l_linenumber").alias("_line"),
        )
    )


def land_sales(spark: SparkSession, sf_dir: str, root: str) -> str:
    """Write the fact as landed files under ``root``: every line item lands exactly once.

    ``base/``    header = the 8 mandatory columns (accepted)
    ``extra/``   + ``payment_mode`` (accepted, folded into ``additional_column``)
    ``missing/`` no ``store_id``, seller id as a list literal (rejected)
    ``json/``    JSON lines (not CSV: quarantined)
    """
    from salesmart.schema import MANDATORY_COLUMNS
    from salesmart.sinks import storage

    # joined once into a folder of each layout, which goes when the files are written: nothing stays in caches or shuffles
    joined = f"{root}-joined"
    fact = sales_fact_with_line(spark, sf_dir).withColumn("layout", landing_layout(F.col("_line"))).drop("_line")
    with freed_shuffles(spark):
        fact.write.partitionBy("layout").parquet(joined)

    def part(name: str) -> DataFrame:
        there = storage.exists(spark, f"{joined}/layout={name}")
        rows = spark.read.parquet(f"{joined}/layout={name}") if there else spark.createDataFrame([], fact.drop("layout").schema)
        return rows.withColumn("payment_mode", payment_mode(F.col("quantity")))

    part("base").select(*MANDATORY_COLUMNS).write.option("header", True).csv(f"{root}/base")
    part("extra").select(*MANDATORY_COLUMNS, "payment_mode").write.option("header", True).csv(f"{root}/extra")
    part("missing").select(
        "customer_id", "product_name", "sales_date",
        F.concat(F.lit("["), F.col("sales_person_id").cast("string"), F.lit("]")).alias("sales_person_id"),
        "price", "quantity", "total_cost", "payment_mode",
    ).write.option("header", True).csv(f"{root}/missing")
    part("json").select(*MANDATORY_COLUMNS).write.json(f"{root}/json")
    storage.delete(spark, joined)
    return root


def land_by_month(fact: DataFrame, root: str) -> str:
    """Land a fact as one CSV file per month of sale: ``land_month=yyyy-MM/part-….csv``."""
    from salesmart.functions.columns import month_key
    from salesmart.schema import MANDATORY_COLUMNS

    rows = fact.select(*MANDATORY_COLUMNS, month_key("sales_date").alias("land_month"))
    with freed_shuffles(fact.sparkSession):
        rows.repartition("land_month").write.partitionBy("land_month").option("header", True).csv(root)
    return root


def corrected(fact: DataFrame) -> DataFrame:
    """A later edition of some sales: a third of the sellers' are gone, some cost twice as much, some were a month later."""
    moved = F.when(F.col("customer_id") % 7 == 0, F.date_add("sales_date", 31)).otherwise(F.col("sales_date"))
    dearer = F.when(F.col("customer_id") % 2 == 0, money(F.col("total_cost") * 2)).otherwise(F.col("total_cost"))
    return (
        fact.where(F.col("sales_person_id") % 3 != 0)
        .withColumn("total_cost", dearer)
        .withColumn("land_month", F.date_format("sales_date", "yyyy-MM"))
        .withColumn("sales_date", moved)
    )


def reland_months(spark: SparkSession, edition: DataFrame, root: str, scratch: str) -> int:
    """Put another edition's months (``land_month``) in place of the files that hold them under ``root``."""
    from salesmart.schema import MANDATORY_COLUMNS
    from salesmart.sinks import storage
    from salesmart.sources.files import discover_files

    rows = edition.select(*MANDATORY_COLUMNS, "land_month")
    with freed_shuffles(spark):
        rows.repartition("land_month").write.partitionBy("land_month").option("header", True).csv(scratch)
    month = F.regexp_extract("path", "/land_month=([^/]+)/", 1).alias("m")
    names = lambda at: discover_files(spark, at, stats=False).select("path", month).where("m <> ''")
    new, old = names(scratch), names(root).withColumnRenamed("path", "old")
    pairs = new.join(old, "m").collect()  # one file for each month
    for r in pairs:
        storage.move(spark, r.path, r.old, replace=True)
    return len(pairs)


def _under_header(header: str):
    """``mapInArrow`` body: every file of a text write begins with ``header``."""

    def lines(batches):
        import pyarrow as pa

        first = True
        for batch in batches:
            if first:
                yield pa.RecordBatch.from_arrays([pa.array([header], batch.schema.field(0).type)], schema=batch.schema)
                first = False
            yield batch

    return lines


def land_faulty(fact: DataFrame, root: str) -> str:
    """Land a fact as CSV with faults: lines without their last cell, quantities in words."""
    from salesmart.schema import MANDATORY_COLUMNS

    cell = {c: F.col(c).cast("string") for c in MANDATORY_COLUMNS}
    cell["quantity"] = F.when(F.col("customer_id") % 11 == 0, F.lit("two")).otherwise(cell["quantity"])
    cell["total_cost"] = F.when(F.col("customer_id") % 13 != 0, cell["total_cost"])
    lines = fact.select(F.concat_ws(",", *cell.values()).alias("value"))
    headed = lines.mapInArrow(_under_header(",".join(MANDATORY_COLUMNS)), "value string")
    with freed_shuffles(fact.sparkSession):
        headed.write.option("lineSep", "\n").text(f"{root}/_parts")
    from salesmart.sinks import storage
    from salesmart.sources.files import discover_files

    for i, r in enumerate(discover_files(fact.sparkSession, f"{root}/_parts", stats=False).collect()):
        storage.move(fact.sparkSession, r.path, f"{root}/sales/part-{i:05d}.csv")
    return f"{root}/sales"


def ledger_files(spark: SparkSession, sf_dir: str, prefix: str = "sales_data") -> DataFrame:
    """One logical landed file per order month: ``sales_data_yyyy-MM.csv``."""
    od = table(spark, sf_dir, "orders")
    m = od.select(F.date_format("o_orderdate", "yyyy-MM").alias("m")).distinct()
    name = F.concat(F.lit("sales_data_"), F.col("m"), F.lit(".csv"))
    return m.select(name.alias("file_name"), F.concat(F.lit(prefix + "/"), name).alias("path"), "m")
