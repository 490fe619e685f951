"""G1–G5, P12 — synthetic sales and customer rows, generated by Spark.

Every pick is a hash of ``(tag, seed, id)``: the first 8 hex digits of an
MD5, modulo the domain size, one tag per column.  Rows are therefore the
same at any partitioning and on any engine that has MD5, and columns are
independent of each other.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from salesmart.schema import (
    MONEY,
    SYNTH_CUSTOMER_ADDRESS,
    SYNTH_CUSTOMER_IDS,
    SYNTH_CUSTOMER_PINCODE,
    SYNTH_DATE_RANGE,
    SYNTH_JOINING_RANGE,
    SYNTH_PAYMENT_MODES,
    SYNTH_PRODUCTS,
    SYNTH_QUANTITY,
    SYNTH_SELLERS_PER_STORE,
    SYNTH_STORE_IDS,
)

LAYOUTS = ("base", "extra", "missing")


def pick(tag: str, seed: int, id_col: Column, k: int) -> Column:
    """Deterministic pseudo-random integer in ``[0, k)`` for each id."""
    h = F.md5(F.concat(F.lit(tag), F.lit(str(seed)), id_col.cast("string")))
    return F.pmod(F.conv(F.substring(h, 1, 8), 16, 10).cast("bigint"), F.lit(k))


def _days_between(a: str, b: str) -> int:
    import datetime as dt

    return (dt.date.fromisoformat(b) - dt.date.fromisoformat(a)).days


def synth_sales(
    ids: DataFrame,
    start: str = SYNTH_DATE_RANGE[0],
    end: str = SYNTH_DATE_RANGE[1],
    layout: str = "base",
    seed: int = 0,
) -> DataFrame:
    """G1–G4 — one sale per row of ``ids`` (column ``id``).

    layout ``base``: the 8 mandatory columns; ``extra``: + ``payment_mode``;
    ``missing``: no ``store_id`` and ``sales_person_id`` holds the store's
    seller list (``"[1, 2, 3]"``) — such a file must be rejected by the audit.
    ``start == end`` gives a single-day file (G2).
    """
    if layout not in LAYOUTS:
        raise ValueError(f"layout must be one of {LAYOUTS}")
    i = F.col("id")
    lo_c, hi_c = SYNTH_CUSTOMER_IDS
    lo_s, hi_s = SYNTH_STORE_IDS
    lo_q, hi_q = SYNTH_QUANTITY
    names = F.array(*[F.lit(n) for n, _ in SYNTH_PRODUCTS])
    prices = F.array(*[F.lit(p).cast(MONEY) for _, p in SYNTH_PRODUCTS])
    prod = pick("product", seed, i, len(SYNTH_PRODUCTS)) + 1
    store = (F.lit(lo_s) + pick("store", seed, i, hi_s - lo_s + 1)).cast("int")
    first_seller = (store - F.lit(lo_s)) * F.lit(SYNTH_SELLERS_PER_STORE) + F.lit(1)
    df = ids.select(
        (F.lit(lo_c) + pick("customer", seed, i, hi_c - lo_c + 1)).cast("int").alias("customer_id"),
        store.alias("store_id"),
        F.element_at(names, prod.cast("int")).alias("product_name"),
        F.date_add(F.lit(start).cast("date"), pick("date", seed, i, _days_between(start, end) + 1).cast("int"))
        .alias("sales_date"),
        (first_seller + pick("seller", seed, i, SYNTH_SELLERS_PER_STORE)).cast("int").alias("sales_person_id"),
        F.element_at(prices, prod.cast("int")).alias("price"),
        (F.lit(lo_q) + pick("quantity", seed, i, hi_q - lo_q + 1)).cast("int").alias("quantity"),
        F.element_at(F.array(*[F.lit(m) for m in SYNTH_PAYMENT_MODES]),
                     (pick("payment", seed, i, len(SYNTH_PAYMENT_MODES)) + 1).cast("int")).alias("payment_mode"),
        F.concat(
            F.lit("["),
            F.array_join(F.sequence(first_seller, first_seller + F.lit(SYNTH_SELLERS_PER_STORE - 1)).cast(
                "array<string>"), ", "),
            F.lit("]"),
        ).alias("seller_list"),
    ).withColumn("total_cost", (F.col("price") * F.col("quantity")).cast(MONEY))
    base = ["customer_id", "store_id", "product_name", "sales_date", "sales_person_id", "price", "quantity",
            "total_cost"]
    if layout == "base":
        return df.select(*base)
    if layout == "extra":
        return df.select(*base, "payment_mode")
    return df.select(
        "customer_id", "product_name", "sales_date", F.col("seller_list").alias("sales_person_id"), "price",
        "quantity", "total_cost", "payment_mode",
    )


# Invented names, made by number.
SEED_FIRST_NAMES = [f"First{i:02d}" for i in range(1, 26)]
SEED_LAST_NAMES = [f"Last{i:02d}" for i in range(1, 26)]


def synth_customers(ids: DataFrame, seed: int = 0) -> DataFrame:
    """G5 — one customer per row of ``ids``: id + 1, name picks, fixed address, ``91`` + 8 digits."""
    i = F.col("id")
    first = F.array(*[F.lit(n) for n in SEED_FIRST_NAMES])
    last = F.array(*[F.lit(n) for n in SEED_LAST_NAMES])
    j0, j1 = SYNTH_JOINING_RANGE
    return ids.select(
        (i + 1).alias("customer_id"),
        F.element_at(first, (pick("first", seed, i, len(SEED_FIRST_NAMES)) + 1).cast("int")).alias("first_name"),
        F.element_at(last, (pick("last", seed, i, len(SEED_LAST_NAMES)) + 1).cast("int")).alias("last_name"),
        F.lit(SYNTH_CUSTOMER_ADDRESS).alias("address"),
        F.lit(SYNTH_CUSTOMER_PINCODE).alias("pincode"),
        F.concat(F.lit("91"), F.lpad(pick("phone", seed, i, 10**8).cast("string"), 8, "0")).alias("phone_number"),
        F.date_add(F.lit(j0).cast("date"), pick("joined", seed, i, _days_between(j0, j1) + 1).cast("int"))
        .alias("customer_joining_date"),
    )


def id_range(spark: SparkSession, n: int) -> DataFrame:
    """``ids`` frame for a fixed row count (``spark.range``)."""
    return spark.range(n)
