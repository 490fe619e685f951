"""Dimension joins J1–J4 with the column renames of P9.

Join type defaults to ``inner``: the customer mart takes its key from the
customer side in the modelled system, which would be null for an unmatched
sale.  ``how="left"`` keeps unmatched sales (the fact's key is kept).

Join order: sales team first (same key the test-data fact was last joined
on, so no new shuffle), then store, then customer.  Each dimension is
broadcast only behind a proven bound (``operators.joins``); building a plan over
files starts no job.  Dimension keys are unique in the model; the job counts lines
before and after its joins and stops where one is not (``plans.pipeline``).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salesmart.schema import ADDITIONAL_COLUMN, MANDATORY_COLUMNS
from salesmart.operators.joins import DEFAULT_BROADCAST_MAX_ROWS, hint_small

FACT_COLUMNS = (*MANDATORY_COLUMNS, ADDITIONAL_COLUMN)
CUSTOMER_ATTRS = ["first_name", "last_name", "address", "pincode", "phone_number", "customer_joining_date"]
STORE_ATTRS = ["store_address", "store_pincode", "store_manager_name", "store_opening_date", "store_reviews"]
SALES_TEAM_ATTRS = [
    "sales_person_first_name",
    "sales_person_last_name",
    "manager_id",
    "is_manager",
    "sales_person_address",
    "sales_person_pincode",
    "sales_person_joining_date",
]


def customer_dim(customer: DataFrame) -> DataFrame:
    return customer.select("customer_id", *CUSTOMER_ATTRS)


def store_dim(store: DataFrame) -> DataFrame:
    """P9 — store columns renamed so they cannot clash with customer / seller columns."""
    return store.select(
        F.col("id").alias("store_id"),
        F.col("address").alias("store_address"),
        "store_pincode",
        "store_manager_name",
        "store_opening_date",
        F.col("reviews").alias("store_reviews"),
    )


def sales_team_dim(sales_team: DataFrame) -> DataFrame:
    """P9 — seller columns renamed to ``sales_person_*``."""
    return sales_team.select(
        F.col("id").alias("sales_person_id"),
        F.col("first_name").alias("sales_person_first_name"),
        F.col("last_name").alias("sales_person_last_name"),
        "manager_id",
        "is_manager",
        F.col("address").alias("sales_person_address"),
        F.col("pincode").alias("sales_person_pincode"),
        F.col("joining_date").alias("sales_person_joining_date"),
    )


def enrich(
    fact: DataFrame,
    customer: DataFrame,
    store: DataFrame,
    sales_team: DataFrame,
    how: str = "inner",
    broadcast_max_rows: int | None = DEFAULT_BROADCAST_MAX_ROWS,
) -> DataFrame:
    """J1–J3 — fact ⋈ sales_team ⋈ store ⋈ customer (equi-joins on the ids)."""
    if how not in ("inner", "left"):
        raise ValueError("how must be 'inner' or 'left'")
    st, so, cu = hint_small([sales_team_dim(sales_team), store_dim(store), customer_dim(customer)], broadcast_max_rows)
    joined = fact.join(st, "sales_person_id", how).join(so, "store_id", how).join(cu, "customer_id", how)
    return joined.select(*fact.columns, *CUSTOMER_ATTRS, *STORE_ATTRS, *SALES_TEAM_ATTRS)


def enrich_product(
    fact: DataFrame,
    product: DataFrame,
    how: str = "inner",
    broadcast_max_rows: int | None = DEFAULT_BROADCAST_MAX_ROWS,
) -> DataFrame:
    """J4 — fact ⋈ product on ``product_name = name``; adds ``current_price``, ``expiry_date``."""
    named = product.select(F.col("name").alias("product_name"), "current_price", "expiry_date")
    (pr,) = hint_small([named], broadcast_max_rows)
    return fact.join(pr, "product_name", how).select(*fact.columns, "current_price", "expiry_date")


@dataclass
class LineDim:
    """A dimension of ``enrich_lines``: its key, its columns as the lines take them, and whether it is proven small."""

    key: str
    rows: DataFrame
    small: bool


def line_dims(
    customer: DataFrame,
    store: DataFrame,
    sales_team: DataFrame,
    product: DataFrame | None = None,
    broadcast_max_rows: int | None = DEFAULT_BROADCAST_MAX_ROWS,
) -> dict[str, LineDim]:
    """J1–J4's dimensions, hinted where small. Attributes that no mart reads are not carried."""
    dims = {
        "sales_team": ("sales_person_id", sales_team_dim(sales_team).drop("sales_person_joining_date")),
        "store": ("store_id", store_dim(store).select("store_id", "store_manager_name")),
        "customer": ("customer_id", customer_dim(customer).drop("customer_joining_date")),
    }
    if product is not None:
        dims["product"] = (
            "product_name",
            product.select(F.col("name").alias("product_name"), "current_price", "expiry_date"),
        )
    plain = [d for _, d in dims.values()]
    hinted = hint_small(plain, broadcast_max_rows)
    return {n: LineDim(key, h, h is not d) for (n, (key, d)), h in zip(dims.items(), hinted)}


def enrich_lines(lines: DataFrame, dims: dict[str, LineDim], how: str = "inner") -> DataFrame:
    """J1–J4 over ``ingest.checked_lines``: no line is dropped, ``reason`` names the dimension that lacks its row.

    ``how="left"`` keeps such sales as accepted, as ``enrich`` does.
    """
    if how not in ("inner", "left"):
        raise ValueError("how must be 'inner' or 'left'")
    joined, unmatched = lines, []
    for name, dim in dims.items():
        joined = joined.join(dim.rows.withColumn(f"_in_{name}", F.lit(True)), dim.key, "left")
        unmatched.append(F.when(F.col(f"_in_{name}").isNull(), F.lit(f"no_{name}")))
    attrs = [c for d in dims.values() for c in d.rows.columns if c not in lines.columns]
    same = [c for c in lines.columns if c not in ("reason", "line")]
    reason = F.coalesce("reason", *unmatched) if how == "inner" else F.col("reason")
    told = F.concat_ws(",", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in lines.columns if c in FACT_COLUMNS])
    checked = joined.select(*same, *attrs, reason.alias("reason"), "line")
    return checked.withColumn("line", F.when(F.col("reason").isNotNull(), F.coalesce("line", told)))


def without_small(checked: DataFrame, dims: dict[str, LineDim]) -> DataFrame:
    """Enriched lines whose attributes of small dimensions are null, for a shuffle; ``with_small`` puts them back."""
    late = {c for d in dims.values() if d.small for c in d.rows.columns if c != d.key}
    kinds = {f.name: f.dataType for f in checked.schema}
    return checked.select(*[F.lit(None).cast(kinds[c]).alias(c) if c in late else c for c in checked.columns])


def with_small(lines: DataFrame, dims: dict[str, LineDim], fresh: Column) -> DataFrame:
    """The attributes that ``without_small`` left out, on the lines that are ``fresh``; the others keep their own."""
    filled = lines
    for dim in (d for d in dims.values() if d.small):
        names = [c for c in dim.rows.columns if c != dim.key]
        found = dim.rows.select(F.col(dim.key).alias("_key"), *[F.col(c).alias(f"_late_{c}") for c in names])
        joined = filled.join(F.broadcast(found), F.col(dim.key) == F.col("_key"), "left")
        late = {c: F.when(fresh, F.col(f"_late_{c}")).otherwise(F.col(c)).alias(c) for c in names}
        filled = joined.select(*[late.get(c, F.col(c)) for c in filled.columns])
    return filled
