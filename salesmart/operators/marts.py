"""Detail and aggregate marts: P4, P5, A1–A4, W1 (with P11, T1).

Aggregates are plain ``groupBy().agg(sum)`` — Spark adds the map-side partial
aggregate, so a hot key is pre-combined in every task before the shuffle.

The incentive (W1) does not rank inside a window: a window puts a whole
(store, month) — or, for ``scope="month"``, a whole month — into one task.
Instead the group's top total is itself a distributed aggregate (partial +
final), joined back on the scope keys.  ``total == max(total)`` is exactly
``rank() == 1`` over ``total DESC``; ``ties="one"`` takes
``max(struct(total, -sales_person_id))``, i.e. ``row_number() == 1`` with the
lowest seller id winning a tie.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesmart.functions.columns import full_name, incentive, money, month_key, month_start

CUSTOMER_DETAIL_COLUMNS = [
    "customer_id",
    "first_name",
    "last_name",
    "address",
    "pincode",
    "phone_number",
    "sales_date",
    "total_cost",
]

SALES_TEAM_DETAIL_COLUMNS = [
    "store_id",
    "sales_person_id",
    "sales_person_first_name",
    "sales_person_last_name",
    "store_manager_name",
    "manager_id",
    "is_manager",
    "sales_person_address",
    "sales_person_pincode",
    "sales_date",
    "total_cost",
    "sales_month",
]


def customer_mart_detail(enriched: DataFrame) -> DataFrame:
    """P4 — one row per sale with the customer's contact columns."""
    return enriched.select(*CUSTOMER_DETAIL_COLUMNS)


def sales_team_mart_detail(enriched: DataFrame) -> DataFrame:
    """P5 + P6 — one row per sale with seller / store columns and the ``yyyy-MM`` month."""
    return enriched.withColumn("sales_month", month_key("sales_date")).select(*SALES_TEAM_DETAIL_COLUMNS)


def customer_month_mart(detail: DataFrame) -> DataFrame:
    """A1 — customer purchases per calendar month (``sales_date_month`` = first day)."""
    return (
        detail.groupBy(
            "customer_id",
            full_name("first_name", "last_name").alias("full_name"),
            "address",
            "phone_number",
            month_start("sales_date").alias("sales_date_month"),
        )
        .agg(money(F.sum("total_cost")).alias("total_sales"))
    )


def customer_day_mart(detail: DataFrame) -> DataFrame:
    """A3 — customer purchases per day."""
    return detail.groupBy("customer_id", "sales_date").agg(money(F.sum("total_cost")).alias("total_sales"))


def customer_day_totals(detail: DataFrame) -> DataFrame:
    """Shared pre-aggregate of A1 and A3: per customer (with contact columns) and day, un-rounded.

    Both customer marts roll up from it exactly (sums of decimal sums), so the
    fact-sized detail is scanned and shuffled once for the two of them.
    """
    return detail.groupBy(
        "customer_id",
        full_name("first_name", "last_name").alias("full_name"),
        "address",
        "phone_number",
        "sales_date",
    ).agg(F.sum("total_cost").alias("_total"))


def customer_month_from_days(days: DataFrame) -> DataFrame:
    """A1 from ``customer_day_totals``."""
    return days.groupBy(
        "customer_id", "full_name", "address", "phone_number", month_start("sales_date").alias("sales_date_month")
    ).agg(money(F.sum("_total")).alias("total_sales"))


def customer_day_from_days(days: DataFrame) -> DataFrame:
    """A3 from ``customer_day_totals``."""
    return days.groupBy("customer_id", "sales_date").agg(money(F.sum("_total")).alias("total_sales"))


def sales_person_month_totals(detail: DataFrame) -> DataFrame:
    """A2 — total billed per seller and month (un-rounded sum kept in ``_total``)."""
    return detail.groupBy(
        "store_id",
        "sales_person_id",
        full_name("sales_person_first_name", "sales_person_last_name").alias("full_name"),
        "sales_month",
    ).agg(F.sum("total_cost").alias("_total"))


def sales_team_month_mart(
    detail: DataFrame, scope: str = "store_month", ties: str = "all", materialize: bool = False
) -> DataFrame:
    """W1 — monthly totals; the top seller of each scope group earns 1 % of their total.

    scope: ``"store_month"`` (top per store and month) or ``"month"`` (top per month).
    ties:  ``"all"`` every tied top seller is paid; ``"one"`` only the lowest id.
    materialize: cut the seller-month totals with a reliable ``checkpoint()`` (eager)
        so both uses read them once.  Without it the plan relies on AQE reusing
        the totals' exchange, which it does not always do once the input itself
        has shuffles (then the input joins run twice).  The totals are one row
        per seller and month — small next to the detail.
    """
    m = sales_person_month_totals(detail)
    if materialize:
        from salesmart.session import ensure_checkpoint_dir

        ensure_checkpoint_dir(detail.sparkSession)
        m = m.checkpoint(eager=True)
    return sales_team_month_from_totals(m, scope, ties)


def merged_seller_totals(totals: DataFrame) -> DataFrame:
    """A2 over several runs' ``sales_person_month_totals``."""
    return totals.groupBy("store_id", "sales_person_id", "full_name", "sales_month").agg(
        F.sum("_total").alias("_total")
    )


def sales_team_month_from_totals(m: DataFrame, scope: str = "store_month", ties: str = "all") -> DataFrame:
    """W1 from ``sales_person_month_totals`` (read twice, so best a written table)."""
    keys = {"store_month": ["store_id", "sales_month"], "month": ["sales_month"]}.get(scope)
    if keys is None:
        raise ValueError("scope must be 'store_month' or 'month'")
    if ties not in ("all", "one"):
        raise ValueError("ties must be 'all' or 'one'")

    rank_key = F.struct(F.col("_total").alias("t"), (-F.col("sales_person_id")).alias("i"))
    top_expr = F.max("_total") if ties == "all" else F.max(rank_key)
    # Aliased keys: new attribute ids, so the join back is not an ambiguous self-join.
    top = m.groupBy(*keys).agg(top_expr.alias("_top")).select(
        *[F.col(k).alias(f"_k_{k}") for k in keys], "_top"
    )
    cond = [m[k].eqNullSafe(top[f"_k_{k}"]) for k in keys]
    joined = m.join(top, cond, "inner")
    if ties == "all":
        # All totals null -> every row ranks first (and earns null).
        is_top = F.when(F.col("_top").isNull(), F.lit(True)).otherwise(
            F.coalesce(F.col("_total") == F.col("_top"), F.lit(False))
        )
    else:
        is_top = rank_key.eqNullSafe(F.col("_top"))
    return joined.select(
        "store_id",
        "sales_person_id",
        "full_name",
        "sales_month",
        money("_total").alias("total_sales"),
        incentive("_total", is_top).alias("incentive"),
    )


def monthly_billing_report(mart: DataFrame) -> DataFrame:
    """A4 — report rows: seller name, store, month, monthly billing and incentive."""
    return mart.select(
        F.col("full_name").alias("sales_person_name"),
        F.col("store_id").alias("sales_person_store_id"),
        "sales_month",
        F.col("total_sales").alias("sales_person_total_billing_done_for_each_month"),
        F.col("incentive").alias("total_incentive"),
    )
