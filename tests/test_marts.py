"""Marts on the literal seed rows: incentive ties, join type, overflow, invariants."""

import datetime as d
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from salesmart.operators import enrich as E
from salesmart.operators import marts as M
from salesmart.schema import FACT_SCHEMA
from tests.seed import dimensions


def _fact(spark, rows):
    return spark.createDataFrame(
        [
            (c, s, p, d.date.fromisoformat(dt), sp, Decimal(pr), q, Decimal(tc), None)
            for c, s, p, dt, sp, pr, q, tc in rows
        ],
        FACT_SCHEMA,
    )


@pytest.fixture(scope="module")
def dims(spark):
    return dimensions(spark)


TIE_ROWS = [
    # store 121, March: sellers 1, 2, 3 each bill 100 -> three-way tie
    (1, 121, "sugar", "2023-03-03", 1, "50", 2, "100"),
    (2, 121, "sugar", "2023-03-04", 2, "50", 2, "100"),
    (3, 121, "maida", "2023-03-05", 3, "20", 5, "100"),
    # store 122, March: seller 4 wins
    (4, 122, "besan", "2023-03-06", 4, "52", 3, "156"),
    (5, 122, "besan", "2023-03-06", 5, "52", 1, "52"),
    # store 122, April: seller 5 only
    (5, 122, "sugar", "2023-04-01", 5, "50", 1, "50"),
    # customer 99 has no dimension row
    (99, 123, "sugar", "2023-04-02", 7, "50", 10, "500"),
]


def _mart(spark, dims, scope="store_month", ties="all", how="inner"):
    customer, store, _, team = dims
    enriched = E.enrich(_fact(spark, TIE_ROWS), customer, store, team, how=how)
    return M.sales_team_month_mart(M.sales_team_mart_detail(enriched), scope=scope, ties=ties)


def test_three_way_tie_all_paid(spark, dims):
    rows = {(r.store_id, r.sales_month, r.sales_person_id): r for r in _mart(spark, dims).collect()}
    for sp in (1, 2, 3):
        assert rows[(121, "2023-03", sp)].incentive == Decimal("1.00")
    assert rows[(122, "2023-03", 4)].incentive == Decimal("1.56")
    assert rows[(122, "2023-03", 5)].incentive == Decimal("0.00")
    assert rows[(122, "2023-04", 5)].incentive == Decimal("0.50")
    assert rows[(121, "2023-03", 1)].full_name == "Seller1 Name1"


def test_tie_one_lowest_id(spark, dims):
    rows = {(r.store_id, r.sales_month, r.sales_person_id): r for r in _mart(spark, dims, ties="one").collect()}
    assert [rows[(121, "2023-03", sp)].incentive for sp in (1, 2, 3)] == [Decimal("1.00"), Decimal("0"), Decimal("0")]


def test_scope_month(spark, dims):
    rows = [r for r in _mart(spark, dims, scope="month").collect() if r.incentive > 0]
    # March: seller 4 (156) beats the 100s of store 121; April: customer 99 is dropped, seller 5 wins
    assert sorted((r.sales_month, r.sales_person_id) for r in rows) == [("2023-03", 4), ("2023-04", 5)]


def test_inner_drops_unknown_customer_left_keeps(spark, dims):
    customer, store, _, team = dims
    f = _fact(spark, TIE_ROWS)
    inner = E.enrich(f, customer, store, team).select("customer_id").collect()
    left = E.enrich(f, customer, store, team, how="left").where("customer_id = 99").collect()
    assert 99 not in {r.customer_id for r in inner}
    assert len(left) == 1 and left[0].first_name is None


def test_unused_dimension_rows_do_not_appear(spark, dims):
    mart = _mart(spark, dims).collect()
    assert {r.store_id for r in mart} <= {121, 122, 123}
    assert 10 not in {r.sales_person_id for r in mart}


def test_customer_marts_and_sums(spark, dims):
    customer, store, _, team = dims
    enriched = E.enrich(_fact(spark, TIE_ROWS), customer, store, team)
    det = M.customer_mart_detail(enriched)
    month = M.customer_month_mart(det)
    day = M.customer_day_mart(det)
    total = enriched.agg(F.sum("total_cost")).first()[0]
    assert month.agg(F.sum("total_sales")).first()[0] == total
    assert day.agg(F.sum("total_sales")).first()[0] == total
    r = month.where("customer_id = 4").first()
    assert (r.full_name, str(r.sales_date_month), r.total_sales) == ("First4 Last4", "2023-03-01", Decimal("156.00"))
    assert month.columns == ["customer_id", "full_name", "address", "phone_number", "sales_date_month", "total_sales"]


def test_incentive_only_on_top_rows(spark, dims):
    mart = _mart(spark, dims)
    from pyspark.sql import Window

    w = Window.partitionBy("store_id", "sales_month").orderBy(F.desc("total_sales"))
    ranked = mart.withColumn("rk", F.rank().over(w))
    assert ranked.where("incentive > 0 and rk <> 1").count() == 0
    assert ranked.where("rk = 1 and incentive = 0").count() == 0


def test_monthly_sum_overflow_raises(spark, dims):
    customer, store, _, team = dims
    rows = [(1, 121, "sugar", "2023-03-03", 1, "50", 1, "99999999.99")] * 2
    enriched = E.enrich(_fact(spark, rows), customer, store, team)
    with pytest.raises(Exception, match="(?i)overflow|cannot be represented|NUMERIC_VALUE_OUT_OF_RANGE"):
        M.sales_team_month_mart(M.sales_team_mart_detail(enriched)).collect()


def test_product_join(spark, dims):
    _, _, product, _ = dims
    out = E.enrich_product(_fact(spark, TIE_ROWS), product).where("product_name = 'besan'").first()
    assert out.current_price == Decimal("52.00") and str(out.expiry_date) == "2025-01-01"


def test_month_key_and_report(spark, dims):
    rep = M.monthly_billing_report(_mart(spark, dims))
    assert rep.columns == [
        "sales_person_name",
        "sales_person_store_id",
        "sales_month",
        "sales_person_total_billing_done_for_each_month",
        "total_incentive",
    ]


def test_customer_marts_from_shared_days_equal_direct(spark, dims):
    customer, store, _, team = dims
    rows = TIE_ROWS + [(1, 121, "sugar", "2023-03-20", 1, "50", 1, "50"), (4, 122, "besan", "2023-04-06", 4, "52", 1, "52")]
    det = M.customer_mart_detail(E.enrich(_fact(spark, rows), customer, store, team))
    days = M.customer_day_totals(det)
    for direct, rolled in [
        (M.customer_month_mart(det), M.customer_month_from_days(days)),
        (M.customer_day_mart(det), M.customer_day_from_days(days)),
    ]:
        assert rolled.columns == direct.columns
        assert sorted(map(tuple, rolled.collect())) == sorted(map(tuple, direct.collect()))
