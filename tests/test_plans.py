"""Physical-plan properties that matter at scale."""

from salesmart.operators import enrich as E
from salesmart.operators import marts as M
from salesmart.operators.joins import broadcast_if_bounded, row_count_at_most
from tests.conftest import SF_SMALL
from salesmart.sources import testdata as TD


def _plan(df):
    """AQE's final plan: run ``df``'s own query execution, then read its executed plan."""
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


def test_hinted_dimension_joins_broadcast(spark):
    enriched = E.enrich(
        TD.sales_fact(spark, SF_SMALL), TD.customers(spark, SF_SMALL), TD.stores(spark, SF_SMALL),
        TD.sales_team(spark, SF_SMALL),
    )
    plan = _plan(enriched)
    assert plan.count("BroadcastHashJoin") >= 3
    assert "SortMergeJoin" not in plan


def test_bounded_probe(spark):
    assert row_count_at_most(spark.range(10), 10)
    assert not row_count_at_most(spark.range(11), 10)
    big = spark.range(100)
    assert broadcast_if_bounded(big, 10) is big
    assert broadcast_if_bounded(big, None) is big


def test_unbounded_dimension_is_not_hinted(spark):
    fact = TD.sales_fact(spark, SF_SMALL)
    customers = TD.customers(spark, SF_SMALL)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        enriched = E.enrich(fact, customers, TD.stores(spark, SF_SMALL), TD.sales_team(spark, SF_SMALL),
                            broadcast_max_rows=10)
        plan = _plan(enriched.select("customer_id", "first_name"))
        assert "SortMergeJoin" in plan or "ShuffledHashJoin" in plan
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_incentive_has_no_window(spark):
    det = M.sales_team_mart_detail(
        E.enrich(TD.sales_fact(spark, SF_SMALL), TD.customers(spark, SF_SMALL), TD.stores(spark, SF_SMALL),
                 TD.sales_team(spark, SF_SMALL))
    )
    for scope in ("store_month", "month"):
        plan = _plan(M.sales_team_month_mart(det, scope=scope))
        assert "Window" not in plan
        assert "SinglePartition" not in plan


def test_scan_is_pruned(spark):
    plan = _plan(TD.sales_fact(spark, SF_SMALL).select("total_cost"))
    assert "ReadSchema: struct<l_orderkey:bigint,l_partkey:bigint,l_suppkey:bigint,l_extendedprice:double>" in plan


def test_probe_many(spark):
    from salesmart.operators.joins import broadcast_all_bounded, rows_at_most

    assert rows_at_most([spark.range(5), spark.range(50), spark.range(0)], 10) == [True, False, True]
    a, b = spark.range(5), spark.range(50)
    out = broadcast_all_bounded([a, b], 10)
    assert out[1] is b and out[0] is not a


def test_probe_is_incremental(spark):
    """The probe of a large many-split frame runs a handful of tasks, not one per split."""
    from salesmart.operators.joins import row_count_at_most

    big = spark.range(0, 2_000_000, 1, 200)
    sc = spark.sparkContext
    sc.setJobGroup("probe-test", "probe-test")
    try:
        assert not row_count_at_most(big, 100)
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
    st = sc.statusTracker()
    tasks = sum(
        st.getStageInfo(s).numTasks
        for j in st.getJobIdsForGroup("probe-test")
        for s in st.getJobInfo(j).stageIds
        if st.getStageInfo(s)
    )
    assert tasks < 20


def test_building_a_plan_over_files_starts_no_job(spark):
    sc = spark.sparkContext
    fact, products = TD.sales_fact(spark, SF_SMALL), TD.products(spark, SF_SMALL)  # footers are read here
    dims = TD.customers(spark, SF_SMALL), TD.stores(spark, SF_SMALL), TD.sales_team(spark, SF_SMALL)
    sc.setJobGroup("plan-only", "plan-only")
    try:
        E.enrich_product(E.enrich(fact, *dims), products)
        assert list(sc.statusTracker().getJobIdsForGroup("plan-only")) == []
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)


def test_large_files_are_not_hinted(spark, monkeypatch):
    from salesmart.operators import joins as J

    customers = TD.customers(spark, SF_SMALL)
    size = J.estimated_bytes(customers)
    assert 0 < size < 1 << 20
    assert J.hint_small([customers])[0] is not customers
    monkeypatch.setattr(J, "DEFAULT_BROADCAST_MAX_BYTES", size - 1)
    assert J.hint_small([customers])[0] is customers
    assert J.estimated_bytes(spark.createDataFrame([(1,)], "a int").rdd.toDF()) is None  # unknown: probed by rows
    assert J.hint_small([customers], None)[0] is customers
