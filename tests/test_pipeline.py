"""Whole job on hand-written landed files: outputs, invariants, crash + re-run."""

import os
import tempfile

import pytest
from pyspark.sql import functions as F

from salesmart.operators import ledger as LG
from salesmart.plans import pipeline as PL
from salesmart.plans.pipeline import RerunRequired, read_snapshot, run_pipeline
from salesmart.sources.files import NoDataError
from tests.seed import dimensions
from tests.test_ingest import BASE, _land


def _landing():
    return _land(
        {
            "day1.csv": f"{BASE}\n1,121,sugar,2023-03-03,1,50,2,100\n2,122,maida,2023-03-04,4,20,1,20\n"
            "3,121,besan,2023-04-05,2,52,1,52\n",
            "day2.csv": f"{BASE},payment_mode\n4,123,nutshell,2023-04-02,7,40,3,120,cash\n",
            "bad.csv": "customer_id,product_name\n1,sugar\n",
            "x.json": "{}\n",
        }
    )


@pytest.fixture(scope="module")
def result(spark):
    customer, store, product, team = dimensions(spark)
    out = tempfile.mkdtemp(prefix="salesmart-run-")
    return run_pipeline(spark, _landing(), out, customer, store, team, product=product)


def test_outputs_exist_and_agree(spark, result):
    p = result.paths
    enriched = spark.read.parquet(p["enriched"])
    total = enriched.agg(F.sum("total_cost")).first()[0]
    assert spark.read.parquet(p["customers_data_mart"]).agg(F.sum("total_sales")).first()[0] == total
    assert spark.read.parquet(p["customer_day_mart"]).agg(F.sum("total_sales")).first()[0] == total
    assert spark.read.parquet(p["sales_team_month_mart"]).agg(F.sum("total_sales")).first()[0] == total
    assert spark.read.parquet(p["customer_data_mart"]).count() == 4
    assert spark.read.parquet(p["sales_partitioned_data_mart"]).count() == 4
    assert "current_price" in enriched.columns
    assert (result.accepted_files, result.rejected_files) == (2, 2)
    assert os.path.isdir(p["monthly_report"].replace("file:", ""))


def test_ledger_finished(spark, result):
    cur = LG.ledger_current(LG.read_ledger(spark, result.ledger)).collect()
    assert sorted((r.file_name, r.status) for r in cur) == [
        ("bad.csv", "E"), ("day1.csv", "I"), ("day2.csv", "I"), ("x.json", "E")]


def test_crash_then_rerun(spark):
    customer, store, _, team = dimensions(spark)
    landing = _landing()
    out = tempfile.mkdtemp(prefix="salesmart-crash-")
    first = run_pipeline(spark, landing, out + "/a", customer, store, team)
    mart_a = sorted(map(tuple, spark.read.parquet(first.paths["sales_team_month_mart"]).collect()))

    # A crashed run: ledger has A events only.
    ledger = out + "/ledger"
    files = spark.read.parquet(first.paths["audit"]).where("accepted").select("path", "file_name")
    LG.append_ledger(LG.ledger_start(files, "2024-01-01 00:00:00"), ledger)
    with pytest.raises(RerunRequired):
        run_pipeline(spark, landing, out + "/b", customer, store, team, ledger_path=ledger, strict=True)
    rerun = run_pipeline(spark, landing, out + "/b", customer, store, team, ledger_path=ledger)
    assert rerun.pending_before == 2
    mart_b = sorted(map(tuple, spark.read.parquet(rerun.paths["sales_team_month_mart"]).collect()))
    assert mart_a == mart_b
    # Everything finished now: a third run has nothing to do.
    from salesmart.sources.files import NoDataError

    with pytest.raises(NoDataError):
        run_pipeline(spark, landing, out + "/c", customer, store, team, ledger_path=ledger)


def test_selected_outputs_only(spark):
    customer, store, _, team = dimensions(spark)
    out = tempfile.mkdtemp(prefix="salesmart-sel-")
    res = run_pipeline(spark, _landing(), out, customer, store, team, outputs={"sales_team_month_mart"})
    assert spark.read.parquet(res.paths["sales_team_month_mart"]).count() > 0
    assert not os.path.exists(res.paths["sales_partitioned_data_mart"].replace("file:", ""))
    assert "snapshot" not in res.timings


def test_relanded_name_is_new_work(spark):
    """A finished file re-landed under the same name (new content, new mtime) is processed again."""
    customer, store, _, team = dimensions(spark)
    landing = _landing()
    out = tempfile.mkdtemp(prefix="salesmart-reland-")
    ledger = out + "/ledger"
    first = run_pipeline(spark, landing, out + "/a", customer, store, team, ledger_path=ledger)
    assert first.accepted_files == 2
    p = os.path.join(landing, "day1.csv")
    with open(p, "w") as f:
        f.write(f"{BASE}\n5,121,sugar,2023-05-01,1,50,1,50\n")
    st = os.stat(p)
    os.utime(p, (st.st_atime + 60, st.st_mtime + 60))
    second = run_pipeline(spark, landing, out + "/b", customer, store, team, ledger_path=ledger)
    assert second.accepted_files == 1
    rows = spark.read.parquet(second.paths["enriched"]).collect()
    assert [(r.customer_id, str(r.sales_date)) for r in rows] == [(5, "2023-05-01")]


def test_marts_accumulate_over_runs(spark):
    """Day 2 lands under day 1's file name in a folder of its own: both days' sales are in every mart."""
    customer, store, _, team = dimensions(spark)
    landing = tempfile.mkdtemp(prefix="salesmart-days-")
    out = tempfile.mkdtemp(prefix="salesmart-days-out-")

    def land(day, row):
        os.makedirs(f"{landing}/{day}")
        with open(f"{landing}/{day}/sales.csv", "w") as f:
            f.write(f"{BASE}\n{row}\n")
        os.utime(f"{landing}/{day}/sales.csv", (1_700_000_000, 1_700_000_000))

    land("d1", "1,121,sugar,2023-03-03,1,50,2,100")
    assert run_pipeline(spark, landing, out, customer, store, team).accepted_files == 1
    land("d2", "1,121,sugar,2023-03-03,2,50,5,250")
    second = run_pipeline(spark, landing, out, customer, store, team)
    assert second.accepted_files == 1
    p = second.paths
    for name in ("enriched", "customer_data_mart", "sales_team_data_mart", "sales_partitioned_data_mart"):
        assert spark.read.parquet(p[name]).agg(F.sum("total_cost")).first()[0] == 350
    assert [r.total_sales for r in spark.read.parquet(p["customers_data_mart"]).collect()] == [350]
    assert [r.total_sales for r in spark.read.parquet(p["customer_day_mart"]).collect()] == [350]
    team_mart = {r.sales_person_id: float(r.incentive) for r in spark.read.parquet(p["sales_team_month_mart"]).collect()}
    assert team_mart == {1: 0.0, 2: 2.5}
    # a run that died after the marts leaves no finish events: its re-run replaces what it wrote
    ledger = spark.read.parquet(second.ledger).where("status = 'A' or run_id = 1").collect()
    again = spark.createDataFrame(ledger, spark.read.parquet(second.ledger).schema)
    again.write.parquet(out + "/_ledger_died")
    third = run_pipeline(spark, landing, out, customer, store, team, ledger_path=out + "/_ledger_died")
    assert third.pending_before == 1
    assert spark.read.parquet(p["sales_partitioned_data_mart"]).agg(F.sum("total_cost")).first()[0] == 350
    assert [r.total_sales for r in spark.read.parquet(p["customers_data_mart"]).collect()] == [350]


def _job(spark, landing, out, **options):
    customer, store, _, team = dimensions(spark)
    return run_pipeline(spark, landing, out, customer, store, team, **options)


FEW = {"sales_team_data_mart"}


def _write(landing, name, rows, at):
    path = os.path.join(landing, name)
    with open(path, "w") as f:
        f.write("\n".join([BASE, *rows]) + "\n")
    os.utime(path, (at, at))


SUMMED = {
    "enriched": "total_cost", "customer_data_mart": "total_cost", "sales_team_data_mart": "total_cost",
    "sales_partitioned_data_mart": "total_cost", "customers_data_mart": "total_sales", "customer_day_mart": "total_sales",
    "sales_team_month_mart": "total_sales",
}


def _sums(spark, res):
    """Total and months of every output, and of the newest snapshot."""
    out = {}
    frames = {n: (spark.read.parquet(res.paths[n]), c) for n, c in SUMMED.items()}
    frames["snapshot"] = read_snapshot(spark, res.out, ledger_path=res.ledger), "total_cost"
    for name, (df, c) in frames.items():
        month = "substring(cast(sales_date_month as string), 1, 7)" if name == "customers_data_mart" else "sales_month"
        rows = df.groupBy(F.expr(month).alias("m")).agg(F.sum(c).alias("s")).collect()
        out[name] = {r.m: float(r.s) for r in rows}
    report = spark.read.option("header", True).csv(res.paths["monthly_report"])
    rows = report.groupBy("sales_month").agg(F.sum(report.columns[2]).alias("s")).collect()
    out["monthly_report"] = {r.sales_month: float(r.s) for r in rows}
    return out


def _all(months):
    return {n: months for n in (*SUMMED, "snapshot", "monthly_report")}


def test_corrected_file_replaces_its_old_version(spark):
    landing, out = tempfile.mkdtemp(prefix="salesmart-fix-"), tempfile.mkdtemp(prefix="salesmart-fix-out-")
    _write(landing, "a.csv", ["1,121,sugar,2023-03-03,1,50,3,150", "2,121,sugar,2023-04-04,1,50,1,50"], 1_700_000_000)
    _write(landing, "b.csv", ["3,122,maida,2023-03-05,4,20,1,20"], 1_700_000_000)
    first = _job(spark, landing, out)
    assert _sums(spark, first) == _all({"2023-03": 170.0, "2023-04": 50.0})
    # a.csv again: a sale is dearer, and the sale of April was one of May
    _write(landing, "a.csv", ["1,121,sugar,2023-03-03,1,50,4,200", "2,121,sugar,2023-05-04,1,50,1,50"], 1_700_000_100)
    second = _job(spark, landing, out)
    assert (second.accepted_files, second.retracted_files) == (1, 1)
    assert _sums(spark, second) == _all({"2023-03": 220.0, "2023-05": 50.0})
    # the first version is still as it was
    old = read_snapshot(spark, out, first.snapshot_version)
    assert sorted((r.sales_month, float(r.total_cost)) for r in old.collect()) == [
        ("2023-03", 20.0), ("2023-03", 150.0), ("2023-04", 50.0)]
    state = {(r.file_name, r.status) for r in LG.ledger_current(LG.read_ledger(spark, second.ledger)).collect()}
    assert state == {("a.csv", "I"), ("a.csv", "R"), ("b.csv", "I")}
    # a second correction, of the other file: its row was carried into run 2
    _write(landing, "b.csv", ["3,122,maida,2023-03-05,4,20,2,40"], 1_700_000_200)
    third = _job(spark, landing, out)
    assert _sums(spark, third) == _all({"2023-03": 240.0, "2023-05": 50.0})
    assert read_snapshot(spark, out, second.snapshot_version).agg(F.sum("total_cost")).first()[0] == 270


def test_months_in_many_parts_are_folded(spark):
    landing, out = tempfile.mkdtemp(prefix="salesmart-fold-"), tempfile.mkdtemp(prefix="salesmart-fold-out-")
    for day in range(1, 5):
        _write(landing, f"d{day}.csv", [f"{day},121,sugar,2023-03-0{day},1,50,1,50"], 1_700_000_000 + day)
        res = _job(spark, landing, out, fold_after=2)
    assert _sums(spark, res) == _all({"2023-03": 200.0})
    runs = spark.read.parquet(res.paths["sales_partitioned_data_mart"]).select("run_id").distinct().collect()
    assert [r.run_id for r in runs] == [4]


def test_died_run_leaves_no_phantom_sales(spark, monkeypatch):
    """Run 1 dies after every mart is written; its file is corrected to another month before the re-run."""
    landing, out = tempfile.mkdtemp(prefix="salesmart-die-"), tempfile.mkdtemp(prefix="salesmart-die-out-")
    _write(landing, "a.csv", ["1,121,sugar,2023-03-03,1,50,2,100"], 1_700_000_000)
    with monkeypatch.context() as m:
        m.setattr(LG, "ledger_finish", lambda *a, **k: (_ for _ in ()).throw(RuntimeError("killed")) if len(a) < 3 else _finish(*a, **k))
        with pytest.raises(RuntimeError, match="killed"):
            _job(spark, landing, out)
    _write(landing, "a.csv", ["1,121,sugar,2023-04-03,1,50,3,150"], 1_700_000_100)
    res = _job(spark, landing, out)
    assert res.run_id == 1 and res.pending_before == 0  # the version that was begun is gone
    assert _sums(spark, res) == _all({"2023-04": 150.0})


_finish = LG.ledger_finish


def test_tidy_up_after_a_run_that_died_behind_its_finish(spark, monkeypatch):
    landing, out = tempfile.mkdtemp(prefix="salesmart-tidy-"), tempfile.mkdtemp(prefix="salesmart-tidy-out-")
    _write(landing, "a.csv", ["1,121,sugar,2023-03-03,1,50,2,100"], 1_700_000_000)
    _job(spark, landing, out)
    _write(landing, "a.csv", ["1,121,sugar,2023-03-03,1,50,3,150"], 1_700_000_100)
    with monkeypatch.context() as m:
        m.setattr(PL, "_retire", lambda spark, paths, units: (_ for _ in ()).throw(RuntimeError("killed")) if units else None)
        with pytest.raises(RuntimeError, match="killed"):
            _job(spark, landing, out)
    _write(landing, "b.csv", ["2,121,sugar,2023-03-04,1,50,1,50"], 1_700_000_200)
    assert _sums(spark, _job(spark, landing, out)) == _all({"2023-03": 200.0})


def test_a_run_number_has_one_holder(spark):
    landing, out = tempfile.mkdtemp(prefix="salesmart-claim-"), tempfile.mkdtemp(prefix="salesmart-claim-out-")
    _write(landing, "a.csv", ["1,121,sugar,2023-03-03,1,50,2,100"], 1_700_000_000)
    with PL.run_claim(spark, f"{out}/_ledger", 1):
        with pytest.raises(PL.RunClaimed, match="run 1 is held by"):
            _job(spark, landing, out, outputs=FEW)
        assert _job(spark, landing, out, takeover=True, outputs=FEW).run_id == 1
    _write(landing, "b.csv", ["1,121,sugar,2023-03-03,1,50,2,100"], 1_700_000_000)
    assert _job(spark, landing, out, outputs=FEW).run_id == 2  # claims are given back


def test_rejected_lines_are_kept_and_counted(spark):
    landing, out = tempfile.mkdtemp(prefix="salesmart-rej-"), tempfile.mkdtemp(prefix="salesmart-rej-out-")
    _write(
        landing, "a.csv",
        ["1,121,sugar,2023-03-03,1,50,2,100", "1,121,sugar,2023-03-03,1,50,two,100", "1,121,sugar,2023-03-03,1,50",
         "1,121,sugar,2023-03-03,1,50,2,100,9", "1,121,sugar,2023-13-03,1,50,2,100", "99999999999999999999,121,sugar,2023-03-03,1,50,2,100",
         "5000000000,121,sugar,2023-03-03,1,50,2,100", "1,999,sugar,2023-03-03,1,50,2,100", "1,121,sugar,2023-03-03,999,50,2,100",
         '1,121,"su\ngar, raw",2023-03-04,1,50,2,100', "1,121,sugar,2023-03-03,1,50,2,999999999.99", ",121,sugar,2023-03-03,1,50,2,100"],
        1_700_000_000,
    )
    _write(landing, "none.csv", [], 1_700_000_000)
    res = _job(spark, landing, out, outputs=FEW)
    assert (res.landed_lines, res.accepted_lines, res.rejected_lines) == (12, 2, 10)
    told = sorted((r.reason, r.line) for r in spark.read.parquet(res.paths["rejected_rows"]).collect())
    assert [r for r, _ in told] == [
        "bad_cell:customer_id", "bad_cell:quantity", "bad_cell:sales_date", "bad_cell:total_cost", "malformed_line",
        "malformed_line", "no_customer", "no_customer", "no_sales_team", "no_store"]
    assert ("bad_cell:quantity", "1,121,sugar,2023-03-03,1,50,two,100") in told
    assert ("malformed_line", "1,121,sugar,2023-03-03,1,50,2,100,9") in told
    names = {r.file_name for r in spark.read.parquet(res.paths["rejected_rows"]).collect()}
    assert names == {"a.csv"}
    kept = spark.read.parquet(res.paths["enriched"]).collect()
    assert sorted(r.product_name for r in kept) == ["su\ngar, raw", "sugar"]
    assert spark.read.parquet(res.paths["sales_team_data_mart"]).agg(F.sum("total_cost")).first()[0] == 200


def test_left_join_keeps_sales_without_a_dimension_row(spark):
    landing, out = tempfile.mkdtemp(prefix="salesmart-left-"), tempfile.mkdtemp(prefix="salesmart-left-out-")
    _write(landing, "a.csv", ["1,999,sugar,2023-03-03,1,50,2,100"], 1_700_000_000)
    res = _job(spark, landing, out, how="left", outputs=FEW)
    assert (res.accepted_lines, res.rejected_lines) == (1, 0)


def test_a_key_twice_in_a_dimension_stops_the_run(spark):
    customer, store, _, team = dimensions(spark)
    landing, out = tempfile.mkdtemp(prefix="salesmart-dup-"), tempfile.mkdtemp(prefix="salesmart-dup-out-")
    _write(landing, "a.csv", ["1,121,sugar,2023-03-03,1,50,2,100"], 1_700_000_000)
    with pytest.raises(PL.LinesLost, match="store has id 121 2 times"):
        run_pipeline(spark, landing, out, customer, store.union(store.where("id = 121")), team)
    assert LG.finished_runs(LG.read_ledger(spark, out + "/_ledger")).count() == 0


def test_rejected_files_are_told_once(spark):
    landing, out = tempfile.mkdtemp(prefix="salesmart-once-"), tempfile.mkdtemp(prefix="salesmart-once-out-")
    with open(landing + "/bad.csv", "w") as f:
        f.write("customer_id,product_name\n1,sugar\n")
    open(landing + "/empty.csv", "w").close()
    with pytest.raises(NoDataError, match="correct files"):
        _job(spark, landing, out, outputs=FEW)
    _write(landing, "a.csv", ["1,121,sugar,2023-03-03,1,50,2,100"], 1_700_000_000)
    res = _job(spark, landing, out, outputs=FEW)
    assert (res.accepted_files, res.rejected_files) == (1, 0)
    told = spark.read.parquet(res.paths["quarantine"]).collect()
    assert sorted((r.file_name, r.line) for r in told if not r.is_header) == [("bad.csv", "1,sugar"), ("empty.csv", None)]


def test_later_runs_read_touched_months_only(spark):
    landing, out = tempfile.mkdtemp(prefix="salesmart-touch-"), tempfile.mkdtemp(prefix="salesmart-touch-out-")
    _write(landing, "a.csv", [f"1,121,sugar,2023-0{m}-03,1,50,2,100" for m in range(1, 7)], 1_700_000_000)
    first = _job(spark, landing, out, outputs={"sales_team_month_mart"})
    path = first.paths["sales_team_month_mart"].replace("file:", "")
    before = {d: sorted(os.listdir(f"{path}/{d}")) for d in os.listdir(path) if d.startswith("sales_month")}
    _write(landing, "b.csv", ["2,121,sugar,2023-02-03,1,50,1,50"], 1_700_000_000)
    _job(spark, landing, out, outputs={"sales_team_month_mart"})
    after = {d: sorted(os.listdir(f"{path}/{d}")) for d in os.listdir(path) if d.startswith("sales_month")}
    assert {d for d in before if before[d] != after[d]} == {"sales_month=2023-02"}


def test_a_run_writes_a_month_of_sums_as_one_file(spark):
    """Not a file for each month from every task that holds some of its keys (small tasks are not merged here)."""
    customer, store, _, team = dimensions(spark)
    lines = "".join(f"{i},121,sugar,2023-0{3 + i % 3}-0{1 + i % 9},{1 + i % 3},50,2,100\n" for i in range(1, 21))
    out = tempfile.mkdtemp(prefix="salesmart-files-")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        paths = run_pipeline(spark, _land({"d.csv": f"{BASE}\n{lines}"}), out, customer, store, team, outputs=set()).paths
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    for name in ("customer_day_totals", "seller_month_totals", "enriched"):
        assert len(spark.read.parquet(paths[name]).inputFiles()) == 3, name


def _shuffle_files(spark):
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    names = spark._jvm.scala.jdk.javaapi.CollectionConverters.asJava(files)
    return {f.getName() for f in names if f.getName().startswith("shuffle_")}


def test_landing_and_partitioned_writes_keep_no_shuffles(spark):
    import time

    from salesmart.sinks import parquet as PQ
    from salesmart.sources import testdata as TD
    from tests.conftest import SF_SMALL

    before = _shuffle_files(spark)
    out = tempfile.mkdtemp(prefix="salesmart-freed-")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        root = TD.land_sales(spark, SF_SMALL, f"{out}/landing")
        fact = TD.sales_fact(spark, SF_SMALL)
        PQ.write_partitioned(fact, f"{out}/fact", ("store_id",))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    for _ in range(50):  # files go behind the write
        left = _shuffle_files(spark) - before
        if not left:
            break
        time.sleep(0.2)
    assert not left
    assert not os.path.exists(f"{root}-joined")
    landed = [spark.read.option("header", True).csv(f"{root}/{n}").count() for n in ("base", "extra", "missing")]
    assert sum(landed) + spark.read.json(f"{root}/json").count() == fact.count()


def test_files_and_small_dimensions_are_not_shuffled_with_each_line(spark):
    """Their columns are null in the shuffle and come back behind it; carried lines keep what they had."""
    from salesmart.operators import enrich as EN

    customer, store, product, team = dimensions(spark)
    audit = spark.createDataFrame([("/a/day1.csv", 5, True), ("/a/day2.csv", None, True)], "path string, file_modified_ms long, accepted boolean")
    row = "customer_id long, store_id long, product_name string, sales_date string, sales_person_id long, path string, file_modified_ms long, reason string, line string"  # noqa: E501
    lines = spark.createDataFrame(
        [(1, 121, "sugar", "2023-03-03", 1, "/a/day1.csv", 5, None, None), (2, 121, "besan", "2023-03-04", 77, "/a/day2.csv", None, None, None)], row
    )
    dims = EN.line_dims(customer, store, team, product)
    assert all(d.small for d in dims.values())
    whole = EN.enrich_lines(lines, dims)
    files = PL._numbered_files(audit, 2)
    bare = EN.without_small(EN.enrich_lines(PL._without_files(lines, files), dims), dims)
    late = {c for d in dims.values() for c in d.rows.columns if c != d.key} | {"path", "file_modified_ms"}
    assert not any(r[c] for r in bare.collect() for c in late)
    own = whole.withColumn("first_name", F.lit("earlier")).withColumn("path", F.lit("/a/before.csv"))
    both = bare.unionByName(own, allowMissingColumns=True)
    back = PL._with_files(EN.with_small(both, dims, F.col("_file").isNotNull()), files)
    assert sorted(map(str, back.select(*whole.columns).collect())) == sorted(map(str, whole.union(own).collect()))
    # two files of one number are told by their paths
    assert PL._numbered_files(audit.union(audit), 4) is None
