"""Landed-file discovery, header audit, ingest and quarantine (hand-written CSVs)."""

import os
import tempfile
from decimal import Decimal

import pytest

from salesmart.operators.audit import audit_landing
from salesmart.operators.ingest import ingest_sales
from salesmart.sinks.quarantine import quarantine, quarantined_lines
from salesmart.sources.files import NoDataError, discover_files

BASE = "customer_id,store_id,product_name,sales_date,sales_person_id,price,quantity,total_cost"


def _land(files: dict[str, str]) -> str:
    root = tempfile.mkdtemp(prefix="salesmart-land-")
    for name, text in files.items():
        p = os.path.join(root, name)
        os.makedirs(os.path.dirname(p), exist_ok=True)
        with open(p, "w") as f:
            f.write(text)
    return root


@pytest.fixture(scope="module")
def landing():
    return _land(
        {
            "plain.csv": f"{BASE}\n1,121,sugar,2023-03-03,1,50,2,100\n2,122,maida,2023-03-04,4,20,1,20\n",
            # extra columns, reordered mandatory columns, values kept verbatim
            "extra.csv": f"payment_mode,{BASE},coupon\nUPI,3,123,besan,2023-04-01,7,52,1,52,007\n"
            "cash,4,121,nutshell,2023-04-02,2,40,3,120,1.50\n",
            # quoted header names (one with a comma), extras all null in one row
            "sub dir/quoted.csv": '"customer_id","store_id","product_name","sales_date","sales_person_id",'
            '"price","quantity","total_cost","note, x","tag"\n5,121,sugar,2023-05-01,3,50,1,50,,\n'
            '6,121,sugar,2023-05-02,3,50,1,50,hello,t\n',
            # bad cell: quantity not a number
            "badcell.csv": f"{BASE}\n7,122,maida,2023-05-03,5,20,two,40\n",
            # rejected: missing store_id
            "missing.csv": "customer_id,product_name,sales_date,sales_person_id,price,quantity,total_cost,payment_mode\n"
            '8,sugar,2023-05-04,"[1, 2, 3]",50,1,50,cash\n',
            # rejected: upper-case header (case-sensitive check)
            "upper.csv": BASE.upper() + "\n9,121,sugar,2023-05-05,1,50,1,50\n",
            # rejected: zero-byte csv, and a json file
            "empty.csv": "",
            "notes.json": '{"a": 1}\n{"a": 2}\n',
        }
    )


@pytest.fixture(scope="module")
def audit(spark, landing):
    return audit_landing(spark, discover_files(spark, landing)).cache()


def _by_name(audit):
    return {r.file_name: r for r in audit.collect()}


def test_discover_lists_every_file(spark, landing):
    files = discover_files(spark, landing)
    names = sorted(r.file_name for r in files.collect())
    assert names == sorted(
        ["plain.csv", "extra.csv", "quoted.csv", "badcell.csv", "missing.csv", "upper.csv", "empty.csv", "notes.json"]
    )
    # paths are decoded and readable again
    assert any(r.path.endswith("sub dir/quoted.csv") for r in files.collect())


def test_discover_empty_raises(spark):
    with pytest.raises(NoDataError):
        discover_files(spark, tempfile.mkdtemp(prefix="salesmart-none-"))


def test_audit_verdicts(audit):
    a = _by_name(audit)
    assert a["plain.csv"].accepted and a["plain.csv"].extra == []
    assert a["extra.csv"].accepted and a["extra.csv"].extra == ["payment_mode", "coupon"]
    assert a["quoted.csv"].accepted and a["quoted.csv"].extra == ["note, x", "tag"]
    assert a["missing.csv"].missing == ["store_id"] and not a["missing.csv"].accepted
    assert not a["upper.csv"].accepted and len(a["upper.csv"].missing) == 8
    assert not a["empty.csv"].accepted and a["empty.csv"].columns == []
    assert a["notes.json"].reason == "not_csv"
    assert sum(r.accepted for r in a.values()) == 4


def test_accepted_plus_rejected_is_discovered(spark, landing, audit):
    assert audit.count() == discover_files(spark, landing).count()


def test_ingest_has_no_column_shift(spark, audit):
    rows = {r.customer_id: r for r in ingest_sales(spark, audit, keep_corrupt=True).collect()}
    assert len(rows) == 7
    r3 = rows[3]
    assert (r3.store_id, r3.product_name, r3.sales_person_id, r3.price, r3.quantity) == (
        123, "besan", 7, Decimal("52.00"), 1)
    assert r3.additional_column == "UPI, 007"  # source-file order, verbatim
    assert rows[4].additional_column == "cash, 1.50"
    assert rows[5].additional_column == ""  # all extras null
    assert rows[6].additional_column == "hello, t"
    assert rows[1].additional_column is None  # no extra columns
    assert str(rows[1].sales_date) == "2023-03-03"


def test_bad_cell_is_null_and_line_kept(spark, audit):
    r = [x for x in ingest_sales(spark, audit, keep_corrupt=True).collect() if x.customer_id == 7][0]
    assert r.quantity is None
    assert r._corrupt_record == "7,122,maida,2023-05-03,5,20,two,40"


def test_fact_schema(spark, audit):
    from salesmart.schema import FACT_SCHEMA

    assert ingest_sales(spark, audit).schema == FACT_SCHEMA


def test_quarantine_lines_and_reasons(spark, audit):
    q = quarantined_lines(spark, audit).collect()
    data = [r for r in q if not r.is_header]
    by_file = {}
    for r in data:
        by_file.setdefault(r.file_name, []).append(r)
    assert sorted(by_file) == ["empty.csv", "missing.csv", "notes.json", "upper.csv"]
    assert [r.line for r in by_file["empty.csv"]] == [None]  # without a byte: one row without a line
    assert len(by_file["notes.json"]) == 2 and by_file["notes.json"][0].reason == "not_csv"
    assert by_file["missing.csv"][0].missing == "store_id"
    assert sum(r.is_header for r in q) == 2  # missing.csv and upper.csv headers


def test_quarantine_written_by_reason(spark, audit):
    out = tempfile.mkdtemp(prefix="salesmart-q-")
    quarantine(spark, audit, out + "/q")
    back = spark.read.parquet(out + "/q")
    assert sorted(r.reason for r in back.select("reason").distinct().collect()) == ["missing_columns", "not_csv"]


def test_header_methods_agree(spark, landing):
    from salesmart.sources.files import read_headers, split_by_suffix

    csv, _ = split_by_suffix(discover_files(spark, landing))
    got = {}
    for m in ("probe", "split", "auto"):
        got[m] = sorted((r.file_name, r.header, tuple(r.columns)) for r in read_headers(spark, csv, m).collect())
    assert got["probe"] == got["split"] == got["auto"]
    plan = read_headers(spark, csv, "probe")._jdf.queryExecution().executedPlan().toString()
    assert "MapInPandas" in plan


def test_first_line_reader(tmp_path):
    from salesmart.sources.probe import _first_line

    p = tmp_path / "a b.csv"
    p.write_bytes(b"x,y\r\nz\r\n")
    assert _first_line("file:" + str(p)) == ("x,y", True)
    (tmp_path / "e.csv").write_bytes(b"")
    assert _first_line("file:" + str(tmp_path / "e.csv")) == (None, True)
    assert _first_line("nosuchscheme://x/y")[1] is False
    (tmp_path / "bom.csv").write_bytes(b"\xef\xbb\xbfcustomer_id,store_id\n1,2\n")
    assert _first_line("file:" + str(tmp_path / "bom.csv")) == ("customer_id,store_id", True)


def test_header_names_follow_spark(spark, tmp_path):
    """Empty and duplicate header names are named as Spark's CSV reader names them."""
    from salesmart.sources.files import read_headers, split_by_suffix

    p = tmp_path / "odd.csv"
    p.write_text("a,,Price,b,price\n1,2,3,4,5\n")
    csv, _ = split_by_suffix(discover_files(spark, str(tmp_path)))
    ours = read_headers(spark, csv).first().columns
    assert ours == spark.read.option("header", True).csv(str(p)).columns == ["a", "_c1", "Price2", "b", "price4"]


def test_listing_spreads_over_tasks(spark, tmp_path, monkeypatch):
    import salesmart.sources.files as FSm

    for i in range(12):
        (tmp_path / f"f{i}.csv").write_text("a\n1\n")
    monkeypatch.setattr(FSm, "FILES_PER_TASK", 4)
    files = FSm.discover_files(spark, str(tmp_path))
    assert files.rdd.getNumPartitions() == 3 and files.count() == 12
    assert files.where("file_size = 4 and file_modified_ms > 0").count() == 12


def test_header_of_any_length(spark, tmp_path):
    """Headers far beyond one read of the probe: extras folded whole, extras first still accepted."""
    from salesmart.schema import MANDATORY_COLUMNS
    from salesmart.sources.probe import _first_line

    wide = [f"extra_column_number_{i}_with_a_long_name" for i in range(4_000)]
    for k, header in enumerate(([*MANDATORY_COLUMNS, *wide], [*wide, *MANDATORY_COLUMNS])):
        path = tmp_path / f"wide{k}.csv"
        path.write_text(",".join(header) + "\n1,2\n")
        line, ok = _first_line(f"file:{path}")
        assert ok and line.split(",") == header


def test_each_cell_is_checked_once(spark, audit):
    spark.conf.set("spark.sql.debug.maxToStringFields", "1000")
    try:
        plan = ingest_sales(spark, audit, keep_corrupt=True)._jdf.queryExecution().optimizedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.debug.maxToStringFields")
    # one each for customer, store, seller, price, quantity and total
    assert plan.count(r"^\S+$") == 6


def test_cells_with_blanks_are_as_the_pattern_says(spark):
    from pyspark.sql import functions as F
    from pyspark.sql import types as T

    from salesmart.operators.ingest import _typed

    odd = ["12", " 12", "12 ", "\t12", "12\n", "12\n\n", "1 2", "", "\x0112", "12\x7f", " 12", "12\u0085", "two", "-3", None]
    cells = spark.createDataFrame([(c,) for c in odd], "c string")
    for kind in (T.IntegerType(), T.DecimalType(10, 2)):
        plain = F.when(F.col("c").rlike(r"^\S+$"), F.col("c").try_cast(kind))
        rows = cells.select("c", _typed(F.col("c"), kind).alias("a"), plain.alias("b")).collect()
        assert [r.c for r in rows if r.a != r.b] == [] and sum(r.a is not None for r in rows) >= 3
