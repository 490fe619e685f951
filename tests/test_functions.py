"""Scalar column expressions."""

import datetime as d
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from salesmart.functions import columns as C


def test_scalar_expressions(spark):
    df = spark.createDataFrame(
        [(d.date(2023, 3, 17), "First6", "Last6", "s3://bucket/sales_data/a b.csv", Decimal("123.45"))],
        "dt date, f string, l string, uri string, amt decimal(10,2)",
    )
    r = df.select(
        C.month_key("dt").alias("mk"),
        C.month_start("dt").alias("ms"),
        C.full_name("f", "l").alias("fn"),
        C.full_name(F.lit(None).cast("string"), "l").alias("fn_null"),
        C.file_base_name("uri").alias("base"),
        C.strip_prefix("uri", "s3://bucket/").alias("key"),
        C.strip_prefix(F.lit("other/x.csv"), "s3://bucket/").alias("kept"),
        C.line_total(F.lit(Decimal("1.50")), F.lit(3)).alias("lt"),
        C.incentive("amt", F.lit(True)).alias("inc_top"),
        C.incentive("amt", F.lit(False)).alias("inc_rest"),
        C.ts_literal("2024-01-01 10:00:00").alias("ts"),
        C.normalise_path(F.lit("file:///tmp/a%20b.csv")).alias("norm"),
    ).first()
    assert (r.mk, str(r.ms), r.fn, r.fn_null) == ("2023-03", "2023-03-01", "First6 Last6", None)
    assert (r.base, r.key, r.kept) == ("a b.csv", "sales_data/a b.csv", "other/x.csv")
    assert (r.lt, r.inc_top, r.inc_rest) == (Decimal("4.50"), Decimal("1.23"), Decimal("0.00"))
    assert str(r.ts) == "2024-01-01 10:00:00" and r.norm == "file:/tmp/a b.csv"


def test_money_overflow_raises(spark):
    with pytest.raises(Exception):
        spark.range(1).select(C.money(F.lit(Decimal("123456789.99")))).collect()


def test_no_csv_files_raises(spark, tmp_path):
    from salesmart.operators.audit import require_csv
    from salesmart.sources.files import NoDataError, discover_files

    (tmp_path / "a.json").write_text("{}\n")
    with pytest.raises(NoDataError, match="No csv data"):
        require_csv(discover_files(spark, str(tmp_path)))
