"""K5 — monthly CSV report: one folder per month, stores kept together inside.

``rebalance`` on the month gives one file per month, or several for a month
too large for one task; every file is sorted by store and seller.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from salesmart.schema import MONEY

REPORT_SCHEMA = T.StructType(
    [
        T.StructField("sales_person_name", T.StringType()),
        T.StructField("sales_person_store_id", T.IntegerType()),
        T.StructField("sales_person_total_billing_done_for_each_month", MONEY),
        T.StructField("total_incentive", MONEY),
        T.StructField("sales_month", T.StringType()),
    ]
)


def write_monthly_report(report: DataFrame, path: str, mode: str = "overwrite", overwrite: str = "static") -> str:
    """K5 — ``overwrite="dynamic"`` replaces only the months in ``report``."""
    (
        report.hint("rebalance", "sales_month")
        .sortWithinPartitions("sales_month", "sales_person_store_id", "sales_person_name")
        .write.mode(mode)
        .option("partitionOverwriteMode", overwrite)
        .partitionBy("sales_month")
        .option("header", True)
        .csv(path)
    )
    return path


def read_monthly_report(spark: SparkSession, path: str, store_id_type: T.DataType = T.IntegerType()) -> DataFrame:
    fields = [
        T.StructField(f.name, store_id_type) if f.name == "sales_person_store_id" else f for f in REPORT_SCHEMA
    ]
    return spark.read.schema(T.StructType(fields)).option("header", True).csv(path)
