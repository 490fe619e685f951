"""F1, F2, U2 — header audit against the mandatory columns.

``missing = mandatory − header`` (non-empty -> reject) and
``extra = header − mandatory`` (kept in source-file order).  The check is
case-sensitive, so an upper-case header is rejected.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesmart.schema import MANDATORY_COLUMNS

REASON_NOT_CSV = "not_csv"
REASON_MISSING = "missing_columns"


def _mandatory() -> F.Column:
    return F.array(*[F.lit(c) for c in MANDATORY_COLUMNS])


def _modified(df: DataFrame) -> F.Column:
    """The file's modification time (epoch ms), null when unknown."""
    c = F.col("file_modified_ms") if "file_modified_ms" in df.columns else F.lit(None)
    return c.cast("bigint").alias("file_modified_ms")


def _size(df: DataFrame) -> F.Column:
    """The file's size in bytes, null when unknown."""
    c = F.col("file_size") if "file_size" in df.columns else F.lit(None)
    return c.cast("bigint").alias("file_size")


def audit_headers(headers: DataFrame) -> DataFrame:
    """Per-file verdict: ``missing``, ``extra``, ``accepted``, ``reason``."""
    cols = F.col("columns")
    missing = F.array_except(_mandatory(), cols)
    return headers.select(
        "path",
        "file_name",
        _modified(headers),
        _size(headers),
        "header",
        "columns",
        missing.alias("missing"),
        F.array_except(cols, _mandatory()).alias("extra"),
    ).select(
        "*",
        (F.size("missing") == 0).alias("accepted"),
        F.when(F.size("missing") > 0, F.lit(REASON_MISSING)).alias("reason"),
    )


def reject_non_csv(others: DataFrame) -> DataFrame:
    """Audit rows for files that are not CSV (quarantined without reading a header)."""
    return others.select(
        "path",
        "file_name",
        _modified(others),
        _size(others),
        F.lit(None).cast("string").alias("header"),
        F.array().cast("array<string>").alias("columns"),
        F.array().cast("array<string>").alias("missing"),
        F.array().cast("array<string>").alias("extra"),
        F.lit(False).alias("accepted"),
        F.lit(REASON_NOT_CSV).alias("reason"),
    )


def audit_landing(spark, files: DataFrame, suffix: str = ".csv") -> DataFrame:
    """S2 + S3 + F1/F2 over discovered files: one audit row per file."""
    from salesmart.sources.files import read_headers, split_by_suffix

    csv, others = split_by_suffix(files, suffix)
    return audit_headers(read_headers(spark, csv)).unionByName(reject_non_csv(others))


def require_csv(files: DataFrame, suffix: str = ".csv") -> DataFrame:
    """S2/F6 — abort when none of the landed files is a CSV file."""
    from salesmart.sources.files import require_rows, split_by_suffix

    require_rows(split_by_suffix(files, suffix)[0], "No csv data available to process the request")
    return files
