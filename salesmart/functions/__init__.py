"""Column-level helpers (scalar expressions) built from ``pyspark.sql.functions``."""

from salesmart.functions.columns import (  # noqa: F401
    file_base_name,
    full_name,
    incentive,
    line_total,
    money,
    month_key,
    month_start,
    normalise_path,
    strip_prefix,
    ts_literal,
)
