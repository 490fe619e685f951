"""Scalar column expressions (P6–P8, P10–P13).

All of these are built-in, codegen-able Spark expressions; none calls Python
per row.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from salesmart.schema import MONEY


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def money(col: Column | str) -> Column:
    """Cast to ``DECIMAL(10,2)``; under ANSI mode an overflow raises."""
    return _c(col).cast(MONEY)


def month_key(col: Column | str) -> Column:
    """P6 — ``'yyyy-MM'`` month key: ``substring(cast(date as string), 1, 7)`` (no time zone involved)."""
    return F.substring(_c(col).cast("date").cast("string"), 1, 7)


def month_start(col: Column | str) -> Column:
    """P8 — first day of the month, as ``DATE``."""
    return F.trunc(_c(col), "month")


def full_name(first: Column | str, last: Column | str) -> Column:
    """P7 — first and last name joined by one space (null if either is null)."""
    return F.concat(_c(first), F.lit(" "), _c(last))


def line_total(price: Column | str, quantity: Column | str) -> Column:
    """P12 — ``price * quantity`` as money."""
    return money(_c(price) * _c(quantity))


def incentive(total: Column | str, is_top: Column, rate: str = "0.01") -> Column:
    """P11 — ``rate`` of the total for the top performer, 0 for everybody else.

    ``is_top`` must not be null; a null total of a top row gives a null incentive.
    """
    r = F.lit(rate).cast("decimal(3,2)")
    return F.when(is_top, _c(total) * r).otherwise(F.lit(0)).cast(MONEY)


def file_base_name(col: Column | str) -> Column:
    """P10 — last path segment of a file URI."""
    return F.element_at(F.split(_c(col), "/"), -1)


def strip_prefix(col: Column | str, prefix: str) -> Column:
    """P10 — remove a leading ``prefix`` (e.g. a bucket root) when present."""
    c = _c(col)
    return F.when(c.startswith(prefix), F.substring(c, len(prefix) + 1, 1 << 30)).otherwise(c)


def normalise_path(col: Column | str) -> Column:
    """One spelling for file URIs: ``file:/x``, ``file:///x`` -> ``file:/x``; percent-decoded."""
    c = _c(col)
    plain = F.replace(F.regexp_replace(c, r"^file:/+", "file:/"), F.lit("+"), F.lit("%2B"))
    # most paths have nothing to change; this runs for every line that is read
    return F.when(c.contains("%") | c.startswith("file://"), F.url_decode(plain)).otherwise(c)


def ts_literal(ts: str | _dt.datetime | _dt.date | Column) -> Column:
    """A ``TIMESTAMP_NTZ`` literal that does not depend on the session time zone."""
    if isinstance(ts, Column):
        return ts.cast("timestamp_ntz")
    if isinstance(ts, _dt.datetime):
        ts = ts.strftime("%Y-%m-%d %H:%M:%S")
    elif isinstance(ts, _dt.date):
        ts = ts.strftime("%Y-%m-%d 00:00:00")
    return F.lit(str(ts)).cast("timestamp_ntz")
