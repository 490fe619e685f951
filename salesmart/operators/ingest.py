"""S4, P1–P3, U1 — read accepted files into the fixed fact layout, and say of every line what became of it.

Each file has a *positional column map*: where in its own header the mandatory columns
and the extra ones stand.  All files are read as rows of plain cells and the map,
joined on ``_metadata.file_path``, picks them; a layout is data, not a plan of its own.
Spark's CSV reader needs the number of cells, so there is one scan for each header
*width*, whatever the number of headers.  Cells stay strings until they are cast, so
extra columns are verbatim (``007``, ``1.50``).

A line that does not fit is not lost: ``reason`` says why and ``line`` keeps it.

============================  ====================================================
``malformed_line``            another number of cells than the file's header
``bad_cell:<column>``         a cell that is not of its column's type (first such column)
``no_<dimension>``            no row of a dimension (``operators.enrich``, inner joins)
============================  ====================================================
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from salesmart.functions.columns import normalise_path
from salesmart.schema import (
    ADDITIONAL_COLUMN,
    CORRUPT_COLUMN,
    EXTRA_SEPARATOR,
    FACT_SCHEMA,
    MANDATORY_COLUMNS,
    MANDATORY_TYPES,
)
from salesmart.sources.files import NoDataError

REASON_MALFORMED = "malformed_line"
REASON_BAD_CELL = "bad_cell"
#: Map entries (files times columns) up to which the column maps are broadcast: four bytes each.
BROADCAST_MAP_ENTRIES = 2_000_000


def read_cells(spark: SparkSession, paths: list[str], width: int, multi_line: bool = True) -> DataFrame:
    """S4 — data lines of files with ``width`` header columns: ``path``, ``cells``, ``malformed`` (the raw line).

    ``multi_line`` lets quoted cells hold line breaks; a file is then one task.
    Without it large files split, and a quoted line break gives malformed lines.
    """
    names = [f"_{i}" for i in range(width)]
    schema = T.StructType([T.StructField(c, T.StringType()) for c in [*names, CORRUPT_COLUMN]])
    return (
        spark.read.schema(schema)
        .option("header", True)
        .option("multiLine", multi_line)
        .option("columnPruning", False)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT_COLUMN)
        .csv(paths)
        .select(
            normalise_path(F.col("_metadata.file_path")).alias("path"),
            F.array(*names).alias("cells"),
            F.col(CORRUPT_COLUMN).alias("malformed"),
        )
    )


def column_maps(accepted: DataFrame) -> DataFrame:
    """One row per file: ``_path``, ``file_modified_ms``, ``at`` (places of the mandatory columns), ``extra_at``."""
    place = lambda c: (F.array_position("columns", c) - 1).cast("int")
    version = F.col("file_modified_ms") if "file_modified_ms" in accepted.columns else F.lit(None).cast("bigint")
    return accepted.select(
        F.col("path").alias("_path"),
        version.alias("file_modified_ms"),
        F.array(*[place(F.lit(c)) for c in MANDATORY_COLUMNS]).alias("at"),
        F.transform("extra", place).alias("extra_at"),
    )


def _typed(cell: Column, kind: T.DataType) -> Column:
    if isinstance(kind, T.DateType):  # yyyy-MM-dd and nothing else
        return F.when(cell.rlike(r"^\d{4}-\d{2}-\d{2}$"), cell.try_cast(kind))
    if isinstance(kind, T.StringType):
        return cell
    # casts trim blanks and control characters, which a cell may not begin or end with; the pattern is for the few that may
    bare = (cell >= F.lit("!")) & (F.substring(cell, -1, 1) >= F.lit("!"))
    return F.when(bare | cell.rlike(r"^\S+$"), cell.try_cast(kind))


def checked_lines(
    spark: SparkSession, audit: DataFrame, multi_line: bool = True, seen: Observation | None = None
) -> DataFrame:
    """Every data line of every accepted file: the fact columns, ``path``, ``file_modified_ms``, ``reason``, ``line``.

    ``reason`` and ``line`` are null for lines that fit.  Blank lines are no data lines.
    ``seen`` observes ``n``, the lines read.
    """
    accepted = audit.where(F.col("accepted"))
    # the paths of this run's files plan its reads; they come with their header widths in one job
    widths: dict[int, list[str]] = {}
    for r in accepted.select("path", F.size("columns").alias("width")).collect():
        widths.setdefault(r.width, []).append(r.path)
    if not widths:
        raise NoDataError("No Data available with correct files")
    scans = [read_cells(spark, paths, width, multi_line) for width, paths in sorted(widths.items())]
    lines = reduce(DataFrame.unionByName, scans)
    if seen is not None:
        lines = lines.observe(seen, F.count(F.lit(1)).alias("n"))
    maps = column_maps(accepted)
    if sum(width * len(paths) for width, paths in widths.items()) <= BROADCAST_MAP_ENTRIES:
        maps = F.broadcast(maps)
    mapped = lines.join(maps, F.col("path") == F.col("_path"))
    cell = {c: F.get("cells", F.get("at", F.lit(i))) for i, c in enumerate(MANDATORY_COLUMNS)}
    # one projection picks the cells, one casts them, one says what did not fit: each is evaluated once a line
    mapped = mapped.select("*", *[cell[c].alias(f"_{c}") for c in MANDATORY_COLUMNS])
    typed = mapped.select("*", *[_typed(F.col(f"_{c}"), MANDATORY_TYPES[c]).alias(c) for c in MANDATORY_COLUMNS])
    bad = [
        F.when(F.col(f"_{c}").isNotNull() & F.col(c).isNull(), F.lit(f"{REASON_BAD_CELL}:{c}"))
        for c in MANDATORY_COLUMNS
        if not isinstance(MANDATORY_TYPES[c], T.StringType)
    ]
    reason = F.coalesce(F.when(F.col("malformed").isNotNull(), F.lit(REASON_MALFORMED)), *bad)
    quoted = F.transform(
        "cells",
        lambda c: F.when(c.rlike('[",\r\n]'), F.concat(F.lit('"'), F.replace(c, F.lit('"'), F.lit('""')), F.lit('"')))
        .otherwise(F.coalesce(c, F.lit(""))),
    )
    # P1–P3: mandatory columns in fixed order; extra values joined, nulls skipped, null without extra columns
    extra = F.when(
        F.size("extra_at") > 0, F.concat_ws(EXTRA_SEPARATOR, F.transform("extra_at", lambda i: F.get("cells", i)))
    )
    told = typed.withColumn("reason", reason)
    return told.select(
        *MANDATORY_COLUMNS,
        extra.alias(ADDITIONAL_COLUMN),
        "path",
        "file_modified_ms",
        "reason",
        F.when(F.col("reason").isNotNull(), F.coalesce("malformed", F.array_join(quoted, ","))).alias("line"),
    )


def ingest_sales(spark: SparkSession, audit: DataFrame, keep_corrupt: bool = False, multi_line: bool = True) -> DataFrame:
    """U1 — all lines of the accepted files in the fact layout, duplicates kept.

    Cells that do not fit are null here; ``keep_corrupt`` adds the line that held
    them.  The job itself sends such lines to the quarantine (``checked_lines``).
    """
    lines = checked_lines(spark, audit, multi_line)
    kept = [F.col("line").alias(CORRUPT_COLUMN)] if keep_corrupt else []
    return lines.select(*FACT_SCHEMA.fieldNames(), *kept)
