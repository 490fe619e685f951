"""S1–S3, F5 — landed-file discovery, suffix split and header read.

File listing is the only driver-side step (Spark's file index lives on the
driver anyway).  Headers are read in **one** job for all files: a bounded
first-line probe per file inside Spark tasks (``mapInPandas``, see
``sources.probe``), with Spark's text source as the fallback; header names
are then parsed JVM-side the way Spark's CSV reader names columns.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from salesmart.functions.columns import file_base_name, normalise_path
from salesmart.sources.probe import file_stats_task, first_lines_task

FILES_PER_TASK = 2_000
MAX_LISTING_PARTITIONS = 10_000


class NoDataError(RuntimeError):
    """Raised when a step has nothing to process."""


def require_rows(df: DataFrame, message: str) -> DataFrame:
    """F6 — abort with ``message`` when ``df`` is empty."""
    if df.isEmpty():
        raise NoDataError(message)
    return df


def listed_files(spark: SparkSession, listing: dict[str, list]) -> DataFrame:
    """A listing's columns (``path`` and more) as a frame without Python workers, paths in one spelling.

    About FILES_PER_TASK files per task, so the in-task stat and header probes
    (and everything keyed on the listing) scale out with the file count.
    """
    import pyarrow as pa

    n_parts = max(1, min(MAX_LISTING_PARTITIONS, -(-len(listing["path"]) // FILES_PER_TASK)))
    df = spark.createDataFrame(pa.table(listing))
    if n_parts > 1:
        df = df.repartition(n_parts)
    return df.withColumn("path", normalise_path("path"))


def discover_files(spark: SparkSession, root: str, stats: bool = True) -> DataFrame:
    """S1 — every file under ``root`` (recursive; zero-byte files included).

    Spark's listing skips hidden files (``_*``, ``.*``) such as ``_SUCCESS``.
    Columns: ``path`` (decoded ``file:/…`` URI, readable again), ``file_name``,
    and with ``stats`` ``file_size`` / ``file_modified_ms`` (read from file
    metadata inside Spark tasks; null where the filesystem cannot be asked).
    The ledger identifies a landed file by name *and* modification time, so a
    file re-landed under a used name is new work.
    """
    try:
        uris = spark.read.option("recursiveFileLookup", True).text(root).inputFiles()
    except AnalysisException as exc:
        if exc.getCondition() != "PATH_NOT_FOUND":
            raise
        raise NoDataError(f"No Data available to process: {root}") from exc
    if not uris:
        raise NoDataError(f"No Data available to process: {root}")
    df = listed_files(spark, {"path": list(uris)})
    df = df.select("path", file_base_name("path").alias("file_name"))
    if stats:
        from salesmart.session import ensure_checkpoint_dir

        # One stat per file, pinned: every later step sees the same listing snapshot.
        ensure_checkpoint_dir(spark)
        df = df.mapInPandas(file_stats_task(), STATS_SCHEMA).checkpoint(eager=True)
    return df


STATS_SCHEMA = T.StructType(
    [
        T.StructField("path", T.StringType()),
        T.StructField("file_name", T.StringType()),
        T.StructField("file_size", T.LongType()),
        T.StructField("file_modified_ms", T.LongType()),
    ]
)


def split_by_suffix(files: DataFrame, suffix: str = ".csv") -> tuple[DataFrame, DataFrame]:
    """S2/F5 — (files ending in ``suffix``, all others).  Case-sensitive."""
    cond = F.col("file_name").endswith(suffix)
    return files.where(cond), files.where(~cond)


def paths_of(files: DataFrame) -> list[str]:
    """Driver-side path list of a file frame (listing metadata, needed to plan a read)."""
    return [r.path for r in files.select("path").collect()]


# A CSV field: quoted (with "" escapes, commas allowed) or unquoted up to the next comma.
_FIELD = r'(?:^|,)("(?:[^"]|"")*"|[^,]*)'


def parse_header(header: F.Column, case_sensitive: bool = False) -> F.Column:
    """Header line -> ARRAY<STRING> of column names, named as Spark's CSV reader names them.

    Quotes are removed (``""`` unescaped); an empty name becomes ``_c<index>``;
    a name that occurs more than once (case-insensitively unless
    ``case_sensitive``) becomes ``<name><index>`` at every occurrence.
    """
    fields = F.regexp_extract_all(header, F.lit(_FIELD), 1)
    names = F.transform(
        fields,
        lambda x: F.when(
            x.rlike(r'^".*"$'), F.replace(F.regexp_replace(x, r'^"(.*)"$', "$1"), F.lit('""'), F.lit('"'))
        ).otherwise(x),
    )

    def norm(c: F.Column) -> F.Column:
        return c if case_sensitive else F.lower(c)

    return F.transform(
        names,
        lambda x, i: F.when(x == F.lit(""), F.concat(F.lit("_c"), i.cast("string")))
        .when(F.size(F.filter(names, lambda y: norm(y) == norm(x))) > 1, F.concat(x, i.cast("string")))
        .otherwise(x),
    )


HEADER_SCHEMA = T.StructType(
    [
        T.StructField("path", T.StringType()),
        T.StructField("header", T.StringType()),
        T.StructField("read_ok", T.BooleanType()),
    ]
)

def _headers_by_split(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Spark-only header read: first line of each file's first split (reads that split whole)."""
    lines = spark.read.text(paths).select(
        normalise_path(F.col("_metadata.file_path")).alias("path"),
        F.col("_metadata.file_block_start").alias("_start"),
        "value",
    )
    return (
        lines.where(F.col("_start") == 0)
        .withColumn("_rid", F.monotonically_increasing_id())
        .groupBy("path")
        .agg(F.min_by("value", "_rid").alias("header"))
    )


def read_headers(spark: SparkSession, files: DataFrame, method: str = "auto") -> DataFrame:
    """S3 — ``files`` plus ``header`` (first line) and ``columns`` (parsed names).

    ``method="probe"`` reads each file up to its first line break inside Spark tasks
    (``mapInPandas`` over the file list), so the audit costs O(files), not
    O(data); ``"split"`` uses Spark's text source (first split of every file);
    ``"auto"`` probes and falls back to ``"split"`` for files the probe cannot
    open.  A zero-byte file has no first line: ``header`` is null, ``columns``
    empty.
    """
    empty_cols = F.array().cast("array<string>")
    if method not in ("auto", "probe", "split"):
        raise ValueError("method must be 'auto', 'probe' or 'split'")
    if method == "split":
        paths = paths_of(files)
        if not paths:
            return files.select("*", F.lit(None).cast("string").alias("header"), empty_cols.alias("columns"))
        firsts = _headers_by_split(spark, paths)
    else:
        probed = files.select("path").mapInPandas(first_lines_task(), HEADER_SCHEMA)
        if method == "auto":
            # One row per file; a reliable checkpoint so the probe runs once for both uses.
            from salesmart.session import ensure_checkpoint_dir

            ensure_checkpoint_dir(spark)
            probed = probed.checkpoint(eager=True)
        firsts = probed.select("path", "header")
        if method == "auto":
            unread = [r.path for r in probed.where(~F.col("read_ok")).select("path").collect()]
            if unread:
                firsts = firsts.join(
                    _headers_by_split(spark, unread).withColumnRenamed("header", "_h2"), "path", "left"
                ).select("path", F.coalesce("header", "_h2").alias("header"))
    return files.join(firsts, "path", "left").select(
        "*", F.coalesce(parse_header(F.col("header")), empty_cols).alias("columns")
    )
