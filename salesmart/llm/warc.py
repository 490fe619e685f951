"""WARC archives: write pages as transactions, read archives back, assemble transactions.

A page makes a request, a response and a metadata record, tied by
``WARC-Concurrent-To``. Of pages with equal payloads of at least
``REVISIT_BYTES`` bytes, the rows with the smallest id have a response record, the
others a revisit record that refers to it and carries no payload. Records are
built by DataFrame functions and written by Spark's text writer, which ends each
one with the blank line that the format asks for; archives go to the shared folder,
gzipped. Reading takes whole archives of bounded size, one a row, and follows
Content-Length, so a payload may hold anything.

Assembly joins records through concurrent-to identifiers, in either direction
and through a request, and gives one nested row per capture.

Results for odd input: a null payload is empty; a page without an id counts as
after all others (or, without ``null_ids_revisit``, always has a response), and its
id reads back null; repeated rows are captures of their own, told apart by an
ordinal in their record ids, and so are rows with one id but other url or payload;
an empty table gives an archive without records and no
captures; a damaged record reads as a record of type ``malformed`` and reading
goes on at the next record; other columns are not archived.
"""

from __future__ import annotations

import gzip
import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from salesmart.llm.common import freed_shuffles, staged

REVISIT_BYTES = 100
#: Pages of one archive file; it bounds what a task holds when it reads one.
PAGES_PER_FILE = 2_000
#: Repeated rows that one task makes from one.
COPIES_AT_ONCE = 64
CRLF, END = "\r\n", "\r\n\r\n"
DATE = "2024-01-01T00:00:00Z"
RECORD_SCHEMA = (
    "record_id string, record_type string, concurrent_to string, refers_to string, target_uri string, "
    "payload_digest string, payload_bytes long, payload_sha256 string, body string, payload binary"
)


def _record_id(kind: str, *parts: Column) -> Column:
    """A urn:uuid that is a function of a page's id, url, payload digest and ordinal."""
    tagged = [F.concat(F.when(p.isNull(), "-").otherwise("+"), F.coalesce(p.cast("string"), F.lit(""))) for p in parts]
    h = F.md5(F.concat_ws("\n", F.lit(kind), *tagged))
    cut = [F.substring(h, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *cut), F.lit(">"))


def _record(headers: list[tuple[str, Column | str]], block: Column) -> Column:
    """A record without its final blank line; headers with a null value are left out."""
    lines = [F.lit("WARC/1.1")]
    lines += [F.concat(F.lit(f"{k}: "), v if isinstance(v, Column) else F.lit(v)) for k, v in headers]
    lines.append(F.concat(F.lit("Content-Length: "), F.octet_length(block).cast("string")))
    return F.concat(F.concat_ws(CRLF, *lines), F.lit(END), block)


def _numbered(p: DataFrame) -> DataFrame:
    """``p`` with ``nth``: 0, or 0 to n - 1 for n equal rows.

    Equal rows are summed up in each task, and the sum is dealt out in short ranges
    before it is unfolded, so no task holds or writes a whole group of them.
    """
    keyed = p.withColumn("_key", _record_id("row", F.col("page_id"), F.col("url"), F.col("digest")))
    repeated = staged(keyed.groupBy("_key").agg(F.count("*").alias("_n")).where("_n > 1"), "warc-repeated")
    columns = [*p.columns, "nth"]
    if repeated.isEmpty():
        return p.withColumn("nth", F.lit(0).cast("long"))
    single = keyed.join(repeated, "_key", "left_anti").withColumn("nth", F.lit(0).cast("long"))
    ranges = (
        keyed.join(repeated, "_key").dropDuplicates(["_key"])
        .withColumn("_from", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_n") - 1, F.lit(COPIES_AT_ONCE).cast("long"))))
        .repartition(int(p.sparkSession.conf.get("spark.sql.shuffle.partitions")), "_key", "_from")
    )
    last = F.least(F.col("_from") + COPIES_AT_ONCE, F.col("_n")) - 1
    return single.select(*columns).union(ranges.withColumn("nth", F.explode(F.sequence("_from", last))).select(*columns))


def page_records(pages: DataFrame, *, null_ids_revisit: bool = True) -> DataFrame:
    """page_id, url, record_type and ``value``: the page's three records."""
    html = F.coalesce(F.col("html").cast("string"), F.lit(""))
    p = pages.select("page_id", "url", html.alias("html")).select("*", F.sha2("html", 256).alias("digest"))
    who = F.struct(
        F.col("page_id").isNull().alias("no_id"), F.col("page_id").alias("page_id"),
        F.col("url").isNull().alias("no_url"), F.col("url").alias("url"),
    )
    large = F.octet_length("html") >= REVISIT_BYTES
    # only payloads that occur more than once have a row here; a frequent one is summed up before it is shuffled
    first_id, no_id = F.col("first.page_id"), F.col("page_id").isNull()
    firsts = (
        p.where(large).groupBy(F.col("digest").alias("_digest"))
        .agg(F.min(who).alias("first"), F.max("page_id").alias("last"), F.max(no_id).alias("any_no_id"))
        .where((first_id < F.col("last")) | (first_id.isNotNull() & F.col("any_no_id") & F.lit(null_ids_revisit)))
    )
    rows = _numbered(p)
    m = rows.join(firsts, F.col("digest") == F.col("_digest"), "left")
    own = [F.col("page_id"), F.col("url"), F.col("digest"), F.col("nth")]
    # the first of the rows with the smallest id is the one referred to
    revisit = F.col("first").isNotNull() & F.coalesce(F.col("page_id") != first_id, F.lit(null_ids_revisit))
    kind = F.when(revisit, "revisit").otherwise("response")
    uri = F.regexp_replace(F.coalesce("url", F.lit("")), "[\\x00-\\x20\\x7F]", "%20")
    capture, request = _record_id("capture", *own), _record_id("request", *own)
    common: list[tuple[str, Column | str]] = [("WARC-Date", DATE), ("WARC-Target-URI", uri)]
    head = F.concat(
        F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
        F.octet_length("html").cast("string"), F.lit(END),
    )
    response = _record(
        [("WARC-Type", kind), ("WARC-Record-ID", capture), *common, ("Content-Type", "application/http;msgtype=response"),
         ("WARC-Payload-Digest", F.concat(F.lit("sha256:"), "digest")),
         ("WARC-Refers-To", F.when(revisit, _record_id("capture", first_id, F.col("first.url"), F.col("digest"), F.lit(0)))),
         ("WARC-Profile", F.when(revisit, F.lit("http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")))],
        F.when(revisit, head).otherwise(F.concat(head, "html")),
    )
    asked = _record(
        [("WARC-Type", "request"), ("WARC-Record-ID", request), ("WARC-Concurrent-To", capture), *common,
         ("Content-Type", "application/http;msgtype=request")],
        F.concat(F.lit("GET "), uri, F.lit(" HTTP/1.1"), F.lit(END)),
    )
    about = _record(
        [("WARC-Type", "metadata"), ("WARC-Record-ID", _record_id("metadata", *own)), ("WARC-Concurrent-To", capture),
         *common, ("Content-Type", "application/json")],
        F.to_json(F.struct("page_id", "url")),
    )
    return m.select("page_id", "url", kind.alias("record_type"), F.concat_ws(END, asked, response, about).alias("value"))


def write_archives(
    pages: DataFrame, path: str, pages_per_file: int = PAGES_PER_FILE, *, null_ids_revisit: bool = True
) -> None:
    """Writes gzipped archives, each of whole transactions."""
    with freed_shuffles(pages.sparkSession):
        (
            page_records(pages, null_ids_revisit=null_ids_revisit).select("value")
            .write.option("lineSep", END).option("compression", "gzip").option("maxRecordsPerFile", pages_per_file)
            .text(path)
        )


def parse_records(data: bytes) -> Iterator[dict]:
    """The records of one uncompressed archive."""
    at, end = 0, len(data)
    while at < end:
        if data[at : at + 2] == b"\r\n":
            at += 2
            continue
        stop = data.find(b"\r\n\r\n", at)
        lines = data[at:stop].decode("utf-8", "replace").split("\r\n") if stop >= 0 else []
        fields = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}
        length = fields.get("content-length", "")
        if not lines or not lines[0].startswith("WARC/") or not length.isdigit() or stop + 4 + int(length) > end:
            yield {"record_type": "malformed"}
            again = data.find(b"\r\n\r\nWARC/", at)
            if again < 0:
                return
            at = again + 4
            continue
        block = data[stop + 4 : stop + 4 + int(length)]
        at = stop + 4 + int(length)
        kind, payload, size = fields.get("warc-type", ""), block, None
        if fields.get("content-type", "").startswith("application/http"):
            head, gap, payload = block.partition(b"\r\n\r\n")
            for line in head.split(b"\r\n")[1:]:
                k, _, v = line.partition(b":")
                if k.strip().lower() == b"content-length" and v.strip().isdigit():
                    size = int(v)
        yield {
            "record_id": fields.get("warc-record-id"), "record_type": kind,
            "concurrent_to": fields.get("warc-concurrent-to"), "refers_to": fields.get("warc-refers-to"),
            "target_uri": fields.get("warc-target-uri"),
            "payload_digest": fields.get("warc-payload-digest", "").rpartition(":")[2] or None,
            "payload_bytes": size if kind == "revisit" and size is not None else len(payload),
            "payload_sha256": None if kind == "revisit" else hashlib.sha256(payload).hexdigest(),
            "body": block.decode("utf-8", "replace") if kind == "metadata" else None,
            "payload": payload,
        }


def read_archives(spark: SparkSession, path: str, *, with_payload: bool = True) -> DataFrame:
    """One row per record of all archives below ``path`` (gzipped or not)."""
    names = [c.split()[0] for c in RECORD_SCHEMA.split(", ")]
    rows_at_once = 256

    def records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.string()] * 6 + [pa.int64(), pa.string(), pa.string(), pa.binary()]
        empty = {n: None for n in names}

        def batch(rows: list[dict]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array([r[n] for r in rows], type=k) for n, k in zip(names, kinds)], names=names
            )

        for b in batches:
            for content in b.column("content"):
                raw = content.as_buffer()
                data = gzip.decompress(raw) if bytes(raw[:2]) == b"\x1f\x8b" else bytes(raw)
                rows = []
                for r in parse_records(data):
                    r = empty | r
                    if not with_payload:
                        r["payload"] = None
                    rows.append(r)
                    if len(rows) == rows_at_once:
                        yield batch(rows)
                        rows = []
                if rows:
                    yield batch(rows)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path)
    return files.where("length > 0").select("content").mapInArrow(records, RECORD_SCHEMA)


def assemble(records: DataFrame) -> DataFrame:
    """One row per capture: capture_id, capture (response or revisit), request, metadata, original (of a revisit).

    A record belongs to the capture that it is concurrent to, in either
    direction, or else to that of a request that it is concurrent to. Of several
    requests or metadata records of a capture the one with the smallest id stands;
    captures that no record refers to have null there.
    """
    one = [c for c in records.columns if c != "record_id"]
    rows = records.where(F.col("record_id").isNotNull())
    # a record that archives hold twice is one
    unique = rows.groupBy("record_id").agg(F.min(F.struct(*one)).alias("r"))
    body = unique.select("record_id", "r.*")
    is_capture = F.col("record_type").isin("response", "revisit")
    captures = body.where(is_capture)
    tied = body.where("concurrent_to is not null")
    edges = tied.select(F.col("record_id").alias("x"), F.col("concurrent_to").alias("y")).union(
        tied.select(F.col("concurrent_to").alias("x"), F.col("record_id").alias("y"))
    )
    ids = captures.select(F.col("record_id").alias("capture_id"))
    direct = edges.join(ids, F.col("y") == F.col("capture_id")).select("x", "capture_id", F.lit(0).alias("steps"))
    through = (
        edges.select(F.col("x").alias("a"), "y").join(direct, F.col("y") == F.col("x"))
        .select(F.col("a").alias("x"), "capture_id", F.lit(1).alias("steps"))
    )
    owner = direct.union(through).groupBy("x").agg(F.min(F.struct("steps", "capture_id")).alias("o"))
    parts = body.where(F.col("record_type").isin("request", "metadata")).join(owner, F.col("record_id") == F.col("x"))
    whole = F.struct("record_id", "target_uri", "payload_bytes", "payload_sha256", "body", "payload")

    def smallest(kind: str) -> Column:
        return F.min_by(F.when(F.col("record_type") == kind, whole), F.when(F.col("record_type") == kind, F.col("record_id")))

    others = parts.groupBy(F.col("o.capture_id").alias("of")).agg(
        smallest("request").alias("request"), smallest("metadata").alias("metadata")
    )
    nested = captures.select(
        F.col("record_id").alias("capture_id"), "record_type", "refers_to",
        F.struct("record_id", "target_uri", "payload_digest", "payload_bytes", "payload_sha256", "payload").alias("capture"),
    ).join(others, F.col("capture_id") == F.col("of"), "left").drop("of")
    nested = staged(nested, "warc-captures")
    originals = nested.where("record_type = 'response'").select(
        F.col("capture_id").alias("_id"), F.struct("capture", "metadata").alias("original")
    )
    return nested.join(originals, F.col("refers_to") == F.col("_id"), "left").drop("_id")


def page_captures(captures: DataFrame) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to: of assembled captures of pages."""
    page = lambda meta: F.get_json_object(meta, "$.page_id").cast("long")
    return captures.select(
        page(F.col("metadata.body")).alias("page_id"),
        F.coalesce(F.col("original.capture.payload_bytes"), F.col("capture.payload_bytes")).alias("payload_bytes"),
        F.coalesce(
            F.col("capture.payload_sha256"), F.col("original.capture.payload_sha256"), F.col("capture.payload_digest")
        ).alias("payload_digest"),
        "record_type",
        page(F.col("original.metadata.body")).alias("refers_to"),
    )
