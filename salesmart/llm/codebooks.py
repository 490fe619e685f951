"""Vector code compression with norm-of-sum bounds.

Components become integers; a vector is cut into equal consecutive parts; every part
position has a codebook that Lloyd rounds refine. A row keeps, for each part and each
group of codebook entries, a lower bound on the distance to the group's entries (its
own entry apart) and the round in which that bound was measured. The driver keeps the
codebooks of all rounds, so a bound of round ``s`` is lowered in round ``t`` by the
*net* displacement ``|C_t[j] - C_s[j]|`` of the group's entries, the norm of the summed
moves, which is at most the sum of the moves' norms that accumulated drifts take off.
Only groups whose lowered bound does not exceed the exact distance to the row's own
entry are scanned again, in exact integers; so codes equal those of a full scan.

A round is one pass over the rows: tasks write the rows' new state and, beside them, the
sums of each entry's parts; Spark adds the sums up, and only the codebook, whose size
is set by its parameters, comes to the driver. Two folders of the shared scratch area
hold the rows in turn. No rows are shuffled but for the codes of the last pass.

Results for odd input: vectors that are null or hold null or non-finite components are
left out, and so are those of another length than the first vector (by id, then
content; null ids last) whose length the parts divide. Rows with a null id are coded
like others. Repeated rows get equal codes. With fewer vectors than entries the
codebooks are that much shorter. Integers are held within +-2**26 (components of 65,536
in size), so that distances are exact 64-bit numbers up to 2,044 components; a sum of errors
stops at the largest 64-bit number. An empty table gives no rows.
Columns of the table other than the named ones play no part.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salesmart.llm.common import freed_shuffles, staged
from salesmart.session import work_dir

PARTS, ENTRIES, ROUNDS, SCALE = 4, 256, 4, 1024
#: Consecutive codebook entries that share one bound.
GROUP = 64
#: Size at which integers stop.
MOST = 1 << 26
#: Rows of one numpy step.
STEP = 4096
#: Labels whose sums are broadcast; more are joined by a shuffle.
BROADCAST_LABELS = 200_000

_STATE = (
    "vec_id long, label string, x array<int>, codes binary, bounds array<float>, stamps binary, "
    "sums array<long>, counts array<long>, sums_row boolean"
)


@dataclass(frozen=True)
class Books:
    """Codebooks of all rounds so far: ``history[round][part]`` is entries x components, in integers."""

    history: tuple[np.ndarray, ...]

    @property
    def last(self) -> np.ndarray:
        return self.history[-1]

    def digest(self) -> str:
        """SHA-256 of the last round's integer components by part, entry, position."""
        return hashlib.sha256(",".join(map(str, self.last.ravel().tolist())).encode()).hexdigest()

    def drops(self) -> np.ndarray:
        """[round, part, group]: most by which any entry of the group lies nearer than it did in that round."""
        now = self.last.astype(np.float64)
        moved = np.stack([np.sqrt(((now - then) ** 2).sum(-1)) for then in self.history])
        starts = np.arange(0, now.shape[1], GROUP)
        return np.maximum.reduceat(moved, starts, axis=-1) * (1 + 1e-9) + 1e-9


def integers(vectors: pa.Array, parts: int, scale: int) -> tuple[np.ndarray, list[np.ndarray]]:
    """(rows that hold a usable vector, their integers); lengths may differ."""
    usable, out = [], []
    lengths = np.asarray(vectors.value_lengths().fill_null(0), np.int64)
    inner = vectors.flatten()  # without the slots of null lists
    values = np.asarray(inner.fill_null(np.nan).cast(pa.float64()), np.float64)
    ends = np.cumsum(lengths)
    with np.errstate(invalid="ignore", over="ignore"):
        whole = np.clip(np.floor(values * scale), -MOST, MOST)
    bad = np.concatenate([[0], np.cumsum(~np.isfinite(values))])
    for i in np.flatnonzero(lengths):
        a, b = ends[i] - lengths[i], ends[i]
        if lengths[i] % parts == 0 and bad[a] == bad[b]:
            usable.append(i)
            out.append(whole[a:b].astype(np.int32))
    return np.array(usable, np.int64), out


def kept_vectors(table: DataFrame, id: str, vector: str, label: str | None, parts: int, scale: int) -> DataFrame:
    """vec_id, label, x (integers) of the usable rows; lengths may differ."""

    def convert(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, ints = integers(batch.column(2), parts, scale)
            took = pa.array(rows)
            lists = pa.ListArray.from_arrays(
                pa.array(np.concatenate([[0], np.cumsum([len(x) for x in ints])]).astype(np.int32)),
                pa.array(np.concatenate(ints) if ints else np.zeros(0, np.int32)),
            )
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(took), batch.column(1).take(took), lists], ["vec_id", "label", "x"]
            )

    tag = F.lit(None) if label is None else F.col(label)
    named = table.select(
        F.col(id).cast("long").alias("vec_id"), tag.cast("string").alias("label"), F.col(vector).cast("array<double>").alias("x")
    )
    return named.mapInArrow(convert, "vec_id long, label string, x array<int>")


def nearest_in(x: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Exact squared distances, rows x entries."""
    most = max(int(np.abs(x).max(initial=0)), int(np.abs(entries).max(initial=0)))
    if 4 * most * most * x.shape[1] < 1 << 53:  # products and sums of such doubles are exact
        a, b = x.astype(np.float64), entries.astype(np.float64)
        return ((a * a).sum(1)[:, None] - 2 * (a @ b.T) + (b * b).sum(1)[None, :]).astype(np.int64)
    out = np.empty((len(x), len(entries)), np.int64)
    for j, e in enumerate(entries):
        gap = x.astype(np.int64) - e
        out[:, j] = (gap * gap).sum(1)
    return out


def assign_part(
    x: np.ndarray, book: np.ndarray, code: np.ndarray | None, bounds: np.ndarray, stamps: np.ndarray, drops: np.ndarray, now: int
) -> tuple[np.ndarray, np.ndarray, int]:
    """(code, squared distance, pairs measured) of one part of some rows; ``bounds`` and ``stamps`` are brought up to date.

    ``bounds[row, group]`` was measured in round ``stamps[row, group]`` and leaves out
    the row's entry of that time. Ties go to the lower entry.
    """
    n, groups = bounds.shape
    far = np.iinfo(np.int64).max
    if code is None:
        code, own = np.zeros(n, np.int64), np.full(n, far)
        scan = np.ones((n, groups), bool)
        lowered = np.full((n, groups), -np.inf)
        measured = 0
    else:
        gap = x.astype(np.int64) - book[code]
        own = (gap * gap).sum(1)
        measured = n
        lowered = bounds - drops[stamps, np.arange(groups)[None, :]]
        scan = lowered <= (np.sqrt(own.astype(np.float64)) * (1 + 1e-9) + 1e-9)[:, None]
    before, before_own = code.copy(), own.copy()
    best, best_at = own.copy(), code.copy()
    first, first_at, second = (np.full((n, groups), far) for _ in range(3))
    for g in range(groups):
        some = np.flatnonzero(scan[:, g])
        if not len(some):
            continue
        base = g * GROUP
        d = nearest_in(x[some], book[base : base + GROUP])
        measured += d.size
        at = d.argmin(1)
        low = d[np.arange(len(some)), at]
        first[some, g], first_at[some, g] = low, at + base
        d[np.arange(len(some)), at] = far
        second[some, g] = d.min(1)
        nearer = (low < best[some]) | ((low == best[some]) & (at + base < best_at[some]))
        best[some] = np.where(nearer, low, best[some])
        best_at[some] = np.where(nearer, at + base, best_at[some])
    # a scanned group's bound is its nearest entry besides the row's own
    apart = np.where(first_at == best_at[:, None], second, first).astype(np.float64)
    fresh = np.where(apart >= far, np.inf, np.sqrt(apart) * (1 - 1e-6))
    bounds[scan] = np.nextafter(fresh[scan].astype(np.float32), np.float32(-np.inf))
    stamps[scan] = now
    # an entry that was a row's own and is no longer joins its group's bound, where that was not scanned
    left = np.flatnonzero((before != best_at) & (before_own < far))
    group = before[left] // GROUP
    left, group = left[~scan[left, group]], group[~scan[left, group]]
    joined = np.minimum(lowered[left, group], np.sqrt(before_own[left].astype(np.float64)) * (1 - 1e-6))
    bounds[left, group] = np.nextafter(joined.astype(np.float32), np.float32(-np.inf))
    stamps[left, group] = now
    return best_at, best, measured


def _column(a: np.ndarray, kind: pa.DataType) -> pa.Array:
    """Rows of an array as lists or binaries of equal length."""
    n, width = a.shape
    offsets = pa.array(np.arange(0, (n + 1) * width, max(width, 1))[: n + 1].astype(np.int32))
    if kind == pa.binary():
        data = np.ascontiguousarray(a, np.uint8)
        return pa.Array.from_buffers(kind, n, [None, offsets.buffers()[1], pa.py_buffer(data.tobytes())])
    return pa.ListArray.from_arrays(offsets, pa.array(np.ascontiguousarray(a).ravel(), kind))


def _bytes(column: pa.Array, width: int) -> np.ndarray:
    joined = b"".join(column.to_pylist())
    return np.frombuffer(joined, np.uint8).reshape(-1, width).astype(np.int64)


def _pass(rows: DataFrame, books: Books, first: bool, final: bool) -> DataFrame:
    """One assignment of all rows; besides their state a task gives one row of sums of each part's entries."""
    spark = rows.sparkSession
    shared = spark.sparkContext.broadcast((books.last, books.drops(), len(books.history) - 1))
    schema = "vec_id long, label string, codes binary, error long" if final else _STATE

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        book, drops, now = shared.value
        parts, entries, width = book.shape
        groups = drops.shape[-1]
        sums, counts = np.zeros((parts, entries, width), np.int64), np.zeros((parts, entries), np.int64)
        for batch in batches:
            for at in range(0, batch.num_rows, STEP):
                b = batch.slice(at, STEP)
                n = b.num_rows
                x = np.asarray(b.column("x").flatten(), np.int32).reshape(n, parts, width)
                if first:
                    codes = [None] * parts
                    bounds, stamps = np.zeros((n, parts, groups), np.float32), np.zeros((n, parts, groups), np.int64)
                else:
                    codes = list(_bytes(b.column("codes"), parts).T)
                    bounds = np.array(b.column("bounds").flatten(), np.float32).reshape(n, parts, groups)
                    stamps = _bytes(b.column("stamps"), parts * groups).reshape(n, parts, groups)
                error = np.zeros(n, np.int64)
                made = np.empty((n, parts), np.int64)
                for p in range(parts):
                    made[:, p], d, _ = assign_part(x[:, p], book[p], codes[p], bounds[:, p], stamps[:, p], drops[:, p], now)
                    error += d
                    if not final:
                        by_entry = np.argsort(made[:, p], kind="stable")
                        used, begins, many = np.unique(made[by_entry, p], return_index=True, return_counts=True)
                        sums[p, used] += np.add.reduceat(x[by_entry, p].astype(np.int64), begins, axis=0)
                        counts[p, used] += many
                same = [b.column("vec_id"), b.column("label")]
                if final:
                    state = [*same, _column(made, pa.binary()), pa.array(error)]
                else:
                    state = [
                        *same, b.column("x"), _column(made, pa.binary()),
                        _column(bounds.reshape(n, -1), pa.float32()), _column(stamps.reshape(n, -1), pa.binary()),
                        pa.nulls(n, pa.list_(pa.int64())), pa.nulls(n, pa.list_(pa.int64())), pa.array(np.zeros(n, bool)),
                    ]
                yield pa.RecordBatch.from_arrays(state, names)
        if not final and counts.any():
            empty = [pa.nulls(1, t) for t in (pa.int64(), pa.string(), pa.list_(pa.int32()), pa.binary(), pa.list_(pa.float32()), pa.binary())]
            totals = [_column(sums.reshape(1, -1), pa.int64()), _column(counts.reshape(1, -1), pa.int64())]
            yield pa.RecordBatch.from_arrays([*empty, *totals, pa.array([True])], names)

    names = ["vec_id", "label", "codes", "error"] if final else [f.split()[0] for f in _STATE.split(", ")]
    return rows.mapInArrow(assign, schema)


def _totals(sums: DataFrame, column: str) -> np.ndarray:
    """The tasks' arrays added up by position; as many rows as a codebook has numbers come back."""
    added = sums.select(F.posexplode(column).alias("at", "v")).groupBy("at").agg(F.sum("v").alias("v"))
    rows = added.toPandas().sort_values("at")
    return rows["v"].to_numpy(np.int64)


def fit(
    vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS
) -> tuple[Books, DataFrame] | None:
    """(codebooks of all rounds, the rows with their state after the last one) of ``kept_vectors``; None without rows.

    ``entries`` is at most 256, as a code is a byte.
    """
    spark = vectors.sparkSession
    order = [F.col("vec_id").asc_nulls_last(), F.col("x").asc()]
    start = [r["x"] for r in vectors.orderBy(*order).select("x").limit(entries).collect()]
    if not start:
        return None
    length = len(start[0])
    rows = vectors.where(F.size("x") == length)
    if any(len(x) != length for x in start):
        start = [r["x"] for r in rows.orderBy(*order).select("x").limit(entries).collect()]
    book = np.array(start, np.int64).reshape(len(start), parts, length // parts).transpose(1, 0, 2)
    books = Books((np.ascontiguousarray(book),))
    base = work_dir(spark, "codebooks")
    for t in range(rounds):
        path = f"{base}/{t % 2}"
        with freed_shuffles(spark):
            _pass(rows, books, first=t == 0, final=False).write.mode("overwrite").partitionBy("sums_row").parquet(path)
        written = spark.read.schema(_STATE).parquet(path)
        rows, tasks = written.where("not sums_row").drop("sums", "counts", "sums_row"), written.where("sums_row")
        counts = _totals(tasks, "counts").reshape(book.shape[:2])
        sums = _totals(tasks, "sums").reshape(book.shape)
        moved = np.floor_divide(sums, np.maximum(counts, 1)[..., None])
        books = Books((*books.history, np.where(counts[..., None] > 0, moved, books.last)))
    return books, rows


def encode(rows: DataFrame, books: Books) -> DataFrame:
    """vec_id, label, codes (a byte a part), error of rows that ``fit`` returned."""
    return _pass(rows, books, first=len(books.history) == 1, final=True)


def compress(
    table: DataFrame, id: str = "vec_id", vector: str = "embedding", label: str | None = "label",
    parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE,
) -> tuple[DataFrame, Books | None]:
    """(vec_id, label, codes, error, label_error per usable vector, the codebooks).

    ``label_error`` is the error summed over rows of an equal label, nulls together.
    Labels' sums are made map-side first, so a label of any share of the rows is
    spread; up to ``BROADCAST_LABELS`` of them are then broadcast, and beyond that
    they are joined by a shuffle, in which AQE splits a hot label's rows.
    """
    spark: SparkSession = table.sparkSession
    found = fit(kept_vectors(table, id, vector, label, parts, scale), parts, entries, rounds)
    if found is None:
        empty = "vec_id long, label string, codes binary, error long, label_error long"
        return spark.createDataFrame([], empty), None
    books, rows = found
    coded = staged(encode(rows, books), "codes")
    most = F.lit((1 << 63) - 1).cast("decimal(38,0)")
    total = F.least(F.sum(F.col("error").cast("decimal(38,0)")), most).cast("long")
    labels = staged(coded.groupBy(F.col("label").alias("_l")).agg(total.alias("label_error")), "label-errors")
    if labels.count() <= BROADCAST_LABELS:
        labels = F.broadcast(labels)
    joined = coded.join(labels, F.col("label").eqNullSafe(F.col("_l")))
    return joined.select(*coded.columns, "label_error"), books
