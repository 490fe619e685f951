"""Nearest neighbours by shifted space-filling curves.

Vectors are projected by a few random rotations onto ``DIMS`` axes, shifted along the
diagonal of a domain twice as wide as they fill, by another part of it for each curve,
and cut to ``BITS`` bits an axis; the Hilbert index of the cell orders them along the
curve. Neighbours that the border of a coarse cell tears apart on one curve lie inside a
cell on another. Spark range-partitions each order and cuts
it into blocks of equal size, and the queries among them into chunks of that size.
A query looks at the blocks around its own on every curve; a task compares one block
with one chunk by exact inner products, and the lists of their best merge, some at a
time, so what a task holds does not grow with the table.

How many blocks on either side is measured: for ``CALIBRATION`` queries all rows
are searched, and the window is the smallest that covers ``TARGET`` of their true
neighbours on some curve. Vectors without near neighbours need wide windows then,
rather than a loss of recall.

Equal vectors are one class with its smallest ids, so a vector that a third of
the rows share is searched once.

Results for odd input: vectors that are null, empty or zero, that hold a null or
non-finite component, or that have another length than most take no part, nor do
rows with a null id; rows with one id are one item that has the best of its
vectors' scores; equal scores go to the smaller id; with fewer candidates than
``k`` all are returned; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from salesmart.llm.common import staged

CURVES, DIMS, BITS = 3, 8, 7
BLOCK = 4_096
#: Lists of one query that merge at once.
LISTS_AT_ONCE = 256
CALIBRATION, TARGET = 128, 0.95
SEED = 11


def rotations(length: int, curves: int = CURVES, dims: int = DIMS) -> tuple[np.ndarray, np.ndarray]:
    """(curves, length, dims) with orthonormal columns, and each curve's shift along every axis, as a part of the domain."""
    rng = np.random.default_rng(SEED)
    dims = min(dims, length)
    axes = np.stack([np.linalg.qr(rng.standard_normal((length, length)))[0][:, :dims] for _ in range(curves)])
    return axes, np.repeat(np.arange(curves) / (curves + 1), dims).reshape(curves, dims)


def hilbert_index(cells: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Index along the Hilbert curve of rows of cell numbers below ``2 ** bits``."""
    x = cells.astype(np.int64).T.copy()
    n = len(x)
    q = 1 << (bits - 1)
    while q > 1:  # undo the rotations of the higher levels
        p = q - 1
        for i in range(n):
            high = (x[i] & q) != 0
            t = np.where(high, 0, (x[0] ^ x[i]) & p)
            x[0] = np.where(high, x[0] ^ p, x[0] ^ t)
            x[i] ^= t
        q >>= 1
    for i in range(1, n):  # Gray code
        x[i] ^= x[i - 1]
    t = np.zeros_like(x[0])
    q = 1 << (bits - 1)
    while q > 1:
        t = np.where((x[n - 1] & q) != 0, t ^ (q - 1), t)
        q >>= 1
    x ^= t
    out = np.zeros(x.shape[1], np.int64)
    for b in range(bits - 1, -1, -1):
        for i in range(n):
            out = (out << 1) | ((x[i] >> b) & 1)
    return out


def curve_keys(vectors: np.ndarray, axes: np.ndarray, shifts: np.ndarray, scale: np.ndarray) -> np.ndarray:
    """(rows, curves) Hilbert indexes; half an axis spans four of its standard deviations either way."""
    out = np.empty((len(vectors), len(axes)), np.int64)
    cells = 1 << BITS
    for c, (a, s) in enumerate(zip(axes, shifts)):
        at = np.clip(vectors @ a / (scale[c] + 1e-300) / 8 + 0.5, 0, 1) * (cells / 2 - 1) + s * cells
        out[:, c] = hilbert_index(np.minimum(at, cells - 1))
    return out


def usable(vectors: DataFrame, key: str, vector: str) -> DataFrame:
    """id and v of the rows that take part, v as doubles."""
    v = F.col("v")
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(v, lambda x: x != 0)
    rows = vectors.select(F.col(key).alias("id"), F.col(vector).cast("array<double>").alias("v")).where(
        F.col("id").isNotNull() & v.isNotNull() & (F.size(v) > 0) & fine
    )
    lengths = rows.groupBy(F.size("v").alias("length")).agg(F.count("*").alias("n"))
    common = lengths.orderBy(F.desc("n"), "length").limit(1).collect()
    return rows.where(F.size("v") == common[0]["length"]) if common else rows.where("false")


def _matrix(column: pa.Array) -> np.ndarray:
    n = len(column)
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(n, -1)


def best_of(queries: np.ndarray, vectors: np.ndarray, ids: np.ndarray, k: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each query (ids, scores) of the ``k`` best vectors, best first, ties to the smaller id."""
    out = []
    longest = np.sqrt((vectors**2).sum(axis=1).max(initial=0))
    for lo in range(0, len(queries), 256):
        q = queries[lo : lo + 256]
        rough = q @ vectors.T
        if k < len(vectors):
            # all that tie with the kth; the product's rounding may swap scores that are nearly equal
            margin = 4 * vectors.shape[1] * np.finfo(np.float64).eps * longest * np.sqrt((q**2).sum(axis=1))
            least = np.partition(rough, len(vectors) - k, axis=1)[:, len(vectors) - k] - margin
        else:
            least = np.full(len(q), -np.inf)
        for row, near in zip(q, ~(rough < least[:, None])):
            at = np.flatnonzero(near)
            scores = (vectors[at] * row).sum(axis=1)
            order = np.lexsort((ids[at], -scores))[:k]
            out.append((ids[at][order], scores[order]))
    return out


def _pairs(frame: DataFrame) -> DataFrame:
    return frame.select("q", F.explode(F.arrays_zip("ids", "scores")).alias("p")).select(
        "q", F.col("p.ids").alias("c"), F.col("p.scores").alias("score")
    )


def _top(frame: DataFrame, k: int) -> DataFrame:
    """The ``k`` best c of each q."""
    order = Window.partitionBy("q").orderBy(F.desc("score"), "c")
    return frame.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def search(
    vectors: DataFrame, is_query, *, key: str = "vec_id", vector: str = "embedding", k: int = 20,
    block: int = BLOCK, target: float = TARGET, calibration: int = CALIBRATION,
) -> DataFrame:
    """query_id, rank, vec_id, score: the ``k`` nearest rows found for every row where ``is_query`` (of its id) holds."""
    spark = vectors.sparkSession
    reach = k + 1  # one of them may be the query itself
    rows = usable(vectors, key, vector)
    # of equal vectors the smallest ids; Spark limits them in each task before the shuffle
    smallest = Window.partitionBy("v").orderBy("id")
    member = rows.withColumn("r", F.dense_rank().over(smallest)).where(F.col("r") <= reach)
    classes = member.groupBy("v").agg(F.sort_array(F.collect_set("id")).alias("ids"))
    asked = rows.where(is_query(F.col("id"))).distinct()
    classes = staged(
        classes.join(asked.select(F.col("v").alias("_v")).distinct().withColumn("asked", F.lit(True)), F.col("v") == F.col("_v"), "left")
        .select(F.element_at("ids", 1).alias("c"), "ids", "v", F.coalesce("asked", F.lit(False)).alias("asked")),
        "ann-classes",
    )
    first = classes.select("v").first()
    shape = "query_id long, rank int, vec_id long, score double"
    if first is None:
        return spark.createDataFrame([], shape)
    axes, shifts = rotations(len(first["v"]))

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = np.zeros(axes.shape[::2]), 0
        for b in batches:
            v = _matrix(b.column("v"))
            total += np.stack([((v @ a) ** 2).sum(axis=0) for a in axes])
            n += len(v)
        yield pa.RecordBatch.from_arrays([pa.array([total.ravel()], pa.list_(pa.float64())), pa.array([n])], names=["s", "n"])

    sums = classes.select("v").mapInArrow(spread, "s array<double>, n long")
    folded = sums.select(F.posexplode("s").alias("i", "x"), "n").groupBy("i").agg(F.sum("x").alias("x"), F.sum("n").alias("n"))
    scale = np.array([np.sqrt(r["x"] / r["n"]) for r in folded.orderBy("i").collect()]).reshape(axes.shape[::2])
    n_classes = classes.count()
    blocks = -(-n_classes // block)

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keys = curve_keys(_matrix(b.column("v")), axes, shifts, scale)
            for c in range(len(axes)):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(b), c, np.int32)), pa.array(keys[:, c]), b.column("c"), b.column("v"), b.column("asked")],
                    names=["curve", "key", "c", "v", "asked"],
                )

    lined = classes.select("c", "v", "asked").mapInArrow(keyed, "curve int, key long, c long, v array<double>, asked boolean")
    parts = max(CURVES, min(blocks * CURVES, 10_000))
    cut = staged(
        lined.repartitionByRange(parts, "curve", "key", "c").withColumn("_p", F.spark_partition_id()), "ann-curves"
    )
    is_asked = F.col("asked").cast("long")
    counts = cut.groupBy("curve", F.col("_p").alias("_q")).agg(F.count("*").alias("n"), F.sum(is_asked).alias("n_asked"))
    earlier = Window.partitionBy("curve").orderBy("_q").rowsBetween(Window.unboundedPreceding, -1)
    base = counts.select(
        F.col("curve").alias("_c"), "_q",
        F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("base"),
        F.coalesce(F.sum("n_asked").over(earlier), F.lit(0)).alias("base_asked"),
    )
    inside = Window.partitionBy("curve", "_p").orderBy("key", "c")
    placed = staged(
        cut.withColumn("_i", F.row_number().over(inside) - 1).withColumn("_a", F.sum(is_asked).over(inside) - is_asked)
        .join(base, (F.col("curve") == F.col("_c")) & (F.col("_p") == F.col("_q")))
        .select(
            "curve", F.floor((F.col("base") + F.col("_i")) / block).cast("long").alias("block"),
            F.floor((F.col("base_asked") + F.col("_a")) / block).cast("long").alias("chunk"), "c", "v", "asked",
        ),
        "ann-blocks",
    )

    window = _window(classes, placed, reach, target, calibration) if blocks > 1 else 0

    def around(first: str, last: str) -> Column:
        return F.sequence(
            F.greatest(F.col(first) - window, F.lit(0).cast("long")), F.least(F.col(last) + window, F.lit(blocks - 1).cast("long"))
        )

    queries = placed.where("asked").select(
        F.col("curve").alias("on_curve"), F.explode(around("block", "block")).alias("at_block"), F.col("chunk").alias("in_chunk"),
        F.col("c").alias("q"), F.col("v").alias("wanted"),
    )
    # a block goes to each chunk whose windows reach it
    spans = placed.where("asked").groupBy("curve", "chunk").agg(F.min("block").alias("lo"), F.max("block").alias("hi"))
    reached = staged(
        spans.select(F.col("curve").alias("_c"), F.col("chunk").alias("for_chunk"), F.explode(around("lo", "hi")).alias("_b")), "ann-reached"
    )
    sides = placed.select("curve", "block", "c", "v").join(
        reached, (F.col("curve") == F.col("_c")) & (F.col("block") == F.col("_b"))
    ).select("curve", "block", "for_chunk", "c", "v")
    list_schema = "q long, part long, ids array<long>, scores array<double>"

    def compare(key: tuple, group: pd.DataFrame, wanted: pd.DataFrame) -> pd.DataFrame:
        if not len(group) or not len(wanted):
            return pd.DataFrame({"q": [], "part": [], "ids": [], "scores": []})
        found = best_of(np.stack(wanted["wanted"]), np.stack(group["v"]), group["c"].to_numpy(), reach)
        part = int(key[0]) * blocks + int(key[1])
        return pd.DataFrame({"q": wanted["q"], "part": part, "ids": [i for i, _ in found], "scores": [s for _, s in found]})

    merged = (
        sides.groupBy("curve", "block", "for_chunk")
        .cogroup(queries.groupBy("on_curve", "at_block", "in_chunk"))
        .applyInPandas(compare, list_schema)
    )

    def merge(key: tuple, found: pd.DataFrame) -> pd.DataFrame:
        ids, scores = np.concatenate(list(found["ids"])), np.concatenate(list(found["scores"]))
        ids, at = np.unique(ids, return_index=True)  # curves find one vector again and again
        order = np.lexsort((ids, -scores[at]))[:reach]
        return pd.DataFrame({"q": [key[0]], "part": [key[1]], "ids": [ids[order]], "scores": [scores[at][order]]})

    # a query has one list for each of the blocks in its windows
    parts_left = len(axes) * blocks
    while parts_left > 0:
        merged = merged.withColumn("part", F.expr(f"part div {LISTS_AT_ONCE}")).groupBy("q", "part").applyInPandas(merge, list_schema)
        parts_left = -(-parts_left // LISTS_AT_ONCE) if parts_left > LISTS_AT_ONCE else 0
    near = _pairs(merged).select("q", "c", "score")
    members = classes.select(F.col("c").alias("_c"), F.explode("ids").alias("vec_id"))
    # of a class the smallest ids stand for all, as there are enough of them
    listed = staged(
        _rank(near.join(members, F.col("c") == F.col("_c")).select("q", "vec_id", "score"), "q", reach).select("q", "vec_id", "score"),
        "ann-lists",
    )
    owners = asked.join(classes.select(F.col("v").alias("_v"), F.col("c").alias("_q")), F.col("v") == F.col("_v")).select(
        F.col("id").alias("query_id"), F.col("_q")
    )
    answers = owners.join(listed, F.col("_q") == F.col("q")).where("vec_id <> query_id")
    best = answers.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    return _rank(best, "query_id", k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def _rank(frame: DataFrame, by: str, k: int) -> DataFrame:
    order = Window.partitionBy(by).orderBy(F.desc("score"), "vec_id")
    return frame.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _window(classes: DataFrame, placed: DataFrame, reach: int, target: float, calibration: int) -> int:
    """Blocks on either side of a query's own that hold ``target`` of the true neighbours of some queries."""
    sc = classes.sparkSession.sparkContext
    sample = classes.where("asked").orderBy(F.xxhash64("c")).select("c", "v").limit(calibration).collect()
    if not sample:
        return 0
    shared = sc.broadcast((np.array([r["c"] for r in sample]), np.array([r["v"] for r in sample])))

    def exact(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        q, v = shared.value
        for b in batches:
            if not len(b):
                continue
            found = best_of(v, _matrix(b.column("v")), b.column("c").to_numpy(), reach)
            yield pa.RecordBatch.from_arrays(
                [pa.array(q), pa.array([i for i, _ in found], pa.list_(pa.int64())), pa.array([s for _, s in found], pa.list_(pa.float64()))],
                names=["q", "ids", "scores"],
            )

    scanned = classes.select("c", "v").mapInArrow(exact, "q long, ids array<long>, scores array<double>")
    true = _top(_pairs(scanned), reach).select("q", "c")
    at = placed.select("curve", "block", F.col("c").alias("of"))
    a, b = at.alias("a"), at.alias("b")
    apart = (
        true.join(a, F.col("q") == F.col("a.of")).join(b, (F.col("c") == F.col("b.of")) & (F.col("a.curve") == F.col("b.curve")))
        .groupBy("q", "c").agg(F.min(F.abs(F.col("a.block") - F.col("b.block"))).alias("apart"))
    )
    # a row for each true neighbour of the sample, less those that are the query itself
    counts = apart.where("q <> c").groupBy("apart").agg(F.count("*").alias("n")).orderBy("apart").collect()
    total, seen = sum(r["n"] for r in counts), 0
    for r in counts:
        seen += r["n"]
        if seen >= target * total:
            return int(r["apart"])
    return 0
