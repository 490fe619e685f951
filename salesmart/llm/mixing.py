"""Mixing sources to target weights along a time-varying curriculum.

Every source has a weight schedule over training time 0 to 1, linear between
knots. Its integral is the source's weight; the weights share all words, each
source up to ``max_epochs`` times its own size, and what a full source leaves is
shared again by weight. The integral up to a time, scaled to the source's
target, is the source's cumulative token demand; a document whose words start at
some cumulative count is due when demand reaches that count, so inverting demand
gives its training position. Positions then range-sort the stream.

Documents of a source stand in an order given by a hash of their id and the
seed, so reruns agree. The order goes round as often as the target asks; the
last document is taken only up to the target's last word.

Results for odd input: a null text has size 0, takes no words and has no
position; a null source is a source of its own that sorts last; rows with a null
id, and repeated rows, are documents of their own; an empty table gives an empty
mix. Columns of documents other than the key, text and source play no part.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from salesmart.llm.common import root_buckets, running_start, staged, word_count

#: Weights of sources by code point order, repeating.
WEIGHTS = (1.0, 2.0, 3.0)
#: A source's schedule as (time, share of its mean weight); one for each weight, repeating. Each integrates to 1.
SHAPES = (
    ((0.0, 1.5), (1.0, 0.5)),
    ((0.0, 1.0), (1.0, 1.0)),
    ((0.0, 0.5), (0.5, 1.0), (1.0, 1.5)),
)
MAX_EPOCHS = 3
SEED = 20


def source_ranks(sources: DataFrame, n_sources: int) -> DataFrame:
    """Adds ``rank``: a source's place by code point from 0, null last, without a window over all sources.

    Sources go to ranges; ranks count along a range and add the ranges before it.
    """
    ranges = root_buckets(n_sources)
    order = (F.col("source").isNull(), F.col("source"))
    cut = staged(
        sources.repartitionByRange(ranges, *order).withColumn("_p", F.spark_partition_id()), "mix-sources"
    )
    before = Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)
    counts = cut.groupBy("_p").agg(F.count("*").alias("_n"))
    base = counts.select(F.col("_p").alias("_q"), F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_base"))
    inside = Window.partitionBy("_p").orderBy(*order)
    ranked = cut.withColumn("_i", F.row_number().over(inside) - 1)
    return ranked.join(base, F.col("_p") == F.col("_q")).select(
        *sources.columns, (F.col("_base") + F.col("_i")).alias("rank")
    )


def default_schedules(sources: DataFrame, n_sources: int) -> DataFrame:
    """source, source_size and ``knots``: weights 1, 2, 3 repeating by code point, each along its shape."""
    knots = F.array(
        *[
            F.array(*[F.struct(F.lit(t).alias("t"), F.lit(w * mean).alias("w")) for t, w in shape])
            for mean, shape in zip(WEIGHTS, SHAPES)
        ]
    )
    return source_ranks(sources, n_sources).select(
        "source", "source_size", F.element_at(knots, (F.col("rank") % len(WEIGHTS) + 1).cast("int")).alias("knots")
    )


def _pieces(knots: Column) -> Column:
    """A schedule as linear pieces: start, length, first and last weight, and the integral up to the start."""
    pairs = F.zip_with(
        F.slice(knots, F.lit(1), F.size(knots) - 1),
        F.slice(knots, F.lit(2), F.size(knots) - 1),
        lambda a, b: F.struct(
            a["t"].alias("t"), (b["t"] - a["t"]).alias("dt"), a["w"].alias("w0"), b["w"].alias("w1"),
            ((a["w"] + b["w"]) / 2 * (b["t"] - a["t"])).alias("area"),
        ),
    )
    return F.transform(
        pairs,
        lambda p, i: F.struct(
            p["t"].alias("t"), p["dt"].alias("dt"), p["w0"].alias("w0"), p["w1"].alias("w1"), p["area"].alias("area"),
            F.aggregate(F.slice(pairs, F.lit(1), i), F.lit(0.0), lambda s, q: s + q["area"]).alias("before"),
        ),
    )


def targets(schedules: DataFrame, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """Adds ``pieces``, ``weight`` (the schedule's integral) and ``target``.

    Weights share the sum of all sizes; a source stops at ``max_epochs`` times
    its size and the excess goes to the others by weight, until none is above.
    Only three sums reach the driver in each turn, and each turn fills a source.
    """
    pieces = _pieces(F.col("knots"))
    t = staged(
        schedules.select("source", "source_size", pieces.alias("pieces")).withColumn(
            "weight", F.aggregate("pieces", F.lit(0.0), lambda s, p: s + p["area"])
        ),
        "mix-schedules",
    )
    cap = F.col("source_size") * float(max_epochs)
    total = t.agg(F.sum("source_size")).first()[0] or 0
    level = 0.0  # words for each unit of weight
    while True:
        # a source whose cap is under its share is full; the level only rises
        full = cap <= F.col("weight") * level
        filled, weight, open_cap = t.agg(
            F.sum(F.when(full, cap).otherwise(0.0)),
            F.sum(F.when(full, 0.0).otherwise(F.col("weight"))),
            F.min(F.when(full, None).otherwise(F.try_divide(cap, F.col("weight")))),
        ).first()
        if not weight:
            break
        now = (total - filled) / weight
        if now <= level or now <= (open_cap or 0.0):
            level = max(level, now)
            break
        level = now
    return t.withColumn("target", F.least(cap, F.col("weight") * level).cast("double"))


def position(demand: Column, pieces: Column) -> Column:
    """The time at which a schedule has spent the share ``demand`` (0 to 1) of its integral."""
    total = F.aggregate(pieces, F.lit(0.0), lambda s, p: s + p["area"])
    want = demand * total
    piece = F.element_at(F.filter(pieces, lambda p: (p["before"] <= want) & (p["area"] > 0)), -1)
    rest = F.greatest(want - piece["before"], F.lit(0.0))
    slope = (piece["w1"] - piece["w0"]) / piece["dt"]
    root = F.sqrt(F.greatest(piece["w0"] * piece["w0"] + 2 * slope * rest, F.lit(0.0)))
    into = F.when(piece["w0"] + root > 0, 2 * rest / (piece["w0"] + root)).otherwise(0.0)
    return F.least(piece["t"] + F.least(into, piece["dt"]), F.lit(1.0))


def mix(
    docs: DataFrame, schedules: DataFrame | None = None, *, key: str = "doc_id", text: str = "text",
    source: str = "source", max_epochs: int = MAX_EPOCHS, seed: int = SEED,
) -> DataFrame:
    """One row per document: key, source, size, source_size, target, taken and ``positions`` (one per started epoch).

    ``schedules`` has source and knots (array of struct t, w, from t 0 to 1);
    without it weights 1, 2, 3 repeat over the sources. Ordering within a source
    is by hash, in sqrt(n) buckets, so that a source of any size spreads over tasks.
    """
    narrow = staged(
        docs.select(
            F.col(key).alias("id"), F.col(source).alias("source"), word_count(F.col(text)).alias("size"),
            # 52 bits of a digest, so that the place in [0, 1) is exact and any engine can compute it
            (F.conv(F.substring(F.md5(F.concat(
                F.coalesce(F.col(key).cast("string"), F.col(text), F.lit("")), F.lit(f":{seed}"))), 1, 13), 16, 10)
             .cast("long") / float(1 << 52)).alias("place"),
        ),
        "mix-sizes",
    )
    sizes = narrow.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n"))
    sizes = staged(sizes, "mix-source-sizes")
    n_rows, n_sources = sizes.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    sizes = sizes.drop("n")
    if schedules is None:
        planned = default_schedules(sizes, n_sources)
    else:
        planned = sizes.join(
            schedules.select(F.col("source").alias("_s"), "knots"), F.col("source").eqNullSafe(F.col("_s"))
        ).drop("_s")
    goal = staged(targets(planned, max_epochs), "mix-targets")
    started = running_start(narrow, "source", "place", "size", n_rows, "start")
    rows = started.alias("d").join(goal.alias("g"), F.col("d.source").eqNullSafe(F.col("g.source")), "left").select(
        F.col("id").alias(key), F.col("d.source").alias("source"), "size", "place",
        F.coalesce("source_size", F.lit(0)).alias("source_size"), F.coalesce("target", F.lit(0.0)).alias("target"),
        "pieces", "start",
    )
    budget = F.round("target").cast("long")
    epochs = F.array(*[F.lit(e).cast("long") for e in range(max_epochs)])
    begins = F.transform(epochs, lambda e: e * F.col("source_size") + F.col("start"))
    left = F.transform(begins, lambda b: F.greatest(F.lit(0), F.least(F.col("size"), budget - b)))
    rows = rows.withColumn("taken", F.aggregate(left, F.lit(0).cast("long"), lambda s, x: s + x))
    live = F.filter(begins, lambda b: (b < budget) & (F.col("size") > 0))
    return rows.withColumn("positions", F.transform(live, lambda b: position(b / F.col("target"), F.col("pieces")))).drop(
        "pieces", "start"
    )


def by_position(mixed: DataFrame) -> DataFrame:
    """Range-sorts one row per document by its first position; documents not taken come last, by hash."""
    first = F.coalesce(F.try_element_at("positions", F.lit(1)), F.lit(2.0))
    sized = mixed.withColumn("first_position", first)
    return (
        sized.repartitionByRange("first_position", "place")
        .sortWithinPartitions("first_position", "place")
        .withColumn("first_position", F.try_element_at("positions", F.lit(1)))
    )


def training_stream(mixed: DataFrame) -> DataFrame:
    """One row per document and epoch taken, range-sorted by training position."""
    copies = mixed.select("*", F.posexplode("positions").alias("epoch", "position"))
    return copies.repartitionByRange("position", "place").sortWithinPartitions("position", "place")
