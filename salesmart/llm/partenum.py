"""N-gram Jaccard join by PartEnum signatures, and its groups of linked documents.

A document is the set of its word shingles. Two sets of similarity at least
``num / den`` differ in few shingles for their size, and sizes that far apart fall
into the same or neighbouring bands. For a band the shingle domain is split into
first-level partitions, by hash; one in which two sets differ at most once is
sure to exist. Each is split again, and every subset of its second-level parts
that leaves one out is a signature: two similar sets share one. Signatures that
fall together are candidates, and candidates are verified on their sets.

* Equal sets are one node, and a task sends a set's signatures once.
* A projection without shingles is no signature. A set uses its partitions in a
  fixed order until enough of them are filled (``differ // 2 + 1``); of any two
  similar sets at least one such partition then serves both.
* Shingles that very many documents hold are left out of the domain, as
  differences can only get fewer. Sets that fill too few partitions then, being
  small or mostly made of such shingles, have their rarest shingles as signatures
  besides, as many as make sure that two similar sets share one. The list of
  frequent shingles changes the work, never the result.
* Candidates of a signature meet its smallest node, so that a group of thousands
  of near copies costs about as many comparisons as it has members. Only where
  this leaves a signature's nodes in different groups are they compared further:
  few of them pair by pair; many, together with those of signatures that share
  nodes with theirs, in blocks of bounded size and sets of like size, each pair of
  blocks whose sizes allow it as one matrix product of sketches in a task, which
  compares the sets that this leaves and returns only links that hold its groups together.
* Before the sets of candidates meet, their parity sketches do: bits that the odd
  number of their shingles sets. Two sketches differ in no more bits than the sets
  in shingles, so that only pairs go that can't be similar. A sketch grows with its
  set and is about a 50th of it.

Results for odd input: a null text, and one without words, is an empty set, linked
with nothing; one with fewer words than a shingle has its whole sequence as one;
texts are read whole; repeated rows are equal sets; a null id stands behind all
others and is the group's only if no other is there; an empty table stays empty;
other columns play no part.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from salesmart.llm.common import in_small_batches, staged
from salesmart.llm.components import components
from salesmart.llm.textarrow import mix64, steps, utf8, words

WORDS, NUM, DEN = 5, 80, 100
#: Second-level parts of a partition; a signature leaves one out.
PARTS = 2
#: Partitions are this many times those needed, so that enough of them are filled.
SLACK = 1.25
#: Sizes of a band grow by this factor.
BAND = 1.5
#: Share of documents from which a shingle is left out of the domain, and how many such shingles are broadcast at most.
FREQUENT, FREQUENT_MOST = 0.001, 1_000_000
#: Nodes of one signature that are compared pair by pair, once its smallest node has met all.
FEW = 64
#: Shingles of a block of nodes (and one set more at most).
BLOCK_SHINGLES = 300_000
#: Rows of a block whose sketches are held against all others at once.
STEP_ROWS = 256
#: Rows of two numbers each that are broadcast at most; more are joined by a shuffle.
BROADCAST_ROWS = 500_000
#: A node counts as this many shingles at least, which bounds the nodes of a block.
NODE_SHINGLES = 150
#: Bits of the smallest sketch; larger ones have the next power of two above the set's size.
SKETCH_BITS = 512
_K1, _K2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)


def differ(size: int, num: int, den: int) -> int:
    """Shingles in which a set of ``size`` and a similar one differ at most."""
    return size * (den - num) // num


def bands(size: int, num: int, den: int) -> list[tuple[int, int]]:
    """(number, largest size) of the bands that a set of ``size`` has signatures for.

    Its own, and the next one if a similar set can be that large.
    """
    number, low, factor = 0, 1, max(BAND, den / num)
    while True:
        above = max(low + 1, int(np.ceil(low * factor)))
        if size < above:
            break
        number, low = number + 1, above
    out = [(number, above - 1)]
    if size * den >= num * above:
        out.append((number + 1, max(above + 1, int(np.ceil(above * factor))) - 1))
    return out


def distinct(x: np.ndarray) -> np.ndarray:
    x = np.sort(x)
    keep = np.ones(len(x), bool)
    keep[1:] = x[1:] != x[:-1]
    return x[keep]


def shingle_sets(data: np.ndarray, offsets: np.ndarray, row: int, end: int, n_words: int) -> Iterator[np.ndarray]:
    """The sorted distinct 64-bit shingles of each of the rows row to end."""
    h, owner = words(data, offsets, row, end)
    n = max(0, len(h) - n_words + 1)
    mixed = h[:n].copy()
    for i in range(1, n_words):
        mixed = mixed * _K1 + h[i : n + i]
    whole = owner[:n] == owner[n_words - 1 : n + n_words - 1]
    mixed, of = mix64(mixed[whole]), owner[:n][whole]
    cuts = np.searchsorted(of, np.arange(row, end + 1))
    spots = np.searchsorted(owner, np.arange(row, end + 1))
    for i in range(end - row):
        if cuts[i] < cuts[i + 1]:
            yield distinct(mixed[cuts[i] : cuts[i + 1]])
        elif spots[i] < spots[i + 1]:
            short = np.uint64(0)
            for x in h[spots[i] : spots[i + 1]]:
                short = np.uint64((int(short) * int(_K1) + int(x)) & 0xFFFFFFFFFFFFFFFF)
            yield mix64(np.array([short ^ np.uint64(spots[i + 1] - spots[i])], np.uint64))
        else:
            yield np.zeros(0, np.uint64)


def set_id(e: np.ndarray) -> int:
    """A 64-bit number of the whole set, signed."""
    total = (int(np.add.reduce(mix64(e ^ _K2))) if len(e) else 0) + len(e)
    total = total * int(_K1) & 0xFFFFFFFFFFFFFFFF
    total ^= total >> 32
    return total - (1 << 64) if total >> 63 else total


def sketch(e: np.ndarray) -> bytes:
    """A bit for each place that an odd number of the shingles falls to."""
    bits = max(SKETCH_BITS, 1 << (len(e) - 1).bit_length()) if len(e) else SKETCH_BITS
    places = (e & np.uint64(bits - 1)).astype(np.int64)
    return np.packbits((np.bincount(places, minlength=bits) & 1).astype(np.uint8), bitorder="little").tobytes()


def sketches_differ(a: bytes, b: bytes) -> int:
    """Bits in which two sketches differ: at most as many as the sets differ in shingles."""
    x, y = np.frombuffer(a, np.uint8), np.frombuffer(b, np.uint8)
    if len(x) < len(y):
        x, y = y, x
    # the larger one folds: places of the smaller are the low bits of its own
    x = np.bitwise_xor.reduce(x.reshape(-1, len(y)), axis=0)
    return int(np.unpackbits(x ^ y).sum())


# What a task works out once: of each domain, and of each size of a set. Bands bound the first, ``_PLANS_MOST`` the second.
_LAYOUTS: dict[int, tuple[int, np.ndarray]] = {}
_PLANS: dict[tuple[int, int, int], tuple[int, list[tuple[int, int]]]] = {}
_PLANS_MOST = 100_000


def _layout(tag: int, partitions: int) -> tuple[int, np.ndarray]:
    """The domain's hash of a tag, and a number for each partition and subset of its parts."""
    if tag not in _LAYOUTS or len(_LAYOUTS[tag][1]) != partitions:
        seed = mix64(np.array([tag, tag + 1], np.uint64))
        place = np.arange(partitions * PARTS, dtype=np.uint64)
        _LAYOUTS[tag] = int(seed[0]), mix64(place ^ seed[1]).reshape(partitions, PARTS)
    return _LAYOUTS[tag]


def _band_signatures(e: np.ndarray, values: np.ndarray, need: int, partitions: int, tag: int) -> tuple[np.ndarray, bool]:
    """Signatures of a set in one band, and whether enough partitions were filled; ``values`` are hashes of the shingles."""
    seed, names = _layout(tag, partitions)
    u = (e ^ np.uint64(seed)) * _K2
    u ^= u >> np.uint64(32)
    u *= _K1
    # the high half picks the cell; cells of a partition are neighbours
    cell = (((u >> np.uint64(32)) * np.uint64(partitions * PARTS)) >> np.uint64(32)).astype(np.int64)
    sums = np.zeros(partitions * PARTS, np.uint64)
    np.add.at(sums, cell, values)
    sums = sums.reshape(partitions, PARTS)
    filled = np.bincount(cell, minlength=partitions * PARTS).reshape(partitions, PARTS) > 0
    reached = np.cumsum(np.count_nonzero(filled, axis=1) >= 2)
    enough = bool(reached[-1] >= need)
    upto = int(np.searchsorted(reached, need)) + 1 if enough else partitions
    out = []
    for k, kept in enumerate(combinations(range(PARTS), PARTS - 1)):
        value = sums[:upto, kept[0]]
        some = filled[:upto, kept[0]]
        for c in kept[1:]:
            value = value * _K1 + sums[:upto, c]
            some = some | filled[:upto, c]
        out.append(((value ^ names[:upto, k]) * _K1)[some])
    return np.concatenate(out), enough


def _plan(size: int, num: int, den: int) -> tuple[int, list[tuple[int, int]]]:
    """(partitions needed, (band, partitions) of each band) of a set of ``size``."""
    key = (size, num, den)
    if key not in _PLANS:
        if len(_PLANS) >= _PLANS_MOST:
            _PLANS.clear()
        _PLANS[key] = differ(size, num, den) // 2 + 1, [
            (number, int(np.ceil(SLACK * (differ(largest, num, den) // 2 + 1))) + 1)
            for number, largest in bands(size, num, den)
        ]
    return _PLANS[key]


def signatures(e: np.ndarray, num: int, den: int, frequent: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """All signatures of a set; none if no other set can be similar to it.

    ``frequent`` are the shingles of most documents, in order, and ``counts`` of how many.
    """
    size = len(e)
    if not differ(size, num, den):
        return np.zeros(0, np.uint64)
    rare, often = e, np.zeros(0, np.int64)
    if len(frequent):
        at = np.searchsorted(frequent, e)
        at[at == len(frequent)] = 0
        found = frequent[at] == e
        rare, often = e[~found], at[found]
    values = mix64(rare ^ _K1)
    out, enough = [], True
    need, plan = _plan(size, num, den)
    for number, partitions in plan:
        sig, filled = _band_signatures(rare, values, need, partitions, number * 2 + 2)
        out.append(sig)
        enough &= filled
    if not enough:
        # rare shingles in order of their numbers, then frequent ones from the least frequent on
        prefix = size - -(-num * size // den) + 1
        order = np.lexsort((often, counts[often]))
        out.append(mix64(np.concatenate([rare, frequent[often[order]]])[:prefix] ^ _K2))
    return np.concatenate(out)


def _only(frame: DataFrame, ids: DataFrame, on: Column) -> DataFrame:
    """Rows of ``frame`` that match some of ``ids``, which are broadcast if they are few."""
    ids = staged(ids.distinct(), "ids")
    return frame.join(F.broadcast(ids) if ids.count() <= BROADCAST_ROWS else ids, on, "left_semi")


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64))


def _texts(docs: DataFrame, key: str, text: str) -> DataFrame:
    return docs.select(F.col(key).alias("id"), F.col(text).alias("text"), F.xxhash64(F.col(text)).alias("text_hash"))


def document_sets(docs: DataFrame, key: str, text: str, n_words: int) -> tuple[DataFrame, DataFrame]:
    """(id, text_hash, n, fp of every document; shingle and number of documents, for shingles frequent in some task)."""
    window = 2_000_000  # shingles that are counted at once
    id_type = docs.schema[key].dataType.simpleString()
    names = ["kind", "id", "text_hash", "n", "fp"]

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, held_size, held_docs = [], 0, 0

        def frequent() -> pa.RecordBatch:
            shingles, counts = np.unique(np.concatenate(held), return_counts=True)
            some = counts >= max(2, FREQUENT * held_docs)
            k = int(some.sum())
            return pa.RecordBatch.from_arrays(
                [pa.array(np.ones(k, np.int32)), pa.nulls(k, id_kind), pa.nulls(k, pa.int64()),
                 pa.array(counts[some].astype(np.int64)), _signed(shingles[some])], names=names,
            )

        id_kind = None
        for b in batches:
            id_kind = b.column("id").type
            data, offsets = utf8(b.column("text"))
            n, fp = np.zeros(len(b), np.int64), np.zeros(len(b), np.int64)
            for row, end in steps(offsets):
                for i, e in enumerate(shingle_sets(data, offsets, row, end, n_words), row):
                    n[i], fp[i] = len(e), set_id(e)
                    held.append(e)
                    held_size, held_docs = held_size + len(e), held_docs + 1
                if held_size > window:
                    yield frequent()
                    held, held_size, held_docs = [], 0, 0
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.zeros(len(b), np.int32)), b.column("id"), b.column("text_hash"), pa.array(n), pa.array(fp)], names=names
            )
        if held:
            yield frequent()

    measured = staged(
        _texts(docs, key, text).mapInArrow(measure, f"kind int, id {id_type}, text_hash long, n long, fp long"),
        "sets", partition_by="kind",
    )
    rows = measured.where("kind = 0").select("id", "text_hash", "n", "fp")
    counts = measured.where("kind = 1").groupBy(F.col("fp").alias("shingle")).agg(F.sum("n").alias("docs"))
    return rows, counts


def _candidates(docs: DataFrame, text: str, n_words: int, num: int, den: int, frequent: tuple[np.ndarray, np.ndarray]) -> DataFrame:
    """sig, hub, fp: of each signature with several nodes its smallest one, with each of the others."""
    shared = docs.sparkSession.sparkContext.broadcast(frequent)

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done: set[int] = set()
        for b in batches:
            data, offsets = utf8(b.column("text"))
            for row, end in steps(offsets):
                sigs, fps, sizes = [], [], []
                for e in shingle_sets(data, offsets, row, end, n_words):
                    fp = set_id(e)
                    if fp in done:
                        continue
                    done.add(fp)
                    s = signatures(e, num, den, *shared.value)
                    sigs.append(s)
                    fps.append(fp)
                    sizes.append(len(s))
                if fps:
                    yield pa.RecordBatch.from_arrays(
                        [_signed(np.concatenate(sigs)), pa.array(np.repeat(np.array(fps, np.int64), sizes))], names=["sig", "fp"]
                    )

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last_sig = last_fp = hub = None
        for b in batches:
            sig, fp = b.column("sig").to_numpy(), b.column("fp").to_numpy()
            if not len(sig):
                continue
            new = np.ones(len(sig), bool)
            new[1:] = sig[1:] != sig[:-1]
            repeat = np.zeros(len(sig), bool)
            repeat[1:] = ~new[1:] & (fp[1:] == fp[:-1])
            if last_sig == sig[0]:
                new[0] = False
                repeat[0] = fp[0] == last_fp
            start = np.maximum.accumulate(np.where(new, np.arange(len(sig)), -1))
            hubs = np.where(start >= 0, fp[np.maximum(start, 0)], hub if hub is not None else 0)
            other = np.flatnonzero((hubs != fp) & ~repeat)
            last_sig, last_fp, hub = sig[-1], fp[-1], hubs[-1]
            if len(other):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(sig[other]), pa.array(hubs[other]), pa.array(fp[other])], names=["sig", "hub", "fp"]
                )

    signed = docs.select(F.col(text).alias("text")).mapInArrow(sign, "sig long, fp long")
    lined = signed.repartition("sig").sortWithinPartitions("sig", "fp")
    return staged(lined.mapInArrow(meet, "sig long, hub long, fp long"), "candidates")


def _node_sets(docs: DataFrame, key: str, text: str, n_words: int, rows: DataFrame, nodes: DataFrame) -> DataFrame:
    """fp, n, sketch and shingles of the nodes, each from one of its documents."""
    first = F.min(F.struct(F.col("id").isNull().alias("no_id"), "id", "text_hash")).alias("d")
    place = rows.join(nodes, "fp", "left_semi").groupBy("fp").agg(first).select(
        F.col("d.id").alias("_id"), F.col("d.text_hash").alias("_hash")
    )
    wanted = _only(
        _texts(docs, key, text), place, F.col("id").eqNullSafe(F.col("_id")) & F.col("text_hash").eqNullSafe(F.col("_hash"))
    )

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done: set[int] = set()
        for b in batches:
            data, offsets = utf8(b.column("text"))
            for row, end in steps(offsets):
                sets = {fp: e for e in shingle_sets(data, offsets, row, end, n_words) if (fp := set_id(e)) not in done}
                done |= sets.keys()
                if not sets:
                    continue
                kept = list(sets.values())
                sizes = np.array([len(e) for e in kept])
                lists = pa.ListArray.from_arrays(
                    pa.array(np.concatenate([[0], np.cumsum(sizes)]), pa.int32()), _signed(np.concatenate(kept))
                )
                yield pa.RecordBatch.from_arrays(
                    [pa.array(list(sets)), pa.array(sizes), pa.array([sketch(e) for e in kept], pa.binary()), lists],
                    names=["fp", "n", "sketch", "shingles"],
                )

    read_schema = "fp long, n long, sketch binary, shingles array<long>"
    return staged(wanted.select("text").mapInArrow(read, read_schema), "node-sets")


def _possible(pairs: DataFrame, sets: DataFrame, num: int, den: int) -> DataFrame:
    """The pairs (hub, fp) that sizes and sketches leave."""
    a = sets.select(F.col("fp").alias("_h"), F.col("n").alias("m"), F.col("sketch").alias("other"))
    sized = pairs.join(sets.select("fp", "n", "sketch"), "fp").join(a, F.col("hub") == F.col("_h"))
    alike = sized.where(F.least("n", "m") * den >= F.greatest("n", "m") * num)

    def sift(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            most = (b.column("n").to_numpy() + b.column("m").to_numpy()) * (den - num)
            rows = zip(b.column("sketch").to_pylist(), b.column("other").to_pylist(), strict=True)
            ok = [sketches_differ(x, y) * (den + num) <= most[i] for i, (x, y) in enumerate(rows)]
            yield b.select(["hub", "fp"]).filter(pa.array(ok, pa.bool_()))

    sifted = alike.select("hub", "fp", "n", "m", "sketch", "other").mapInArrow(sift, "hub long, fp long")
    return staged(sifted, "possible")


def _verified(pairs: DataFrame, sets: DataFrame, num: int, den: int) -> DataFrame:
    """The pairs (hub, fp) that are similar."""
    pairs = _possible(pairs, sets, num, den)
    some = _only(sets, pairs.select(F.col("fp").alias("_f")), F.col("fp") == F.col("_f"))
    hubs = _only(sets, pairs.select(F.col("hub").alias("_f")), F.col("fp") == F.col("_f"))
    a = hubs.select(F.col("fp").alias("_h"), F.col("shingles").alias("others"))
    met = pairs.join(some, "fp").join(a, F.col("hub") == F.col("_h")).select("hub", "fp", "shingles", "others")

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x, y = b.column("shingles"), b.column("others")
            xo, yo = x.offsets.to_numpy(), y.offsets.to_numpy()
            xv, yv = x.values.to_numpy().view(np.uint64), y.values.to_numpy().view(np.uint64)
            ok = np.zeros(len(b), bool)
            for i in range(len(b)):
                p, q = xv[xo[i] : xo[i + 1]], yv[yo[i] : yo[i + 1]]
                at = np.searchsorted(q, p)
                at[at == len(q)] = 0
                both = int((q[at] == p).sum())
                ok[i] = both * den >= (len(p) + len(q) - both) * num
            yield b.select(["hub", "fp"]).filter(pa.array(ok))

    return staged(met.mapInArrow(check, "hub long, fp long").distinct(), "links")


def similar_steps(
    fp: np.ndarray, n: np.ndarray, offsets: np.ndarray, values: np.ndarray, num: int, den: int
) -> Iterator[tuple[int, np.ndarray]]:
    """Walks each group of similar sets from its smallest node: a place, and those that it reaches first.

    Parity sketches, all against all as one matrix product, leave the pairs whose sets are compared.
    """
    bits = max(SKETCH_BITS, 1 << int(n.mean()).bit_length()) if len(n) else SKETCH_BITS
    values = values[offsets[0] : offsets[-1]]
    owner = np.repeat(np.arange(len(n)), n)
    place = owner * bits + (values & (bits - 1))
    odd = (np.bincount(place, minlength=len(n) * bits) & 1).astype(np.float32).reshape(len(n), bits)
    ones = odd.sum(axis=1)
    maybe = np.empty((len(n), len(n)), bool)
    for lo in range(0, len(n), STEP_ROWS):
        rows = slice(lo, lo + STEP_ROWS)
        # bits in which two sketches differ, at most the shingles in which their sets do; a little more is let through than floats round
        apart = ones[rows, None] + ones[None, :] - 2 * (odd[rows] @ odd.T)
        maybe[rows] = apart * (den + num) <= (n[rows, None] + n[None, :]) * (den - num) * (1 + 1e-5) + 1
    del odd
    start = offsets - offsets[0]
    left = np.ones(len(n), bool)
    for first in np.argsort(fp, kind="stable"):
        ahead = [int(first)] if left[first] else []
        left[first] = False
        while ahead:
            i = ahead.pop()
            small, large = np.minimum(n, n[i]), np.maximum(n, n[i])
            some = np.flatnonzero(left & maybe[i] & (small * den >= large * num))
            if not len(some):
                continue
            own = np.sort(values[start[i] : start[i + 1]])
            theirs = np.concatenate([values[start[j] : start[j + 1]] for j in some])
            at = np.searchsorted(own, theirs)
            at[at == len(own)] = 0
            shares = np.add.reduceat((own[at] == theirs).astype(np.int64), np.concatenate([[0], np.cumsum(n[some])[:-1]]))
            near = some[shares * den >= (n[i] + n[some] - shares) * num]
            left[near] = False
            ahead += near.tolist()
            yield i, near


def _block_links(nodes: DataFrame, sets: DataFrame, num: int, den: int) -> DataFrame:
    """Pairs (hub, fp) that hold together what is similar among the nodes (cluster, fp) of each cluster."""
    # blocks by size: only those that lie near enough can hold similar sets
    along = Window.partitionBy("cluster").orderBy("n", "fp").rowsBetween(Window.unboundedPreceding, -1)
    weight = F.greatest("n", F.lit(NODE_SHINGLES))
    sized = nodes.join(sets.select("fp", "n"), "fp").withColumn(
        "block", F.floor(F.coalesce(F.sum(weight).over(along), F.lit(0)) / BLOCK_SHINGLES).cast("int")
    )
    sized = staged(sized, "blocks")
    blocks = sized.groupBy("cluster", F.col("block").alias("a")).agg(F.max("n").alias("largest"))
    others = sized.groupBy(F.col("cluster").alias("_c"), F.col("block").alias("b")).agg(F.min("n").alias("smallest"))
    near = (F.col("a") == F.col("b")) | ((F.col("a") < F.col("b")) & (F.col("largest") * den >= F.col("smallest") * num))
    met = blocks.join(others, (F.col("cluster") == F.col("_c")) & near).select(F.col("cluster").alias("_c"), "a", "b")
    met = staged(met, "block-pairs")
    sides = met.withColumn("_b", F.col("a")).union(met.where("a < b").withColumn("_b", F.col("b")))
    dealt = sized.drop("n").join(sides, (F.col("cluster") == F.col("_c")) & (F.col("block") == F.col("_b")))
    keyed = dealt.select("cluster", "fp", "a", "b").join(
        _only(sets, nodes.select(F.col("fp").alias("_f")), F.col("fp") == F.col("_f")).drop("sketch"), "fp"
    )

    def compare(group: pa.Table) -> pa.Table:
        group = group.combine_chunks()
        fp, n = group.column("fp").to_numpy(), group.column("n").to_numpy()
        shingles = group.column("shingles").combine_chunks()
        links = [x for i, near in similar_steps(fp, n, shingles.offsets.to_numpy(), shingles.values.to_numpy(), num, den) for x in
                 zip([i] * len(near), near.tolist(), strict=True)]
        at = np.array(links, np.int64).reshape(-1, 2)
        return pa.table({"hub": fp[at[:, 0]], "fp": fp[at[:, 1]]})

    return keyed.groupBy("cluster", "a", "b").applyInArrow(compare, "hub long, fp long").distinct()


@in_small_batches
def similar_groups(
    docs: DataFrame, *, key: str = "doc_id", text: str = "text", n_words: int = WORDS, num: int = NUM, den: int = DEN
) -> tuple[DataFrame, DataFrame]:
    """(documents, links).

    documents: key, text_hash, n_shingles, component_id (smallest key of the
    group) and is_first (whether the row is that document). links: pairs of set
    numbers that were found similar; they span every group.
    """
    if not 0 < num <= den:
        raise ValueError("the similarity must be above 0 and at most 1")
    spark = docs.sparkSession
    rows, counts = document_sets(docs, key, text, n_words)
    total = rows.count()
    often = counts.where(F.col("docs") >= max(2, FREQUENT * total)).orderBy(F.desc("docs")).limit(FREQUENT_MOST)
    listed = often.toPandas()
    shingles, held = listed["shingle"].to_numpy(np.int64).view(np.uint64), listed["docs"].to_numpy(np.int64)
    order = np.argsort(shingles)
    frequent = shingles[order], held[order]

    live = _candidates(docs, text, n_words, num, den, frequent)
    pairs = staged(live.select("hub", "fp").distinct(), "pairs")
    links = spark.createDataFrame([], "hub long, fp long")
    comps = spark.createDataFrame([], "node long, comp long")
    if not pairs.isEmpty():
        nodes = pairs.select("fp").union(pairs.select("hub")).distinct()
        sets = _node_sets(docs, key, text, n_words, rows, nodes)
        links = _verified(pairs, sets, num, den)
        comps = staged(components(links, "hub", "fp"), "groups")
        # nodes of a signature that its smallest one did not bring together
        named = live.select("sig", "fp").join(comps, F.col("fp") == F.col("node"), "left").select(
            "sig", "fp", F.coalesce("comp", "fp").alias("comp")
        )
        apart = named.groupBy("sig").agg(
            F.min("comp").alias("lo"), F.max("comp").alias("hi"), F.count("*").alias("size")
        ).where("lo <> hi").select(F.col("sig").alias("_s"), "size")
        open_ = staged(named.join(apart, F.col("sig") == F.col("_s")).drop("_s"), "open")
        few = open_.where(F.col("size") <= FEW).drop("size")
        more = few.select("sig", F.col("fp").alias("hub"), F.col("comp").alias("_c")).join(few, "sig").where(
            "hub < fp and _c <> comp"
        ).select("hub", "fp").distinct()
        fresh = staged(more.join(pairs, ["hub", "fp"], "left_anti"), "pairs")
        links = links.union(_verified(fresh, sets, num, den))
        many = open_.where(F.col("size") > FEW).select("sig", "fp")
        if not many.isEmpty():
            least = many.groupBy(F.col("sig").alias("_s")).agg(F.min("fp").alias("hub"))
            clusters = components(many.join(least, F.col("sig") == F.col("_s")), "hub", "fp")
            clusters = staged(clusters.select(F.col("comp").alias("cluster"), F.col("node").alias("fp")), "clusters")
            links = links.union(_block_links(clusters, sets, num, den))
        links = staged(links, "links")
        comps = staged(components(links, "hub", "fp"), "groups")

    filled = rows.where("n > 0").join(comps, F.col("fp") == F.col("node"), "left").withColumn(
        "group", F.coalesce("comp", "fp")
    )
    who = F.struct(F.col("id").isNull().alias("no_id"), "id", "text_hash")
    # read from a table, so that a group that many documents share can be split in the join
    firsts = staged(filled.groupBy(F.col("group").alias("_g")).agg(F.min(who).alias("first")), "firsts")
    grouped = filled.join(firsts, F.col("group") == F.col("_g")).select(
        F.col("id").alias(key), "text_hash", F.col("n").alias("n_shingles"), F.col("first.id").alias("component_id"),
        (who == F.col("first")).alias("is_first"),
    )
    empty = rows.where("n = 0").select(
        F.col("id").alias(key), "text_hash", F.col("n").alias("n_shingles"), F.col("id").alias("component_id"),
        F.lit(True).alias("is_first"),
    )
    return grouped.union(empty), links
