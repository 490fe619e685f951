"""Toxicity scores by FTRL-proximal logistic regression over hashed word n-grams.

A text's features are its words (whole, and cut to their first four and five
bytes, which inflected forms share), its pairs of neighbouring words and its
skip-grams (pairs with one word between), each hashed to a coordinate and present
or not. Words are runs of letters, digits and non-ASCII characters. FTRL-proximal keeps for every coordinate a sum of gradients and a
sum of their squares; the second gives the coordinate its own rate, the first
must exceed an L1 bound before the coordinate gets a weight at all. The few
weights that are not zero are broadcast, and texts are scored where they are.

The model is fitted on a bounded sample of labelled rows, ``SAMPLE`` documents
at most expected and ``SAMPLE_FEATURES`` features at most, picked by hash of the
id, in one task; everything else runs over all documents. Only texts are inputs.

Results for odd input: a null or empty text has the score of the model's bias;
texts are scored whole whatever their length; repeated rows get equal scores;
labels that are null or belong to no document teach nothing; without any usable
label the model is empty and every score is 0.5; an empty table stays empty;
columns named ``score`` are replaced.
"""

from __future__ import annotations

import math
import tempfile
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salesmart.llm.common import freed_shuffles, in_small_batches
from salesmart.llm.textarrow import NOT_ALNUM, mix64, steps, utf8, words

#: Labelled documents that the model is fitted on, as expected from the hash; features of them at most.
SAMPLE, SAMPLE_FEATURES = 16_000, 60_000_000
#: Texts whose coordinates a task hands on at once; bytes of text whose features it makes at once (they take some 50 times as much).
EXTRACTED, STEP = 256, 1 << 17
BITS = 22
EPOCHS, ALPHA, BETA, L1, L2 = 3, 1.0, 1.0, 2.0, 0.0
THRESHOLD = 0.7
#: Bytes that a word is cut to.
HEADS = (4, 5)
_HEAD_SEEDS = (np.uint64(0x2545F4914F6CDD1D), np.uint64(0x9E6C63D0876A9A47))
_SEEDS = (np.uint64(0x51ED270B9A3C1F05), np.uint64(0xA0761D6478BD642F), np.uint64(0xE7037ED1A0B428DB))


@dataclass(frozen=True)
class Model:
    """Bias, and the coordinates that have a weight."""

    bias: float
    at: np.ndarray
    weight: np.ndarray
    bits: int = BITS


def held_out(key: Column) -> Column:
    """Rows that never teach: crc32 of the id as text leaves 1 when divided by 3; false for a null id."""
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def features(data: np.ndarray, offsets: np.ndarray, row: int, end: int, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """(coordinate, row) of every word, pair and skip-gram of rows row to end; not yet distinct."""
    take = np.uint64(64 - bits)
    h, owner, *heads = words(data, offsets, row, end, NOT_ALNUM, HEADS)
    at, of = [mix64(h ^ _SEEDS[0]) >> take], [owner]
    for head, seed in zip(heads, _HEAD_SEEDS):
        at.append(mix64(head ^ seed) >> take)
        of.append(owner)
    for gap in (1, 2):
        if len(h) > gap:
            same = owner[gap:] == owner[:-gap]
            pair = mix64((h[:-gap] * np.uint64(0x9E3779B97F4A7C15) + h[gap:]) ^ _SEEDS[gap]) >> take
            at.append(pair[same])
            of.append(owner[gap:][same])
    return np.concatenate(at).astype(np.int64), np.concatenate(of)


def text_features(texts: pa.Array, bits: int) -> Iterator[np.ndarray]:
    """The distinct coordinates of each text, in order."""
    data, offsets = utf8(texts)
    for row, end in steps(offsets, STEP):
        at, of = features(data, offsets, row, end, bits)
        keys = np.unique((of << np.int64(bits)) | at)
        cuts = np.searchsorted(keys >> np.int64(bits), np.arange(row, end + 1))
        at = keys & np.int64((1 << bits) - 1)
        for i in range(end - row):
            yield at[cuts[i] : cuts[i + 1]]


class Blocks:
    """Blocks of rows in a scratch file without a name; each pass reads them again, one block in memory."""

    def __init__(self):
        self._file, self._cuts = tempfile.TemporaryFile(), []

    def add(self, ids: np.ndarray, cuts: np.ndarray) -> None:
        self._file.write(np.ascontiguousarray(ids, np.int32).data)
        self._cuts.append(cuts)

    def __iter__(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        self._file.seek(0)
        for cuts in self._cuts:
            yield np.frombuffer(self._file.read(4 * int(cuts[-1])), np.int32), cuts

    def close(self) -> None:
        self._file.close()


def fit_rows(rows: Iterable[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, bits: int = BITS) -> Model:
    """FTRL-proximal over rows in the given order, ``EPOCHS`` times.

    ``rows`` are blocks, gone through once an epoch: 32-bit coordinates of rows laid end to
    end, and where each row begins and the last one ends.
    """
    bias = 1 << bits
    z, n = np.zeros(bias + 1), np.zeros(bias + 1)

    def weights(i: np.ndarray, bound: float) -> np.ndarray:
        zi = z[i]
        w = -(zi - np.sign(zi) * bound) / ((BETA + np.sqrt(n[i])) / ALPHA + L2)
        return np.where(np.abs(zi) <= bound, 0.0, w)

    for _ in range(EPOCHS):
        answers = iter(labels)
        for ids, cuts in rows:
            for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
                i, y = ids[a:b], next(answers)
                w, w0 = weights(i, L1), weights(np.array([bias]), 0.0)[0]
                p = 1.0 / (1.0 + math.exp(-min(max(w.sum() + w0, -35.0), 35.0)))
                g = p - y
                for at, of in ((i, w), (bias, w0)):
                    ni = n[at]
                    z[at] += g - (np.sqrt(ni + g * g) - np.sqrt(ni)) / ALPHA * of
                    n[at] = ni + g * g
    at = np.flatnonzero((z[:bias] > L1) | (z[:bias] < -L1))
    return Model(float(weights(np.array([bias]), 0.0)[0]), at, weights(at, L1), bits)


@in_small_batches
def fit(
    docs: DataFrame, labels: DataFrame, *, key: str = "doc_id", text: str = "text", label: str = "toxic",
    teaches: Column | None = None, sample: int = SAMPLE,
) -> Model:
    """The model of labelled documents; ``teaches`` says, of a label's row, whether it may be learnt from."""
    known = labels.where(F.col(label).isin(0, 1) & F.col(key).isNotNull())
    if teaches is not None:
        known = known.where(teaches)
    known = known.groupBy(F.col(key).alias("_key")).agg(F.max(label).cast("int").alias("y")).withColumn(
        "place", F.shiftrightunsigned(F.xxhash64("_key", F.lit(7)), 11) / float(1 << 53)
    )
    with freed_shuffles(docs.sparkSession):
        n = known.count()
        # its expected number of rows is the bound
        picked = F.broadcast(known.where(F.col("place") < sample / max(n, 1)))
        rows = docs.select(F.col(key).alias("_k"), F.col(text).alias("text")).join(picked, F.col("_k") == F.col("_key"))

        def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for whole in batches:
                for at in range(0, len(whole), EXTRACTED):
                    b = whole.slice(at, EXTRACTED)
                    ids = [r.astype(np.int32) for r in text_features(b.column("text"), BITS)]
                    yield pa.RecordBatch.from_arrays(
                        [b.column("place"), b.column("y"), pa.array(ids, pa.list_(pa.int32()))], names=["place", "y", "ids"]
                    )

        def train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            blocks, ys, total = Blocks(), [], 0
            for b in batches:
                sizes = np.asarray(b.column("ids").value_lengths(), np.int64)
                room = np.cumsum(sizes) + total <= SAMPLE_FEATURES
                if not room.all():  # rows that fit in order, later and shorter ones included
                    for k, size in enumerate(sizes.tolist()):
                        room[k] = total + size <= SAMPLE_FEATURES
                        total += size if room[k] else 0
                    b, sizes = b.filter(pa.array(room)), sizes[room]
                else:
                    total += int(sizes.sum())
                blocks.add(b.column("ids").flatten().to_numpy(), np.concatenate([[0], np.cumsum(sizes)]))
                ys += b.column("y").to_pylist()
            # what the last batch took goes before the model's sums come
            b = None
            pa.default_memory_pool().release_unused()
            m = fit_rows(blocks, np.array(ys, float)) if ys else None
            blocks.close()
            if m is None:
                return
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.append(m.at, -1)), pa.array(np.append(m.weight, m.bias))], names=["at", "weight"]
            )
            # the worker goes on to other tasks
            pa.default_memory_pool().release_unused()

        given = rows.select("text", "place", "y").mapInArrow(extract, "place double, y int, ids array<int>")
        ordered = given.repartition(1).sortWithinPartitions("place", F.size("ids"))
        # at most as many numbers as there are coordinates; L1 leaves a small part of them
        learnt = ordered.mapInArrow(train, "at long, weight double").toArrow()
    at, weight = learnt.column("at").to_numpy(), learnt.column("weight").to_numpy()
    return Model(float(weight[at < 0].sum()), at[at >= 0], weight[at >= 0])


def score_texts(texts: pa.Array, model: Model) -> np.ndarray:
    dense = np.zeros(1 << model.bits, np.float32)
    dense[model.at] = model.weight
    data, offsets = utf8(texts)
    sums = np.full(len(texts), model.bias)
    for row, end in steps(offsets, STEP):
        at, of = features(data, offsets, row, end, model.bits)
        live = np.flatnonzero(dense[at])
        keys = np.unique((of[live] << np.int64(model.bits)) | at[live])
        sums += np.bincount(
            keys >> np.int64(model.bits), weights=dense[keys & np.int64((1 << model.bits) - 1)], minlength=len(texts)
        )
    return 1.0 / (1.0 + np.exp(-np.clip(sums, -35, 35)))


def score(docs: DataFrame, model: Model, *, text: str = "text") -> DataFrame:
    """``docs`` with ``score``, 0 to 1: no shuffle, the model is broadcast."""
    shared = docs.sparkSession.sparkContext.broadcast((model.bias, model.at, model.weight, model.bits))

    @F.arrow_udf("double")
    def scored(texts: pa.Array) -> pa.Array:
        return pa.array(score_texts(texts, Model(*shared.value)))

    return docs.withColumn("score", scored(F.col(text)))
