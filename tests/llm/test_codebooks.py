"""Vector code compression against plain Lloyd rounds in exact integers."""

import collections
import hashlib
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from salesmart.llm import codebooks, queries

SCHEMA = "vec_id long, embedding array<float>, label int, code string, error string"


def brute(rows, parts=4, entries=256, rounds=4):
    """{(vec_id, code, error, label_error): rows}, digest; one full scan a round."""
    kept = []
    for i, v, label in rows:
        if v is None or not len(v) or len(v) % parts or any(x is None or not math.isfinite(x) for x in v):
            continue
        kept.append((i, tuple(math.floor(1024 * float(np.float32(x))) for x in v), label))
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    kept = [r for r in kept if len(r[1]) == len(kept[0][1])]
    if not kept:
        return collections.Counter(), None
    width = len(kept[0][1]) // parts
    x = np.array([r[1] for r in kept], dtype=object).reshape(len(kept), parts, width)
    books = [x[:entries, p].copy() for p in range(parts)]

    def assign():
        out = []
        for p in range(parts):
            d = ((x[:, p][:, None, :] - books[p][None]) ** 2).sum(-1)
            out.append((d.argmin(1), d.min(1)))
        return out

    for _ in range(rounds):
        for p, (code, _d) in enumerate(assign()):
            for j in set(code.tolist()):
                own = x[code == j, p]
                books[p][j] = [sum(c) // len(own) for c in own.T.tolist()]
    final = assign()
    errors = [sum(int(d[k]) for _, d in final) for k in range(len(kept))]
    by_label = collections.Counter()
    for (_, _, label), e in zip(kept, errors):
        by_label[label] += e
    digest = hashlib.sha256(",".join(str(int(v)) for b in books for e in b for v in e).encode()).hexdigest()
    return collections.Counter(
        (r[0], "".join(f"{int(code[k]):02x}" for code, _ in final), errors[k], by_label[r[2]]) for k, r in enumerate(kept)
    ), digest


def got(coded):
    rows = coded.select("vec_id", F.lower(F.hex("codes")), "error", "label_error").collect()
    return collections.Counter(tuple(r) for r in rows)


def rows_of(spark, rows):
    return spark.createDataFrame([(i, v, label, "clash", "clash") for i, v, label in rows], SCHEMA).repartition(3)


def vectors(n, d, seed, clusters=0):
    rng = np.random.default_rng(seed)
    v = rng.normal(size=(n, d))
    if clusters:
        v = rng.normal(size=(clusters, d))[rng.integers(0, clusters, n)] * 3 + v * 0.05
    return [[float(x) for x in row] for row in v.astype(np.float32)]


@pytest.mark.parametrize("n, d, clusters", [(700, 8, 0), (900, 16, 12), (40, 4, 0)])
def test_codes_equal_plain_rounds(spark, n, d, clusters):
    rows = [(i * 3 % 1009, v, i % 5 or None) for i, v in enumerate(vectors(n, d, n, clusters))]
    coded, books = codebooks.compress(rows_of(spark, rows))
    want, digest = brute(rows)
    assert got(coded) == want and books.digest() == digest


def test_odd_rows(spark):
    usable = vectors(30, 8, 5)
    rows = [(i, v, i % 2) for i, v in enumerate(usable)]
    rows += [(3, usable[3], 1), (3, usable[3], 1), (None, usable[4], None), (7, usable[9], None)]  # repeated, null and shared ids
    rows += [(100, None, 1), (101, [], 1), (102, [None] * 8, 1), (103, [float("nan")] * 8, 1), (104, [float("inf")] + [0.0] * 7, 1)]
    rows += [(105, [1.0] * 6, 1), (106, [1.0] * 12, 1)]  # not of four parts, of another length
    rows += [(200, [-0.0005, 0.0005, 63.5, -63.5] * 2, 2)]
    coded, books = codebooks.compress(rows_of(spark, rows))
    want, digest = brute(rows)
    assert got(coded) == want and books.digest() == digest
    huge = [(i, [x * 1e30 if i % 3 else x for x in v], 1) for i, v in enumerate(vectors(50, 8, 6))]
    assert codebooks.compress(rows_of(spark, huge))[0].count() == 50


@pytest.mark.parametrize("rows", [[], [(1, None, 1)]])
def test_no_vectors(spark, rows):
    coded, books = codebooks.compress(rows_of(spark, rows))
    assert coded.count() == 0 and books is None


def test_labels_joined_by_shuffle(spark, monkeypatch):
    monkeypatch.setattr(codebooks, "BROADCAST_LABELS", 0)
    rows = [(i, v, None if i < 20 else i % 3) for i, v in enumerate(vectors(60, 8, 9))]
    assert got(codebooks.compress(rows_of(spark, rows))[0]) == brute(rows)[0]


def test_bounds_save_work_and_beat_accumulated_drifts():
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(64, 4)) * 4000
    x = (centres[rng.integers(0, 64, 3000)] + rng.normal(size=(3000, 4)) * 60).astype(np.int32)
    book = x[:256].astype(np.int64)
    history, code = [book], None
    groups = 256 // codebooks.GROUP
    bounds, stamps = np.zeros((3000, groups), np.float32), np.zeros((3000, groups), np.int64)
    work = []
    for t in range(6):
        books = codebooks.Books(tuple(h[None] for h in history))
        code, own, measured = codebooks.assign_part(x, history[-1], code, bounds, stamps, books.drops()[:, 0], t)
        full = codebooks.nearest_in(x, history[-1])
        assert (full.argmin(1) == code).all() and (full.min(1) == own).all()
        # a bound, lowered to now, never exceeds the distance of an entry it covers
        work.append(measured)
        sums = np.stack([np.bincount(code, x[:, c], 256) for c in range(4)], 1)
        n = np.bincount(code, minlength=256)[:, None]
        history.append(np.where(n > 0, np.floor_divide(sums.astype(np.int64), np.maximum(n, 1)), history[-1]))
    assert work[-1] < 0.6 * work[0]
    net = codebooks.Books(tuple(h[None] for h in history)).drops()[0, 0]
    steps = [np.sqrt(((b - a) ** 2).sum(1)) for a, b in zip(history, history[1:])]
    summed = np.maximum.reduceat(np.sum(steps, axis=0), np.arange(0, 256, codebooks.GROUP))
    assert (net <= summed + 1e-6).all() and (net < summed - 1).any()


def test_query(spark):
    sf = "/root/testdata/sf0.001"
    rows = [(r.vec_id, r.embedding, r.label) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    want, digest = brute(rows)
    out = queries.op11_codes(spark, sf).collect()
    assert collections.Counter((r.vec_id, r.code, r.error, r.label_error) for r in out) == want
    assert {r.codebooks_sha256 for r in out} == {digest}
