"""The whole pipeline against plain Python, row by row; and on tables without rows."""

import collections
import hashlib
import random

from pyspark.sql import functions as F

import corpus_pipeline as P
from salesmart.llm import decontamination, mixing, sharding
from tests.llm.test_operators import brute_distance, brute_groups

DOCS = "doc_id long, text string, lang string, source string, n_chars long, score string"
ITEMS = ["a benchmark passage of quite a few words that nobody should train on at all today", "what is the capital of the moon"]


def fixture_rows():
    rng = random.Random(9)
    words = [f"word{i}" for i in range(400)]
    say = lambda n: " ".join(rng.choice(words) for _ in range(n))
    rows = [(100 + i, f"calm {say(40)}") for i in range(80)]
    rows += [(300 + i, f"vile awful {say(30)}") for i in range(80)]
    base = say(80).split()
    for i in range(6):  # near copies: one word of 80 differs
        rows.append((20 - i, " ".join([*base[: 10 * i], f"own{i}", *base[10 * i + 1 :]])))
    rows += [(30 + i, " ".join(base[:40]) + f" {say(60)}") for i in range(3)]  # half in common: no copies
    rows += [(1, f"lead {ITEMS[0]} tail {say(20)}"), (2, f"{say(9)} {ITEMS[0][:40]}#{ITEMS[0][41:]}"), (3, f"{say(9)}: What is the capital  of the MOON?")]
    rows += [(4, None), (5, ""), (6, "one"), (7, rows[0][1]), (7, rows[0][1]), (8, say(3000)), (8, "another text of an id that stands twice")]
    return [(d, t, "en", [None, "a", "b", "é", "Z"][k % 5], 1, "clash") for k, (d, t) in enumerate(rows)]


def brute_run(rows, keys):
    """Rows (doc_id, text) of the pipeline's result; ``keys`` gives a row's place in the mix."""
    rows = [r for r in rows if "vile" not in (r[1] or "")]
    kept, group_of = [], {}
    for (doc, n, comp), _ in brute_groups([(r[0], r[1]) for r in rows], 5, 80, 100).items():
        group_of.setdefault((doc, n), comp)
    first = set()
    for r in rows:
        n = next(s for (d, s, c) in brute_groups([(r[0], r[1])], 5, 80, 100))
        if n == 0:
            kept.append(r)
        elif group_of[r[0], n] == r[0] and (r[0], r[1]) not in first:
            first.add((r[0], r[1]))
            kept.append(r)
    clean = []
    for r in kept:
        text = decontamination.normal(r[1] or "")
        if len(text) > 5000:
            found = any(i in text for i in ITEMS)
        else:
            found = any(brute_distance(i, text) <= (int(len(i) * 0.05) if len(i) >= 32 else 0) for i in map(decontamination.normal, ITEMS))
        if not found:
            clean.append(r)
    size = lambda r: len((r[1] or "").split())
    total = sum(map(size, clean))
    names = sorted({r[3] for r in clean}, key=lambda s: (s is None, s or ""))
    weight = {s: mixing.WEIGHTS[k % 3] for k, s in enumerate(names)}
    sizes = {s: sum(size(r) for r in clean if r[3] == s) for s in names}
    target, full = {}, set()
    while True:  # the excess of full sources goes to the others by weight
        level = (total - sum(3 * sizes[s] for s in full)) / (sum(weight[s] for s in names if s not in full) or 1)
        over = {s for s in names if s not in full and weight[s] * level > 3 * sizes[s]}
        if not over:
            break
        full |= over
    out = collections.Counter()
    for s in names:
        target = 3.0 * sizes[s] if s in full else weight[s] * level
        start = 0
        own = sorted((r for r in clean if r[3] == s), key=lambda r: int(hashlib.md5(f"{keys[r[0], r[1]]}:{mixing.SEED}".encode()).hexdigest()[:13], 16))
        for r in own:
            copies = sum(min(size(r), round(target) - start - e * sizes[s]) > 0 for e in range(3))
            out[r[0], r[1]] += copies
            start += size(r)
    return +out


def test_run_equals_plain_python(spark, tmp_path):
    rows = fixture_rows()
    docs = spark.createDataFrame(rows, DOCS)
    labels = [(r[0], int("vile" in (r[1] or ""))) for r in rows if r[0] >= 100]
    spark.createDataFrame(labels, "doc_id long, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame(list(enumerate(ITEMS)), "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs.repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    keys = {(r.doc_id, r.text): r.k for r in docs.select("doc_id", "text", F.xxhash64("doc_id", "text").alias("k")).collect()}
    got = P.run(spark, str(tmp_path)).collect()
    assert collections.Counter((r.doc_id, r.text) for r in got) == brute_run(rows, keys)
    owner = sharding.fill_table(list(sharding.SHARDS))
    for r in got:
        assert r.slot == int(hashlib.md5(f"key:{r.doc_id}".encode()).hexdigest()[:15], 16) % sharding.SLOTS
        assert r.shard_id == owner[r.slot] and r.shard == sharding.SHARDS[r.shard_id]


def test_run_on_empty_tables(spark, tmp_path):
    spark.createDataFrame([], DOCS).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert P.run(spark, str(tmp_path)).count() == 0
