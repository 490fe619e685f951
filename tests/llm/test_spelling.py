"""Spelling variants against plain comparison of all pairs of words."""

import collections
import itertools
import re
import zlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from salesmart.llm import queries, spelling

SCHEMA = "doc_id long, text string, word string, n string"


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) - len(a) == 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute_counts(rows):
    n = collections.Counter()
    for doc, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if c.isascii() else c for c in run)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if h % 199 == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1 :]
            n[run] += 1
    return {w: c for w, c in n.items() if c >= 5 and len(w) >= 6}


def brute(n):
    near = {w: [] for w in n}
    by_length = collections.defaultdict(list)
    for w in n:
        by_length[len(w)].append(w)
    for k, words in by_length.items():
        for a, b in itertools.chain(itertools.combinations(words, 2), itertools.product(words, by_length.get(k + 1, []))):
            if one_edit(a, b):
                near[a].append(b)
                near[b].append(a)
    form = {}
    for w in n:
        best = min(near[w], key=lambda x: (-n[x], x), default=None)
        form[w] = best if best is not None and n[best] >= 5 * n[w] else None
    out = set()
    for w in n:
        root = w
        while form[root] is not None:
            root = form[root]
        out.add((w, form[w], root, n[w], len(near[w]), n[form[w]] if form[w] else None))
    return out


def rows_of(spark, rows):
    return spark.createDataFrame([(d, t, "clash", "clash") for d, t in rows], SCHEMA).repartition(3)


def corpus():
    rows = []
    stem = "wandering"
    for k, (word, n) in enumerate(
        [(stem, 300), ("wandring", 44), ("wandrin", 6), ("wanderings", 25), ("pandering", 200), ("wanderinx", 5), ("éclairs", 40),
         ("eclairs", 6), ("écÉairs", 5), ("abcdef", 5), ("abcdeg", 5), ("abcdefg", 5), ("bcdefg", 5), ("Straße", 9), ("short", 90)]
    ):
        rows += [(1000 * k + i, f"{word} {word.upper() if word.isascii() else word}") for i in range(n // 2 + 1)]
    # one common beginning and one common ending
    for i in range(60):
        a, b = chr(97 + i % 26), chr(97 + i // 26)
        rows += [(90_000 + i, f"prefix{a}{b}xyz " * 5 + f"{a}{b}qvending " * (6 + i))]
    rows += [(1, None), (2, ""), (None, "wandering wandring"), (None, None), (3, "x" * 50_000 + " " + "wandering, " * 5)]
    return rows


@pytest.mark.parametrize("most", [2048, 4])
def test_variants_equal_all_pairs(spark, most):
    rows = corpus()
    want = brute(brute_counts(rows))
    got = [tuple(r) for r in spelling.variants(rows_of(spark, rows), most=most).collect()]
    assert len(got) == len(want) and set(got) == want
    assert any(f is not None and f != r for _, f, r, *_ in want)  # a chain of two


def test_odd_tables(spark, monkeypatch):
    assert spelling.variants(rows_of(spark, [])).count() == 0
    assert spelling.variants(rows_of(spark, [(1, None), (2, "one two")])).count() == 0
    monkeypatch.setattr(spelling, "HELD_WORDS", 3)
    monkeypatch.setattr(spelling, "STEP", 10)
    monkeypatch.setattr(spelling, "BROADCAST_ROWS", 0)
    rows = corpus()
    assert {tuple(r) for r in spelling.variants(rows_of(spark, rows), most=8).collect()} == brute(brute_counts(rows))


words = st.lists(st.text("abé", min_size=6, max_size=9), unique=True, max_size=30)


@settings(max_examples=300, deadline=None)
@given(words, st.integers(1, 7))
def test_windows_meet_each_pair_once(found, width):
    """Sets of every window, built as the keys build them, give each pair once from either side."""
    met = collections.Counter()
    for m in {len(w) - d for w in found for d in (0, 1)}:
        for a in range(0, m + 1, width):
            b = min(a + width, m + 1)
            sets = collections.defaultdict(list)
            for w in found:
                if len(w) in (m, m + 1):
                    sets[w[:a], w[len(w) - max(m - b, 0) :]].append(w)
            for some in sets.values():
                index = spelling.PositionIndex(some, a, b)
                for w in some:
                    bits = index.near(w)
                    for k, other in enumerate(some):
                        if bits >> k & 1 and not len(w) == len(other) == m + 1:
                            met[w, other] += 1
    assert met == {(a, b): 1 for a in found for b in found if one_edit(a, b)}


def test_query(spark):
    sf = "/root/testdata/sf0.001"
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    got = [tuple(r) for r in queries.op12_spelling(spark, sf).collect()]
    want = brute(brute_counts(rows))
    assert len(got) == len(want) and set(got) == want
