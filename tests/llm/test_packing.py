"""Packing: every document whole and in its place, identifiers as the library gives them, few sequences."""

import collections
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from salesmart.llm import packing, queries

VOCABULARY = public_tokenizers.path("word_bpe_49k.json")
SCHEMA = "doc_id long, text string, piece string, g string, length string"


def rows_of(spark, rows):
    return spark.createDataFrame([(d, t, "clash", "clash", "clash") for d, t in rows], SCHEMA).repartition(3)


def brute_pieces(rows, capacity=2048):
    library = Tokenizer.from_file(VOCABULARY)
    out = collections.Counter()
    for doc, text in rows:
        ids = [*library.encode(text or "", add_special_tokens=False).ids, 0]
        for k, at in enumerate(range(0, len(ids), capacity)):
            some = ids[at : at + capacity]
            out[doc, k, at, len(some), zlib.crc32(np.array(some, "<u4").tobytes())] += 1
    return out


def assert_packed(packed, capacity=2048):
    """Sequences without gaps or overlaps, none over the capacity; their number."""
    sequences = collections.defaultdict(list)
    for r in packed:
        sequences[r.sequence_id].append((r.offset, r.length))
    for members in sequences.values():
        at = 0
        for offset, length in sorted(members):
            assert offset == at
            at += length
        assert at <= capacity
    return len(sequences)


def texts():
    rng = random.Random(4)
    words = ["Wandering", "l'été", "don't", "Straße,", "12,5", "中文", "ΟΔΟΣ", "x", "naïve", " ", "\x1f", "😀", "'S"]
    rows = [(i, " ".join(rng.choice(words) for _ in range(rng.choice([1, 5, 60, 400, 900, 3000])))) for i in range(120)]
    rows += [(200, None), (201, ""), (None, "one two"), (7, rows[7][1]), (7, rows[7][1]), (202, "a <|endoftext|> b"), (203, "y" * 4000)]
    rows += [(204, "Dž ᲊ new \U0001c000 letters"), (205, "\n" * 3000), (206, "word " * 150_000), (207, "!" * 9000)]
    return rows


def test_pieces_and_sequences(spark):
    rows = texts()
    packed = packing.pack(rows_of(spark, rows), VOCABULARY).collect()
    got = collections.Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in packed)
    assert got == brute_pieces(rows)
    least = packing.least_sequences(np.array([r.length for r in packed]), 2048)
    assert least <= assert_packed(packed) <= least + 1


def test_levels_join_what_groups_leave(spark):
    """Small groups leave part-filled sequences behind; the levels above empty most of them."""
    rows = [(i, "x " * (i * 37 % 300)) for i in range(900)]
    docs = rows_of(spark, rows)
    packed = packing.pack(docs, VOCABULARY, capacity=256, group=32, fan_in=4).collect()
    assert collections.Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in packed) == brute_pieces(rows, 256)
    n = assert_packed(packed, 256)
    lengths = np.array([r.length for r in packed])
    least = packing.least_sequences(lengths, 256)
    assert n <= 1.02 * least  # groups of 32 pieces are poor samples of 900
    assert max(r.sequence_id >> 56 for r in packed) == 3
    one = packing.pack(docs, VOCABULARY, capacity=256).collect()
    assert assert_packed(one, 256) <= least + 1


def test_empty_table(spark):
    assert packing.pack(rows_of(spark, []), VOCABULARY).count() == 0


def test_steps_of_long_texts_end_before_white_space():
    white = packing._patterns()[-1]
    text = "ab cd　ef\n" * 50 + "z" * 100 + " end"
    parts = list(packing.steps_of(text, white, step=20))
    assert "".join(parts) == text and len(parts) > 5 and all(white.match(p) for p in parts[1:])


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(1, 40), min_size=1, max_size=60), st.integers(40, 60))
def test_search_keeps_pieces_and_never_adds_sequences(found, capacity):
    lengths = np.array(found)
    first = packing.best_fit(lengths, capacity)
    least = packing.least_sequences(lengths, capacity)
    bins = packing.search([list(b) for b in first], lengths, capacity, least)
    assert sorted(i for b in bins for i in b) == list(range(len(found)))
    assert all(sum(found[i] for i in b) <= capacity for b in bins)
    assert -(-sum(found) // capacity) <= least <= len(bins) <= len(first)


def squared(bins, lengths):
    return sum(int(sum(lengths[i] for i in b)) ** 2 for b in bins)


def test_search_exchanges_one_and_two(spark):
    for lengths, given_bins, want in (
        ([6, 3, 3, 7], [[0], [1, 2], [3]], 2),  # a move, then one for one
        ([5, 5, 4, 4, 2], [[0, 2], [1, 3], [4]], 2),  # 5 + 5 and 4 + 4 + 2
        ([3, 3, 5, 5, 4], [[2, 4], [3, 0], [1]], 2),
    ):
        lengths = np.array(lengths)
        bins = packing.search([list(b) for b in given_bins], lengths, 10, 2)
        assert len(bins) == want and squared(bins, lengths) >= squared(given_bins, lengths)


def test_search_beats_first_fit(spark):
    rng = np.random.default_rng(2)
    better = 0
    for _ in range(20):
        lengths = rng.integers(20, 60, 90)
        bins, room = [], []
        for i, n in enumerate(lengths.tolist()):  # first fit in the order given
            k = next((k for k, r in enumerate(room) if r >= n), None)
            if k is None:
                bins.append([])
                room.append(100)
                k = len(bins) - 1
            bins[k].append(i)
            room[k] -= n
        found = packing.search([list(b) for b in bins], lengths, 100, packing.least_sequences(lengths, 100))
        assert len(found) <= len(bins) and squared(found, lengths) >= squared(bins, lengths)
        better += len(found) < len(bins)
    assert better >= 15


@pytest.mark.parametrize("size", ["0.001"])
def test_query(spark, size):
    sf = f"/root/testdata/sf{size}"
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    packed = queries.op13_packing(spark, sf).collect()
    assert collections.Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in packed) == brute_pieces(rows)
    least = packing.least_sequences(np.array([r.length for r in packed]), 2048)
    assert assert_packed(packed) <= least + 1
