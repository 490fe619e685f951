"""Token counts by heap-and-linked-list byte-pair merging.

A text splits into pieces by the byte-level pattern (contractions; letters,
digits or other characters with one space before them; white space). A piece's
bytes form a linked list; a heap holds the adjacent pairs that have a merge rank.
The lowest rank is popped and merged, its new neighbours are pushed, until no
pair is left. The count is the initial symbols minus the merges; no identifiers
are made. Strings of special tokens inside a text are one token each.

Pieces of a few texts are found together: code points get classes, class changes
give the pieces, a 64-bit hash stands for each piece, and only pieces that this
worker has not seen are merged. What a worker remembers is bounded; beyond the
bound it forgets all and starts again.

Results for odd input: a null or empty text has 0 tokens; texts of any length
are counted whole; repeated rows get equal counts; other columns play no part.
"""

from __future__ import annotations

import heapq
import json
import unicodedata
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from salesmart.llm.textarrow import mix64, run_hashes, steps, utf8

#: Pieces that a worker remembers.
REMEMBERED = 1_500_000
_OTHER, _LETTER, _DIGIT, _SPACE = 0, 1, 2, 3
# Unicode's white space.
_WHITE = [*range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]


def merge_ranks(path: str) -> tuple[dict[int, int], list[int], list[str]]:
    """(rank of each pair, symbol that each rank makes, special strings) of a byte-level BPE tokenizer file.

    Symbols are numbers: a byte's own, then one for each string of bytes that
    merging makes. A pair is ``left << 32 | right``.
    """
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    plain = [*range(ord("!"), ord("~") + 1), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    spare = (b for b in range(256) if b not in set(plain))
    to_byte = {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(spare)}
    symbols = {bytes([b]): b for b in range(256)}
    ranks, made = {}, []
    for rank, pair in enumerate(spec["model"]["merges"]):
        left, right = (bytes(to_byte[c] for c in p) for p in (pair.split(" ") if isinstance(pair, str) else pair))
        ranks[symbols[left] << 32 | symbols[right]] = rank
        made.append(symbols.setdefault(left + right, len(symbols)))
    return ranks, made, [t["content"] for t in spec["added_tokens"]]


def count_merged(piece: bytes, ranks: dict[int, int], made: list[int]) -> int:
    """Tokens of one piece."""
    n = len(piece)
    parts, after, before = list(piece), list(range(1, n + 1)), list(range(-1, n - 1))
    rank_of = ranks.get
    # a heap entry is rank << 32 | place of the left symbol; of equal ranks the leftmost comes first
    heap = [r << 32 | i for i in range(n - 1) if (r := rank_of(parts[i] << 32 | parts[i + 1])) is not None]
    heapq.heapify(heap)
    pop, push, merges = heapq.heappop, heapq.heappush, 0
    while heap:
        entry = pop(heap)
        i = entry & 0xFFFFFFFF
        j = after[i]
        left = parts[i]
        # stale if either symbol has gone or grown since the push
        if left < 0 or j >= n or rank_of(left << 32 | parts[j]) != entry >> 32:
            continue
        merged = parts[i] = made[entry >> 32]
        parts[j] = -1
        k = after[i] = after[j]
        merges += 1
        if k < n:
            before[k] = i
            if (r := rank_of(merged << 32 | parts[k])) is not None:
                push(heap, r << 32 | i)
        h = before[i]
        if h >= 0 and (r := rank_of(parts[h] << 32 | merged)) is not None:
            push(heap, r << 32 | h)
    return n - merges


def classes() -> np.ndarray:
    """Class of every code point."""
    kinds = {"L": _LETTER, "N": _DIGIT}
    table = np.fromiter((kinds.get(unicodedata.category(chr(c))[0], _OTHER) for c in range(0x110000)), np.uint8, 0x110000)
    table[_WHITE] = _SPACE
    return table


def piece_starts(cps: np.ndarray, kinds: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Where pieces start in code points of texts laid end to end; ``bounds`` are the texts' starts."""
    n = len(cps)
    k = kinds[cps]
    first = np.zeros(n + 1, bool)
    first[bounds] = True
    first[n] = True
    space = k == _SPACE
    blank_before = np.zeros(n, bool)  # a plain space that goes with what follows it
    blank_before[1:] = (cps[:-1] == 32) & ~first[1:n]
    change = np.ones(n, bool)
    change[1:] = (k[1:] != k[:-1]) | first[1:n]
    start = ~space & change & ~blank_before
    text_goes_on = np.zeros(n, bool)
    text_goes_on[:-1] = ~space[1:] & ~first[1:n]
    start |= space & (change | text_goes_on)
    # contractions: an apostrophe that begins a piece of its own, and its letters
    mark = np.flatnonzero((cps == 39) & start)
    mark = mark[mark + 1 < n]
    mark = mark[~first[mark + 1]]
    if len(mark):
        pad = np.concatenate([cps, np.zeros(2, cps.dtype)])
        a, b = pad[mark + 1], pad[mark + 2]
        two = ~first[np.minimum(mark + 2, n)]
        one = np.isin(a, [ord(c) for c in "stmd"])
        both = two & (((a == ord("r")) & (b == ord("e"))) | ((a == ord("v")) & (b == ord("e"))) | ((a == ord("l")) & (b == ord("l"))))
        for cut, length in ((mark[one], 2), (mark[both & ~one], 3)):
            start[cut + 1] = False
            rest = cut + length
            rest = rest[rest < n]
            start[rest[(k[rest] == _LETTER) & ~first[rest]]] = True
    return np.flatnonzero(start)


def counter(ranks: dict[int, int], made: list[int], special: list[str]) -> Callable[[pa.Array], pa.Array]:
    """A function from texts to token counts, which remembers pieces."""
    kinds = classes()
    known: dict[int, int] = {}

    def counts_of(texts: list[str]) -> np.ndarray:
        sizes = np.array([len(t) for t in texts], np.int64)
        out = np.zeros(len(texts), np.int64)
        joined = "".join(texts)
        if not joined:
            return out
        cps = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
        begins = np.cumsum(sizes) - sizes
        starts = piece_starts(cps, kinds, begins[sizes > 0])
        ends = np.append(starts[1:], len(cps))
        hashes = run_hashes(mix64(cps.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15)), starts, ends)
        unique, where, which = np.unique(hashes, return_index=True, return_inverse=True)
        if len(known) > REMEMBERED:
            known.clear()
        counts = np.empty(len(unique), np.int64)
        for i, (h, at) in enumerate(zip(unique.tolist(), where.tolist())):
            c = known.get(h)
            if c is None:
                c = known[h] = count_merged(joined[starts[at] : ends[at]].encode(), ranks, made)
            counts[i] = c
        owners = np.searchsorted(begins, starts, "right") - 1
        return np.bincount(owners, weights=counts[which], minlength=len(texts)).astype(np.int64)

    def count(texts: pa.Array) -> pa.Array:
        data, offsets = utf8(texts)
        out = np.zeros(len(texts), np.int64)
        for row, end in steps(offsets):
            parts = [bytes(data[offsets[i] : offsets[i + 1]]).decode("utf-8", "replace") for i in range(row, end)]
            if any(s in t for s in special for t in parts):
                for i, t in enumerate(parts):
                    pieces = [t]
                    for s in special:
                        pieces = [q for p in pieces for q in p.split(s)]
                    out[row + i] = counts_of(pieces).sum() + len(pieces) - 1
            else:
                out[row:end] = counts_of(parts)
        return pa.array(out)

    return count


def token_count(spark: SparkSession, text: Column, vocabulary: str) -> Column:
    """Number of tokens of a text by the tokenizer file ``vocabulary``.

    The file is read once, by the driver; its merges, as many as the vocabulary
    has, are broadcast.
    """
    shared = spark.sparkContext.broadcast(merge_ranks(vocabulary))

    @F.arrow_udf("long")
    def count(texts: pa.Array) -> pa.Array:
        import sys

        # kept with the worker, so that later tasks know the pieces of earlier ones
        kept = sys.modules["pyspark"].__dict__.setdefault("_salesmart_counters", {})
        if vocabulary not in kept:
            kept[vocabulary] = counter(*shared.value)
        return kept[vocabulary](texts)

    return F.coalesce(count(text), F.lit(0).cast("long"))
