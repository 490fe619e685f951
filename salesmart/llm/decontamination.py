"""Benchmark decontamination by pigeonhole edit matching.

Texts are compared lower-cased with white space as single blanks. A test item of
n characters has an error budget of ``RATE`` * n edits and splits into budget + 1
pieces; an occurrence within the budget holds at least one piece unchanged, so
exact hits of pieces (one automaton over all of them) give all candidate places.
Myers' bit-parallel distance then decides. Overlapping candidate places of an
item are verified as one, so that the work is linear in a document's length
whatever it repeats.

Items go to blocks of bounded length; a block is broadcast and meets all
documents, one pass for each block. An item shorter than ``LEAST`` characters
counts where it occurs exactly, from word boundary to word boundary; with fewer than
``SHORT_WORDS`` words and ``SHORT_CHARS`` characters it is no evidence inside a text
and counts only where it is all of a document.

Results for odd input: null or empty items and documents match nothing; equal
items each count under their own id, and items without an id under null; documents are read whole; repeated rows get
equal results; an empty table on either side gives no hits; a column named
``leaks`` is replaced.
"""

from __future__ import annotations

from collections.abc import Callable

import ahocorasick
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesmart.llm.common import staged

RATE = 0.05
LEAST = 32
SHORT_WORDS, SHORT_CHARS = 4, 16
#: Characters of the items that are broadcast at once (one longer item is a block of its own).
BLOCK_CHARS = 2_000_000
LEAK = "array<struct<item_id:bigint,end:bigint,distance:int>>"


def normal(text: str) -> str:
    return " ".join(text.lower().split())


def pieces(item: str, budget: int) -> list[tuple[int, str]]:
    """(offset, piece) of ``budget + 1`` pieces of nearly equal length."""
    n, k = len(item), budget + 1
    cuts = [i * n // k for i in range(k + 1)]
    return [(a, item[a:b]) for a, b in zip(cuts, cuts[1:])]


def best_end(item: str, text: str, budget: int) -> tuple[int, int] | None:
    """(distance, end) of the nearest occurrence of ``item`` in ``text`` within the budget; the first of equals."""
    m = len(item)
    masks: dict[str, int] = {}
    for i, c in enumerate(item):
        masks[c] = masks.get(c, 0) | (1 << i)
    full, top = (1 << m) - 1, 1 << (m - 1)
    up, down, score = full, 0, m  # rises and falls along a column of the distance table
    found = None
    for j, c in enumerate(text):
        eq = masks.get(c, 0)
        vertical = eq | down
        diagonal = (((eq & up) + up) ^ up) | eq
        rise = down | (full & ~(diagonal | up))
        fall = up & diagonal
        if rise & top:
            score += 1
        elif fall & top:
            score -= 1
        rise, fall = (rise << 1) & full, (fall << 1) & full
        up = fall | (full & ~(vertical | rise))
        down = rise & vertical
        if score <= budget and (found is None or score < found[0]):
            found = (score, j + 1)
    return found


def at_boundaries(text: str, start: int, end: int) -> bool:
    """Whether ``text[start:end]`` cuts no word; scripts from U+2E80 on are written without blanks."""
    return not any(
        0 < at < len(text) and all(c.isalnum() and c < "\u2e80" for c in text[at - 1 : at + 1]) for at in (start, end)
    )


def matcher(items: list[tuple[int | None, str]], rate: float = RATE) -> Callable[[str], list[dict]]:
    """A function from a normalised document to its leaks of ``items`` (id, normalised text)."""
    budgets = [int(len(t) * rate) if len(t) >= LEAST else 0 for _, t in items]
    automaton = ahocorasick.Automaton()
    whole: dict[str, list[int]] = {}
    places: dict[str, list[tuple[int, int]]] = {}
    for k, (_, t) in enumerate(items):
        if len(t) < min(LEAST, SHORT_CHARS) and len(t.split()) < SHORT_WORDS:
            whole.setdefault(t, []).append(k)
            continue
        for offset, piece in pieces(t, budgets[k]):
            places.setdefault(piece, []).append((k, offset))
    for piece, at in places.items():
        automaton.add_word(piece, (len(piece), at))
    if places:
        automaton.make_automaton()

    def match(text: str) -> list[dict]:
        starts: dict[int, list[int]] = {}
        if places:
            for end, (size, at) in automaton.iter(text):
                for k, offset in at:
                    starts.setdefault(k, []).append(end + 1 - size - offset)
        out = [{"item_id": items[k][0], "end": len(text), "distance": 0} for k in whole.get(text, ()) if text]
        for k, found in starts.items():
            item, budget = items[k][1], budgets[k]
            if len(item) < LEAST:
                ends = [s + len(item) for s in sorted(set(found)) if at_boundaries(text, s, s + len(item))]
                out += [{"item_id": items[k][0], "end": e, "distance": 0} for e in ends[:1]]
                continue
            best, lo, hi = None, None, None
            for s in [*sorted(set(found)), None]:
                if lo is not None and (s is None or s - budget > hi):
                    b = best_end(item, text[lo:hi], budget)
                    if b is not None and (best is None or b[0] < best[0]):
                        best = (b[0], lo + b[1])
                    lo = None
                if s is not None:
                    lo = max(0, s - budget) if lo is None else lo
                    hi = min(len(text), s + len(item) + budget)
            if best is not None:
                out.append({"item_id": items[k][0], "end": best[1], "distance": best[0]})
        return sorted(out, key=lambda x: (x["item_id"] is None, x["item_id"] or 0))

    return match


def item_blocks(benchmark: DataFrame, *, key: str = "item_id", text: str = "text", block_chars: int = BLOCK_CHARS):
    """Lists of (id, normalised text), each of about ``block_chars`` characters."""
    given = benchmark.where(F.col(text).isNotNull()).select(
        F.col(key).cast("long").alias("id"), F.col(text).alias("text")
    )
    total = given.agg(F.sum(F.length("text"))).first()[0] or 0
    blocks = max(1, -(-total // block_chars))
    for b in range(blocks):
        mine = given.where(F.pmod(F.xxhash64("id", "text"), F.lit(blocks)) == b) if blocks > 1 else given
        items = sorted({(r["id"], normal(r["text"])) for r in mine.toLocalIterator()}, key=lambda x: (x[0] is None, x[0] or 0, x[1]))
        yield [(i, t) for i, t in items if t]


def flag(docs: DataFrame, benchmark: DataFrame, *, text: str = "text", rate: float = RATE, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """``docs`` with ``leaks``: array of struct item_id, end (in the normalised text), distance. No shuffle."""
    sc = docs.sparkSession.sparkContext
    out = docs.withColumn("leaks", F.array().cast(LEAK))
    passes = 0
    for items in item_blocks(benchmark, block_chars=block_chars):
        if not items:
            continue
        if passes:
            out = staged(out, "leaks")
        out = out.withColumn("leaks", F.concat("leaks", _leaks(sc.broadcast(items), rate)(F.col(text))))
        passes += 1
    return out


def _leaks(items: Broadcast, rate: float):
    kind = pa.list_(pa.struct([("item_id", pa.int64()), ("end", pa.int64()), ("distance", pa.int32())]))
    made: list[Callable[[str], list[dict]]] = []  # one automaton for each task

    @F.arrow_udf(LEAK)
    def leaks(texts: pa.Array) -> pa.Array:
        if not made:
            made.append(matcher(items.value, rate))
        return pa.array([made[0](normal(t.as_py() or "")) for t in texts], type=kind)

    return leaks
