"""Best-fit packing of tokenised documents by swap-based local search.

Tokens. A text is normalised and split by the tokenizer's own rules; each different
piece of text is tokenised once by the library and remembered as bytes. Texts with
special strings, or with code points that this Python's Unicode tables do not know, go
to the library whole. A document's identifiers end with one more; only documents beyond
the capacity are cut. Texts stay where they are read: Spark shuffles piece lengths.

Packing. Pieces are dealt at random to groups of bounded size, so that each group is
a fair sample of all lengths. A group starts from best-fit decreasing. While it holds more
sequences than a lower bound, a local search works between sequences with room left:
it takes the least full one and moves a document out of it, or exchanges one for one,
two for one or one for two, so that the fuller sequence gets fuller; every step raises the sum of
squared fills, until sequences empty. Then the least full sequences of ``FAN_IN`` groups come together
and are searched alike, level by level, until one group is left. All others stay as they are.

Results for odd input: a null or empty text is the end identifier alone; texts of any
length are tokenised whole, in steps that end before white space; repeated rows, null
ids and equal lengths are packed like others; an empty table gives no rows. Other
columns play no part.
"""

from __future__ import annotations

import json
import os
import re
import unicodedata
import zlib
from array import array
from collections.abc import Callable, Iterator
from itertools import chain, combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salesmart.llm.common import staged

CAPACITY, END_ID = 2048, 0
#: Pieces of text that a worker remembers, and the longest of them.
REMEMBERED, LONGEST = 1_000_000, 64
#: Code points of a text that are tokenised in one step, at least.
STEP = 1 << 18
#: Pieces that a group holds, groups that meet at the next level, sequences that each sends there.
GROUP, FAN_IN, SENT = 16_384, 64, 64
#: Tries of the local search for each sequence of a group; what they leave stays packed as it is.
SEARCH_STEPS = 4
#: Documents of a sequence that exchanges of two look at; pairs out of the least full one.
PAIRED, PAIRS = 16, 256
# Unicode's white space.
_WHITE = [*range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
# Contractions of the tokenizer's pattern.
_CONTRACTIONS = "'s|'t|'re|'ve|'m|'ll|'d"
# Bytes that byte-level vocabularies write as themselves; the others follow from U+0100 on.
_PLAIN = [*range(ord("!"), ord("~") + 1), *range(0xA1, 0xAD), *range(0xAE, 0x100)]


def _ranges(marked: np.ndarray) -> str:
    """The marked code points as the inside of a character class."""
    edges = np.flatnonzero(np.diff(np.concatenate([[False], marked, [False]]).astype(np.int8)))
    return "".join(f"{re.escape(chr(a))}-{re.escape(chr(b - 1))}" for a, b in edges.reshape(-1, 2).tolist())


def _patterns() -> tuple[dict[str, re.Pattern], dict[str, re.Pattern], re.Pattern]:
    """Pieces of a lower-cased text and code points without a known class, by the text's reach; white space.

    Reach is ascii, bmp (two bytes a code point) or any: a class with ranges beyond
    the first plane makes every test of it slow.
    """
    kinds = [unicodedata.category(chr(c)) for c in range(0x110000)]
    first = np.array([k[0] for k in kinds])
    unknown = np.array([k == "Cn" for k in kinds])
    white = "".join(map(chr, _WHITE))
    pieces, odd = {}, {"ascii": re.compile("(?!)")}
    for reach, end in (("ascii", 0x80), ("bmp", 0x10000), ("any", 0x110000)):
        letters, numbers = _ranges(first[:end] == "L"), _ranges(first[:end] == "N")
        blank = white if end > 0x80 else "\t-\r "
        pieces[reach] = re.compile(rf"[{letters}]+|{_CONTRACTIONS}|[{numbers}]|[^{blank}{letters}{numbers}]+")
        if end > 0x80:
            odd[reach] = re.compile(f"[{_ranges(unknown[:end])}]")
    return pieces, odd, re.compile(f"[{white}]")


def steps_of(text: str, white: re.Pattern, step: int = STEP) -> Iterator[str]:
    """A text in parts that begin with white space, each of ``step`` code points or more."""
    at = 0
    while len(text) - at > 2 * step:
        cut = white.search(text, at + step)
        if cut is None:
            break
        yield text[at : cut.start()]
        at = cut.start()
    yield text[at:]


def identifiers(tokenizer: str) -> Callable[[str], Iterator[bytes]]:
    """A function from a text to its identifiers, as little-endian unsigned 32-bit numbers, in steps.

    ``tokenizer`` is the text of a tokenizer file whose normaliser composes, blanks white space
    and lower-cases, and whose pieces are contractions, letters, single digits and runs of others.
    """
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    special = [t["content"] for t in json.loads(tokenizer)["added_tokens"]]
    whole = Tokenizer.from_str(tokenizer)
    model = whole.model
    pieces, odd, white = _patterns()
    spare = (b for b in range(256) if b not in set(_PLAIN))
    written = {b: chr(b) for b in _PLAIN} | {b: chr(256 + i) for i, b in enumerate(spare)}
    known: dict[str, bytes] = {}

    def by_library(text: str) -> bytes:
        return array("I", whole.encode(text, add_special_tokens=False).ids).tobytes()

    def merged(piece: str) -> bytes:
        if not piece.isascii() or not piece.isprintable():
            piece = "".join([written[b] for b in piece.encode("utf-8", "surrogatepass")])
        return array("I", [t.id for t in model.tokenize(piece)]).tobytes()

    def step(text: str) -> bytes:
        if any(s in text for s in special):
            return by_library(text)
        if text.isascii():
            reach, text_low = "ascii", text.lower()
        else:
            # lower-casing goes code point by code point: no final sigma
            text_low = unicodedata.normalize("NFC", text).replace("Σ", "σ").lower()
            reach = "bmp" if len(text_low.encode("utf-16-le", "surrogatepass")) == 2 * len(text_low) else "any"
        parts = pieces[reach].findall(text_low)
        try:
            return b"".join([known[p] for p in parts])
        except KeyError:
            pass
        if len(known) > REMEMBERED:
            known.clear()
        new = [p for p in dict.fromkeys(parts) if p not in known]
        if reach != "ascii" and any(odd[reach].search(p) for p in new if not p.isascii()):
            return by_library(text)
        known.update((p, merged(p)) for p in new)
        out = b"".join([known[p] for p in parts])
        for p in new:
            if len(p) > LONGEST:
                del known[p]
        return out

    return lambda text: map(step, steps_of(text, white))


def token_pieces(
    docs: DataFrame, vocabulary: str, key: str = "doc_id", text: str = "text", capacity: int = CAPACITY, end_id: int = END_ID
) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32: each document's identifiers, cut at the capacity."""
    with open(vocabulary, encoding="utf-8") as f:
        shared = docs.sparkSession.sparkContext.broadcast({"tokenizer": f.read()})
    end = np.array([end_id], "<u4").tobytes()
    size = 4 * capacity

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # a broadcast value stays with its worker, and so do the pieces that earlier tasks met
        kept = shared.value
        if "ids_of" not in kept:
            kept["ids_of"] = identifiers(kept["tokenizer"])
        ids_of = kept["ids_of"]
        for batch in batches:
            rows, out = [], []
            for row, body in enumerate(batch.column(1)):
                held, piece, start = b"", 0, 0
                for ids in chain(ids_of(body.as_py()) if body.is_valid else (), (end,)):
                    held += ids
                    at = 0
                    while len(held) - at > size:
                        rows.append(row)
                        out.append((piece, start, capacity, zlib.crc32(held[at : at + size])))
                        piece, start, at = piece + 1, start + capacity, at + size
                    held = held[at:]
                rows.append(row)
                out.append((piece, start, len(held) // 4, zlib.crc32(held)))
            if out:
                kinds = (pa.int32(), pa.int64(), pa.int64(), pa.int64())
                columns = [pa.array(c, kind) for c, kind in zip(zip(*out), kinds)]
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(rows)), *columns], names)

    names = ["doc_id", "piece", "start", "length", "ids_crc32"]
    kind = docs.select(key).schema[0].dataType.simpleString()
    return docs.select(key, text).mapInArrow(cut, f"doc_id {kind}, piece int, start long, length long, ids_crc32 long")


def least_sequences(lengths: np.ndarray, capacity: int) -> int:
    """A lower bound: long pieces need sequences of their own, the rest at least their sum less the room beside those."""
    n = np.bincount(lengths, minlength=capacity + 1)[: capacity + 1]
    size = np.arange(capacity + 1)
    count, total = np.cumsum(n), np.cumsum(n * size)
    half = capacity // 2
    best = -(-int(total[-1]) // capacity)
    for a in np.unique(np.minimum(lengths, half)):
        longest = count[-1] - count[capacity - a]  # nothing as long as ``a`` fits beside these
        mid_n, mid = count[capacity - a] - count[half], total[capacity - a] - total[half]
        small = total[half] - (total[a - 1] if a else 0)
        best = max(best, int(longest + mid_n + max(0, -(-(small - (mid_n * capacity - mid)) // capacity))))
    return best


def best_fit(lengths: np.ndarray, capacity: int) -> list[list[int]]:
    """Best-fit decreasing: each piece goes to the fullest sequence that has room."""
    rooms: list[list[int]] = [[] for _ in range(capacity + 1)]
    some = 0  # bit r: there is a sequence with room r
    bins: list[list[int]] = []
    for i in np.argsort(-lengths, kind="stable").tolist():
        n = int(lengths[i])
        fits = some >> n
        if fits:
            room = n + (fits & -fits).bit_length() - 1
            b = rooms[room].pop()
            if not rooms[room]:
                some ^= 1 << room
            bins[b].append(i)
            room -= n
        else:
            b, room = len(bins), capacity - n
            bins.append([i])
        if room:
            rooms[room].append(b)
            some |= 1 << room
    return bins


def search(bins: list[list[int]], lengths: np.ndarray, capacity: int, target: int) -> list[list[int]]:
    """Local search between sequences with room until ``target`` sequences are left or no step helps.

    A step takes ``d`` tokens out of a sequence ``a``, the least full first, and adds them to
    another one of at least its fill: the sum of squared fills grows, so that no state comes twice.
    """
    size = lengths.tolist()
    fill = np.array([sum(size[i] for i in b) for b in bins], np.int64)
    left, tries = len(bins), SEARCH_STEPS * len(bins)
    stuck = np.zeros(len(bins), bool)  # sequences that no step takes from, as things are

    def pairs_of(some: list[int]) -> list[tuple[int, int]]:
        longest = some if len(some) <= PAIRED else sorted(some, key=lambda i: -size[i])[:PAIRED]
        return list(combinations(longest, 2))

    def members(of: list[int]) -> tuple[np.ndarray, ...]:
        """Documents and pairs of documents of some sequences, and the sequences they are in."""
        ones = [(i, b) for b in of for i in bins[b]]
        twos = [(i, j, b) for b in of for i, j in pairs_of(bins[b])]
        return np.array(ones, np.int64).reshape(-1, 2), np.array(twos, np.int64).reshape(-1, 3)

    ones, twos = members(np.flatnonzero((fill > 0) & (fill < capacity)).tolist())
    while left > target and tries > 0:
        waiting = np.flatnonzero((fill > 0) & (fill < capacity) & ~stuck)
        if not len(waiting):
            break
        a = int(waiting[fill[waiting].argmin()])
        tries -= 1
        singles = {size[i]: (i,) for i in bins[a]}
        doubles = dict(sorted(((size[i] + size[j], (i, j)) for i, j in pairs_of(bins[a])), reverse=True)[:PAIRS])
        # (tokens moved, documents out of a, sequence that takes them, documents back)
        best: tuple[int, tuple, int, tuple] = (0, (), 0, ())
        fits = np.flatnonzero((fill >= fill[a]) & (fill < capacity))
        fits = fits[fits != a]
        for s, out in singles.items():
            roomy = fits[capacity - fill[fits] >= s]
            if len(roomy) and s > best[0]:
                best = (s, out, int(roomy[fill[roomy].argmax()]), ())
        for held, moves in ((ones, (singles | doubles)), (twos, singles)):
            owner = held[:, -1]
            other = (owner != a) & (fill[owner] >= fill[a])
            some, owner = held[other, :-1], owner[other]
            if not len(some):
                continue
            total, room = lengths[some].sum(1), capacity - fill[owner]
            for s, out in moves.items():
                d = s - total
                d[(d < 0) | (d > room)] = 0
                k = int(d.argmax())
                if d[k] > best[0]:
                    best = (int(d[k]), out, int(owner[k]), tuple(some[k].tolist()))
        d, out, b, back = best
        if not d:
            stuck[a] = True
            continue
        bins[a] = [i for i in bins[a] if i not in out] + list(back)
        bins[b] = [i for i in bins[b] if i not in back] + list(out)
        fill[a] -= d
        fill[b] += d
        left -= not bins[a]
        stuck[:] = False
        new_ones, new_twos = members([x for x in (a, b) if 0 < fill[x] < capacity])
        keep_ones, keep_twos = ~np.isin(ones[:, -1], (a, b)), ~np.isin(twos[:, -1], (a, b))
        ones, twos = np.concatenate([ones[keep_ones], new_ones]), np.concatenate([twos[keep_twos], new_twos])
    return [b for b in bins if b]


def pack_lengths(lengths: np.ndarray, capacity: int, given: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(sequence, offset) of each piece; ``given`` is a packing to start from where best-fit decreasing is no better."""
    bins = best_fit(lengths, capacity)
    if given is not None and len(np.unique(given)) <= len(bins):
        order = np.argsort(given, kind="stable")
        bins = [x.tolist() for x in np.split(order, np.flatnonzero(np.diff(given[order])) + 1)]
    target = least_sequences(lengths, capacity)
    if len(bins) > target:
        bins = search(bins, lengths, capacity, target)
    sequence, offset = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    for b, members in enumerate(bins):
        at = 0
        for i in members:
            sequence[i], offset[i] = b, at
            at += int(lengths[i])
    return sequence, offset


def _groups(rows: DataFrame, level: int, capacity: int, sent: int) -> DataFrame:
    """Packs each group ``g``; ``open`` marks its ``sent`` least full sequences with room."""

    def one(table: pa.Table) -> pa.Table:
        lengths = table.column("length").to_numpy().astype(np.int64)
        given = table.column("sequence_id").to_numpy() if level else None
        sequence, offset = pack_lengths(lengths, capacity, given)
        fill = np.bincount(sequence, weights=lengths).astype(np.int64)
        least = np.argsort(fill, kind="stable")[:sent]
        is_open = np.zeros(len(fill), bool)
        is_open[least[fill[least] < capacity]] = True
        ids = (level << 56) + (table.column("g")[0].as_py() << 24) + sequence
        made = {"sequence_id": ids, "offset": offset, "open": is_open[sequence]}
        return pa.table({c: pa.array(made[c]) if c in made else table.column(c) for c in table.column_names})

    return rows.groupBy("g").applyInArrow(one, rows.schema)


def pack(
    docs: DataFrame, vocabulary: str, key: str = "doc_id", text: str = "text", capacity: int = CAPACITY, end_id: int = END_ID,
    group: int = GROUP, fan_in: int = FAN_IN, sent: int = SENT,
) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset of every piece of every document."""
    spark: SparkSession = docs.sparkSession
    pieces = staged(token_pieces(docs, vocabulary, key, text, capacity, end_id), "pieces")
    groups = max(1, -(-pieces.count() // group))
    # the place of a row in the written files is the same whenever a task runs again
    dealt = F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(groups)).alias("g")
    none = F.lit(0).cast("long")
    rows = pieces.select("*", none.alias("sequence_id"), none.alias("offset"), F.lit(False).alias("open"), dealt)
    level, done = 0, []
    while True:
        packed = staged(_groups(rows, level, capacity, sent if groups > 1 else 0), f"packed-{level}")
        if groups == 1:
            done.append(packed)
            break
        done.append(packed.where("not open"))
        level, groups = level + 1, -(-groups // fan_in)
        rows = packed.where("open").withColumn("g", F.floor(F.col("g") / fan_in))
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    return out.drop("open", "g")
