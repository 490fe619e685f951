"""Spelling variants: words one edit apart, found by a bit-sliced position index.

Words. Tasks count the runs of letters of whole texts; some runs lose a code point by a
hash rule (the misspellings to be found again). Spark adds the tasks' counts up.

Index. For a set of words there is one bitset per (position, letter): bit ``k`` is set
where word ``k`` has that letter at that position. A query walks its own code points
once, with four bitsets: words that agree so far (no error), and words with one error
so far, by the shift that it left: a replaced code point (positions stay level), one
more in the word (its positions run ahead), one less (they lag). Each step is a few
``&`` and ``|`` over all words of the set at once. The error is taken at the first
position that differs, so that a pair is met once.

Sets. A pair's first difference lies in a window of positions; what stands before and
behind the window is then equal in both words, and is the key that brings them
together. A word of length L joins the sets of pairs whose shorter word has length L
and L - 1, once for each window; two windows cover a word at first. A key with more than
``MOST`` words gives way to the two halves of its window, again and again, down to
windows of one position, whose sets no corpus can grow: their words differ by the
letters of one or two places. So no task holds a large set, however common a beginning
or an ending is.

Results for odd input: a null text has no words; a null id stands as the empty string in
the hash rule; runs of any length count; repeated rows count as often as they
stand there; an empty table, or one without words that count, gives no rows. Other
columns play no part.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterable, Iterator
from itertools import islice

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesmart.llm.common import LOWER, UPPER, staged

#: Letters of a run: A-Z, a-z and the upper half of Latin-1.
RUN = "[A-Za-zÀ-ÿ]+"
#: A run loses a code point where this divides its hash.
DIVISOR = 199
LEAST_LENGTH, LEAST_COUNT, RATIO = 6, 5, 5
#: Words of a set that one index holds; more are split by narrower windows.
MOST = 2048
#: Different words that a task counts before it hands them on.
HELD_WORDS = 200_000
#: Runs of a text that are looked at together.
STEP = 100_000
#: Keys or roots that are broadcast; more are joined by a shuffle.
BROADCAST_ROWS = 200_000

_FOLD = str.maketrans(UPPER, LOWER)


def worn(run: str, prefix: int) -> str:
    """A lower-cased run, less a code point where the hash rule says so; ``prefix`` is the crc32 of ``<doc_id>:``."""
    h = zlib.crc32(run.encode(), prefix)
    if h % DIVISOR:
        return run
    at = h % len(run)
    return run[:at] + run[at + 1 :]


def word_counts(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """word and n: words of ``LEAST_LENGTH`` code points that occur ``LEAST_COUNT`` times in all texts."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter[str] = Counter()

        def out() -> pa.RecordBatch:
            columns = [pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64())]
            batch = pa.RecordBatch.from_arrays(columns, ["word", "n"])
            held.clear()
            return batch

        finder = re.compile(RUN)
        for batch in batches:
            for doc, body in zip(batch.column(0), batch.column(1)):
                if not body.is_valid:
                    continue
                prefix = zlib.crc32(f"{doc.as_py() if doc.is_valid else ''}:".encode())
                body = body.as_py()
                if len(body) < 8 * STEP:
                    found: Iterable[list[str]] = (finder.findall(body),)
                else:
                    runs = (m.group() for m in finder.finditer(body))
                    found = iter(lambda: list(islice(runs, STEP)), [])
                for some in found:
                    for run, n in Counter(some).items():
                        if len(run) >= LEAST_LENGTH and len(word := worn(run.translate(_FOLD), prefix)) >= LEAST_LENGTH:
                            held[word] += n
                    if len(held) > HELD_WORDS:
                        yield out()
        if held:
            yield out()

    counted = docs.select(F.col(key).cast("string"), F.col(text)).mapInArrow(count, "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= LEAST_COUNT)


class PositionIndex:
    """Bitsets over some words by (position, letter) for positions from ``start`` to ``stop``, and by length."""

    def __init__(self, words: list[str], start: int, stop: int):
        slots: dict[tuple[int, str], int] = {}
        lengths: dict[int, int] = {}
        for k, word in enumerate(words):
            bit = 1 << k
            lengths[len(word)] = lengths.get(len(word), 0) | bit
            for i, c in enumerate(word[start : stop + 1], start):
                slots[i, c] = slots.get((i, c), 0) | bit
        self.every = (1 << len(words)) - 1
        self.slots, self.lengths, self.start, self.stop = slots, lengths, start, stop

    def near(self, word: str) -> int:
        """Bits of the words exactly one edit from ``word`` whose first difference lies in ``[start, stop)``.

        All words of the index agree with each other before ``start`` and, counted from
        their ends, behind ``stop``; only positions between need a look.
        """
        at, n = self.slots.get, len(word)
        same, level, ahead, lags = self.every, 0, 0, 0
        for i in range(self.start, min(self.stop, n)):
            c = word[i]
            here = at((i, c), 0)
            differs = same & ~here
            # lags: the word's position is one behind the query's; ahead: one in front
            lags = lags & at((i - 1, c), 0) if i > self.start else 0
            lags |= differs
            ahead = (ahead | differs) & at((i + 1, c), 0)
            level = (level & here) | differs
            same &= here
        if n < self.stop:
            ahead |= same  # the word goes on by one code point
        elif n > self.stop:
            lags &= at((self.stop - 1, word[self.stop]), 0)
        lengths = self.lengths.get
        return (level & lengths(n, 0)) | (ahead & lengths(n + 1, 0)) | (lags & lengths(n - 1, 0))


def _windows(entries: DataFrame) -> DataFrame:
    """word, n, m, a, b -> the same with ``key``: what two words with their first difference in [a, b) share.

    ``m`` is the shorter word's length; behind the window stand at least m - b equal code points.
    """
    tail = F.greatest(F.col("m") - F.col("b"), F.lit(0))
    behind = F.when(tail > 0, F.col("word").substr(F.length("word") - tail + 1, tail)).otherwise(F.lit(""))
    head = F.col("word").substr(F.lit(1), F.col("a"))
    return entries.withColumn("key", F.concat_ws("|", "m", "a", "b", head, behind))


def candidate_sets(words: DataFrame, most: int = MOST) -> DataFrame:
    """word, n, m, a, b, key: each word in the sets where its near words are; a set has at most ``most`` words
    or a window of one position."""
    half = lambda m: F.floor(m / 2).cast("int")
    pair = lambda m: F.array(
        F.struct(m.alias("m"), F.lit(0).alias("a"), half(m).alias("b")),
        F.struct(m.alias("m"), half(m).alias("a"), (m + 1).cast("int").alias("b")),
    )
    length = F.length("word").cast("int")
    spread = F.explode(F.concat(pair(length), pair((length - 1).cast("int"))))
    entries = words.select("word", "n", spread.alias("w")).select("word", "n", "w.m", "w.a", "w.b")
    entries = staged(_windows(entries), "sets")
    done = []
    while True:
        large = staged(
            entries.where("b - a > 1").groupBy(F.col("key").alias("_key")).agg(F.count("*").alias("size"))
            .where(F.col("size") > most).select("_key"),
            "large-sets",
        )
        many = large.count()
        if not many:
            done.append(entries)
            break
        if many <= BROADCAST_ROWS:
            large = F.broadcast(large)
        done.append(entries.join(large, F.col("key") == F.col("_key"), "left_anti"))
        middle = F.floor((F.col("a") + F.col("b")) / 2).cast("int")
        halves = F.explode(
            F.array(F.struct(F.col("a"), middle.alias("b")), F.struct(middle.alias("a"), F.col("b")))
        )
        again = entries.join(large, F.col("key") == F.col("_key"), "left_semi")
        again = again.select("word", "n", "m", halves.alias("w")).select("word", "n", "m", "w.a", "w.b")
        entries = staged(_windows(again), "sets")
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    return out


def near_in_set(words: list[str], counts: list[int], m: int, a: int, b: int) -> Iterator[tuple[str, int, int, str]]:
    """(word, near words, largest n among them, that word) for words of a set that have near ones in it."""
    lengths = [len(w) for w in words]
    if m not in lengths or len(words) < 2:
        return
    index = PositionIndex(words, a, b)
    # two words of length m + 1 are compared in the sets of that length
    shorter = index.lengths.get(m, 0)
    for k, word in enumerate(words):
        found = index.near(word)
        if lengths[k] > m:
            found &= shorter
        if not found:
            continue
        n_near, best, best_word = 0, -1, ""
        while found:
            low = found & -found
            j = low.bit_length() - 1
            found ^= low
            n_near += 1
            if counts[j] > best or (counts[j] == best and words[j] < best_word):
                best, best_word = counts[j], words[j]
        yield word, n_near, best, best_word


def _sets_in_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by key, one set after another."""
    key, place, words, counts = None, None, [], []
    rows: list[tuple[str, int, int, str]] = []

    def out() -> pa.RecordBatch:
        kinds = (pa.string(), pa.int64(), pa.int64(), pa.string())
        columns = [pa.array(c, kind) for c, kind in zip(zip(*rows), kinds)]
        batch = pa.RecordBatch.from_arrays(columns, ["word", "n_near", "best_n", "best"])
        rows.clear()
        return batch

    for batch in batches:
        data = batch.to_pydict()
        for k, word, n, m, a, b in zip(data["key"], data["word"], data["n"], data["m"], data["a"], data["b"]):
            if k != key:
                if len(words) > 1:
                    rows.extend(near_in_set(words, counts, *place))
                    if len(rows) > 10_000:
                        yield out()
                key, place, words, counts = k, (m, a, b), [], []
            words.append(word)
            counts.append(n)
    if len(words) > 1:
        rows.extend(near_in_set(words, counts, *place))
    if rows:
        yield out()


def near_words(words: DataFrame, most: int = MOST) -> DataFrame:
    """word, n_near, best_n, best: for each word with near ones their number and the most frequent
    (ties: the smallest in code-point order)."""
    sets = candidate_sets(words, most).select("key", "word", "n", "m", "a", "b")
    sorted_sets = sets.repartition("key").sortWithinPartitions("key")
    found = sorted_sets.mapInArrow(_sets_in_task, "word string, n_near long, best_n long, best string")
    best = F.min(F.struct((-F.col("best_n")).alias("n"), F.col("best").alias("word")))
    return found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("b")).select(
        "word", "n_near", (-F.col("b.n")).alias("best_n"), F.col("b.word").alias("best")
    )


def roots(forms: DataFrame) -> DataFrame:
    """form and root: where the chain of forms that begins at each form ends.

    ``forms`` has word and form. A form's count is at least ``RATIO`` times the word's, so a
    chain has no circle and its length grows with the logarithm of the largest count. Only
    different forms are followed, whatever the number of words that lead to one.
    """
    links = staged(forms.select("word", "form"), "forms")
    chains = staged(links.select("form", F.col("form").alias("root")).distinct(), "chains")
    while True:
        step = chains.join(links.select("word", F.col("form").alias("_next")), F.col("root") == F.col("word"), "left")
        moved = staged(step.select("form", F.coalesce("_next", "root").alias("root"), F.col("_next").isNotNull().alias("on")), "chains")
        chains = moved.select("form", "root")
        if moved.where("on").isEmpty():
            return chains


def variants(docs: DataFrame, key: str = "doc_id", text: str = "text", most: int = MOST) -> DataFrame:
    """word, form, root, n, n_near, form_n of every word of the texts."""
    words = staged(word_counts(docs, key, text), "words")
    near = near_words(words, most).withColumnRenamed("word", "_w")
    joined = words.join(near, F.col("word") == F.col("_w"), "left")
    leads = F.col("best_n") >= RATIO * F.col("n")
    formed = staged(
        joined.select(
            "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            F.when(leads, F.col("best")).alias("form"), F.when(leads, F.col("best_n")).alias("form_n"),
        ),
        "formed",
    )
    chains = roots(formed.where("form is not null")).withColumnRenamed("form", "_f")
    if chains.count() <= BROADCAST_ROWS:
        chains = F.broadcast(chains)
    rooted = formed.join(chains, F.col("form") == F.col("_f"), "left")
    return rooted.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
