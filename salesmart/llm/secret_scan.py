"""Secret scans: base patterns, and assignment-aware lexing.

Base patterns are leftmost non-overlapping matches per kind (``assign``,
``access``, ``hex``). The lexer reads lines that assign something: source
(``const name = "..."``, ``name := '...'``, ``conf["name"] = "..."``), JSON and YAML
(``"name": "..."``), INI and shell (``export NAME=...``). It makes pairs of a
target name and an expression of literals, names and ``+``; names given a value
before carry it on, also through ``${name}`` inside literals. A value may stand on
the line behind its key, indented. A value is scored by how sensitive the words of its
target name are and how random it looks; the literals of a value that scores enough
are spans of kind ``literal``.

A value is not its text: it carries what the score needs (length, how often each
character stands in it, flags) and the values it was made of. So a name that doubles
itself line by line costs a line each time, and a chain of names is walked once, when
the spans of the values that scored are told. Time and memory grow with the text.

Results for odd input: a null text is empty; texts are read whole; offsets count
code points, ends are exclusive; repeated rows get equal results; an empty table
stays empty; other columns play no part.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

KINDS = ("assign", "access", "hex", "literal")
# The base patterns.
_ASSIGN = re.compile(
    r"((?i:password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.ASCII
)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{32,}")
ASSIGN_CHARS, ACCESS_CHARS = 8, 16
_ASSIGN_WORDS = ("passw", "secret", "token", "apikey", "api_key")

#: How sensitive a target name is that has these words one after another.
SENSITIVE = {
    "password": 1.0, "passwd": 1.0, "pwd": 0.9, "passphrase": 1.0, "secret": 1.0, "token": 0.9, "apikey": 1.0,
    "api key": 1.0, "access key": 1.0, "private key": 1.0, "secret key": 1.0, "signing key": 0.9,
    "encryption key": 0.9, "auth key": 0.9, "credential": 0.9, "credentials": 0.9, "auth": 0.6,
}
_STEMS = ("pass", "pwd", "secret", "token", "key", "credential", "auth")
LITERAL_CHARS = 8
#: Name and value count half each.
THRESHOLD = 0.75
#: Bits a character from which a value counts as fully random.
RANDOM_BITS = 3.5

_TOKEN = re.compile(
    r"""(?P<quote>["'`])|(?P<name>[^\W\d][\w$]*(?:[.-][\w$]+)*)|(?P<op>:=|=>|[=!<>]=|[=:+])|(?P<other>[^\s\w])|(?P<number>\d[\w.-]*)"""
)
_SIMPLE = re.compile(r"\s*([^\W\d][\w$]*(?:[.-][\w$]+)*)\s*[:=]\s*([A-Za-z0-9_]+)\s*")
_QUOTES = re.compile(r"""(\\*)(["'`])""")
_BARE = re.compile(r"[A-Za-z0-9+/_.=~!@%^&*-]+")
_REFERENCE = re.compile(r"\$\{(\w+)\}|\$(\w+)")
_NAME_WORD = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+|\d+")
_PLACEHOLDER = re.compile(r"(?i)example|change.?me|your|dummy|placeholder|redacted|sample|x{4,}|\*{3,}|<.*>|\.{3}")


#: Characters of joined values are counted in so many bins, by the low byte of the code point.
_BINS = 256
#: Counts of a joined value are scaled down beyond this length; their shares stay.
_LONG = 1e15


@dataclass(frozen=True)
class Looks:
    """What the score of a value needs."""

    length: float
    counts: Counter | np.ndarray
    blank: bool
    placeholder: bool
    digit: bool
    letter: bool
    lower: bool
    upper: bool
    title: bool


class Value:
    """A literal, or values one after another; how it looks is worked out when it is asked for."""

    __slots__ = ("text", "spans", "quoted", "parents", "_looks")

    def __init__(self, text: str = "", spans: tuple[tuple[int, int], ...] = (), quoted: bool = False, looks: Looks | None = None,
                 parents: tuple["Value", ...] = ()):
        self.text, self.spans, self.quoted, self._looks, self.parents = text, spans, quoted, looks, parents

    @property
    def looks(self) -> Looks:
        if self._looks is None:
            t = self.text
            self._looks = Looks(
                len(t), Counter(t), re.search(r"\s", t) is not None, _PLACEHOLDER.search(t) is not None,
                re.search(r"\d", t) is not None, re.search(r"[A-Za-z]", t) is not None,
                any(map(str.islower, t)), any(map(str.isupper, t)), t.istitle(),
            )
        return self._looks


def sensitivity(name: str) -> float:
    words = [w.lower() for w in _NAME_WORD.findall(name)]
    joined = f" {' '.join(words)} "
    return max((s for w, s in SENSITIVE.items() if f" {w} " in joined), default=0.0)


def joined(parts: list[Value], quoted: bool | None = None) -> Value:
    """Values one after another."""
    if len(parts) == 1:
        return parts[0]
    counts, length = np.zeros(_BINS), 0.0
    for p in parts:
        length += p.looks.length
        if isinstance(p.looks.counts, Counter):
            for c, k in p.looks.counts.items():
                counts[ord(c) % _BINS] += k
        else:
            counts += p.looks.counts
    if length > _LONG:
        counts, length = counts * (_LONG / length), _LONG
    flags = {f: any(getattr(p.looks, f) for p in parts) for f in ("blank", "placeholder", "digit", "letter", "lower", "upper")}
    looks = Looks(length, counts, title=False, **flags)
    any_quoted = any(p.quoted for p in parts) if quoted is None else quoted
    return Value("", (), any_quoted, looks, tuple(dict.fromkeys(parts)))


def randomness(value: Value | str) -> float:
    """0 to 1: bits a character against ``RANDOM_BITS``; 0 for placeholders, words and short values."""
    v = (Value(value) if isinstance(value, str) else value).looks
    if v.length < LITERAL_CHARS or v.blank or v.placeholder:
        return 0.0
    if not v.digit and (v.lower != v.upper or v.title):
        return 0.0
    counts = v.counts.values() if isinstance(v.counts, Counter) else v.counts[v.counts > 0].tolist()
    bits = -sum(c / v.length * math.log2(c / v.length) for c in counts)
    return min(1.0, bits / RANDOM_BITS)


def tokens_of(line: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) of the tokens of a line; a quote without its partner is a character like others."""
    closing: dict[str, list[int]] | None = None
    out, at = [], 0
    while (m := _TOKEN.search(line, at)) is not None:
        kind, start, at = m.lastgroup, m.start(), m.end()
        if kind == "quote":
            kind, q = "other", m[0]
            if q != "'" or start == 0 or not (line[start - 1].isalnum() or line[start - 1] == "_"):
                if closing is None:  # where each kind of quote can end, found once a line
                    closing = {'"': [], "'": [], "`": []}
                    for c in _QUOTES.finditer(line):
                        if c[2] == "`" or len(c[1]) % 2 == 0:
                            closing[c[2]].append(c.start(2))
                ends = closing[q]
                k = bisect_right(ends, start)
                if k < len(ends):
                    kind, at = "string", ends[k] + 1
        out.append((kind, start, at))
    return out


def _resolve(literal: str, at: int, quoted: bool, known: dict[str, Value]) -> Value:
    """A literal's value, with the values of the names it refers to in place."""
    own = ((at, at + len(literal)),)
    named = [m for m in _REFERENCE.finditer(literal) if (m[1] or m[2]) in known] if "$" in literal else []
    if not named:
        return Value(literal, own, quoted)
    rest, end = [], 0
    for m in named:
        rest.append(literal[end : m.start()])
        end = m.end()
    parts = [Value("".join([*rest, literal[end:]]), own, quoted), *[known[m[1] or m[2]] for m in named]]
    return joined(parts, quoted)


def _expression(
    line: str, base: int, tokens: list[tuple[str, int, int]], i: int, known: dict[str, Value]
) -> tuple[Value | None, int]:
    """The value of literals and known names joined by ``+`` from token ``i`` on, and the next token."""
    parts: list[Value] = []
    text = lambda k: line[tokens[k][1] : tokens[k][2]] if k < len(tokens) else ""
    while i < len(tokens):
        kind, start, end = tokens[i]
        if kind == "string":
            v, i = _resolve(line[start + 1 : end - 1], base + start + 1, True, known), i + 1
        elif kind == "name" and line[start:end] in known and text(i + 1) not in ("(", "["):
            v, i = known[line[start:end]], i + 1
        else:
            m = _BARE.match(line, start)
            if m is None or line[start:end] in ("=", ":", "+"):
                break
            v = _resolve(m[0], base + start, False, known)
            while i < len(tokens) and tokens[i][1] < m.end():
                i += 1
        parts.append(v)
        if text(i) == "+":
            i += 1
            continue
        break
    return (joined(parts) if parts else None), i


def pairs(line: str, base: int, known: dict[str, Value]) -> Iterator[tuple[str, Value]]:
    """(target name, value) of the assignments of a line; ``known`` learns them."""
    m = _SIMPLE.fullmatch(line)
    if m is not None and m[2] not in known:  # the commonest line, by the same rules
        value = known[m[1]] = Value(m[2], ((base + m.start(2), base + m.end(2)),))
        yield m[1], value
        return
    tokens = tokens_of(line)
    text = lambda k: line[tokens[k][1] : tokens[k][2]]
    i = 0
    while i < len(tokens):
        if tokens[i][0] != "op" or text(i) not in ("=", ":", ":=", "=>") or i == 0:
            i += 1
            continue
        # the target ends before the operator: a name, a quoted key, or a key in brackets
        k = i - 1
        if text(k) == "]" and k >= 1:
            k -= 1
        kind = tokens[k][0]
        name = text(k)[1:-1] if kind == "string" else text(k) if kind == "name" else ""
        j = i + 1
        # a type between colon and equals sign
        if text(i) == ":" and j + 1 < len(tokens) and tokens[j][0] == "name" and text(j + 1) == "=":
            j += 2
        value, after = _expression(line, base, tokens, j, known)
        if name and value is not None:
            known[name] = value
            yield name, value
        i = max(after, i + 1)


def _lines(text: str) -> Iterator[tuple[int, int]]:
    """Lines that assign something; a key at a line's end takes an indented line without one of its own."""
    at = 0
    for m in _ASSIGNS.finditer(text):
        if m.start() < at:
            continue
        begin = text.rfind("\n", at, m.start()) + 1 or at
        end = text.find("\n", m.start())
        end = len(text) if end < 0 else end
        if (behind := _NEXT_LINE.match(text, end)) is not None and text[begin:end].rstrip().endswith(":"):
            end = behind.end()
        yield begin, end
        at = end


_ASSIGNS = re.compile("[=:]")
_NEXT_LINE = re.compile(r"\n[ \t]+[^\s=:#-][^\n=:]*(?=\n|\Z)")


def literals(text: str) -> list[tuple[int, int, str, float]]:
    """(start, end, target name, score) of the literals that the lexer finds secret."""
    low = text.lower()
    if ("=" not in text and ":" not in text) or not any(s in low for s in _STEMS):
        return []
    known: dict[str, Value] = {}
    strong: list[tuple[float, int, str, Value]] = []
    for begin, end in _lines(text):
        for name, value in pairs(text[begin:end], begin, known):
            s = sensitivity(name) if any(x in name.lower() for x in _STEMS) else 0.0
            random = randomness(value) if s else 0.0
            score = (s + random) / 2 if s else 0.0
            told = score >= THRESHOLD and random > 0.5
            if told and (value.quoted or (value.looks.digit and value.looks.letter)):
                strong.append((-score, len(strong), name, value))
    # the best score first, so that every value is walked once
    best: dict[tuple[int, int], tuple[str, float]] = {}
    seen: set[int] = set()
    for score, _, name, value in sorted(strong, key=lambda x: x[:2]):
        waiting = [value]
        while waiting:
            v = waiting.pop()
            if id(v) in seen:
                continue
            seen.add(id(v))
            for span in v.spans:
                best.setdefault(span, (name, -score))
            waiting.extend(v.parents)
    return [(a, b, name, score) for (a, b), (name, score) in sorted(best.items()) if b > a]


def scan_text(text: str) -> list[dict]:
    """All spans of a text by start, then kind in the order of ``KINDS``."""
    found: list[tuple[int, int, int, str | None, float]] = []
    low = text.lower()
    if any(w in low for w in _ASSIGN_WORDS):
        found += [(m.start(), 0, m.end(), m[1], 1.0) for m in _ASSIGN.finditer(text) if len(m[2]) >= ASSIGN_CHARS]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end(), None, 1.0) for m in _ACCESS.finditer(text) if len(m[0]) >= ACCESS_CHARS]
    found += [(m.start(), 2, m.end(), None, 1.0) for m in _HEX.finditer(text)]
    found += [(a, 3, b, name, score) for a, b, name, score in literals(text)]
    return [
        {"kind": KINDS[k], "start": a, "end": b, "name": name, "score": score}
        for a, k, b, name, score in sorted(found, key=lambda x: x[:3])
    ]


_SPAN = pa.list_(
    pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("name", pa.string()), ("score", pa.float64())])
)


def spans(text: Column) -> Column:
    """Array of struct kind, start, end, name, score."""

    @F.arrow_udf("array<struct<kind:string,start:bigint,end:bigint,name:string,score:double>>")
    def scanned(texts: pa.Array) -> pa.Array:
        return pa.array([scan_text(t.as_py() or "") for t in texts], type=_SPAN)

    return scanned(text)


def digest_columns(found: Column) -> dict[str, Column]:
    """Counts of the base kinds, the hash of the base spans, and all spans, of an array of spans."""
    written = lambda a: F.array_join(
        F.transform(a, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ","
    )
    base = F.filter(found, lambda s: s["kind"] != "literal")

    def count(kind: str) -> Column:
        return F.size(F.filter(found, lambda s: s["kind"] == kind)).cast("long")

    counts = {f"n_{kind}": count(kind) for kind in KINDS if kind != "literal"}
    return counts | {"base_sha256": F.sha2(written(base), 256), "spans": written(found)}
