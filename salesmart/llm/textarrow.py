"""Arrow string columns as numpy bytes, for functions that run inside tasks."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Bytes of text that a vectorised step takes at once; one longer text is a step of its own.
STEP_BYTES = 1 << 20
_SPACE = np.zeros(256, bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True
#: Bytes between words where only letters, digits and non-ASCII characters make words.
NOT_ALNUM = np.array([b < 128 and not chr(b).isalnum() for b in range(256)])
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_RANDOM = np.random.default_rng(4_2024)
_BYTE = _RANDOM.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_SHIFT_30, _SHIFT_27, _SHIFT_31 = np.uint64(30), np.uint64(27), np.uint64(31)
_MIX_1, _MIX_2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; nulls are empty."""
    if pa.types.is_string_view(column.type):
        column = column.cast(pa.large_string())
    if column.null_count:
        column = column.fill_null("")
    width = np.int64 if pa.types.is_large_string(column.type) else np.int32
    _, places, data = column.buffers()
    offsets = np.frombuffer(places, width)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    return (np.frombuffer(data, np.uint8) if data else np.zeros(0, np.uint8)), offsets


def steps(offsets: np.ndarray, most: int = STEP_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of at most ``most`` bytes, or of one row."""
    row, rows = 0, len(offsets) - 1
    while row < rows:
        end = int(np.searchsorted(offsets, offsets[row] + most, "right")) - 1
        end = min(max(end, row + 1), rows)
        yield row, end
        row = end


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    y = x >> _SHIFT_30
    y ^= x
    y *= _MIX_1
    y ^= y >> _SHIFT_27
    y *= _MIX_2
    y ^= y >> _SHIFT_31
    return y


def powers(n: int) -> np.ndarray:
    out = np.full(n, _MULTIPLIER, np.uint64)
    if n:
        out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


def run_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each run ``values[start:end]`` of 64-bit numbers; runs are in order and do not overlap."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    lengths = ends - starts
    inside = np.arange(int(lengths.sum()), dtype=np.int64)
    first = np.cumsum(lengths) - lengths
    rank = inside - np.repeat(first, lengths)
    taken = values[rank + np.repeat(starts, lengths)]
    sums = np.add.reduceat(taken * powers(int(lengths.max()))[rank], first)
    return mix64(sums + lengths.astype(np.uint64))


def _cuts(data: np.ndarray, lo: int, hi: int, blank: np.ndarray) -> Iterator[tuple[int, int]]:
    """Pieces of a long byte range that begin and end between words."""
    while hi - lo > 2 * STEP_BYTES:
        window, cut = lo + STEP_BYTES, -1
        while cut < 0 and window < hi:
            gap = np.flatnonzero(blank[data[window : min(window + STEP_BYTES, hi)]])
            cut = window + int(gap[0]) if len(gap) else -1
            window += STEP_BYTES
        if cut < 0:
            break
        yield lo, cut
        lo = cut
    yield lo, hi


def words(
    data: np.ndarray, offsets: np.ndarray, row: int, end: int, blank: np.ndarray = _SPACE, prefixes: tuple[int, ...] = ()
) -> tuple[np.ndarray, ...]:
    """(hash, row) of every word of rows row to end, A-Z as a-z, in order; then a hash of each word's first bytes.

    Words are runs of bytes that ``blank`` does not mark: by default ``[^\\x20\\x09-\\x0D]+``.
    """
    hashes, owners, heads = [], [], [[] for _ in prefixes]
    for lo, hi in _cuts(data, int(offsets[row]), int(offsets[end]), blank):
        b = data[lo:hi]
        if not len(b):
            continue
        inner = ~blank[b]
        begins = inner.copy()
        begins[1:] &= ~inner[:-1]
        bounds = offsets[row:end] - lo
        bounds = bounds[(bounds >= 0) & (bounds < len(b))]
        begins[bounds] = inner[bounds]
        starts = np.flatnonzero(begins)
        stops = inner.copy()
        stops[:-1] &= ~inner[1:]
        last = bounds[bounds > 0] - 1
        stops[last] = inner[last]
        ends = np.flatnonzero(stops) + 1
        values = _BYTE[_LOWER[b]]
        hashes.append(run_hashes(values, starts, ends))
        for n, out in zip(prefixes, heads):
            out.append(run_hashes(values, starts, np.minimum(ends, starts + n)))
        owners.append(np.searchsorted(offsets[row : end + 1], starts + lo, "right") - 1 + row)
    if not hashes:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), *[np.zeros(0, np.uint64) for _ in prefixes]
    return np.concatenate(hashes), np.concatenate(owners), *[np.concatenate(x) for x in heads]
