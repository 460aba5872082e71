"""Array kernels over UTF-8 text held in Arrow buffers.

All of them work on whole chunks of documents at once: one byte buffer and the
offsets of its documents. Words are maximal runs of bytes other than space and
\\x09-\\x0D, which is the same set whether read as bytes or as characters.

Fingerprints have 64 bits. Two different strings share one with a probability
of about 2^-64, so among n strings about n^2 / 2^65 pairs are confused.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

_SLICE = 1 << 20  # bytes whose 8-byte intermediates are held at a time

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True

_rng = np.random.Generator(np.random.PCG64(20240517))
_BYTE = _rng.integers(0, 1 << 64, 256, np.uint64)
_FOLDED = _BYTE.copy()
_FOLDED[65:91] = _BYTE[97:123]
_BASE = 0x9E6C63D0676A9A99
_INVERSE = pow(_BASE, -1, 1 << 64)
_A, _B, _C = (np.uint64(x) for x in (0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0xD6E8FEB86659FD93))
_powers: list[np.ndarray] = []


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective scrambling of 64-bit values (the splitmix64 finalizer)."""
    x = (x ^ (x >> np.uint64(30))) * _A
    x = (x ^ (x >> np.uint64(27))) * _B
    return x ^ (x >> np.uint64(31))


def pair(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Fingerprint of the ordered pair (a, b)."""
    x = a * _C
    x ^= x >> np.uint64(32)
    x += b
    x *= _A
    x ^= x >> np.uint64(29)
    x *= _B
    x ^= x >> np.uint64(32)
    return x


def text_buffer(column: pa.ChunkedArray | pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; a null counts as an empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = pa.concat_arrays([c.cast(pa.large_string()) for c in column.chunks]) if column.num_chunks else (
            pa.array([], pa.large_string()))
    column = column.cast(pa.large_string()).fill_null("")
    _, offsets, data = column.buffers()
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    at = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    whole = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return whole[at[0] : at[-1]], at - at[0]


def words(buf: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, first): byte range of every word, and the first word of each document plus the end."""
    n = len(buf)
    if n == 0:
        none = np.zeros(0, np.int64)
        return none, none, np.zeros(len(offsets), np.int64)
    inside = ~_SPACE[buf]
    edge = np.zeros(n + 1, bool)
    edge[offsets] = True
    start = inside.copy()
    start[1:] &= ~inside[:-1] | edge[1:n]
    end = inside.copy()
    end[:-1] &= ~inside[1:] | edge[1:n]
    starts, ends = np.flatnonzero(start), np.flatnonzero(end) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def _power_tables(n: int) -> list[np.ndarray]:
    if not _powers or len(_powers[0]) < n:
        size = max(n, 2 * _SLICE)
        _powers[:] = []
        for base in (_BASE, _INVERSE):
            table = np.full(size, base, np.uint64)
            table[0] = 1
            _powers.append(np.multiply.accumulate(table))
    return _powers


def word_hashes(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray, fold: bool = False) -> np.ndarray:
    """Fingerprint of every word; `fold` reads A-Z as a-z."""
    out = np.empty(len(starts), np.uint64)
    code = _FOLDED if fold else _BYTE
    i = 0
    while i < len(starts):
        base = starts[i]
        j = max(int(np.searchsorted(ends, base + _SLICE, "right")), i + 1)
        part = buf[base : ends[j - 1]]
        up, down = _power_tables(len(part) + 1)
        sums = np.empty(len(part) + 1, np.uint64)
        sums[0] = 0
        np.cumsum(code[part] * up[: len(part)], out=sums[1:])
        a, b = starts[i:j] - base, ends[i:j] - base
        out[i:j] = mix((sums[b] - sums[a]) * down[a] + (b - a).astype(np.uint64))
        i = j
    return out


def window_hashes(items: np.ndarray, size: int, known: tuple[int, np.ndarray] | None = None) -> np.ndarray:
    """Fingerprint of every run of `size` items, found by doubling from (length, fingerprints) `known`."""
    length, now = known or (1, items)
    while length < size:
        step = min(length, size - length)
        if len(now) <= step:
            return np.zeros(0, np.uint64)
        now, length = pair(now[:-step], now[step:]), length + step
    return now


def byte_words(buf: np.ndarray) -> np.ndarray:
    """The eight bytes from every position on, as one number."""
    n = len(buf) - 7
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.empty(n, np.uint64)
    for r in range(8):
        here = np.frombuffer(buf[r : r + (len(buf) - r) // 8 * 8].tobytes(), "<u8")
        out[r::8] = here[: len(out[r::8])]
    return out


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every run of `width` values."""
    length, now = 1, values
    while length < width:
        step = min(length, width - length)
        if len(now) <= step:
            return now[:0]
        now, length = np.minimum(now[:-step], now[step:]), length + step
    return now


def cover(starts: np.ndarray, size: int) -> np.ndarray:
    """For flags of window starts: which items some flagged window of `size` items covers (length + size - 1)."""
    edge = np.zeros(len(starts) + size, np.int32)
    edge[: len(starts)] += starts
    edge[size:] -= starts
    return np.cumsum(edge[:-1]) > 0


def valid_starts(first: np.ndarray, size: int, n: int) -> np.ndarray:
    """Flags of the first n items from which `size` items fit in the same document."""
    out = np.zeros(n + 1, np.int32)
    lengths = np.diff(first)
    fits = lengths >= size
    np.add.at(out, first[:-1][fits], 1)
    np.add.at(out, (first[1:] - size + 1)[fits], -1)
    return np.cumsum(out[:n]) > 0
