"""Vectorised work on the UTF-8 bytes of a batch of texts: words, word hashes, rolling hashes.

All hashes are polynomials modulo 2**64 over a random table, read off prefix sums, then mixed.
Work goes through the buffer in pieces that fit the processor's cache, so memory stays a small
multiple of the batch whatever the texts' lengths."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

PIECE = 1 << 17
U = np.uint64
_BASE = 0x9E3779B97F4A7C15  # any odd number serves
_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}

_RNG = np.random.default_rng(20240229)
BYTES = _RNG.integers(1, 1 << 63, 256, dtype=np.uint64) | U(1)
FOLDED = BYTES.copy()  # A-Z hash as a-z
FOLDED[65:91] = BYTES[97:123]

#: Words end at ASCII white space: space and 0x09 to 0x0D.
SPACED = np.ones(256, bool)
SPACED[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = False
#: Words are ASCII letters and digits and everything beyond ASCII.
ALNUM = np.zeros(256, bool)
ALNUM[0x80:] = True
for _lo, _hi in ((0x30, 0x3A), (0x41, 0x5B), (0x61, 0x7B)):
    ALNUM[_lo:_hi] = True


def mix(x: np.ndarray) -> np.ndarray:
    """Finalise 64-bit hashes in place (the splitmix64 finaliser)."""
    x ^= x >> U(30)
    x *= U(0xBF58476D1CE4E5B9)
    x ^= x >> U(27)
    x *= U(0x94D049BB133111EB)
    x ^= x >> U(31)
    return x


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """``base**i`` and its inverse modulo 2**64 for i < n."""
    size = 1 << max(18, (n - 1).bit_length())
    if size not in _POWERS:
        if len(_POWERS) > 1:
            _POWERS.clear()
        both = []
        for b in (_BASE, pow(_BASE, -1, 1 << 64)):
            p = np.full(size, b, U)
            p[0] = 1
            both.append(np.cumprod(p, dtype=U))
        _POWERS[size] = tuple(both)
    return _POWERS[size]


def utf8(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """A string or binary column as one byte array and the offsets of its values; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("" if pa.types.is_string(column.type) else b"")
    offsets = np.frombuffer(column.buffers()[1], np.int32, len(column) + 1, column.offset * 4).astype(np.int64)
    data = column.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return data[offsets[0]:offsets[-1]], offsets - offsets[0]


def words(data: np.ndarray, offsets: np.ndarray, kind: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end byte of every word, and the row it belongs to."""
    inside = kind[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    before = np.empty(len(data), bool)
    before[:1] = False
    before[1:] = inside[:-1]
    starts = np.flatnonzero(inside & (~before | edge[:-1]))
    after = np.empty(len(data), bool)
    after[-1:] = False
    after[:-1] = inside[1:]
    ends = np.flatnonzero(inside & (~after | edge[1:])) + 1
    return starts, ends, np.searchsorted(offsets, starts, side="right") - 1


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, table: np.ndarray = BYTES) -> np.ndarray:
    out = np.empty(len(starts), U)
    i = 0
    while i < len(starts):
        lo = starts[i]
        j = max(i + 1, int(np.searchsorted(ends, lo + PIECE, side="right")))
        hi = ends[j - 1]
        up, down = powers(int(hi - lo))
        sums = np.zeros(hi - lo + 1, U)
        np.cumsum(table[data[lo:hi]] * up[:hi - lo], out=sums[1:])
        s, e = starts[i:j] - lo, ends[i:j] - lo
        out[i:j] = mix((sums[e] - sums[s]) * down[s] + (e - s).astype(U))
        i = j
    return out


def rolling(values: np.ndarray, n: int) -> np.ndarray:
    """Hash of every run of ``n`` neighbouring values; windows over row ends are the caller's to drop."""
    count = len(values) - n + 1
    if count <= 0:
        return np.zeros(0, U)
    out = np.empty(count, U)
    for lo in range(0, count, PIECE):
        hi = min(count, lo + PIECE)
        up, down = powers(hi - lo + n)
        sums = np.zeros(hi - lo + n, U)
        np.cumsum(values[lo:hi + n - 1] * up[:hi - lo + n - 1], out=sums[1:])
        out[lo:hi] = mix((sums[n:] - sums[:hi - lo]) * down[:hi - lo])
    return out


def first_of(rows: np.ndarray, n_rows: int) -> np.ndarray:
    """For every row, the index of its first entry in the sorted ``rows`` (one more: their number)."""
    return np.searchsorted(rows, np.arange(n_rows + 1))


def runs_of(sorted_values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start index and length of every run of equal values."""
    if not len(sorted_values):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    starts = np.flatnonzero(np.concatenate(([True], sorted_values[1:] != sorted_values[:-1])))
    return starts, np.diff(np.append(starts, len(sorted_values)))


def covered(length: int, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Which of ``length`` places lie in one of the intervals ``[starts, ends)``."""
    depth = np.zeros(length + 1, np.int32)
    np.add.at(depth, starts, 1)
    np.add.at(depth, ends, -1)
    return np.cumsum(depth[:-1], dtype=np.int32) > 0
