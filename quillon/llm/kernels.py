"""Vectorised byte kernels shared by the text operators.

They work on the value buffer of an Arrow string array, so a batch of texts is
read without making Python strings. Every kernel takes a bounded slice of rows
(``row_slices``): scratch memory follows the slice, or the longest single text.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

SLICE_BYTES = 1 << 19

_U = np.uint64
_SEPARATOR = np.zeros(256, dtype=bool)
_SEPARATOR[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 32
_ALNUM = np.ones(256, dtype=bool)
_ALNUM[0x00:0x30] = False
_ALNUM[0x3A:0x61] = False
_ALNUM[0x7B:0x80] = False

_BASE = 0x9E3779B97F4A7C15 | 1
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)


def _splitmix_table(seed: int, n: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        return mix64(np.arange(1, n + 1, dtype=_U) * _U(0x9E3779B97F4A7C15) + _U(seed))


def mix64(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser: a bijection of 64-bit values."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


_BYTE_CODES = _splitmix_table(17, 256)


class _Powers:
    """Powers of the rolling base and of its inverse, grown on demand."""

    def __init__(self) -> None:
        self.up = np.ones(1, dtype=_U)
        self.down = np.ones(1, dtype=_U)

    def get(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = max(n, 2 * len(self.up), SLICE_BYTES // 4)
            self.up, self.down = (
                np.cumprod(np.concatenate([[_U(1)], np.full(size - 1, base, dtype=_U)]), dtype=_U)
                for base in (_BASE, _BASE_INVERSE)
            )
        return self.up[:n], self.down[:n]


_POWERS = _Powers()


def text_buffer(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and row offsets (length rows + 1) of a string or binary column; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary())
    if column.null_count:
        column = column.fill_null(b"")
    n = len(column)
    if n == 0:
        return np.zeros(0, dtype=np.uint8), np.zeros(1, dtype=np.int64)
    _, offsets, data = column.buffers()
    offs = np.frombuffer(offsets, dtype=np.int64)[column.offset : column.offset + n + 1]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.zeros(0, dtype=np.uint8)
    return raw[offs[0] : offs[-1]], offs - offs[0]


def row_slices(offsets: np.ndarray, limit: int = SLICE_BYTES):
    """Ranges of rows that hold about ``limit`` bytes together; one longer text makes a range of its own."""
    n, first = len(offsets) - 1, 0
    while first < n:
        last = int(np.searchsorted(offsets, offsets[first] + limit, side="right")) - 1
        last = min(max(last, first + 1), n)
        yield first, last
        first = last


def lower_ascii(data: np.ndarray) -> np.ndarray:
    return _LOWER[data]


def spans(inside: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the runs of ``inside`` bytes that stay within a row, and each row's first run."""
    n = len(inside)
    if n == 0:
        none = np.zeros(0, dtype=np.int64)
        return none, none, np.zeros(len(offsets), dtype=np.int64)
    edge = np.zeros(n + 1, dtype=bool)
    edge[offsets] = True
    begins = inside.copy()
    begins[1:] &= ~inside[:-1] | edge[1:n]
    closes = inside.copy()
    closes[:-1] &= ~inside[1:] | edge[1:n]
    starts = np.flatnonzero(begins)
    return starts, np.flatnonzero(closes) + 1, np.searchsorted(starts, offsets)


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words of ``[^\\x20\\x09-\\x0D]+``: starts, ends and each row's first word."""
    return spans(~_SEPARATOR[data], offsets)


def alnum_words(lowered: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words of ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` of lower-cased bytes."""
    return spans(_ALNUM[lowered], offsets)


def prefix_hash(data: np.ndarray) -> np.ndarray:
    """Running polynomial sums; ``span_hash`` turns two of them into the hash of a span."""
    up, _ = _POWERS.get(len(data) + 1)
    sums = np.zeros(len(data) + 1, dtype=_U)
    np.cumsum(_BYTE_CODES[data] * up[:-1], out=sums[1:])
    return sums


def span_hash(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of the spans [start, end); equal bytes give equal hashes wherever they stand."""
    _, down = _POWERS.get(len(sums))
    return mix64((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(_U))


def shingle_hashes(word_hash: np.ndarray, n: int) -> np.ndarray:
    """Hashes of the runs of n consecutive words; the whole sequence as one if it is shorter."""
    if len(word_hash) == 0:
        return word_hash
    n = min(n, len(word_hash))
    out = np.full(len(word_hash) - n + 1, n, dtype=_U)
    for k in range(n):
        out = mix64(out * _U(0x2545F4914F6CDD1D) + word_hash[k : k + len(out)])
    return out


def count_words(column: pa.Array) -> np.ndarray:
    data, offsets = text_buffer(column)
    out = np.zeros(len(offsets) - 1, dtype=np.int64)
    for a, b in row_slices(offsets):
        own = offsets[a : b + 1] - offsets[a]
        _, _, first = words(data[offsets[a] : offsets[b]], own)
        out[a:b] = np.diff(first)
    return out
