"""Vectorised byte-level helpers that run inside Arrow batches.

Everything here works on the UTF-8 buffer of an Arrow string column, so a batch of texts is
hashed with a fixed number of numpy passes instead of a Python loop over words.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa

_M = np.uint64(0xD6E8FEB86659FD93)
_P = 0x9E3779B97F4A7C15 | 1
_P_INV = pow(_P, -1, 1 << 64)
_BYTE = np.random.Generator(np.random.PCG64(20240229)).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_IS_SPACE = np.zeros(256, dtype=bool)
_IS_SPACE[[9, 10, 11, 12, 13, 32]] = True
_POWERS: dict[int, np.ndarray] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser."""
    x = x ^ (x >> np.uint64(32))
    x *= _M
    x ^= x >> np.uint64(29)
    x *= _M
    x ^= x >> np.uint64(32)
    return x


def powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64; up to 2**20 of them are kept in the worker."""
    have = _POWERS.get(base)
    if have is None or len(have) < n:
        size = 1 << max(16, (n - 1).bit_length())
        have = np.empty(size, dtype=np.uint64)
        have[0] = 1
        step, filled = base, 1
        while filled < size:
            have[filled : 2 * filled] = have[:filled] * np.uint64(step)
            step = step * step % (1 << 64)
            filled *= 2
        if size <= 1 << 20:
            _POWERS[base] = have
    return have[:n]


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; nulls count as empty texts."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    column = column.cast(pa.large_string())
    _, offsets, data = column.buffers()
    if len(column) == 0 or offsets is None:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    at = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[at[0] : at[-1]], at - at[0]


def chunks(offsets: np.ndarray, most: int = 500_000) -> Iterator[tuple[int, int]]:
    """Row ranges of at most `most` bytes; a longer text is a range of its own."""
    n, lo = len(offsets) - 1, 0
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + most, "right")) - 1)
        yield lo, min(hi, n)
        lo = min(hi, n)


def word_hashes(data: np.ndarray, offsets: np.ndarray, fold_case: bool = True) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Words are maximal runs of bytes outside x20 and x09-x0D, never across texts.

    Returns (hash, row, start, end) of each word, in order. fold_case lower-cases A-Z only.
    """
    n = len(data)
    none = np.zeros(0, np.int64)
    if n == 0:
        return np.zeros(0, np.uint64), none, none, none
    solid = ~_IS_SPACE[data]
    edge = offsets[(offsets > 0) & (offsets < n)]
    first = solid.copy()
    first[1:] &= ~solid[:-1]
    first[edge] = solid[edge]
    last = solid.copy()
    last[:-1] &= ~solid[1:]
    last[edge - 1] = solid[edge - 1]
    start, end = np.flatnonzero(first), np.flatnonzero(last) + 1
    total = np.empty(n + 1, np.uint64)
    total[0] = 0
    np.cumsum(_BYTE[_LOWER[data] if fold_case else data] * powers(_P, n), out=total[1:])
    h = mix((total[end] - total[start]) * powers(_P_INV, n)[start] + (end - start).astype(np.uint64))
    return h, np.searchsorted(offsets, start, "right") - 1, start, end


def shingles(words: np.ndarray, row: np.ndarray, rows: int, k: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """(hash, row) of every k-word shingle; a text of 1 to k-1 words gives its whole sequence as one."""
    n = len(words)
    if n == 0:
        return words, row
    factor = powers(0xC2B2AE3D27D4EB4F, k + 1)[1:]
    short_h = np.zeros(0, np.uint64)
    short_row = np.zeros(0, np.int64)
    count = np.bincount(row, minlength=rows)
    few = (count > 0) & (count < k)
    if few.any():
        firsts = np.cumsum(count) - count
        pick = few[row]
        place = np.arange(n) - firsts[row]
        part = np.where(pick, words * factor[np.minimum(place, k - 1)], np.uint64(0))
        short_row = np.flatnonzero(few)
        short_h = _short(part, firsts[few], count[few])
    if n < k:
        return short_h, short_row
    whole = row[: n - k + 1] == row[k - 1 :]
    h = words[: n - k + 1] * factor[0]
    for i in range(1, k):
        h += words[i : n - k + 1 + i] * factor[i]
    return np.concatenate([mix(h[whole]), short_h]), np.concatenate([row[: n - k + 1][whole], short_row])


def _short(part: np.ndarray, at: np.ndarray, size: np.ndarray) -> np.ndarray:
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(part)])
    return mix(total[at + size] - total[at] + size.astype(np.uint64) * np.uint64(0xA24BAED4963EE407))


def distinct(h: np.ndarray, row: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct (row, hash) pairs, by row and hash."""
    order = np.lexsort((h, row))
    h, row = h[order], row[order]
    keep = np.ones(len(h), bool)
    keep[1:] = (h[1:] != h[:-1]) | (row[1:] != row[:-1])
    return h[keep], row[keep]


def shingle_sets(column: pa.Array, k: int = 5, most: int = 500_000) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, hashes, offsets) of each chunk: the sorted shingle set of row i is hashes[offsets[i]:offsets[i+1]]."""
    data, offsets = utf8(column)
    for lo, hi in chunks(offsets, most):
        at = offsets[lo : hi + 1]
        words, row, _, _ = word_hashes(data[at[0] : at[-1]], at - at[0])
        h, row = distinct(*shingles(words, row, hi - lo, k))
        yield lo, hi, h, np.searchsorted(row, np.arange(hi - lo + 1))


def slim_batches(batch: pa.RecordBatch, text: str, most: int = 16_000_000) -> Iterator[pa.RecordBatch]:
    """The batch cut so that no part holds more than `most` bytes of text, but for a single longer text."""
    _, offsets = utf8(batch.column(batch.schema.get_field_index(text)))
    for lo, hi in chunks(offsets, most):
        yield batch.slice(lo, hi - lo)


def tidy() -> None:
    """Give the freed memory of this worker back to the machine, for the tasks that come next."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def lean(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """The same function of a task's batches, tidied up after."""

    def wrapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        tidy()

    return wrapped
