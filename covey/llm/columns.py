"""Arrow columns as numpy arrays, words and their hashes: shared by the operators' tasks."""

from __future__ import annotations

import ctypes
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

_M1, _M2, _GOLD = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB), np.uint64(0x9E3779B97F4A7C15)
_POWER = 0xD6E8FEB86659FD93  # odd
_POWERS = 1 << 16
_BLOCK = 1 << 21


def mix(x: np.ndarray) -> np.ndarray:
    """Spread every bit of 64-bit numbers over all bits (a bijection)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= _M1
    x ^= x >> np.uint64(27)
    x *= _M2
    x ^= x >> np.uint64(31)
    return x


def _powers(n: int, base: int) -> np.ndarray:
    out = np.empty(n, np.uint64)
    out[0] = 1
    out[1:] = np.uint64(base)
    return np.multiply.accumulate(out)


_POW = _powers(_POWERS, _POWER)
_VALUE = mix(np.arange(1, 257, dtype=np.uint64) * _GOLD)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_VALUE[_SPACE] = 0
#: Bytes between words, where words are runs of letters and digits: the rest of ASCII.
_OTHER = np.ones(256, bool)
_OTHER[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = False


def text_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a string column and its n+1 offsets; a null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("" if pa.types.is_string(column.type) else b"")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1]
    at = at.astype(np.int64)
    if data is None:
        return np.zeros(0, np.uint8), at - at[0]
    return np.frombuffer(data, np.uint8)[at[0] : at[-1]], at - at[0]


@dataclass
class Words:
    """Words ``[^\\x20\\x09-\\x0D]+`` of a batch of texts: where they are, and whose."""

    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray  # of each text, the index of its first word; n+1 long

    def owner(self) -> np.ndarray:
        """The text each word belongs to."""
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))


def find_words(data: np.ndarray, offsets: np.ndarray, alnum: bool = False) -> Words:
    """Words between white space, or with ``alnum`` runs of ASCII letters, digits and any other
    byte beyond ASCII."""
    inside = ~(_OTHER if alnum else _SPACE)[data]
    begin, end = inside.copy(), inside.copy()
    begin[1:] &= ~inside[:-1]
    end[:-1] &= ~inside[1:]
    # A text's edges end words even where the next text goes on without white space.
    edges = offsets[(offsets > 0) & (offsets < len(data))]
    begin[edges] = inside[edges]
    end[edges - 1] = inside[edges - 1]
    starts = np.flatnonzero(begin)
    return Words(starts, np.flatnonzero(end) + 1, np.searchsorted(starts, offsets))


def word_hashes(data: np.ndarray, words: Words, lower: bool = False, alnum: bool = False) -> np.ndarray:
    """A 64-bit hash of each word's bytes, the same in every process."""
    starts, ends, n = words.starts, words.ends, len(words.starts)
    out = np.empty(n, np.uint64)
    a = 0
    while a < n:
        b = max(a + 1, int(np.searchsorted(starts, starts[a] + _BLOCK)))
        lo, hi = int(starts[a]), int(ends[b - 1])
        raw = data[lo:hi]
        rel = starts[a:b] - lo
        place = np.arange(hi - lo) - np.repeat(rel, np.diff(np.append(rel, hi - lo)))
        values = _VALUE[_LOWER[raw] if lower else raw]
        values *= _POW[place & (_POWERS - 1)]
        if alnum:
            values[_OTHER[raw]] = 0
        if (ends[a:b] - starts[a:b]).max() > _POWERS:
            values *= _powers(int(place.max() >> 16) + 1, pow(_POWER, _POWERS, 1 << 64))[place >> 16]
        out[a:b] = np.add.reduceat(values, rel)
        a = b
    return mix(out ^ ((ends - starts).astype(np.uint64) * _GOLD))


def run_hashes(values: np.ndarray, width: int) -> np.ndarray:
    """A hash of each ``width`` consecutive values (wherever they start, over all edges)."""
    if len(values) < width:
        return np.zeros(0, np.uint64)
    n = len(values) - width + 1
    out = np.zeros(n, np.uint64)
    for j in range(width):
        out *= np.uint64(_POWER)
        out += values[j : j + n]
    return mix(out)


def whole_hash(values: np.ndarray) -> np.uint64:
    """Hash of a whole short sequence; differs from that of any other length."""
    return mix(run_hashes(values, len(values)) ^ np.uint64(len(values)))[0]


def texts(batches: Iterator[pa.RecordBatch], column: str, most: int = 1 << 22) -> Iterator[pa.RecordBatch]:
    """The batches cut so that a piece holds about ``most`` bytes of text, or one row."""
    for batch in batches:
        at = text_buffer(batch.column(column))[1]
        a = 0
        while a < batch.num_rows:
            b = max(a + 1, int(np.searchsorted(at, at[a] + most, "right")) - 1)
            yield batch.slice(a, b - a)
            a = b
    release()


def release() -> None:
    """Give back what a task has freed. Workers live on from task to task, several an executor, and
    would keep their largest task's memory."""
    pa.default_memory_pool().release_unused()
    if _TRIM is not None:
        _TRIM(0)


def _trim():
    try:
        return ctypes.CDLL("libc.so.6").malloc_trim
    except (OSError, AttributeError):
        return None  # another C library


_TRIM = _trim()
