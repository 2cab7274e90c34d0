"""The random numbers of Spark's ``XORShiftRandom``, many at once.

A step of the generator is linear over its 64 bits, so the states that lie ``m`` steps behind
known ones follow from tables of the ``m``-th power of a step.
"""

from __future__ import annotations

import functools

import numpy as np

_WORD = 0xFFFFFFFF


def hashed(seed: int) -> int:
    """The state a generator starts from: two Murmur hashes of the seed's 8 bytes."""
    low = _murmur(seed, 0x3C074A61)
    return (_murmur(seed, low) << 32) | low


def doubles(state: int, n: int) -> tuple[np.ndarray, int]:
    """The next ``n`` results of ``nextDouble``, and the state behind them."""
    states = np.empty(2 * n, np.uint64)
    states[:1] = _step(np.array([state], np.uint64))
    known = 1
    while known < 2 * n:
        more = min(known, 2 * n - known)
        states[known : known + more] = _jump(_tables(known), states[:more])
        known += more
    high = states[0::2] & np.uint64((1 << 26) - 1)
    low = states[1::2] & np.uint64((1 << 27) - 1)
    return ((high << np.uint64(27)) + low) * 2.0**-53, int(states[-1])


def _step(s: np.ndarray) -> np.ndarray:
    s = s ^ (s << np.uint64(21))
    s = s ^ (s >> np.uint64(35))
    return s ^ (s << np.uint64(4))


def _jump(tables: np.ndarray, s: np.ndarray) -> np.ndarray:
    to = np.zeros_like(s)
    for i, table in enumerate(tables):
        to ^= table[(s >> np.uint64(8 * i)) & np.uint64(255)]
    return to


@functools.lru_cache(maxsize=64)
def _tables(steps: int) -> np.ndarray:
    """For a power of two of steps: where each byte of a state goes."""
    bits = np.uint64(1) << np.arange(64, dtype=np.uint64)
    half = _tables(steps // 2) if steps > 1 else None
    images = _step(bits) if half is None else _jump(half, _jump(half, bits))
    tables = np.zeros((8, 256), np.uint64)
    for i in range(64):
        table, at = tables[i // 8], 1 << (i % 8)
        table[at : 2 * at] = table[:at] ^ images[i]
    return tables


def _murmur(seed: int, h: int) -> int:
    data = (seed & ((1 << 64) - 1)).to_bytes(8, "big")
    for at in (0, 4):
        k = int.from_bytes(data[at : at + 4], "little") * 0xCC9E2D51 & _WORD
        k = ((k << 15 | k >> 17) & _WORD) * 0x1B873593 & _WORD
        h ^= k
        h = ((h << 13 | h >> 19) & _WORD) * 5 + 0xE6546B64 & _WORD
    h ^= 8
    h = (h ^ h >> 16) * 0x85EBCA6B & _WORD
    h = (h ^ h >> 13) * 0xC2B2AE35 & _WORD
    return h ^ h >> 16
