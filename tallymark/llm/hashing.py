"""Vectorised hashes of substrings, and a hash table of 64-bit keys, in numpy.

The hash of a range of symbols is the polynomial sum of a random 64-bit value per symbol, modulo
2**64; prefix sums give the hash of every range of a buffer in a constant number of passes.
"""

from __future__ import annotations

import numpy as np

_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_MASK = (1 << 64) - 1
_SYMBOLS = np.random.default_rng(20240607).integers(
    0, 1 << 64, 0x110000, dtype=np.uint64, endpoint=False
)
_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse, 0 to n."""
    if len(_powers[0]) <= n:
        size = 1 << n.bit_length()
        for k, base in enumerate((_BASE, _INVERSE)):
            table = np.full(size + 1, base, np.uint64)
            table[0] = 1
            _powers[k] = np.cumprod(table, dtype=np.uint64)
    return _powers[0], _powers[1]


def mix(values: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every input bit over all output bits."""
    h = values.astype(np.uint64, copy=True)
    h ^= h >> np.uint64(32)
    h *= np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(32)
    h *= np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(32)
    return h


def range_hashes(symbols: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of symbols[start:end] for each range, the length mixed in."""
    return sequence_hashes(_SYMBOLS[symbols], starts, ends)


def sequence_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of values[start:end] for each range, the length mixed in; values are hashes already."""
    up, down = _power_tables(len(values))
    sums = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * up[: len(values)], dtype=np.uint64, out=sums[1:])
    h = (sums[ends] - sums[starts]) * down[starts]
    return mix(h + (ends - starts).astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F))


def shingle_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """Hash of every run of `size` consecutive word hashes (len(words) - size + 1 values)."""
    n = len(words) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    h = np.zeros(n, np.uint64)
    for k in range(size):
        h = h * np.uint64(_BASE) + words[k : k + n]
    return mix(h)


def ranges_of(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The indices start, start+1, ... of all ranges, one after the other."""
    total = int(lengths.sum())
    first = np.cumsum(lengths) - lengths
    return np.repeat(starts - first, lengths) + np.arange(total)


class HashIndex:
    """Open-addressing table from 64-bit keys (hashes already) to row numbers 0, 1, 2, ..."""

    def __init__(self, capacity: int = 1 << 16):
        self.clear(capacity)

    def clear(self, capacity: int = 1 << 16) -> None:
        self._bits = max(10, int(capacity).bit_length())
        self._keys = np.zeros(1 << self._bits, np.uint64)
        self._rows = np.full(1 << self._bits, -1, np.int32)
        self.size = 0

    def _slots(self, keys: np.ndarray) -> np.ndarray:
        return (keys >> np.uint64(64 - self._bits)).astype(np.int64)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Row of each key, -1 for unknown keys."""
        slots = self._slots(keys)
        rows = self._rows[slots]
        open_ = np.flatnonzero((rows >= 0) & (self._keys[slots] != keys))
        at = slots[open_]
        while len(open_):
            at = (at + 1) & ((1 << self._bits) - 1)
            found = self._rows[at]
            rows[open_] = found
            more = (found >= 0) & (self._keys[at] != keys[open_])
            open_, at = open_[more], at[more]
        return rows

    def add(self, keys: np.ndarray) -> None:
        """Give new rows to distinct keys that the table does not hold."""
        if (self.size + len(keys)) * 2 > 1 << self._bits:
            kept = self._rows >= 0
            old_keys, old_rows = self._keys[kept], self._rows[kept]
            self._bits = int((self.size + len(keys)) * 4).bit_length()
            self._keys = np.zeros(1 << self._bits, np.uint64)
            self._rows = np.full(1 << self._bits, -1, np.int32)
            self._place(old_keys, old_rows)
        self._place(keys, np.arange(self.size, self.size + len(keys), dtype=np.int32))
        self.size += len(keys)

    def _place(self, keys: np.ndarray, rows: np.ndarray) -> None:
        at = self._slots(keys)
        while len(keys):
            free = np.flatnonzero(self._rows[at] < 0)
            slots, first = np.unique(at[free], return_index=True)
            taken = free[first]
            self._keys[slots] = keys[taken]
            self._rows[slots] = rows[taken]
            rest = np.ones(len(keys), bool)
            rest[taken] = False
            keys, rows, at = keys[rest], rows[rest], (at[rest] + 1) & ((1 << self._bits) - 1)
