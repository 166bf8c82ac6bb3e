"""The 64-bit FarmHash fingerprint of many strings at once, and bucket numbers from it.

Models trained elsewhere number their n-grams by this fingerprint modulo the size of the vocabulary.
The function is published and fixed for all time; it treats strings of up to 16, 32, 64 and more
bytes differently, so strings are hashed group by group.
"""

from __future__ import annotations

import sys

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column
from pyspark.sql import functions as F

# The constants of the published function.
K0 = np.uint64(0xC3A5C85C97CB3127)
K1 = np.uint64(0xB492B66FBE98F273)
K2 = np.uint64(0x9AE16A3B2F90404F)
SEED = np.uint64(81)
# End of fixed values.


def _u(value: int) -> np.uint64:
    return np.uint64(value)


def _turn(x: np.ndarray, bits: int) -> np.ndarray:
    return (x >> _u(bits)) | (x << _u(64 - bits))


def _fold(x: np.ndarray) -> np.ndarray:
    return x ^ (x >> _u(47))


def _pair(u: np.ndarray, v: np.ndarray, factor: np.ndarray) -> np.ndarray:
    a = _fold((u ^ v) * factor)
    return _fold((v ^ a) * factor) * factor


class _Bytes:
    """Little-endian words at any byte of a buffer."""

    def __init__(self, raw: np.ndarray):
        self.raw = np.concatenate([raw, np.zeros(8, np.uint8)])
        self._words = np.ndarray((len(raw) + 1,), "<u8", self.raw, 0, (1,))
        self._halves = np.ndarray((len(raw) + 1,), "<u4", self.raw, 0, (1,))

    def word(self, at: np.ndarray) -> np.ndarray:
        return self._words[at]

    def half(self, at: np.ndarray) -> np.ndarray:
        return self._halves[at].astype(np.uint64)

    def byte(self, at: np.ndarray) -> np.ndarray:
        return self.raw[at].astype(np.uint64)


def _up_to_3(b: _Bytes, at: np.ndarray, n: np.ndarray) -> np.ndarray:
    size = n.astype(np.uint64)
    y = b.byte(at) + (b.byte(at + n // 2) << _u(8))
    z = size + (b.byte(at + n - 1) << _u(2))
    return _fold(y * K2 ^ z * K0) * K2


def _up_to_7(b: _Bytes, at: np.ndarray, n: np.ndarray) -> np.ndarray:
    size = n.astype(np.uint64)
    return _pair(size + (b.half(at) << _u(3)), b.half(at + n - 4), K2 + size * _u(2))


def _up_to_16(b: _Bytes, at: np.ndarray, n: np.ndarray) -> np.ndarray:
    factor = K2 + n.astype(np.uint64) * _u(2)
    first, last = b.word(at) + K2, b.word(at + n - 8)
    return _pair(_turn(last, 37) * factor + first, (_turn(first, 25) + last) * factor, factor)


def _ends(b: _Bytes, at: np.ndarray, n: np.ndarray, first: np.uint64, factor: np.ndarray):
    """What strings of up to 32 and up to 64 bytes have in common: words at both ends, mixed twice."""
    a, c = b.word(at) * first, b.word(at + 8)
    d, e = b.word(at + n - 8) * factor, b.word(at + n - 16) * K2
    return a, _turn(a + c, 43) + _turn(d, 30) + e, a + _turn(c + K2, 18) + d


def _up_to_32(b: _Bytes, at: np.ndarray, n: np.ndarray) -> np.ndarray:
    factor = K2 + n.astype(np.uint64) * _u(2)
    _, x, y = _ends(b, at, n, K1, factor)
    return _pair(x, y, factor)


def _up_to_64(b: _Bytes, at: np.ndarray, n: np.ndarray) -> np.ndarray:
    factor = K2 + n.astype(np.uint64) * _u(2)
    a, x, y = _ends(b, at, n, K2, factor)
    z = _pair(x, y, factor)
    e, f = b.word(at + 16) * factor, b.word(at + 24)
    g, h = (x + b.word(at + n - 32)) * factor, (z + b.word(at + n - 24)) * factor
    return _pair(_turn(e + f, 43) + _turn(g, 30) + h, e + _turn(f + a, 18) + g, factor)


def _half_block(b: _Bytes, at: np.ndarray, x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """32 bytes mixed into a pair of seeds."""
    w = [b.word(at + 8 * k) for k in range(4)]
    x = x + w[0]
    y = _turn(y + x + w[3], 21)
    total = x + w[1] + w[2]
    return total + w[3], y + _turn(total, 44) + x


def _longer(b: _Bytes, at: np.ndarray, n: np.ndarray) -> np.ndarray:
    """56 bytes of state; whole blocks of 64 bytes, then the last 64 bytes once more in another way."""
    zero = np.zeros(len(at), np.uint64)
    y = zero + (SEED * K1 + _u(113))
    z = _fold(y * K2 + _u(113)) * K2
    x = SEED * K2 + b.word(at)
    state = [x, y, z, *(zero.copy() for _ in range(4))]
    blocks = (n - 1) // 64

    def mixed(some: list[np.ndarray], start: np.ndarray, factor, weight: np.uint64) -> list[np.ndarray]:
        x, y, z, v0, v1, w0, w1 = some
        x = _turn(x + y + v0 + b.word(start + 8), 37) * factor
        y = _turn(y + v1 + b.word(start + 48), 42) * factor
        x = x ^ w1 * weight
        y = y + v0 * weight + b.word(start + 40)
        z = _turn(z + w0, 33) * factor
        v0, v1 = _half_block(b, start, v1 * factor, x + w0)
        w0, w1 = _half_block(b, start + 32, z + w1, y + b.word(start + 16))
        return [z, y, x, v0, v1, w0, w1]

    for k in range(int(blocks.max())):
        on = np.flatnonzero(blocks > k)
        for old, new in zip(state, mixed([s[on] for s in state], at[on] + 64 * k, K1, _u(1))):
            old[on] = new
    x, y, z, v0, v1, w0, w1 = state
    factor = K1 + ((z & _u(0xFF)) << _u(1))
    w0 = w0 + ((n - 1) & 63).astype(np.uint64)
    v0 = v0 + w0
    w0 = w0 + v0
    x, y, z, v0, v1, w0, w1 = mixed([x, y, z, v0, v1, w0, w1], at + n - 64, factor, _u(9))
    return _pair(_pair(v0, w0, factor) + _fold(y) * K0 + z, _pair(v1, w1, factor) + x, factor)


_KINDS = ((0, None), (3, _up_to_3), (7, _up_to_7), (16, _up_to_16), (32, _up_to_32), (64, _up_to_64), (None, _longer))


def fingerprints(raw: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Fingerprints of raw[offsets[k]:offsets[k + 1]], as unsigned 64-bit integers."""
    starts, sizes = offsets[:-1].astype(np.int64), np.diff(offsets).astype(np.int64)
    out = np.full(len(starts), K2, np.uint64)
    data, low = _Bytes(raw), 0
    with np.errstate(over="ignore"):
        for most, function in _KINDS:
            some = np.flatnonzero((sizes > low) & (sizes <= most) if most is not None else sizes > low)
            if function is not None and len(some):
                out[some] = function(data, starts[some], sizes[some])
            low = most if most is not None else low
    return out


def _bytes_of(strings: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all strings, one after the other, and the offsets between them."""
    strings = strings.cast(pa.large_string()).fill_null("")
    _, ends, data = strings.buffers()
    offsets = np.frombuffer(ends, np.int64, len(strings) + 1, strings.offset * 8)
    raw = np.zeros(0, np.uint8) if data is None else np.frombuffer(data, np.uint8)
    return raw[offsets[0] : offsets[-1]], offsets - offsets[0]


def fingerprint(text: Column) -> Column:
    """The fingerprint of a string as a signed long; null counts as the empty string."""
    cloudpickle.register_pickle_by_value(sys.modules[__name__])

    @F.arrow_udf("long")
    def hashed(strings: pa.Array) -> pa.Array:
        return pa.array(fingerprints(*_bytes_of(strings)).view(np.int64))

    return hashed(text)


def fingerprint_buckets(grams: Column, n_buckets: int, length: int) -> Column:
    """Bucket number of every n-gram, padded with 0 or cut to `length`."""
    cloudpickle.register_pickle_by_value(sys.modules[__name__])

    @F.arrow_udf("array<int>")
    def buckets(lists: pa.Array) -> pa.Array:
        counts = lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
        found = fingerprints(*_bytes_of(lists.flatten())) % np.uint64(n_buckets)
        row = np.repeat(np.arange(len(counts)), counts)
        place = np.arange(len(row)) - np.repeat(np.cumsum(counts) - counts, counts)
        kept = place < length
        out = np.zeros((len(counts), length), np.int32)
        out[row[kept], place[kept]] = found[kept]
        ends = np.arange(len(counts) + 1, dtype=np.int32) * length
        return pa.ListArray.from_arrays(pa.array(ends), pa.array(out.ravel()))

    return buckets(grams)
