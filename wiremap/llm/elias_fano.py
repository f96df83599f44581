"""Elias-Fano coding of a non-decreasing sequence, with a select directory.

``n`` values below ``universe`` take about ``n * (2 + log2(universe / n))``
bits: the low bits of each value are packed at a fixed width, the high bits
are unary gaps in a bit vector.  Bit position ``p`` of the ``i``-th one gives
``high = p - i``.  The directory keeps the position of every 64th one as
uint32, relative to the vector, so no table of 64-bit offsets exists.
"""

from __future__ import annotations

import struct

import numpy as np

SAMPLE = 64
HEAD = struct.Struct("<QQBII")


def encode(values: np.ndarray) -> bytes:
    v = np.asarray(values, np.uint64)
    n = len(v)
    if not n:
        return HEAD.pack(0, 0, 0, 0, 0)
    if (v[1:] < v[:-1]).any():
        raise ValueError("values must not decrease")
    top = int(v[-1])
    low = max(0, (top // n).bit_length() - 1)
    high = (v >> np.uint64(low)).astype(np.int64) + np.arange(n)
    if high[-1] >= 1 << 32:
        raise ValueError("too many values for one block")
    bits = np.zeros(int(high[-1]) + 1, np.uint8)
    bits[high] = 1
    upper = np.packbits(bits, bitorder="little").tobytes()
    shifts = np.arange(low, dtype=np.uint64)
    lower = np.packbits(((v[:, None] >> shifts) & np.uint64(1)).astype(np.uint8).ravel(),
                        bitorder="little").tobytes()
    directory = high[::SAMPLE].astype("<u4").tobytes()
    return HEAD.pack(n, top, low, len(upper), len(directory)) + directory + upper + lower


class EliasFano:
    """Reads ``encode``'s bytes; ``size`` is their length."""

    def __init__(self, data, at: int = 0):
        self.n, self.top, self.low, nu, nd = HEAD.unpack_from(data, at)
        a = at + HEAD.size
        self.directory = np.frombuffer(data, "<u4", nd // 4, a)
        self.upper = np.frombuffer(data, np.uint8, nu, a + nd)
        nl = -(-self.n * self.low // 8)
        self.lower = np.frombuffer(data, np.uint8, nl, a + nd + nu)
        self.size = HEAD.size + nd + nu + nl

    def __len__(self) -> int:
        return self.n

    def __getitem__(self, i: int) -> int:
        """Value ``i``: select in the upper bits from the nearest sample."""
        if not 0 <= i < self.n:
            raise IndexError(i)
        p = int(self.directory[i // SAMPLE])
        left, byte = i % SAMPLE, p // 8
        word = int(self.upper[byte]) >> (p % 8) << (p % 8)
        left += 1
        while (ones := word.bit_count()) < left:
            left -= ones
            byte += 1
            word = int(self.upper[byte])
        for _ in range(left - 1):
            word &= word - 1
        p = byte * 8 + (word & -word).bit_length() - 1
        bit, value = i * self.low, 0
        for k in range(self.low):
            value |= ((int(self.lower[(bit + k) // 8]) >> (bit + k) % 8) & 1) << k
        return (p - i) << self.low | value

    def values(self) -> np.ndarray:
        if not self.n:
            return np.zeros(0, np.uint64)
        ones = np.flatnonzero(np.unpackbits(self.upper, bitorder="little"))[:self.n]
        high = (ones - np.arange(self.n)).astype(np.uint64)
        if not self.low:
            return high
        low = np.unpackbits(self.lower, bitorder="little")[:self.n * self.low]
        low = low.reshape(self.n, self.low).astype(np.uint64) @ (
            np.uint64(1) << np.arange(self.low, dtype=np.uint64))
        return (high << np.uint64(self.low)) | low
