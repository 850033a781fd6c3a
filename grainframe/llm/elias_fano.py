"""Monotone sequences in Elias-Fano form and fixed-width integers, read in place by numpy.

A value's low bits are packed; its high part is written in unary, value ``i`` setting bit
``high + i``.  All look-ups take arrays of queries.
"""

from __future__ import annotations

import numpy as np

_PAD = 16


def pack_bits(values: np.ndarray, width: int) -> bytes:
    """``values`` in ``width`` bits each (at most 56), low bits first."""
    n = len(values)
    if width == 0 or n == 0:
        return bytes(_PAD)
    out = np.zeros((n * width + 7) // 8 + _PAD, dtype=np.uint8)
    block = 1 << 16  # a multiple of 8 values starts at a byte
    for low in range(0, n, block):
        part = values[low : low + block].astype("<u8")
        bits = np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")[:, :width]
        raw = np.packbits(bits.ravel(), bitorder="little")
        at = low * width // 8
        out[at : at + len(raw)] = raw
    return out.tobytes()


class Packed:
    """Fixed-width integers in a byte array."""

    def __init__(self, data: np.ndarray, width: int) -> None:
        self.width, self.mask = width, np.uint64((1 << width) - 1)
        self.at = np.ndarray((max(0, len(data) - 7),), dtype="<u8", buffer=data, strides=(1,))

    def __getitem__(self, index: np.ndarray) -> np.ndarray:
        if self.width == 0:
            return np.zeros(len(index), dtype=np.uint64)
        bit = index.astype(np.int64) * self.width
        return (self.at[bit >> 3] >> (bit & 7).astype(np.uint64)) & self.mask


def encode(values: np.ndarray) -> bytes:
    """A non-decreasing sequence of non-negative integers below 2**63."""
    values = values.astype(np.uint64)
    n = len(values)
    last = int(values[-1]) if n else 0
    width = min(56, max(0, (last // max(n, 1)).bit_length() - 1))
    high = (values >> np.uint64(width)).astype(np.int64) + np.arange(n)
    words = int(high[-1] // 64 + 2 if n else 1)
    bits = np.zeros(words * 8, dtype=np.uint8)
    np.bitwise_or.at(bits, high >> 3, (1 << (high & 7)).astype(np.uint8))
    low = pack_bits(values & np.uint64((1 << width) - 1), width)
    low += bytes(-len(low) % 8)
    head = np.array([n, width, words, len(low)], dtype="<i8").tobytes()
    return head + bits.tobytes() + low


def _u(x: int) -> np.uint64:
    return np.uint64(x)


_ONES, _HIGH = _u(0x0101010101010101), _u(0x8080808080808080)
# place of the n-th set bit of a byte, at 8 * byte + n
_IN_BYTE = np.array([([i for i in range(8) if b >> i & 1] + [0] * 8)[:8] for b in range(256)], dtype=np.uint64).ravel()


def select_bit(value: np.ndarray, k: np.ndarray) -> np.ndarray:
    """Place of the ``k``-th set bit (from 0) of each 64-bit word, which has more than ``k``."""
    count = value - ((value >> _u(1)) & _u(0x5555555555555555))
    count = (count & _u(0x3333333333333333)) + ((count >> _u(2)) & _u(0x3333333333333333))
    upto = ((count + (count >> _u(4))) & _u(0x0F0F0F0F0F0F0F0F)) * _ONES  # bits up to each byte
    byte = np.bitwise_count(((k * _ONES | _HIGH) - upto) & _HIGH).astype(np.uint64) << _u(3)
    byte = np.minimum(byte, _u(56))
    left = k - (((upto << _u(8)) >> byte) & _u(255))
    return byte + _IN_BYTE[(((value >> byte) & _u(255)) << _u(3)) + np.minimum(left, _u(7))]


class EliasFano:
    """Reads what :func:`encode` wrote; only a count per 64 bits is held in memory."""

    def __init__(self, data: np.ndarray) -> None:
        self.n, width, words, low = (int(x) for x in data[:32].view("<i8"))
        self.width = np.uint64(width)
        self.high = data[32 : 32 + 8 * words].view("<u8")
        self.low = Packed(data[32 + 8 * words : 32 + 8 * words + low], width)
        self.size = 32 + 8 * words + low
        self.ones = np.concatenate([[0], np.cumsum(np.bitwise_count(self.high), dtype=np.int64)])
        self.zeros = np.arange(len(self.ones), dtype=np.int64) * 64 - self.ones

    def _select(self, k: np.ndarray, counts: np.ndarray, flip: bool) -> np.ndarray:
        """Place of the ``k``-th set (or clear) bit."""
        word = np.searchsorted(counts, k, side="right") - 1
        word = np.minimum(word, len(self.high) - 1)
        value = self.high[word]
        if flip:
            value = ~value
        return word * 64 + select_bit(value, (k - counts[word]).astype(np.uint64)).astype(np.int64)

    def __getitem__(self, index: np.ndarray) -> np.ndarray:
        high = self._select(index, self.ones, False) - index
        return (high.astype(np.uint64) << self.width) | self.low[index]

    def find(self, x: np.ndarray) -> np.ndarray:
        """Index of each ``x`` in a strictly increasing sequence, or -1."""
        if not self.n:
            return np.full(len(x), -1, dtype=np.int64)
        x = x.astype(np.uint64)
        high = (x >> self.width).astype(np.int64)
        known = high < self.zeros[-1]
        high = np.where(known, high, 0)
        end = self._select(high, self.zeros, True) - high
        start = np.where(high > 0, self._select(np.maximum(high - 1, 0), self.zeros, True) - high + 1, 0)
        want = x & np.uint64((1 << int(self.width)) - 1)
        return np.where(known, search(self.low, start, end, want), -1)


def search(values: Packed, low: np.ndarray, high: np.ndarray, want: np.ndarray) -> np.ndarray:
    """Index of ``want`` among the increasing values of each range ``[low, high)``, or -1."""
    last = high
    low, high = low.copy(), high.copy()
    while (open_ := low < high).any():
        at = np.flatnonzero(open_)
        middle = (low[at] + high[at]) >> 1
        less = values[middle] < want[at]
        low[at] = np.where(less, middle + 1, low[at])
        high[at] = np.where(less, high[at], middle)
    inside = low < last
    found = np.full(len(want), -1, dtype=np.int64)
    at = np.flatnonzero(inside)
    hit = values[low[at]] == want[at]
    found[at[hit]] = low[at[hit]]
    return found
