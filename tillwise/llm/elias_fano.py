"""Elias-Fano coded monotone sequences in memory-mapped files, with vectorised successor search."""

from __future__ import annotations

import numpy as np

_BITS = (np.arange(1 << 16)[:, None] >> np.arange(16) & 1).astype(np.uint8)
_ONES = _BITS.sum(axis=1, dtype=np.int64)  # one bits of each 16-bit unit


def _numbered(bits: np.ndarray) -> np.ndarray:
    """Place of bit number r in each unit: [unit, r], 16 beyond the last."""
    table = np.full((1 << 16, 17), 16, np.uint8)
    rank = np.where(bits == 1, np.cumsum(bits, axis=1) - 1, 16)
    np.put_along_axis(table, rank, np.arange(16, dtype=np.uint8)[None, :], axis=1)
    return table[:, :16]


_ONE_AT, _ZERO_AT = _numbered(_BITS), _numbered(1 - _BITS)
_STRIDE = 4  # units of high bits per rank sample


def save(array: np.ndarray, path: str) -> np.ndarray:
    """The array as a read-only map of its file; empty arrays have no file."""
    if not len(array):
        return array
    array.tofile(path)
    return np.memmap(path, array.dtype, "r").view(np.ndarray)


class EliasFano:
    """n increasing numbers below 2^63: the low bits packed, the high bits in unary, one 0 ending each
    bucket, and the number of zeros before every 64 bits."""

    def __init__(self, values: np.ndarray, folder: str, name: str):
        values = values.astype(np.uint64)
        self.n = n = len(values)
        top = int(values[-1]) if n else 0
        self.low_bits = low = max(0, ((top + 1) // max(n, 1)).bit_length() - 1)
        high = (values >> np.uint64(low)).astype(np.int64)
        self.buckets = (int(high[-1]) if n else 0) + 1
        unary = np.zeros(-(-(n + self.buckets) // (16 * _STRIDE)) * 16 * _STRIDE, np.uint8)
        unary[high + np.arange(n)] = 1
        units = np.packbits(unary, bitorder="little").view("<u2")
        zeros = 16 * _STRIDE - _ONES[units].reshape(-1, _STRIDE).sum(axis=1)
        self.high = save(units, f"{folder}/{name}.high")
        self.before = save(np.concatenate([[0], np.cumsum(zeros)[:-1]]).astype(np.uint32), f"{folder}/{name}.rank")
        self.low = save(self._packed_lows(values, low), f"{folder}/{name}.low")

    @staticmethod
    def _packed_lows(values: np.ndarray, low: int) -> np.ndarray:
        if not low or not len(values):
            return np.zeros(0, np.uint8)
        parts = []
        for at in range(0, len(values), 1 << 16):  # whole bytes: a multiple of eight values
            part = values[at : at + (1 << 16)]
            bits = (part[:, None] >> np.arange(low, dtype=np.uint64)) & np.uint64(1)
            parts.append(np.packbits(bits.astype(np.uint8).reshape(-1), bitorder="little"))
        return np.concatenate([*parts, np.zeros(16, np.uint8)])

    def _lows(self, at: np.ndarray) -> np.ndarray:
        """Low bits of the values at these places."""
        if not self.low_bits:
            return np.zeros(len(at), np.uint64)
        bit = at * self.low_bits
        byte, shift = bit >> 3, (bit & 7).astype(np.uint64)
        word = np.zeros(len(at), np.uint64)
        for i in range(8):
            word |= self.low[byte + i].astype(np.uint64) << np.uint64(8 * i)
        word >>= shift
        if self.low_bits > 56:
            rest = self.low[byte + 8].astype(np.uint64)
            word |= np.where(shift > 0, rest << (np.uint64(64) - np.maximum(shift, np.uint64(1))), np.uint64(0))
        return word & np.uint64((1 << self.low_bits) - 1)

    def _place(self, number: np.ndarray, ones: bool) -> np.ndarray:
        """Bit position of each numbered zero (or one): its sample, its unit, its place in the unit."""
        before = self.before.astype(np.int64)
        if ones:
            before = np.arange(len(before)) * 16 * _STRIDE - before
        at = np.searchsorted(before, number, side="right") - 1
        left = number - before[at]
        at *= _STRIDE
        for _ in range(_STRIDE - 1):
            held = _ONES[self.high[at]]
            held = held if ones else 16 - held
            on = held <= left
            left -= np.where(on, held, 0)
            at += on
        within = _ONE_AT if ones else _ZERO_AT
        return at * 16 + within[self.high[at], left]

    def _up_to(self, bucket: np.ndarray) -> np.ndarray:
        """How many values lie in buckets up to this one: the place of its zero, less the zeros before."""
        return self._place(bucket, False) - bucket

    def get(self, at: np.ndarray) -> np.ndarray:
        """Values at these places."""
        at = np.asarray(at, np.int64)
        return (self._place(at, True) - at).astype(np.uint64) << np.uint64(self.low_bits) | self._lows(at)

    def successor(self, x: np.ndarray, low: np.ndarray | None = None, high: np.ndarray | None = None) -> np.ndarray:
        """Place of the first value at or above each x, searched from `low` to before `high`."""
        x = x.astype(np.uint64)
        if not self.n:
            return np.zeros(len(x), np.int64)
        bucket = (x >> np.uint64(self.low_bits)).astype(np.int64)
        beyond = bucket >= self.buckets
        bucket = np.minimum(bucket, self.buckets - 1)
        end = self._up_to(bucket)
        begin = np.where(bucket > 0, self._up_to(np.maximum(bucket - 1, 0)), 0)
        begin, end = np.where(beyond, self.n, begin), np.where(beyond, self.n, end)
        if low is not None:
            begin, end = np.clip(begin, low, high), np.clip(end, low, high)
        wanted = x & np.uint64((1 << self.low_bits) - 1)
        while True:  # binary search inside the bucket
            open_ = np.flatnonzero(begin < end)
            if not len(open_):
                return begin
            middle = (begin[open_] + end[open_]) >> 1
            less = self._lows(middle) < wanted[open_]
            begin[open_[less]] = middle[less] + 1
            end[open_[~less]] = middle[~less]

    def find(self, x: np.ndarray, low: np.ndarray | None = None, high: np.ndarray | None = None) -> np.ndarray:
        """Place of each x between `low` and `high`, or -1."""
        at = self.successor(x, low, high)
        inside = np.flatnonzero(at < (self.n if high is None else high))
        same = self.get(at[inside]) == x[inside].astype(np.uint64)
        out = np.full(len(x), -1)
        out[inside[same]] = at[inside[same]]
        return out

    def bytes(self) -> int:
        return sum(a.nbytes for a in (self.high, self.before, self.low))

