"""Elias-Fano sequences of ascending integers, with vectorised operations.

A sequence of m values below u keeps the low ``floor(log2(u / m))`` bits of
each value packed, and the high parts in unary in a bit vector: about
``2 + log2(u / m)`` bits a value.  Arrays may be views of a mapped file; when
one is opened, the ones before each 64-bit word are counted, to serve selection.
"""

from __future__ import annotations

import numpy as np

_U = np.uint64
_BYTES, _TOPS = _U(0x0101010101010101), _U(0x8080808080808080)
#: [byte, k]: the place of the byte's k-th one.
_PLACES = np.zeros((256, 8), np.int64)
for _byte in range(256):
    _at = [i for i in range(8) if _byte >> i & 1]
    _PLACES[_byte, :len(_at)] = _at


def _select(words: np.ndarray, before: np.ndarray, k: np.ndarray, ones: bool) -> np.ndarray:
    """Positions of the k-th ones (or zeros), counted from 0.  ``before``: ones
    (zeros) before each word."""
    at = np.searchsorted(before, k, "right") - 1
    word = words[at] if ones else ~words[at]
    left = (k - before[at]).astype(_U)
    # ones in each byte and those before it, then how many bytes end at or before the wanted one
    n = word - ((word >> _U(1)) & _U(0x5555555555555555))
    n = (n & _U(0x3333333333333333)) + ((n >> _U(2)) & _U(0x3333333333333333))
    n = ((n + (n >> _U(4))) & _U(0x0F0F0F0F0F0F0F0F)) * _BYTES
    done = ((left * _BYTES | _TOPS) - n) & _TOPS
    shift = np.bitwise_count(done).astype(_U) * _U(8)
    left -= (n << _U(8) >> shift) & _U(0xFF)
    byte = (word >> shift) & _U(0xFF)
    return at * 64 + shift.astype(np.int64) + _PLACES[byte.astype(np.int64), left.astype(np.int64)]


class EliasFano:
    def __init__(self, size: int, low_bits: int, low: np.ndarray, high: np.ndarray):
        self.size, self.low_bits, self.low, self.high = size, low_bits, low, high
        n = np.bitwise_count(high).astype(np.int64)
        self.ones = np.cumsum(n) - n
        self.zeros = np.arange(len(high)) * 64 - self.ones

    @classmethod
    def of(cls, values: np.ndarray) -> EliasFano:
        v = np.asarray(values, _U)
        m = len(v)
        top = int(v[-1]) + 1 if m else 1
        bits = max(0, (top // max(m, 1)).bit_length() - 1)
        words = np.zeros((m * bits + 63) // 64 + 1, _U)
        if bits:
            lows = v & _U((1 << bits) - 1)
            at = np.arange(m, dtype=np.int64) * bits
            word, off = at >> 6, (at & 63).astype(_U)
            np.bitwise_or.at(words, word, lows << off)
            over = (off + _U(bits)) > 64
            np.bitwise_or.at(words, word[over] + 1, lows[over] >> (_U(64) - off[over]))
        at = ((v >> _U(bits)) + np.arange(m, dtype=_U)).astype(np.int64)
        n_bits = m + (top >> bits) + 1
        flags = np.zeros((n_bits + 511) // 512 * 512, np.uint8)
        flags[at] = 1
        high = np.packbits(flags, bitorder="little").view(_U)
        return cls(m, bits, words, high)

    def arrays(self, name: str) -> dict[str, np.ndarray]:
        return {f"{name}.meta": np.array([self.size, self.low_bits], np.int64), f"{name}.low": self.low,
                f"{name}.high": self.high}

    @classmethod
    def load(cls, arrays: dict[str, np.ndarray], name: str) -> EliasFano:
        size, bits = arrays[f"{name}.meta"].tolist()
        return cls(size, bits, *(arrays[f"{name}.{x}"] for x in ("low", "high")))

    def _low(self, i: np.ndarray) -> np.ndarray:
        if not self.low_bits:
            return np.zeros(len(i), _U)
        at = i * self.low_bits
        word, off = at >> 6, (at & 63).astype(_U)
        both = self.low[word] >> off
        spill = (off + _U(self.low_bits)) > 64
        if spill.any():
            more = self.low[word[spill] + 1] << (_U(64) - off[spill])
            both[spill] |= more
        return both & _U((1 << self.low_bits) - 1)

    def access(self, i: np.ndarray) -> np.ndarray:
        """The i-th values."""
        i = np.asarray(i, np.int64)
        if not len(i):
            return np.zeros(0, _U)
        high = _select(self.high, self.ones, i, True) - i
        return (high.astype(_U) << _U(self.low_bits)) | self._low(i)

    def values(self) -> np.ndarray:
        """All values, unpacked one after another."""
        bits = np.flatnonzero(np.unpackbits(np.ascontiguousarray(self.high).view(np.uint8), bitorder="little"))
        i = np.arange(self.size)
        return ((bits[:self.size] - i).astype(_U) << _U(self.low_bits)) | self._low(i)

    def successor(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Of each x, the index of the first value that is not smaller (the
        size, if none), and whether that value is x."""
        x = np.asarray(x, _U)
        if not len(x) or not self.size:
            return np.zeros(len(x), np.int64), np.zeros(len(x), bool)
        h = (x >> _U(self.low_bits)).astype(np.int64)
        zeros = len(self.high) * 64 - self.size
        out = h >= zeros - 1
        h = np.minimum(h, zeros - 2)
        ends = _select(self.high, self.zeros, np.concatenate([np.maximum(h - 1, 0), h]), False)
        lo = np.where(h > 0, ends[:len(h)] - (h - 1), 0)  # values with a smaller high part
        hi = ends[len(h):] - h
        lo, hi = np.where(out, self.size, lo), np.where(out, self.size, hi)
        want = x & _U((1 << self.low_bits) - 1)
        end = hi
        lo, open_ = lo.copy(), np.flatnonzero(lo < hi)
        hi = hi.copy()
        while len(open_):  # most high parts have one value or two
            a, b = lo[open_], hi[open_]
            mid = (a + b) >> 1
            less = self._low(mid) < want[open_]
            lo[open_], hi[open_] = np.where(less, mid + 1, a), np.where(less, b, mid)
            open_ = open_[lo[open_] < hi[open_]]
        same = lo < end
        same[same] = self._low(lo[same]) == want[same]
        return lo, same
