"""Rising sequences in about 2 + log2(universe / n) bits a value, with select."""

from __future__ import annotations

import struct

import numpy as np

#: One position is kept for so many ones of the upper bits.
SAMPLE = 64
_HEAD = struct.Struct("<QQBIII")  # n, universe, low bits, bytes of lows, of uppers, of samples


def encode(values: np.ndarray) -> bytes:
    """``values``: rising, from 0 on, below 2 ** 63."""
    v = np.asarray(values, np.uint64)
    n, top = len(v), int(v[-1]) if len(v) else 0
    width = max(0, (top // n).bit_length() - 1) if n else 0
    bits = (v[:, None] >> np.arange(width, dtype=np.uint64)[None, :]) & np.uint64(1)
    low = np.packbits(bits.astype(np.uint8).reshape(-1), bitorder="little").tobytes()
    ones = (v >> np.uint64(width)).astype(np.int64) + np.arange(n)
    upper = np.zeros(n + (top >> width) + 1, np.uint8)
    upper[ones] = 1
    high = np.packbits(upper, bitorder="little").tobytes()
    samples = ones[::SAMPLE].astype("<u4").tobytes()
    return _HEAD.pack(n, top, width, len(low), len(high), len(samples)) + low + high + samples


class Reader:
    def __init__(self, raw: memoryview | bytes) -> None:
        raw = memoryview(raw)
        self.n, self.top, self.width, a, b, c = _HEAD.unpack_from(raw)
        at = _HEAD.size
        self.low = np.frombuffer(raw[at : at + a], np.uint8)
        self.high = np.frombuffer(raw[at + a : at + a + b], np.uint8)
        self.samples = np.frombuffer(raw[at + a + b : at + a + b + c], "<u4")
        self.size = at + a + b + c

    def _low(self, i: int) -> int:
        start, value = i * self.width, 0
        first, last = start // 8, -(-(start + self.width) // 8)
        value = int.from_bytes(self.low[first:last].tobytes(), "little") >> start % 8
        return value & ((1 << self.width) - 1)

    def _one(self, i: int) -> int:
        """Where the i-th one of the upper bits is: from its sample on, byte by byte."""
        at, skip = int(self.samples[i // SAMPLE]), i % SAMPLE
        byte = at // 8
        word = int(self.high[byte]) >> at % 8 << at % 8
        while (count := word.bit_count()) <= skip:
            skip, byte = skip - count, byte + 1
            word = int(self.high[byte])
        for _ in range(skip):
            word &= word - 1
        return 8 * byte + (word & -word).bit_length() - 1

    def select(self, i: int) -> int:
        """The i-th value."""
        if not 0 <= i < self.n:
            raise IndexError(i)
        return (self._one(i) - i << self.width) | self._low(i)

    def all(self) -> np.ndarray:
        """All values at once."""
        ones = np.flatnonzero(np.unpackbits(self.high, bitorder="little"))[: self.n]
        out = (ones - np.arange(self.n)).astype(np.uint64) << np.uint64(self.width)
        bits = np.unpackbits(self.low, bitorder="little")[: self.n * self.width]
        for k in range(self.width):
            out |= bits[k :: self.width].astype(np.uint64) << np.uint64(k)
        return out.astype(np.int64)
