"""Elias-Fano coding of a non-decreasing integer sequence, with rank samples
for select: about 2 + log2(u / n) bits a value and 6 % of the upper bits for
the samples."""

from __future__ import annotations

import numpy as np

_BLOCK = 64  # bytes of upper bits for each sample
_ONES = np.array([bin(i).count("1") for i in range(256)], np.uint8)
#: _NTH[b, k]: place of the k-th one in byte b.
_NTH = np.zeros((256, 8), np.uint8)
for _b in range(256):
    for _k, _p in enumerate(p for p in range(8) if _b >> p & 1):
        _NTH[_b, _k] = _p


class EliasFano:
    """``n`` values; ``low_bits`` bits of each in ``lower``, the rest in unary
    in ``upper``; ``samples``: ones before each block of ``upper``."""

    def __init__(self, n: int, low_bits: int, lower: bytes, upper: bytes, samples: bytes):
        self.n, self.low_bits = n, low_bits
        self.lower, self.upper, self.samples = lower, upper, samples
        self._lower = np.concatenate([np.frombuffer(lower, np.uint8), np.zeros(8, np.uint8)])
        pad = -len(upper) % _BLOCK
        self._upper = np.concatenate([np.frombuffer(upper, np.uint8), np.zeros(pad, np.uint8)]).reshape(-1, _BLOCK)
        self._samples = np.frombuffer(samples, "<u4").astype(np.int64)

    @classmethod
    def encode(cls, values: np.ndarray) -> EliasFano:
        v = np.asarray(values, np.int64)
        n = len(v)
        if n == 0:
            return cls(0, 0, b"", b"", b"")
        if v[0] < 0 or (np.diff(v) < 0).any():
            raise ValueError("values must be non-negative and non-decreasing")
        low = max(0, int(int(v[-1]) // n).bit_length() - 1)
        bits = ((v[:, None] >> np.arange(low)) & 1).astype(np.uint8)
        ones = (v >> low) + np.arange(n)
        upper = np.zeros(int(ones[-1]) + 1, np.uint8)
        upper[ones] = 1
        packed = np.packbits(upper, bitorder="little")
        whole = np.concatenate([packed, np.zeros(-len(packed) % _BLOCK, np.uint8)]).reshape(-1, _BLOCK)
        before = np.concatenate([[0], np.cumsum(_ONES[whole].sum(axis=1, dtype=np.int64))[:-1]])
        return cls(n, low, np.packbits(bits.ravel(), bitorder="little").tobytes(), packed.tobytes(), before.astype("<u4").tobytes())

    def select(self, at: np.ndarray) -> np.ndarray:
        """The values at the places ``at``."""
        at = np.asarray(at, np.int64)
        out = np.empty(len(at), np.int64)
        for i in range(0, len(at), 1 << 14):
            out[i : i + (1 << 14)] = self._select(at[i : i + (1 << 14)])
        return out

    def _select(self, at: np.ndarray) -> np.ndarray:
        if len(at) == 0:
            return at
        block = np.searchsorted(self._samples, at, side="right") - 1
        within = at - self._samples[block]
        sums = np.cumsum(_ONES[self._upper[block]], axis=1, dtype=np.int64)
        byte = (sums <= within[:, None]).sum(axis=1)
        rows = np.arange(len(at))
        left = within - np.where(byte > 0, sums[rows, byte - 1], 0)
        place = (block * _BLOCK + byte) * 8 + _NTH[self._upper[block, byte], left]
        high = place - at
        if not self.low_bits:
            return high
        bit = at * self.low_bits
        word = np.zeros(len(at), np.uint64)
        for k in range(8):
            word |= self._lower[bit // 8 + k].astype(np.uint64) << np.uint64(8 * k)
        low = (word >> (bit % 8).astype(np.uint64)) & np.uint64((1 << self.low_bits) - 1)
        return (high << self.low_bits) | low.astype(np.int64)

    def size(self) -> int:
        return len(self.lower) + len(self.upper) + len(self.samples)
