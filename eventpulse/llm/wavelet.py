"""A wavelet matrix: a sequence of token ids as bit-planes with rank and select.

The top plane holds the highest bit of every id in order. Below it the ids whose bit
was 0 come first, then those whose bit was 1, each in their order, and so on for the
lower bits. Beside each plane lies the number of ones before every 2048 bits. From
that alone one can read the id at a place, count an id up to a place, and find the
k-th place of an id, in one step per plane.
"""

from __future__ import annotations

import struct
from functools import cached_property

import numpy as np
import zstandard

MAGIC = b"WVM1"
SAMPLE = 2048
_POPCOUNT = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1).sum(1, dtype=np.uint8)


class WaveletMatrix:
    def __init__(self, n: int, planes: list[np.ndarray], zeros: list[int], ones_before: list[np.ndarray]):
        self.n, self.planes, self.zeros, self.ones_before = n, planes, zeros, ones_before

    @classmethod
    def build(cls, ids: np.ndarray) -> WaveletMatrix:
        """From ids of any unsigned or non-negative type; none at all is allowed."""
        top = int(ids.max()) if len(ids) else 0
        order = ids.astype(np.uint16 if top < 1 << 16 else np.uint32)
        planes, zeros, ones_before = [], [], []
        for level in range(max(1, top.bit_length()) - 1, -1, -1):
            ones = (order & order.dtype.type(1 << level)) != 0
            packed = np.packbits(ones, bitorder="little")
            planes.append(packed)
            zeros.append(len(ones) - int(np.count_nonzero(ones)))
            ones_before.append(_directory(packed))
            order = np.concatenate((order[~ones], order[ones]))
        return cls(len(ids), planes, zeros, ones_before)

    def to_bytes(self) -> bytes:
        """The compressed file: a header, then for each plane its zeros, directory and bits."""
        parts = [MAGIC, struct.pack("<QB", self.n, len(self.planes))]
        for plane, zeros, before in zip(self.planes, self.zeros, self.ones_before):
            parts += [struct.pack("<Q", zeros), before.astype("<u4").tobytes(), plane.tobytes()]
        return zstandard.ZstdCompressor(level=1).compress(b"".join(parts))

    @classmethod
    def from_bytes(cls, data: bytes) -> WaveletMatrix:
        raw = zstandard.ZstdDecompressor().decompress(data)
        if raw[:4] != MAGIC:
            raise ValueError("not a wavelet matrix file")
        (n, levels), at = struct.unpack_from("<QB", raw, 4), 13
        n_bytes, n_samples = (n + 7) // 8, (n + SAMPLE - 1) // SAMPLE + 1
        planes, zeros, before = [], [], []
        for _ in range(levels):
            zeros.append(struct.unpack_from("<Q", raw, at)[0])
            before.append(np.frombuffer(raw, "<u4", n_samples, at + 8))
            planes.append(np.frombuffer(raw, np.uint8, n_bytes, at + 8 + 4 * n_samples))
            at += 8 + 4 * n_samples + n_bytes
        return cls(n, planes, zeros, before)

    def _bit(self, level: int, i: int) -> int:
        return int(self.planes[level][i >> 3]) >> (i & 7) & 1

    def _ones(self, level: int, i: int) -> int:
        """Ones among the first i bits of a plane."""
        start = i // SAMPLE
        whole = self.planes[level][start * SAMPLE // 8 : i >> 3]
        count = int(self.ones_before[level][start]) + int(_POPCOUNT[whole].sum(dtype=np.int64))
        return count + (int(self.planes[level][i >> 3]) & ((1 << (i & 7)) - 1)).bit_count() if i & 7 else count

    def access(self, i: int) -> int:
        """The id at a place."""
        if not 0 <= i < self.n:
            raise IndexError(i)
        value = 0
        for level in range(len(self.planes)):
            bit, ones = self._bit(level, i), self._ones(level, i)
            i = self.zeros[level] + ones if bit else i - ones
            value = value << 1 | bit
        return value

    def _range(self, token: int, upto: int) -> tuple[int, int]:
        """Where the id's places among the first ``upto`` end up below the last plane."""
        low, high = 0, upto
        for level in range(len(self.planes)):
            a, b = self._ones(level, low), self._ones(level, high)
            if token >> (len(self.planes) - 1 - level) & 1:
                low, high = self.zeros[level] + a, self.zeros[level] + b
            else:
                low, high = low - a, high - b
        return low, high

    def count(self, token: int, upto: int | None = None) -> int:
        """How often the id is among the first ``upto`` ids (all by default)."""
        if token >> len(self.planes):
            return 0
        low, high = self._range(token, self.n if upto is None else upto)
        return high - low

    def select(self, token: int, k: int) -> int:
        """The place of the id's k-th occurrence, from 0."""
        if not 0 <= k < self.count(token):
            raise IndexError(k)
        i = self._range(token, 0)[0] + k
        for level in range(len(self.planes) - 1, -1, -1):
            bit = token >> (len(self.planes) - 1 - level) & 1
            i = self._select_bit(level, bit, i - self.zeros[level] if bit else i)
        return i

    def _select_bit(self, level: int, bit: int, k: int) -> int:
        """The place of the k-th bit of this kind in a plane, from 0: search the directory, then 2048 bits."""
        before = self.ones_before[level].astype(np.int64)
        if not bit:
            before = np.arange(len(before), dtype=np.int64) * SAMPLE - before
        start = int(np.searchsorted(before[: (self.n + SAMPLE - 1) // SAMPLE], k, side="right")) - 1
        own = np.unpackbits(self.planes[level][start * SAMPLE // 8 : (start + 1) * SAMPLE // 8], bitorder="little")
        own = own[: self.n - start * SAMPLE]
        return start * SAMPLE + int(np.flatnonzero(own == bit)[k - int(before[start])])

    @cached_property
    def ids(self) -> np.ndarray:
        """All ids in order, put together from the lowest plane up."""
        order = np.zeros(self.n, np.uint16 if len(self.planes) <= 16 else np.uint32)
        for level in range(len(self.planes) - 1, -1, -1):
            ones = np.unpackbits(self.planes[level], count=self.n, bitorder="little").view(bool)
            above = np.empty_like(order)
            above[~ones] = order[: self.zeros[level]]
            above[ones] = order[self.zeros[level] :] | order.dtype.type(1 << (len(self.planes) - 1 - level))
            order = above
        return order


def _directory(packed: np.ndarray) -> np.ndarray:
    """Ones before every 2048 bits, and before the end."""
    step = SAMPLE // 8
    counts = _POPCOUNT[packed]
    sums = np.add.reduceat(counts, np.arange(0, len(counts), step), dtype=np.int64) if len(counts) else []
    return np.concatenate(([0], np.cumsum(sums))).astype(np.uint32)
