"""Words of whole batches of texts, as array operations on their bytes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# Texts handled at once: several arrays of eight bytes per byte of text stay within a core's caches and memory.
CHUNK_BYTES = 1 << 19
_BASE = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.uint64(0xFF51AFD7ED558CCD)
_powers = np.ones(1, np.uint64)
_inverses = np.ones(1, np.uint64)


def byte_class(pattern_bytes) -> np.ndarray:
    """A table that is true for the bytes of words."""
    table = np.zeros(256, bool)
    table[list(pattern_bytes)] = True
    return table


# Anything but blank and the control characters from tab to carriage return.
NOT_SPACE = byte_class(set(range(256)) - {0x20, *range(0x09, 0x0E)})
# Digits, lower-case a-z and all bytes of characters beyond ASCII.
ALNUM = byte_class({*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)})


def lowered(column: pa.Array) -> pa.LargeStringArray:
    """The texts with A-Z in lower case; null becomes empty."""
    return pc.ascii_lower(pc.fill_null(column.cast(pa.large_string()), ""))


def chunks(texts: pa.LargeStringArray, most: int = CHUNK_BYTES) -> Iterator[tuple[int, pa.LargeStringArray]]:
    """Slices of at most so many bytes (one text may be longer), with the place of their first text."""
    sizes = pc.binary_length(texts).to_numpy(zero_copy_only=False)
    ends = np.cumsum(sizes)
    start = 0
    while start < len(texts):
        done = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, done + most, side="right")))
        yield start, texts.slice(start, stop - start)
        start = stop


def text_bytes(texts: pa.LargeStringArray) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of the texts one after the other, and where each text starts; the last number is the end."""
    offsets = np.frombuffer(texts.buffers()[1], np.int64, len(texts) + 1, 8 * texts.offset)
    data = texts.buffers()[2]
    if data is None or offsets[-1] == offsets[0]:
        return np.zeros(0, np.uint8), np.zeros(len(texts) + 1, np.int64)
    return np.frombuffer(data, np.uint8, offsets[-1] - offsets[0], offsets[0]), offsets - offsets[0]


def word_bounds(data: np.ndarray, docs: np.ndarray, is_word: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of all words, and the place of each text's first word; the last number is the end."""
    inside = np.zeros(len(data) + 1, bool)
    inside[:-1] = is_word[data]
    first = np.zeros(len(data) + 1, bool)
    first[docs] = True
    before = np.zeros(len(data) + 1, bool)
    before[1:] = inside[:-1]
    starts = np.flatnonzero(inside & (first | ~before))
    ends = np.flatnonzero(before & (first | ~inside))
    return starts, ends, np.searchsorted(starts, docs)


def _grown(n: int) -> None:
    global _powers, _inverses
    if len(_powers) < n:
        n = max(n, 2 * len(_powers))
        inverse = np.uint64(pow(int(_BASE), -1, 1 << 64))
        with np.errstate(over="ignore"):
            _powers, _inverses = (
                np.cumprod(np.concatenate((np.ones(1, np.uint64), np.full(n - 1, x, np.uint64)))) for x in (_BASE, inverse)
            )


def mixed(x: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(33))) * _MIX
        return x ^ (x >> np.uint64(29))


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each word: a polynomial over its bytes, from differences of running sums."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    _grown(len(data) + 1)
    with np.errstate(over="ignore"):
        sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * _powers[: len(data)], out=sums[1:])
        return mixed((sums[ends] - sums[starts]) * _inverses[starts] + (ends - starts).astype(np.uint64))
