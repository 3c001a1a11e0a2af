"""Distinct word shingles of texts as sorted 64-bit hashes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from .words import NOT_SPACE, chunks, lowered, mixed, text_bytes, word_bounds, word_hashes

WORDS = 5
_PLACES = np.array([pow(0x9E3779B97F4A7C15, i + 2, 1 << 64) | 1 for i in range(WORDS)], np.uint64)


def shingle_sets(texts: pa.LargeStringArray) -> tuple[np.ndarray, np.ndarray]:
    """The sets of all texts one after the other, each sorted, and where each starts; the last number is the end.

    A text of fewer than ``WORDS`` words has its whole sequence as one shingle; one without words has none.
    """
    data, docs = text_bytes(texts)
    starts, ends, first = word_bounds(data, docs, NOT_SPACE)
    words = word_hashes(data, starts, ends)
    n_words = np.diff(first)
    n_each = np.where(n_words >= WORDS, n_words - WORDS + 1, (n_words > 0).astype(np.int64))
    doc = np.repeat(np.arange(len(texts)), n_each)
    at = np.arange(n_each.sum()) + np.repeat(first[:-1] - (np.cumsum(n_each) - n_each), n_each)
    length = np.minimum(n_words, WORDS)[doc]
    with np.errstate(over="ignore"):
        total = length.astype(np.uint64)
        padded = np.concatenate((words, np.zeros(WORDS, np.uint64)))
        for i in range(WORDS):
            total += np.where(i < length, padded[at + i], np.uint64(0)) * _PLACES[i]
    hashes = mixed(total)
    order = np.lexsort((hashes, doc))
    hashes, doc = hashes[order], doc[order]
    fresh = np.ones(len(hashes), bool)
    fresh[1:] = (hashes[1:] != hashes[:-1]) | (doc[1:] != doc[:-1])
    return hashes[fresh], np.searchsorted(doc[fresh], np.arange(len(texts) + 1))


def set_keys(hashes: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """A 64-bit key of each set, the same whatever order its members come in. Empty sets have key 0."""
    sizes = np.diff(bounds)
    keys = np.zeros(len(sizes), np.uint64)
    full = sizes > 0
    if full.any():
        with np.errstate(over="ignore"):
            sums = np.add.reduceat(mixed(hashes + np.uint64(0x632BE59BD9B4E019)), bounds[:-1][full])
            keys[full] = mixed(sums + sizes[full].astype(np.uint64))
    return keys


def set_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list, np.ndarray, np.ndarray, np.ndarray]]:
    """Ids, set keys, hashes and bounds of each chunk of the documents' batches."""
    for batch in batches:
        ids = batch.column("doc_id").to_pylist()
        for first, texts in chunks(lowered(batch.column("text"))):
            hashes, bounds = shingle_sets(texts)
            yield ids[first : first + len(texts)], set_keys(hashes, bounds), hashes, bounds
