"""Periodic runs of words: stretches in which the words ``period`` apart are identical.

Documents are exploded into overlapping tiles per octave of periods. A tile of the first scale has
``TILE`` words and serves all periods below an eighth of that; each further scale doubles tiles and
periods. Neighbouring tiles share a quarter of their words, twice the longest period, so every run
shows its whole minimal length in some tile, and two fragments of one run share at least a period.

A tile is solved by itself. Boundaries lie a period of the octave apart, so each run holds a boundary
``m`` together with ``m + q``. The values of the Z-functions at the boundary, forwards and backwards,
are how far the words from ``m`` on, and those before it, agree with the words ``q`` further on; a
run of period ``q`` is where both together reach ``q``. They are read from ranks of all stretches of
1, 2, 4, ... words (equal ranks are equal words, not equal hashes), for all boundaries and periods of
an octave at once.

Fragments are shuffled by document and period and stitched where they share a period; the runs of a
document are what is left that is long enough. A bitmap of the documents with runs lets the texts of
all others stay where they are.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import in_small_batches, text_or_empty, written
from .filters import key_filter, may_be_in, row_key
from .words import NOT_SPACE, chunks, text_bytes, word_bounds

# Words of the smallest tile. Texts beyond so many characters send their tiles to other tasks.
TILE = 1 << 13
LONG_CHARS = 1 << 16
# Shortest run, beside twice its period.
LEAST_WORDS = 12
# Words of tiles that are solved at once; one tile may be longer.
BATCH_WORDS = 1 << 18

TILE_SCHEMA = "key binary, low bigint, high bigint, start bigint, words binary"
FRAGMENT_SCHEMA = "key binary, period bigint, start bigint, end bigint"


def word_numbers(texts: pa.LargeStringArray) -> tuple[np.ndarray, np.ndarray]:
    """A number for each word of all texts, the same for equal words, and the place of each text's first word."""
    data, docs = text_bytes(texts)
    starts, ends, first = word_bounds(data, docs, NOT_SPACE)
    offsets = np.concatenate(([0], np.cumsum(ends - starts)))
    parts = [None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(data[NOT_SPACE[data]])]
    words = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(starts), parts)
    return words.dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.int32), first


def tiles_of(n: int, tile: int) -> Iterator[tuple[int, int, int, int]]:
    """Lowest period, end of periods, first word and end of the tiles of a document of n words."""
    size, low = tile, 1
    while 2 * low <= n:
        start = 0
        while True:
            yield low, size // 8, start, min(n, start + size)
            if start + size >= n:
                break
            start += size - size // 4
        low, size = size // 8, 2 * size


def _laid(tile: int):
    def lay(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = batch.column("key").to_pylist()
            for begin, texts in chunks(pc.cast(batch.column("text"), pa.large_string())):
                words, first = word_numbers(texts)
                rows = [
                    (keys[begin + i], low, high, start, words[first[i] + start : first[i] + end].tobytes())
                    for i in range(len(texts))
                    if first[i + 1] - first[i] >= LEAST_WORDS
                    for low, high, start, end in tiles_of(int(first[i + 1] - first[i]), tile)
                ]
                kinds = [pa.binary(), *[pa.int64()] * 3, pa.binary()]
                columns = [pa.array(c, k) for c, k in zip(zip(*rows) if rows else [()] * 5, kinds)]
                yield pa.record_batch(columns, names=["key", "low", "high", "start", "words"])

    return lay


class _Ranks:
    """Level k numbers the stretches of 2 ** k words; stretches beyond the end equal no other."""

    def __init__(self, words: np.ndarray):
        self.levels = [words.astype(np.int64)]

    def __getitem__(self, k: int) -> np.ndarray:
        while len(self.levels) <= k:
            last, half = self.levels[-1], 1 << (len(self.levels) - 1)
            n = len(last)
            level = -1 - np.arange(n, dtype=np.int64)
            if n > half:
                ranks = pd.factorize(last[:-half] * (int(last.max(initial=0)) + 1) + last[half:])[0]
                both = (last[:-half] >= 0) & (last[half:] >= 0)
                level[:-half][both] = ranks[both]
            self.levels.append(level)
        return self.levels[k]

    def agree(self, a: np.ndarray, b: np.ndarray, step: int) -> np.ndarray:
        """How many words from a and b on (step 1), or before them (step -1), are the same; a < b."""
        n, reach = len(self.levels[0]), np.zeros(len(a), np.int64)

        def grow(some: np.ndarray, k: int) -> np.ndarray:
            size = 1 << k
            x, y = a[some] + step * reach[some], b[some] + step * reach[some]
            if step < 0:
                x, y = x - size, y - size
            inside = (x >= 0) & (y < n)
            rank = self[k]
            same = np.zeros(len(some), bool)
            same[inside] = rank[x[inside]] == rank[y[inside]]
            reach[some[same]] += size
            return some[same]

        some, k = np.arange(len(a)), 0
        while len(some):
            some, k = grow(some, k), k + 1
        for level in range(k - 2, -1, -1):
            grow(np.arange(len(a)), level)
        return reach


def _smallest_factors(most: int) -> np.ndarray:
    found = np.arange(most + 1)
    for p in range(2, int(most**0.5) + 1):
        if found[p] == p:
            rest = found[p * p :: p]
            rest[rest == np.arange(p * p, most + 1, p)] = p
    return found


def _meeting(ranks: _Ranks, n: int, period: int) -> tuple[np.ndarray, np.ndarray]:
    """Boundaries and periods of an octave at which the Z-values can reach the period, one way or the other.

    Of both values together one is at least half, so a stretch of half the least sum must agree on one side.
    """
    level = 2 if period < 4 else max(1, period.bit_length() - 2)
    ahead, back = ranks[level], np.full(n, -1 - 2 * n, np.int64)
    back[1 << level :] = ahead[: -(1 << level)] if n > 1 << level else []
    found = []
    for side in (ahead, back):
        if period < 4:
            for q in range(period, 2 * period):
                m = np.flatnonzero(side[: max(0, n - q) : 4] == side[q::4][: len(side[: max(0, n - q) : 4])]) * 4
                found.append((m, np.full(len(m), q)))
        else:
            padded = np.concatenate((side, np.full(-n % period, -2 - 3 * n)))
            rows = padded.reshape(-1, period)
            row, column = np.nonzero(rows[1:] == rows[:-1, :1])
            found.append((row * period, period + column))
    return np.concatenate([m for m, _ in found]), np.concatenate([q for _, q in found])


def find_fragments(tiles: list[np.ndarray], low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, ...]:
    """Number of the tile, period, start and end of what each tile holds of runs of its periods, as far as it goes."""
    sizes = np.array([len(t) for t in tiles])
    begin = np.concatenate(([0], np.cumsum(sizes + 1)))[:-1]
    words = np.empty(int(sizes.sum()) + len(tiles), np.int64)
    fresh = 1 + max(int(t.max(initial=-1)) for t in tiles)
    for i, t in enumerate(tiles):
        words[begin[i] : begin[i] + len(t)] = t
        words[begin[i] + len(t)] = fresh + i
    n, ranks = len(words), _Ranks(words)
    most = int(np.minimum(high - 1, sizes // 2).max(initial=0))
    factors = _smallest_factors(most)
    found, period = [], 1
    while period <= most:
        m, q = _meeting(ranks, n, period)
        after, before = ranks.agree(m, m + q, 1), ranks.agree(m, m + q, -1)
        good = (after + before >= q) & (after + before + q >= LEAST_WORDS)
        found.append(np.stack((q[good], (m - before)[good], (m + q + after)[good])))
        period *= 2
    if not found:
        return (np.zeros(0, np.int64),) * 4
    # Boundaries inside one run give it again and again; period and start name it.
    q, start, end = np.concatenate(found, axis=1)
    once = np.unique(q * (n + 1) + start, return_index=True)[1]
    q, start, end = q[once], start[once], end[once]
    tile = np.searchsorted(begin, start, side="right") - 1
    keep = (q >= low[tile]) & (q < high[tile])
    # A period is the smallest if no divisor of it is one; the largest proper divisors are enough.
    rest = np.where(keep, q, 1)
    while (rest > 1).any():
        some = np.flatnonzero(rest > 1)
        prime = factors[rest[some]]
        rest[some] //= prime
        shift = q[some] // prime
        keep[some[ranks.agree(start[some], start[some] + shift, 1) >= q[some] - shift]] = False
        rest[~keep] = 1
    tile, q, start, end = tile[keep], q[keep], start[keep], end[keep]
    return tile, q, start - begin[tile], end - begin[tile]


def _solved(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        key, low, high, start, data = (batch.column(c).to_pylist() for c in ("key", "low", "high", "start", "words"))
        words = [np.frombuffer(x, np.int32) for x in data]
        first = 0
        while first < len(words):
            last, size = first, 0
            while last < len(words) and (last == first or size + len(words[last]) <= BATCH_WORDS):
                size += len(words[last])
                last += 1
            part = slice(first, last)
            tile, period, begin, end = find_fragments(words[part], np.array(low[part]), np.array(high[part]))
            offset = np.array(start[part], np.int64)[tile]
            columns = [
                pa.array([key[first + i] for i in tile.tolist()], pa.binary()),
                *(pa.array(x.astype(np.int64)) for x in (period, begin + offset, end + offset)),
            ]
            yield pa.record_batch(columns, names=["key", "period", "start", "end"])
            first = last


def _stitched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of each document and period the runs: fragments that share at least a period are one."""
    for batch in batches:
        rows = []
        for key, period, found in zip(*(batch.column(c).to_pylist() for c in ("key", "period", "fragments"))):
            runs: list[list[int]] = []
            for start, end in sorted((f["start"], f["end"]) for f in found):
                if runs and start <= runs[-1][1] - period:
                    runs[-1][1] = max(runs[-1][1], end)
                else:
                    runs.append([start, end])
            rows += [(key, start, end - start, period) for start, end in runs]
        kinds = [pa.binary(), *[pa.int64()] * 3]
        columns = [pa.array(c, k) for c, k in zip(zip(*rows) if rows else [()] * 4, kinds)]
        yield pa.record_batch(columns, names=["key", "start", "length", "period"])


def _collapsed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The words that no run holds after its first period, joined by a blank."""
    for batch in batches:
        texts = pc.cast(batch.column("text"), pa.large_string())
        out, n_words = [], []
        data, docs = text_bytes(texts)
        starts, ends, first = word_bounds(data, docs, NOT_SPACE)
        raw = data.tobytes()
        for i, runs in enumerate(batch.column("runs").to_pylist()):
            n = int(first[i + 1] - first[i])
            gone = np.zeros(n + 1, np.int64)
            for run in runs or ():
                gone[run["start"] + run["period"]] += 1
                gone[run["start"] + run["length"]] -= 1
            stay = first[i] + np.flatnonzero(np.cumsum(gone)[:n] == 0)
            out.append(b" ".join(raw[a:b] for a, b in zip(starts[stay].tolist(), ends[stay].tolist())))
            n_words.append(n)
        columns = [
            batch.column("doc_id"), batch.column("runs"), pa.array(n_words, pa.int64()), pa.array(out, pa.binary()).cast(pa.string()),
        ]
        yield pa.record_batch(columns, names=["doc_id", "runs", "n_words", "collapsed"])


def find_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", tile: int = TILE, long_chars: int = LONG_CHARS) -> DataFrame:
    """One row per input row: doc_id, ``runs`` (start, period, length, in that order), n_words, collapsed.

    Words are runs of anything but white-space bytes. A run is a stretch of at least twelve words and
    two periods whose smallest period is ``period`` and which no neighbouring word extends. In
    ``collapsed`` a word goes that some run holds after its first ``period`` words; the others are
    joined by one blank. A null text is empty; texts without words have no runs and an empty
    ``collapsed``. Repeated rows give repeated results, a null id is kept, other columns are ignored,
    and an empty table gives an empty result.

    Memory: a task holds its batch of texts and about a hundred bytes per word of the tiles it solves
    at once; the tile of the longest periods of a text is that text's words, at four bytes each.
    """
    if tile < 16 or tile & (tile - 1) or tile // 4 < LEAST_WORDS:
        raise ValueError("tile is a power of two of at least 64")
    in_small_batches(docs)
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), text_or_empty(F.col(text_col).cast("string")).alias("text"))
    rows = rows.select(row_key("doc_id", "text").alias("key"), "doc_id", "text")
    is_long = F.char_length("text") > long_chars
    short, long = (rows.where(c).select("key", "text").mapInArrow(_laid(tile), TILE_SCHEMA) for c in (~is_long, is_long))
    # The tiles of one long text are dealt out to tasks; those of short ones are solved where they are.
    spread = long.repartition("key", "low", "start")
    fragments = short.mapInArrow(_solved, FRAGMENT_SCHEMA).unionByName(spread.mapInArrow(_solved, FRAGMENT_SCHEMA))
    # Equal rows give equal fragments, which the set holds once in each task.
    by_period = fragments.groupBy("key", "period").agg(F.collect_set(F.struct("start", "end")).alias("fragments"))
    runs = by_period.mapInArrow(_stitched, "key binary, start bigint, length bigint, period bigint")
    by_document = runs.groupBy(F.col("key").alias("of")).agg(F.sort_array(F.collect_list(F.struct("start", "period", "length"))).alias("runs"))
    found = written(by_document, "runs")

    bitmap = key_filter(found, "of")
    held = rows.where(may_be_in("key", bitmap)).join(found, F.col("key") == F.col("of"), "left")
    none = F.expr("CAST(array() AS array<struct<start:bigint,period:bigint,length:bigint>>)")
    without = rows.where(~may_be_in("key", bitmap)).select("doc_id", "text", none.alias("runs"))
    together = held.select("doc_id", "text", F.coalesce("runs", none).alias("runs")).unionByName(without)
    return together.mapInArrow(
        _collapsed, "doc_id bigint, runs array<struct<start:bigint,period:bigint,length:bigint>>, n_words bigint, collapsed string"
    )
