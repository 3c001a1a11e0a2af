"""Benchmark decontamination by the q-gram lemma.

Passages and documents are compared as lower-case letters and digits with single
blanks between runs of them. A passage is cut into pieces of 100 to 199 characters (a
shorter one is one piece), and pieces of 100 characters are laid over it every 50, the
last one at its end. So an excerpt of ``EXCERPT_CHARS`` characters holds one of them
whole, wherever it begins. A piece of m characters may differ by k = m / 10 edits.
By the lemma a place within that budget shares at least m + 1 - q - k q of the piece's
q-grams, and all of them lie on k + 1 neighbouring diagonals (place in the document
less place in the piece). So shared q-grams are counted in overlapping bands of
2 (k + 1) diagonals, which loses nothing; bands that reach the count are verified by
a banded alignment. Passages that begin alike, such as questions with a shared instruction,
give many such bands wherever a text repeats what they share; so many bands of one shape are first
aligned together, row by row, and only those within the budget are looked at one by one.
Passages too short for all this can be looked for as whole words.

The passages are a stated query set: they go to all tasks in blocks of bounded size,
and each block is compared with all documents, whole texts included.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import in_small_batches, kept_by_worker
from .words import word_hashes

Q = 8
EDIT_RATE = 0.1
PIECE_CHARS = 100
PIECE_STEP = 50
EXCERPT_CHARS = PIECE_CHARS + PIECE_STEP - 1
# Shorter passages have no edits to spare: they match nothing, or whole words exactly.
LEAST_CHARS = 24
# Characters of passages that are sent to all tasks at once, and of documents handled at once.
BLOCK_CHARS = 4_000_000
CHUNK_CHARS = 1 << 19
# Postings looked at together, and bands aligned together; from so many on of one shape.
SLICE_POSTINGS, TOGETHER, LEAST_TOGETHER = 4_000_000, 1_024, 8
_FILTER_BITS = 22
_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


@cache
def _kept() -> np.ndarray:
    """True for letters and digits, by code point."""
    return np.fromiter((chr(c).isalnum() for c in range(0x110000)), bool, 0x110000)


def _lower(text: str) -> str:
    low = text.lower()
    return low if len(low) == len(text) else "".join(x if len(x) == 1 else c for c in text for x in [c.lower()])


def normalised(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The compared characters of all texts, the place of each in its text, and where each text starts.

    Each text is followed by ``Q`` zeros, so no q-gram spans two texts; the last
    number of the starts is the end.
    """
    lower = [_lower(t) for t in texts]
    lengths = np.fromiter(map(len, lower), np.int64, len(lower))
    chars = np.frombuffer("".join(lower).encode("utf-32-le", "surrogatepass"), np.uint32)
    starts = np.concatenate(([0], np.cumsum(lengths)))
    word = _kept()[chars]
    before = np.zeros(len(chars), bool)
    before[1:] = word[:-1]
    before[starts[:-1][lengths > 0]] = False
    keep = np.flatnonzero(word | before)
    upto = np.searchsorted(keep, starts)
    sizes = np.diff(upto)
    doc = np.repeat(np.arange(len(texts)), sizes)
    out = np.zeros(len(keep) + Q * len(texts), np.uint32)
    places = np.zeros(len(out), np.int64)
    at = np.arange(len(keep)) + Q * doc
    out[at] = np.where(word[keep], chars[keep], np.uint32(32))
    places[at] = keep - starts[doc]
    return out, places, upto + Q * np.arange(len(texts) + 1)


def q_grams(chars: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the ``Q`` characters from each place on, built by doubling."""
    with np.errstate(over="ignore"):
        h, width = chars.astype(np.uint64) + np.uint64(1), 1
        while width < Q:
            h = (h[:-width] * (_MULTIPLIER ^ np.uint64(width))) ^ (h[width:] + np.uint64(width))
            h ^= h >> np.uint64(31)
            width *= 2
        return h


@dataclass(frozen=True)
class Piece:
    item_id: int | None
    chars: np.ndarray
    edits: int
    least: int  # shared q-grams that a place within the budget has at least
    whole_words: bool = False  # looked for as it is, from the start of a word to the end of one


def _cuts(n: int) -> list[tuple[int, int]]:
    """Start and end of the pieces of a passage of n characters."""
    bounds = [0, *np.cumsum([len(x) for x in np.array_split(np.empty(n), max(1, n // PIECE_CHARS))]).tolist()]
    cuts = list(zip(bounds[:-1], bounds[1:]))
    if n >= PIECE_CHARS:
        starts = [*range(0, n - PIECE_CHARS, PIECE_STEP), n - PIECE_CHARS]
        cuts += [(i, i + PIECE_CHARS) for i in starts]
    return sorted(set(cuts))


def pieces_of(items: list[tuple[int | None, str | None]], whole_words: bool = False) -> list[Piece]:
    """The pieces of all passages; with ``whole_words``, passages below ``LEAST_CHARS``, too."""
    pieces = []
    for item_id, text in items:
        chars = normalised([text or ""])[0][:-Q]
        if len(chars) and chars[-1] == 32:
            chars = chars[:-1]
        if len(chars) < LEAST_CHARS:
            if whole_words and len(chars):
                pieces.append(Piece(item_id, chars, 0, 0, True))
            continue
        for begin, end in _cuts(len(chars)):
            m = end - begin
            edits = min(int(m * EDIT_RATE), (m - Q) // Q)
            pieces.append(Piece(item_id, chars[begin:end], edits, m + 1 - Q - edits * Q))
    return pieces


class Index:
    """The q-grams of all pieces: a bitmap that rules most out, and sorted postings."""

    def __init__(self, pieces: list[Piece]):
        self.pieces = pieces
        grams = [np.zeros(0, np.uint64) if p.whole_words else q_grams(p.chars) for p in pieces]
        keys = np.concatenate(grams)
        piece = np.repeat(np.arange(len(pieces), dtype=np.int32), [len(g) for g in grams])
        place = np.concatenate([np.arange(len(g), dtype=np.int32) for g in grams])
        order = np.argsort(keys, kind="stable")
        self.keys, first = np.unique(keys[order], return_index=True)
        self.first = np.append(first, len(order))
        self.piece, self.place = piece[order], place[order]
        self.maybe = np.zeros(1 << _FILTER_BITS, bool)
        self.maybe[self.keys >> np.uint64(64 - _FILTER_BITS)] = True
        self.width = np.array([p.edits + 1 for p in pieces], np.int64)
        self.least = np.array([p.least for p in pieces], np.int64)
        self.longest = max(len(p.chars) for p in pieces)
        # Pieces looked for as whole words, by their lengths: sorted hashes, and the numbers of the pieces.
        by_length: dict[int, list[int]] = {}
        for number, p in enumerate(pieces):
            if p.whole_words:
                by_length.setdefault(len(p.chars), []).append(number)
        self.words = {}
        for length, numbers in by_length.items():
            chars = np.concatenate([pieces[n].chars for n in numbers])
            begins = np.arange(len(numbers)) * length
            hashes = word_hashes(chars, begins, begins + length)
            order = np.argsort(hashes, kind="stable")
            self.words[length] = hashes[order], np.array(numbers)[order]

    def whole_words(self, chars: np.ndarray) -> Iterator[tuple[int, int]]:
        """Piece and place of those that stand as whole words, by place for each length."""
        if not self.words:
            return
        padded = np.concatenate(([0], chars, np.zeros(LEAST_CHARS, chars.dtype)))
        between = (padded == 0) | (padded == 32)
        begins = np.flatnonzero(between[:-1] & ~between[1:])
        for length, (hashes, numbers) in self.words.items():
            here = begins[between[np.minimum(begins + 1 + length, len(padded) - 1)]]
            here = here[here + length <= len(chars)]
            own = word_hashes(chars, here, here + length)
            first, last = np.searchsorted(hashes, own), np.searchsorted(hashes, own, side="right")
            for i in np.flatnonzero(last > first).tolist():
                at = int(here[i])
                for number in numbers[first[i] : last[i]].tolist():
                    if np.array_equal(self.pieces[number].chars, chars[at : at + length]):
                        yield number, at

    def bands(self, chars: np.ndarray) -> Iterator[tuple[int, int, int]]:
        """Piece, least and greatest diagonal of the bands that share enough q-grams."""
        if len(chars) < Q or not len(self.keys):
            return
        grams = q_grams(chars)
        some = np.flatnonzero(self.maybe[grams >> np.uint64(64 - _FILTER_BITS)])
        at = np.minimum(np.searchsorted(self.keys, grams[some]), len(self.keys) - 1)
        equal = self.keys[at] == grams[some]
        some, at = some[equal], at[equal]
        n = self.first[at + 1] - self.first[at]
        # Slices of bounded size, overlapping by more than a piece with its edits, so each band is whole in one.
        upto, reach, begin = np.cumsum(n), 2 * (self.longest + 2 * int(self.width.max())), 0
        while begin < len(some):
            done = upto[begin - 1] if begin else 0
            end = int(np.searchsorted(upto, done + SLICE_POSTINGS, side="right"))
            end = max(end, int(np.searchsorted(some, some[begin] + 2 * reach, side="right")))
            yield from self._bands_of(some[begin:end], at[begin:end], n[begin:end])
            if end >= len(some):
                break
            begin = int(np.searchsorted(some, some[end] - reach))

    def _bands_of(self, some: np.ndarray, at: np.ndarray, n: np.ndarray) -> Iterator[tuple[int, int, int]]:
        postings = np.repeat(self.first[at] - (np.cumsum(n) - n), n) + np.arange(n.sum())
        piece = self.piece[postings].astype(np.int64)
        diagonal = np.repeat(some, n) - self.place[postings]
        # Half bands are counted; a band is one of them and the next.
        half = diagonal // self.width[piece] + (1 << 20)
        band = piece << np.int64(40) | half
        order = np.argsort(band, kind="stable")
        keys, begin = np.unique(band[order], return_index=True)
        if not len(keys):
            return
        end = np.append(begin[1:], len(order))
        follows = keys[1:] == keys[:-1] + 1
        end[:-1][follows] = end[1:][follows]  # a band starts at a half band that has q-grams and holds the next one
        for i in np.flatnonzero(end - begin >= self.least[keys >> 40]).tolist():
            number, half_band = int(keys[i]) >> 40, (int(keys[i]) & ((1 << 40) - 1)) - (1 << 20)
            # A q-gram of the piece counts once, however often the document has it nearby.
            if len(np.unique(self.place[postings[order[begin[i] : end[i]]]])) >= self.least[number]:
                width = int(self.width[number])
                yield number, half_band * width, half_band * width + 2 * width - 1


def align(piece: np.ndarray, text: np.ndarray, low: int, high: int, edits: int) -> tuple[int, int, int] | None:
    """Start, end and edits of the best place of the piece in the text, on diagonals from low to high; or none.

    A path may leave the band by the edit budget. Places before and behind the match are free.
    """
    if exact := _word_for_word(piece, text, low, high, edits):
        return exact
    best = _banded(piece, text, low - edits, high + edits, edits, free=True)
    if best is None:
        return None
    end = best[1]
    back = _banded(piece[::-1], text[:end][::-1], -edits, edits, edits, free=False)
    return (end - back[1] if back else max(0, end - len(piece))), end, best[0]


def _word_for_word(piece: np.ndarray, text: np.ndarray, low: int, high: int, edits: int) -> tuple[int, int, int] | None:
    begin = max(0, low - edits)
    found = text[begin : max(0, high + edits + len(piece))].astype("<u4").tobytes().find(piece.astype("<u4").tobytes())
    return (begin + found // 4, begin + found // 4 + len(piece), 0) if found >= 0 and found % 4 == 0 else None


def within_budget(tasks: list[tuple[np.ndarray, np.ndarray, int, int]], edits: int) -> np.ndarray:
    """Which of the tasks (piece, text, least and greatest diagonal) ``align`` would find; pieces and bands are of one size.

    The rows of all tables are computed side by side; those beyond the budget fall out on the way.
    """
    found = np.zeros(len(tasks), bool)
    m, width, far = len(tasks[0][0]), tasks[0][3] - tasks[0][2] + 1 + 2 * edits, 1 << 20
    offsets = np.arange(width, dtype=np.int32)
    for first in range(0, len(tasks), TOGETHER):
        part = tasks[first : first + TOGETHER]
        pieces = np.stack([t[0] for t in part])
        low = np.array([t[2] - edits for t in part])
        size = np.array([len(t[1]) for t in part])
        places = low[:, None] + np.arange(m + width)
        inside, after = (places >= 0) & (places <= size[:, None]), places >= 1
        # chars[:, k] is the character that a step to place low + k reads.
        chars = np.zeros(places.shape, np.uint32)
        for row, (_, text, *_) in zip(range(len(part)), part):
            begin, end = max(0, int(low[row])), min(len(text), int(low[row]) + m + width - 1)
            if begin < end:
                chars[row, begin - low[row] + 1 : end - low[row] + 1] = text[begin:end]
        alive = np.arange(len(part))
        table = np.where(inside[:, :width], 0, far).astype(np.int32)
        for i in range(1, m + 1):
            here = slice(i, i + width)
            step = table + (chars[alive, here] != pieces[alive, i - 1, None])
            step[~after[alive, here]] = far
            down = np.full_like(table, far)
            down[:, :-1] = table[:, 1:] + 1
            ok = inside[alive, here]
            step = np.where(ok, np.minimum(step, down), far)
            table = np.where(ok, np.minimum.accumulate(step - offsets, axis=1) + offsets, far).astype(np.int32)
            if i % 4 == 0:
                lasting = table.min(axis=1) <= edits
                if not lasting.all():
                    alive, table = alive[lasting], table[lasting]
                    if not len(alive):
                        break
        found[first + alive[table.min(axis=1) <= edits] if len(alive) else []] = True
    return found


def _banded(piece: np.ndarray, text: np.ndarray, low: int, high: int, edits: int, free: bool) -> tuple[int, int] | None:
    """Fewest edits, if within the budget, and the end in the text. Cell c of row i is the text's place i + low + c."""
    width, far = high - low + 1, 1 << 20
    offsets = np.arange(width)
    places = low + offsets
    inside = (places >= 0) & (places <= len(text))
    row = np.where(inside, 0 if free else np.abs(places), far)  # a fixed start is reached by leading edits alone
    padded = np.concatenate((text, [0]))
    for i in range(1, len(piece) + 1):
        places = low + i + offsets
        inside = (places >= 0) & (places <= len(text))
        here = padded[np.clip(places - 1, 0, len(text))]
        step = row + np.where((here == piece[i - 1]) & (places >= 1), 0, 1)
        step[places < 1] = far
        down = np.append(row[1:], far) + 1
        step = np.where(inside, np.minimum(step, down), far)
        row = np.minimum.accumulate(step - offsets) + offsets
        row = np.where(inside, row, far)
        if i % 8 == 0 and row.min() > edits:
            return None
    at = int(row.argmin())
    return (int(row[at]), low + at + len(piece)) if row[at] <= edits else None


def _leaks(index: Index, texts: list[str]) -> dict[int, list[tuple[Piece, int, int, int]]]:
    """By text: pieces found, with start and end in the text's own characters, and edits."""
    chars, places, starts = normalised(texts)
    found: dict[int, dict[int, tuple[int, int, int]]] = {}
    bands: dict[tuple[int, int, int], list[tuple[int, int, int, int]]] = {}
    for number, low, high in index.bands(chars):
        piece = index.pieces[number]
        middle = min(max((low + high) // 2 + len(piece.chars) // 2, 0), len(chars) - 1)
        first = int(np.searchsorted(starts, max(low, 0), side="right")) - 1
        last = int(np.searchsorted(starts, min(max(high + len(piece.chars), middle), len(chars) - 1), side="right")) - 1
        for doc in range(first, last + 1):
            if int(starts[doc + 1]) - Q > int(starts[doc]):
                bands.setdefault((len(piece.chars), high - low, piece.edits), []).append((number, doc, low, high))

    def own(doc: int) -> slice:
        return slice(int(starts[doc]), int(starts[doc + 1]) - Q)

    def note(number: int, doc: int, hit: tuple[int, int, int]) -> None:
        if hit[2] < found.get(doc, {}).get(number, (0, 0, 1 << 20))[2]:
            of_text = places[own(doc)]
            found.setdefault(doc, {})[number] = (int(of_text[hit[0]]), int(of_text[hit[1] - 1]) + 1, hit[2])

    for (*_, edits), tasks in bands.items():
        inexact = []
        for number, doc, low, high in tasks:
            if found.get(doc, {}).get(number, (0, 0, 1))[2]:
                begin = int(starts[doc])
                task = index.pieces[number].chars, chars[own(doc)], low - begin, high - begin
                if hit := _word_for_word(*task, edits):
                    note(number, doc, hit)
                else:
                    inexact.append((number, doc, task))
        if len(inexact) >= LEAST_TOGETHER:
            good = within_budget([task for *_, task in inexact], edits)
            inexact = [x for x, is_good in zip(inexact, good) if is_good]
        for number, doc, task in inexact:
            if found.get(doc, {}).get(number, (0, 0, 1))[2] and (hit := align(*task, edits)):
                note(number, doc, hit)
    for number, at in index.whole_words(chars):
        doc = int(np.searchsorted(starts, at, side="right")) - 1
        end = at + len(index.pieces[number].chars)
        found.setdefault(doc, {}).setdefault(number, (int(places[at]), int(places[end - 1]) + 1, 0))
    return {doc: [(index.pieces[n], *hit) for n, hit in sorted(hits.items())] for doc, hits in found.items()}


def _index_of(shared) -> Index | None:
    """The worker's index of a broadcast block of passages; none if no passage is long enough."""
    name, items, whole_words = shared.value

    def index() -> Index | None:
        pieces = pieces_of(items, whole_words)
        return Index(pieces) if pieces else None

    return kept_by_worker(("index", name), index)


def _chunks(texts: list[str]) -> Iterator[tuple[int, list[str]]]:
    start, size = 0, 0
    for i, text in enumerate(texts):
        if i > start and size + len(text) > CHUNK_CHARS:
            yield start, texts[start:i]
            start, size = i, 0
        size += len(text)
    if start < len(texts):
        yield start, texts[start:]


def _blocks(benchmark: DataFrame, id_col: str, text_col: str, whole_words: bool) -> Iterator:
    """Broadcasts the passages in blocks of about ``BLOCK_CHARS`` characters; one block for most benchmarks."""
    in_small_batches(benchmark)
    items = benchmark.select(F.col(id_col).cast("bigint").alias("item_id"), F.col(text_col).cast("string").alias("text"))
    total = items.agg(F.sum(F.char_length("text"))).first()[0] or 0
    n = -(-total // BLOCK_CHARS) or 1
    for i in range(n):
        block = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == i)
        # The name tells a worker that has an index already which block it is of.
        items_of = [tuple(r) for r in block.collect()]
        yield benchmark.sparkSession.sparkContext.broadcast((uuid.uuid4().hex, items_of, whole_words))


SCHEMA = "doc_id bigint, item_id bigint, pieces bigint, begin bigint, end bigint, edits bigint"


def find_leaks(
    docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    item_col: str = "item_id", item_text_col: str = "text", whole_words: bool = False,
) -> DataFrame:
    """One row per document and passage found in it: doc_id, item_id, pieces, begin, end, edits.

    ``pieces`` counts the pieces of the passage that are found; from ``begin`` to
    ``end`` (code points of the text, end exclusive) they lie, with ``edits`` edits
    together; pieces overlap, so several may count the same edit. Documents without a
    passage have no row. Passages of fewer than ``LEAST_CHARS`` compared characters
    match nothing or, with ``whole_words``, the same words in a document, as one piece.
    Null and empty texts match nothing; null ids are kept; repeated rows give repeated results; other columns are ignored.
    """
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text"))

    def with_block(shared):
        def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            index = _index_of(shared)
            for batch in batches if index else ():
                ids, texts = batch.column("doc_id").to_pylist(), [t or "" for t in batch.column("text").to_pylist()]
                out = []
                for first, part in _chunks(texts):
                    for doc, hits in sorted(_leaks(index, part).items()):
                        by_item: dict = {}
                        for piece, begin, end, edits in hits:
                            by_item.setdefault(piece.item_id, []).append((begin, end, edits))
                        out += [
                            (ids[first + doc], item, len(h), min(x[0] for x in h), max(x[1] for x in h), sum(x[2] for x in h))
                            for item, h in by_item.items()
                        ]
                columns = [pa.array(c, pa.int64()) for c in zip(*out)] if out else [pa.array([], pa.int64())] * 6
                yield pa.record_batch(columns, names=[x.split()[0] for x in SCHEMA.split(", ")])

        return found

    parts = [rows.mapInArrow(with_block(shared), SCHEMA) for shared in _blocks(benchmark, item_col, item_text_col, whole_words)]
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result


def without_leaks(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", whole_words: bool = False) -> DataFrame:
    """The documents, with all their columns, in which no passage is found. Nothing is shuffled."""
    for shared in _blocks(benchmark, "item_id", "text", whole_words):

        def clean(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            index = _index_of(shared)
            for batch in batches:
                texts = [t or "" for t in batch.column(text_col).to_pylist()]
                leaked = {first + doc for first, part in _chunks(texts) for doc in _leaks(index, part)} if index else ()
                yield batch.filter(pa.array([i not in leaked for i in range(batch.num_rows)], pa.bool_()))

        docs = docs.mapInArrow(clean, docs.schema)
    return docs
