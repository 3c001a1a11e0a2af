"""Token ids of all documents in id order, written as one wavelet matrix per block of a shard.

A shard is a range of document ids. Its task tokenizes the documents in order and
closes a block at ``BLOCK_TOKENS`` ids; each block is a row with the compressed
matrix and the ids and lengths of its documents. Spark writes the rows, so a lost
executor's shard is written again, and any store that Spark knows will do.

The tokenizer splits a text into pieces and encodes each piece by itself. So the
pieces of a whole batch are found at once with array operations, and the library
encodes each distinct piece once. Which characters are letters, digits or white space
is asked of the library, too, for each character that occurs. Strings of added tokens
are ordinary text, or cut out first and given their ids, as the library does by default.
"""

from __future__ import annotations

import os
import re
import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import in_small_batches, kept_by_worker, text_or_empty, written
from .wavelet import WaveletMatrix
from .words import chunks, text_bytes, word_hashes

BLOCK_TOKENS = 1_000_000
# Pieces whose ids a worker remembers at most; all are forgotten beyond it. Longer pieces are not remembered.
MOST_PIECES = 1_500_000
SLOT_BITS = 21
LONG_PIECE = 64
CHUNK_BYTES = 1 << 19
END = 0

BLOCK_SCHEMA = "shard int, block int, doc_ids array<bigint>, lengths array<bigint>, n_tokens bigint, payload binary"
_LETTER, _DIGIT, _SPACE, _OTHER, _UNKNOWN = range(5)
# The short endings that the byte-level pattern takes together with an apostrophe. Fixed values of that pattern.
ENDINGS = ("s", "t", "re", "ve", "m", "ll", "d")

# The byte-level alphabet: printable bytes stand for themselves, the others for characters from 256 on, in order.
_PRINTABLE = {*range(33, 127), *range(161, 173), *range(174, 256)}
_OTHERS = [b for b in range(256) if b not in _PRINTABLE]
_BYTE_CHARS = np.array([b if b in _PRINTABLE else 256 + _OTHERS.index(b) for b in range(256)], np.uint32)


class BatchEncoder:
    """Encodes batches of texts with a byte-level tokenizer file, by its distinct pieces."""

    def __init__(self, path: str, added_tokens: bool = False):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = not added_tokens
        added = self.tokenizer.get_added_tokens_decoder() if added_tokens else {}
        self.added = {token.content: number for number, token in added.items() if token.content}
        # Of tokens that begin at one place the longest counts.
        self.added_pattern = re.compile("(" + "|".join(map(re.escape, sorted(self.added, key=len, reverse=True))) + ")")
        # Tokens that take white space with them or ask for whole words are left to the library.
        self.by_library = any(token.lstrip or token.rstrip or token.single_word for token in added.values())
        self.model = self.tokenizer.model
        self.kinds = np.full(0x110000, _UNKNOWN, np.uint8)
        self._forget()

    def _learn_kinds(self, chars: np.ndarray) -> None:
        """A character's kind shows in what the library leaves in one piece with it."""
        for code in chars.tolist():
            found = _OTHER
            for kind, before in ((_LETTER, "a"), (_DIGIT, "1"), (_OTHER, "!"), (_SPACE, "\n")):
                if len(self.tokenizer.pre_tokenizer.pre_tokenize_str(before + chr(code))) == 1:
                    found = kind
                    break
            self.kinds[code] = found

    def _starts(self, chars: np.ndarray, doc_starts: np.ndarray) -> np.ndarray:
        """Where pieces start. ``doc_starts`` marks the first character of each text."""
        kinds = self.kinds[chars]
        if (kinds == _UNKNOWN).any():
            self._learn_kinds(np.unique(chars[kinds == _UNKNOWN]))
            kinds = self.kinds[chars]
        space = kinds == _SPACE
        starts = np.empty(len(chars), bool)
        starts[0] = True
        np.not_equal(kinds[1:], kinds[:-1], out=starts[1:])
        starts |= doc_starts
        # The last white space before something else is a piece by itself, or begins the next one if it is a blank.
        last = space.copy()
        last[:-1] &= ~space[1:] & ~doc_starts[1:]
        last[-1] = False
        starts |= last
        places = np.flatnonzero(last)
        starts[places[chars[places] == 32] + 1] = False
        # An apostrophe that starts a piece takes a short ending with it.
        quotes = np.flatnonzero(starts & (chars == 39))
        for quote in quotes.tolist():
            tail = chars[quote + 1 : quote + 3]
            fresh = doc_starts[quote + 1 : quote + 3].tolist()
            text = "".join(map(chr, tail[: fresh.index(True) if True in fresh else 2].tolist()))
            for ending in ENDINGS:
                if text.startswith(ending):
                    starts[quote + 1] = False
                    after = quote + 1 + len(ending)
                    if after < len(starts):
                        starts[after] = starts[after] or kinds[after] == _LETTER
                    break
        return starts

    def encode(self, texts: pa.LargeStringArray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, and how many each text has. No text may be null."""
        joined = text_bytes(texts)[0].tobytes() if self.added else b""
        if any(content.encode() in joined for content in self.added):
            return self._encode_with_added(texts.to_pylist())
        return self._encode_ordinary(texts)

    def _encode_with_added(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """As ``encode``, with added tokens: what stands between them is encoded by itself."""
        if self.by_library:
            found = [e.ids for e in self.tokenizer.encode_batch(texts, add_special_tokens=False)]
            return np.fromiter(chain.from_iterable(found), np.uint32), np.fromiter(map(len, found), np.int64, len(found))
        # Of each text's parts, every second one is an added token.
        parts = [self.added_pattern.split(text) for text in texts]
        ordinary = [part for cut in parts for part in cut[::2]]
        ids, counts = self._encode_ordinary(pa.array(ordinary, pa.large_string()))
        after = np.array([i + 1 < len(cut) for cut in parts for i in range(0, len(cut), 2)], bool)
        tokens = np.array([self.added[part] for cut in parts for part in cut[1::2]], np.uint32)
        ids = np.insert(ids, np.cumsum(counts)[after], tokens)
        upto = np.concatenate(([0], np.cumsum(counts + after)))
        ends = np.cumsum([(len(cut) + 1) // 2 for cut in parts])
        return ids, np.diff(upto[np.concatenate(([0], ends))])

    def _encode_ordinary(self, texts: pa.LargeStringArray) -> tuple[np.ndarray, np.ndarray]:
        data, doc_bytes = text_bytes(texts)
        joined = data.tobytes()
        chars = np.frombuffer(joined.decode().encode("utf-32-le"), np.uint32)
        if not len(chars):
            return np.zeros(0, np.uint32), np.zeros(len(texts), np.int64)
        width = 1 + (chars >= 0x80) + (chars >= 0x800) + (chars >= 0x10000).astype(np.int64)
        byte_at = np.concatenate(([0], np.cumsum(width)))
        doc_chars = np.searchsorted(byte_at, doc_bytes)
        doc_starts = np.zeros(len(chars), bool)
        doc_starts[doc_chars[:-1][doc_chars[:-1] < len(chars)]] = True
        starts = np.flatnonzero(self._starts(chars, doc_starts))
        piece_at = np.append(byte_at[starts], len(joined))
        rows = self._rows(data, piece_at[:-1], piece_at[1:])
        n = self.lengths[rows].astype(np.int64)
        ends = np.cumsum(n)
        places = np.repeat(self.firsts[rows] - (ends - n), n)
        places += np.arange(len(places))
        upto = np.concatenate(([0], ends))
        return self.flat[places], np.diff(upto[np.searchsorted(starts, doc_chars)])

    def _forget(self) -> None:
        """No pieces are known. Slots hold the hash and the row of a piece; rows, the place and number of its ids."""
        self.slot_hashes = np.zeros(1 << SLOT_BITS, np.uint64)
        self.slot_rows = np.zeros(1 << SLOT_BITS, np.int32)
        self.flat, self.firsts, self.lengths = (np.zeros(0, kind) for kind in (np.uint32, np.int32, np.int32))

    def _rows(self, data: np.ndarray, begins: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """The row of each piece. Pieces not in their slot are encoded, each distinct one once."""
        if len(self.lengths) > MOST_PIECES:
            self._forget()
        hashes = word_hashes(data, begins, ends)
        # The hash tells short pieces apart; a long one counts as different from all others. Empty slots hold 0.
        long = np.flatnonzero((ends - begins > LONG_PIECE) | (hashes == 0))
        hashes[long] = np.arange(len(long), dtype=np.uint64)
        slots = (hashes >> np.uint64(64 - SLOT_BITS)).astype(np.int64)
        rows = self.slot_rows[slots]
        known = self.slot_hashes[slots] == hashes
        known[long] = False
        missed = np.flatnonzero(~known)
        if len(missed):
            new, first, back = np.unique(hashes[missed], return_index=True, return_inverse=True)
            at = missed[first]
            # The model of the tokenizer reads bytes as the characters of the byte-level alphabet.
            text = _BYTE_CHARS[data].tobytes().decode("utf-32-le")
            pieces = [text[i:j] for i, j in zip(begins[at].tolist(), ends[at].tolist())]
            ids = [[t.id for t in self.model.tokenize(p)] for p in pieces]
            lengths = np.fromiter(map(len, ids), np.int64, len(ids))
            fresh = np.arange(len(self.lengths), len(self.lengths) + len(ids), dtype=np.int32)
            rows[missed] = fresh[back]
            firsts = (len(self.flat) + np.cumsum(lengths) - lengths).astype(np.int32)
            self.firsts = np.concatenate((self.firsts, firsts))
            self.lengths = np.concatenate((self.lengths, lengths.astype(np.int32)))
            self.flat = np.concatenate((self.flat, np.fromiter(chain.from_iterable(ids), np.uint32, lengths.sum())))
            kept = ends[at] - begins[at] <= LONG_PIECE
            places = (new[kept] >> np.uint64(64 - SLOT_BITS)).astype(np.int64)
            # Of pieces with the same slot the last one stays, in both arrays.
            self.slot_hashes[places], self.slot_rows[places] = new[kept], fresh[kept]
        return rows


def batch_encoder(path: str, added_tokens: bool = False) -> BatchEncoder:
    """One encoder per worker process, so what a task has learnt serves the next."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    return kept_by_worker(("encoder", path, added_tokens), lambda: BatchEncoder(path, added_tokens))


def _blocks(tokenizer_path: str, added_tokens: bool):
    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, shard, block = batch_encoder(tokenizer_path, added_tokens), TaskContext.get().partitionId(), 0
        held: list[np.ndarray] = []
        doc_ids: list[int | None] = []
        lengths: list[int] = []

        def closed() -> pa.RecordBatch:
            ids = np.concatenate(held)
            row = [shard, block, doc_ids, lengths, len(ids), WaveletMatrix.build(ids).to_bytes()]
            kinds = [pa.int32(), pa.int32(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.int64(), pa.binary()]
            names = ["shard", "block", "doc_ids", "lengths", "n_tokens", "payload"]
            return pa.record_batch([pa.array([x], k) for x, k in zip(row, kinds)], names=names)

        for batch in batches:
            batch_ids = batch.column("doc_id").to_pylist()
            for first, texts in chunks(batch.column("text").cast(pa.large_string()), CHUNK_BYTES):
                ids, counts = encoder.encode(texts)
                held.append(np.insert(ids, np.cumsum(counts), END).astype(np.uint32))
                doc_ids += batch_ids[first : first + len(texts)]
                lengths += (counts + 1).tolist()
                if sum(map(len, held)) >= BLOCK_TOKENS:
                    yield closed()
                    held, doc_ids, lengths, block = [], [], [], block + 1
        if doc_ids:
            yield closed()

    return blocks


def write_token_files(
    docs: DataFrame, tokenizer_path: str, folder: str | None = None, id_col: str = "doc_id", text_col: str = "text",
    added_tokens: bool = False,
) -> DataFrame:
    """Writes the shards and returns their rows, read back: shard, block, doc_ids, lengths, n_tokens, payload.

    Documents are in ascending order of id, null first; rows that share an id are in an
    order of their texts. A null text is empty and has the end id alone. Other columns
    are ignored; an empty table gives no rows. ``tokenizer_path`` must name the same
    file on every executor. With ``added_tokens``, strings of the tokenizer's added tokens
    get their ids, as by ``Tokenizer.encode(text, add_special_tokens=False)``; without, they
    are ordinary text.
    """
    in_small_batches(docs)
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), text_or_empty(F.col(text_col).cast("string")).alias("text"))
    keyed = rows.withColumn("key", F.xxhash64("text"))
    shards = keyed.repartitionByRange("doc_id", "key").sortWithinPartitions("doc_id", "key").drop("key")
    return written(shards.mapInArrow(_blocks(tokenizer_path, added_tokens), BLOCK_SCHEMA), "token-files", folder, compression="none")


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            data = WaveletMatrix.from_bytes(row["payload"]).ids.astype("<u4")
            ends = np.cumsum(row["lengths"])
            starts = ends - row["lengths"]
            crcs = [zlib.crc32(data[a:b]) for a, b in zip(starts.tolist(), ends.tolist())]
            n = len(ends)
            columns = [
                pa.array([row["shard"]] * n, pa.int32()), pa.array([row["block"]] * n, pa.int32()),
                pa.array(row["doc_ids"], pa.int64()), pa.array(starts, pa.int64()),
                pa.array(row["lengths"], pa.int64()), pa.array(crcs, pa.int64()),
            ]
            yield pa.record_batch(columns, names=["shard", "block", "doc_id", "place", "n_tokens", "ids_crc32"])


def read_documents(blocks: DataFrame) -> DataFrame:
    """One row per document, from the files alone: doc_id, start, n_tokens, ids_crc32.

    ``start`` counts the ids of all documents before it. Sums run over shards (one row
    each) and, within a shard, over its blocks; document rows are not sorted.
    """
    found = blocks.select("shard", "block", "doc_ids", "lengths", "payload").mapInArrow(
        _digests, "shard int, block int, doc_id bigint, place bigint, n_tokens bigint, ids_crc32 bigint"
    )
    sizes = blocks.select("shard", "block", "n_tokens")
    earlier = lambda *by: W.partitionBy(*by).rowsBetween(W.unboundedPreceding, -1)
    in_shard = sizes.withColumn("before", F.coalesce(F.sum("n_tokens").over(earlier("shard").orderBy("block")), F.lit(0)))
    shards = sizes.groupBy("shard").agg(F.sum("n_tokens").alias("n"))
    shards = shards.select("shard", F.coalesce(F.sum("n").over(earlier().orderBy("shard")), F.lit(0)).alias("first"))
    starts = in_shard.join(shards, "shard").select("shard", "block", (F.col("first") + F.col("before")).alias("base"))
    return found.join(starts, ["shard", "block"]).select(
        "doc_id", (F.col("base") + F.col("place")).alias("start"), "n_tokens", "ids_crc32"
    )
