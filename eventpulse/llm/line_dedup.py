"""Line de-duplication: lines that several documents share stay in one of them only.

Documents are exploded into their distinct normalised lines, each a digest of 16 bytes with
the line's places; the texts of lines are never shuffled. Distinct documents are counted per
digest in two steps (by digest and document, then by digest), so a line that a third of all
documents hold is spread over tasks before it is added up. Lines that enough documents share
are joined back to the other documents that hold them, whose texts are put together again from
the places that are left. A bitmap of these documents lets all other texts stay where they are.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import in_small_batches, text_or_empty, written
from .filters import key_filter, may_be_in, row_key

BLANK = b" \t\n\x0b\x0c\r"
_LATER_BYTES = bytes(range(0x80, 0xC0))


def line_key(line: bytes) -> bytes:
    """The line without blanks at its ends, A-Z in lower case."""
    return line.strip(BLANK).lower()


def _n_chars(data: bytes) -> int:
    return len(data) if data.isascii() else len(data.translate(None, _LATER_BYTES))


def _exploded(least_chars: int):
    def explode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows of line, key, doc_id and places: each distinct line of a row that is long enough, once."""
        for batch in batches:
            lines, keys, ids, places = [], [], [], []
            texts = pc.cast(batch.column("text"), pa.large_binary()).to_pylist()
            for key, doc_id, text in zip(batch.column("key").to_pylist(), batch.column("doc_id").to_pylist(), texts):
                found: dict[bytes, list[int]] = {}
                for place, line in enumerate(text.split(b"\n")):
                    line = line_key(line)
                    if len(line) >= least_chars and _n_chars(line) >= least_chars:
                        found.setdefault(hashlib.blake2b(line, digest_size=16).digest(), []).append(place)
                lines += found
                places += found.values()
                keys += [key] * len(found)
                ids += [doc_id] * len(found)
            columns = [
                pa.array(lines, pa.binary()), pa.array(keys, pa.binary()), pa.array(ids, pa.int64()),
                pa.array(places, pa.list_(pa.int32())),
            ]
            yield pa.record_batch(columns, names=["line", "key", "doc_id", "places"])

    return explode


def _put_together(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts, n_lines, n_dropped = [], [], []
        dropped = batch.column("dropped").to_pylist()
        for text, lost in zip(pc.cast(batch.column("text"), pa.large_binary()).to_pylist(), dropped):
            lines = text.split(b"\n")
            gone = {place for some in lost or () for place in some}
            texts.append(b"\n".join(x for i, x in enumerate(lines) if i not in gone) if gone else text)
            n_lines.append(len(lines))
            n_dropped.append(len(gone))
        columns = [
            batch.column("doc_id"), pa.array(texts, pa.binary()).cast(pa.string()),
            pa.array(n_lines, pa.int64()), pa.array(n_dropped, pa.int64()),
        ]
        yield pa.record_batch(columns, names=["doc_id", "text", "n_lines", "n_dropped"])


def dedup_lines(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least_chars: int = 20, least_docs: int = 3
) -> DataFrame:
    """One row per input row: doc_id, text without its dropped lines, n_lines (before), n_dropped.

    Texts are split at line feeds; a null or empty text is one empty line. Lines whose keys have
    ``least_chars`` code points and are in ``least_docs`` documents go, but for those of the
    document with the largest id, which keeps each of its own. Rows with the same id are one
    document and each gets a row. Rows without an id count as one document, below all others.
    A text of which every line goes is empty. Other columns are ignored; an empty table gives
    an empty result. Keys are compared by digests of 128 bits. A task holds a batch of whole
    texts, and of a document the places of its lines.
    """
    in_small_batches(docs)
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), text_or_empty(F.col(text_col).cast("string")).alias("text"))
    rows = rows.select(row_key("doc_id", "text").alias("key"), "doc_id", "text")
    lines = rows.mapInArrow(_exploded(least_chars), "line binary, key binary, doc_id bigint, places array<int>")

    n_docs = F.count_distinct("doc_id") + F.max(F.col("doc_id").isNull().cast("int"))
    counted = lines.groupBy("line").agg(n_docs.alias("n_docs"), F.max("doc_id").alias("keep_id"))
    shared = written(counted.where(F.col("n_docs") >= least_docs).select(F.col("line").alias("of"), "keep_id"), "shared-lines")
    going = lines.join(shared, F.col("line") == F.col("of")).where(~F.col("doc_id").eqNullSafe(F.col("keep_id")))
    # Equal rows give equal places, which the set holds once in each task.
    dropped = written(going.groupBy(F.col("key").alias("of")).agg(F.collect_set("places").alias("dropped")), "dropped-lines")

    bitmap = key_filter(dropped, "of")
    touched = rows.where(may_be_in("key", bitmap)).join(dropped, F.col("key") == F.col("of"), "left")
    changed = touched.select("doc_id", "text", "dropped").mapInArrow(
        _put_together, "doc_id bigint, text string, n_lines bigint, n_dropped bigint"
    )
    n_lines = F.length("text") - F.length(F.replace("text", F.lit("\n"), F.lit(""))) + 1
    whole = rows.where(~may_be_in("key", bitmap)).select(
        "doc_id", "text", n_lines.cast("bigint").alias("n_lines"), F.lit(0).cast("bigint").alias("n_dropped")
    )
    return changed.unionByName(whole)
