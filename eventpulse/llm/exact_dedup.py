"""Exact de-duplication by a tree-merge of sorted digest runs.

Every input partition becomes a run: its digests in order, each with the ids that
share it. Runs then meet in rounds. In a round, ``FAN`` neighbouring runs of the
same digest range go to one task, which merges them in digest order and keeps one
identifier per digest, so after log(partitions) rounds there is one run per range.
A text that a third of all rows share is one entry per run, never one per row.
Digests are SHA-256; the merge takes two entries for the same text only if the
whole digest and the length in bytes agree.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, in_small_batches

FAN = 8
# A run is closed at this many ids, so a task's memory is bounded whatever its input.
RUN_ROWS = 200_000

RUN_SCHEMA = "shard int, node bigint, run bigint, digest binary, n_bytes bigint, ids array<bigint>"
MERGED_SCHEMA = "shard int, node bigint, digest binary, n_bytes bigint, best_id bigint, best_run bigint, n bigint"


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    part, piece, n_rows = TaskContext.get().partitionId(), 0, 0
    found: dict[tuple[bytes, int], list[int | None]] = {}

    def closed() -> pa.RecordBatch:
        keys = sorted(found)
        return pa.record_batch(
            [
                pa.array([k[0][0] << 8 | k[0][1] for k in keys], pa.int32()),
                pa.array([part] * len(keys), pa.int64()),
                pa.array([part << 20 | piece] * len(keys), pa.int64()),
                pa.array([k[0] for k in keys], pa.binary()),
                pa.array([k[1] for k in keys], pa.int64()),
                pa.array([found[k] for k in keys], pa.list_(pa.int64())),
            ],
            names=["shard", "node", "run", "digest", "n_bytes", "ids"],
        )

    for batch in batches:
        lowered = pc.ascii_lower(pc.fill_null(batch.column("text"), "").cast(pa.large_string()))
        for doc_id, text in zip(batch.column("doc_id").to_pylist(), lowered.cast(pa.large_binary()).to_pylist()):
            found.setdefault((hashlib.sha256(text).digest(), len(text)), []).append(doc_id)
            n_rows += 1
        if n_rows >= RUN_ROWS:
            yield closed()
            found, n_rows, piece = {}, 0, piece + 1
    if found:
        yield closed()


def _merge(largest: bool):
    """Merges runs that arrive in order of shard, node and digest: one row per digest stays."""

    def better(a: tuple, b: tuple) -> tuple:
        if a[0] != b[0]:
            if a[0] is None or b[0] is None:
                return b if a[0] is None else a
            return max(a, b, key=lambda x: x[0]) if largest else min(a, b, key=lambda x: x[0])
        return min(a, b, key=lambda x: x[1])

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, held, best, n = ["shard", "node", "digest", "n_bytes"], None, None, 0
        for batch in batches:
            out: list[tuple] = []
            columns = [batch.column(c).to_pylist() for c in (*names, "best_id", "best_run", "n")]
            for shard, node, digest, n_bytes, best_id, best_run, m in zip(*columns):
                if (shard, node, digest, n_bytes) == held:
                    best, n = better(best, (best_id, best_run)), n + m
                else:
                    if held is not None:
                        out.append((*held, *best, n))
                    held, best, n = (shard, node, digest, n_bytes), (best_id, best_run), m
            if out:
                yield _merged_batch(out)
        if held is not None:
            yield _merged_batch([(*held, *best, n)])

    return merge


def _merged_batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int32(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64(), pa.int64()]
    names = ["shard", "node", "digest", "n_bytes", "best_id", "best_run", "n"]
    return pa.record_batch([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "largest") -> DataFrame:
    """One row per input row: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal when identical after lower-casing A-Z; a null text counts as
    empty. ``keep`` says whether the row with the largest or the smallest id stays.
    Exactly one row of a group stays: of rows with the same id, one of them. A null
    id loses to every other id; a group with null ids only has a null ``keep_id``.
    Other columns are ignored. An empty table gives an empty result.
    """
    if keep not in ("largest", "smallest"):
        raise ValueError("keep is 'largest' or 'smallest'")
    in_small_batches(docs)
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    runs = cut(rows.mapInArrow(_runs, RUN_SCHEMA))
    last = runs.agg(F.max("node")).first()[0] or 0
    best = F.array_max("ids") if keep == "largest" else F.array_min("ids")
    level = runs.select(
        "shard", "node", "digest", "n_bytes", best.alias("best_id"), F.col("run").alias("best_run"),
        F.size("ids").cast("bigint").alias("n"),
    )
    while True:
        level = level.withColumn("node", F.expr(f"node div {FAN}"))
        sorted_runs = level.repartition("shard", "node").sortWithinPartitions("shard", "node", "digest", "n_bytes")
        level, last = sorted_runs.mapInArrow(_merge(keep == "largest"), MERGED_SCHEMA), last // FAN
        if last == 0:
            break
    winners = level.select("digest", "n_bytes", "best_id", "best_run", "n")
    at = F.when(F.col("best_id").isNull(), F.lit(0)).otherwise(F.array_position("ids", F.col("best_id")) - 1)
    return (
        runs.join(winners, ["digest", "n_bytes"])
        .select("*", at.alias("at"))
        .select("*", F.posexplode("ids").alias("pos", "doc_id"))
        .select(
            "doc_id",
            F.col("best_id").alias("keep_id"),
            F.col("n").alias("group_size"),
            ((F.col("run") == F.col("best_run")) & (F.col("pos") == F.col("at"))).alias("kept"),
            F.lower(F.hex("digest")).alias("text_sha256"),
        )
    )
