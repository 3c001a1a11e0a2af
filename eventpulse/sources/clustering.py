"""Laying out a table so that filters on any of several columns skip most of its files, and bucketed tables."""

from __future__ import annotations

import functools
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.reshape import quoted

# Ranks of a column are cut into so many bits; values are ranked against a sample of so many rows.
BITS, SAMPLE_ROWS = 6, 20_000


def _ranks(df: DataFrame, columns: Sequence[str], bits: int, seed: int) -> list[Column]:
    """The rank of each row's value among cut points that a bounded sample gives; NULL first."""
    n = df.count()
    sample = df.select(*[quoted(c).alias(f"c{i}") for i, c in enumerate(columns)]).sample(min(1.0, SAMPLE_ROWS / max(n, 1)), seed)
    ranks = []
    for i, name in enumerate(columns):
        own = sample.where(F.col(f"c{i}").isNotNull()).groupBy(f"c{i}").agg(F.count(F.lit(1)).alias("n"))
        rows = own.orderBy(f"c{i}").collect()
        # A value opens a new rank when the rows before it fill one, or always while there are ranks enough.
        total, most, upto, cuts = sum(r.n for r in rows), (1 << bits) - 1, 0, []
        for r in rows:
            if len(rows) <= most or upto * most >= len(cuts) * total:
                cuts.append(r[0])
            upto += r.n
        kind = df.schema[name].dataType
        known = [F.lit(v).cast(kind) for v in cuts[:most]]
        value = quoted(name)
        rank = F.coalesce(F.size(F.filter(F.array(*known), lambda c: c <= value)), F.lit(0)) if known else F.lit(0)
        # Spread over all bits, so that a column of few values weighs as much as one of many.
        ranks.append(F.floor(rank * (1 << bits) / (len(known) + 1)).cast("int"))
    return [F.when(quoted(c).isNull(), F.lit(0)).otherwise(r) for c, r in zip(columns, ranks)]


def morton_number(ranks: Sequence[Column], bits: int) -> Column:
    """The bits of the ranks in turn, the highest first, as one whole number."""
    parts = [
        F.shiftleft(F.shiftright(r, bit).bitwiseAND(F.lit(1)).cast("bigint"), bit * len(ranks) + len(ranks) - 1 - i)
        for bit in range(bits)
        for i, r in enumerate(ranks)
    ]
    return functools.reduce(lambda a, b: a.bitwiseOR(b), parts)


def clustered(df: DataFrame, columns: Sequence[str], files: int, bits: int = BITS, seed: int = 7) -> DataFrame:
    """The rows dealt out to ``files`` partitions along a Z-curve through the columns' ranks, sorted by it.

    Rows that are near in all columns lie together, so a filter on one of ``k`` columns leaves about the k-th root of
    the files per column to be read, not all of them as a sort by the columns in turn does for the later ones.
    """
    if not 0 < len(columns) * bits <= 62:
        raise ValueError("columns times bits must be between 1 and 62")
    placed = df.withColumn("_z", morton_number(_ranks(df, columns, bits, seed), bits))
    # The columns themselves spread rows that share a rank in all of them.
    order = ["_z", *[quoted(c) for c in columns]]
    return placed.repartitionByRange(files, *order).sortWithinPartitions(*order).drop("_z")


def write_bucketed(df: DataFrame, table: str, path: str, key: str, buckets: int) -> None:
    """Stores a table by hash of its key, so that joins and groups by the key need no exchange of it.

    Each bucket is written by one task, once: a key is in one file.
    """
    dealt = df.repartition(buckets, quoted(key))
    dealt.write.option("path", path).bucketBy(buckets, key).sortBy(key).saveAsTable(table)
