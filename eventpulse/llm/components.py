"""Connected components of a graph given as edges, by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from .common import cut

# A round's tasks are as many as this makes of the edges; most rounds are of few edges.
EDGES_PER_TASK = 200_000


def _kept(edges: DataFrame, tasks: int) -> tuple[DataFrame, int, int]:
    """The edges, written, with their number and a hash of them all."""
    seen = Observation()
    n, mark = F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("a", "b")).alias("mark")
    kept = cut(edges.coalesce(tasks).observe(seen, n, mark))
    return kept, seen.get["n"], seen.get["mark"]


def components(edges: DataFrame) -> DataFrame:
    """One row per node of an edge: node, component (the least node reachable). Edges have columns ``a`` and ``b``.

    A round joins each node's greater neighbours to its least one, then its lesser
    neighbours. Minima combine before they are shuffled, and rounds are as many as the
    logarithm of the longest path. Loops are left out; an empty table gives none.
    """
    pairs = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a > b").distinct()
    tasks = int(edges.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    current, n, mark = _kept(pairs, tasks)
    before = None
    while n and (n, mark) != before:
        before, tasks = (n, mark), min(tasks, -(-n // EDGES_PER_TASK))
        current = current.coalesce(tasks)
        both = current.unionAll(current.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("least"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("least").alias("b"))
        large = large.where("a > b").coalesce(tasks)
        least = large.groupBy("a").agg(F.min("b").alias("least"))
        small = large.join(least, "a").select(F.col("b").alias("a"), F.col("least").alias("b")).where("a > b")
        joined = small.unionAll(least.select("a", F.col("least").alias("b"))).coalesce(tasks).distinct()
        current, n, mark = _kept(joined, tasks)
    roots = current.select(F.col("b").alias("node")).distinct().select("node", F.col("node").alias("component"))
    return current.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(roots)
