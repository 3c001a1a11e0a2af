"""The most frequent values of a column of any width, counted exactly without a shuffle of all values.

A first pass keeps a mergeable summary of frequent items, of bounded size in each task. A second counts its
candidates exactly where the rows are. A value that the summary lacks has fewer rows than its error allows, so
the result is certain if the last value listed has more; otherwise (a flat column) all values are counted.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut
from .introspect import column_values
from .reshape import quoted

TRACKED = 10_000


def least_certain(n_rows: int, tracked: int) -> float:
    """Rows beyond which a value is surely among the candidates.

    A frequent-items sketch of s slots (a power of two, three quarters of them used) is wrong by 3.5 / s of the rows
    at most, and lists every value whose count is beyond twice that.
    """
    slots = 1 << max(3, (max(1, -(-4 * tracked // 3)) - 1).bit_length())
    return 2 * 3.5 / slots * n_rows


def frequent_values(df: DataFrame, column: str, n_values: int, tracked: int = TRACKED) -> DataFrame:
    """What ``column_values`` with ``max_records`` gives: value and n_records, most frequent first, ties by value.

    ``tracked`` bounds the values that a task remembers and that go to all tasks; it is at least ``n_values``.
    """
    if not 0 < n_values <= tracked:
        raise ValueError(f"n_values must be between 1 and {tracked}, got {n_values}")
    values = df.select(quoted(column).alias("value"))
    told = F.expr(f"approx_top_k(value, {tracked}, {tracked})")
    summary = values.where(F.col("value").isNotNull()).agg(told.alias("items"), F.count(F.lit(1)).alias("n"))
    found = cut(summary.select(F.explode_outer("items").alias("i"), "n").select(F.col("i.item").alias("candidate"), "n"))
    n_rows = found.agg(F.max("n")).first()[0] or 0
    candidates = found.where(F.col("candidate").isNotNull()).select("candidate").distinct()
    # At most ``tracked`` candidates and, as one more value, NULL.
    wanted = candidates.unionAll(values.limit(1).select(F.lit(None).cast(values.schema["value"].dataType)))
    counted = values.join(F.broadcast(wanted), F.col("value").eqNullSafe(F.col("candidate")), "left_semi")
    counted = cut(counted.groupBy("value").agg(F.count(F.lit(1)).alias("n_records")))
    top = counted.orderBy(F.desc("n_records"), F.asc_nulls_last("value")).limit(n_values)
    known = top.agg(F.min("n_records").alias("least"), F.count(F.lit(1)).alias("n")).first()
    all_counted = counted.where(F.col("value").isNotNull()).agg(F.sum("n_records")).first()[0] or 0
    if all_counted == n_rows or known.n == n_values and known.least > least_certain(n_rows, tracked):
        return top
    return column_values(df, column, max_records=n_values)
