"""Next value in order within groups of any size.

``lead``/``lag`` over a whole table, or over a group that holds a third of it, puts
that group into one task. Here rows are cut into ranges of (group, order columns),
in the columns' own types, as Spark's range partitioning samples them. A range is
searched by itself, and its last row is joined up with the first row of the next
range that has any. Where the cuts fall only affects the balance, never the result.
Rows must be distinct, so that no value can fill a range: callers count equal rows first.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..session import cut
from .reshape import quoted

# More ranges than tasks, so tasks get about as much each when ranges are dealt out to them.
RANGES_PER_TASK = 4


def in_ranges(df: DataFrame, columns: Sequence[str], ranges: int | None = None) -> DataFrame:
    """Adds ``_range``, a number that rises with the columns (NULL first), and keeps the result in the shared folder."""
    if ranges is None:
        ranges = RANGES_PER_TASK * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = df.repartitionByRange(ranges, *[quoted(c).asc_nulls_first() for c in columns])
    # Kept, since the cuts are sampled anew each time the rows are dealt out.
    return cut(dealt.withColumn("_range", F.spark_partition_id()))


def with_next(distinct: DataFrame, group: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Adds ``next_value``, the first order column of the next row in the group, and ``is_last``.

    The rows, which must be distinct in these columns, are dealt out and written when
    this is called. The table of range heads has one row per range.
    """
    keys = [*group, *order]
    # A struct is never NULL itself, so groups with a NULL key are compared like others.
    own = F.struct(F.lit(0).alias("all"), *map(quoted, group))
    head = F.struct(own.alias("group"), F.struct(*map(quoted, order)).alias("values"))
    ranged = in_ranges(distinct, keys)
    following = W.partitionBy("_range").orderBy(*[quoted(c).asc_nulls_first() for c in keys])
    within = ranged.withColumn("_next", F.lead(head).over(following))
    heads = ranged.groupBy("_range").agg(F.min(head).alias("_head"))
    after = heads.select("_range", F.lead("_head").over(W.orderBy("_range")).alias("_after"))
    found = within.join(F.broadcast(after), "_range").withColumn("_next", F.coalesce("_next", "_after"))
    same_group = F.coalesce(F.col("_next.group") == own, F.lit(False))
    value = F.col("_next.values")[order[0]]
    return found.select(
        *map(quoted, distinct.columns), F.when(same_group, value).alias("next_value"), (~same_group).alias("is_last")
    )
