"""Grouped aggregates that are more than one built-in function."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def most_frequent(
    df: DataFrame, group_by: Sequence[str], column: str, name: str = "most_frequent", approximate: bool = False
) -> DataFrame:
    """The value that occurs most often in each group, NULL counted as a value.

    Rows are counted per group and value first, so a large group is spread over
    its values. Of equally frequent values the lowest is taken, NULL last. With
    ``approximate`` a sketch of bounded size per group is used instead.
    """
    value = F.col(column)
    if approximate:
        return df.groupBy(*group_by).agg(F.expr(f"approx_top_k(`{column}`, 1)")[0]["item"].alias(name))
    counted = df.groupBy(*group_by, column).agg(F.count(F.lit(1)).alias("n"))
    preference = F.struct(-F.col("n"), value.isNull(), value)
    return counted.groupBy(*group_by).agg(F.min_by(value, preference).alias(name), F.max("n").alias("n_rows"))
