"""Row counts, nulls, least and greatest values of stored tables, answered from the files' footers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .reshape import quoted

# Types whose extremes a footer holds as exact values; of others only nulls are counted.
_EXACT = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.BooleanType, T.DateType)


def _asking(spark: SparkSession) -> SparkSession:
    """A session beside the caller's, in which Parquet answers aggregates from footers."""
    session = spark.newSession()
    session.conf.set("spark.sql.session.timeZone", spark.conf.get("spark.sql.session.timeZone"))
    session.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    session.conf.set("spark.sql.sources.useV1SourceList", "")
    return session


def from_footers(spark: SparkSession, paths: Sequence[str], columns: Sequence[str] = ()) -> DataFrame:
    """The aggregate itself, as one row: n_rows, and for each column ``<c>_n`` (not null), ``<c>_min``, ``<c>_max``.

    No column data is read. ``paths`` are Parquet files or folders.
    """
    stored = _asking(spark).read.parquet(*paths)
    return stored.agg(*_asked(stored, columns))


def _asked(stored: DataFrame, columns: Sequence[str]) -> list[Column]:
    kinds = {f.name: f.dataType for f in stored.schema}
    asked = [F.count(F.lit(1)).alias("n_rows")]
    for name in columns:
        asked.append(F.count(quoted(name)).alias(f"{name}_n"))
        if isinstance(kinds[name], _EXACT):
            asked += [F.min(quoted(name)).alias(f"{name}_min"), F.max(quoted(name)).alias(f"{name}_max")]
    return asked


def column_bounds(spark: SparkSession, paths: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """One row per column: column_name, n_rows, n_null, and least and greatest value as text (null for text columns).

    A file without bounds of a column, such as one whose values are all null, cannot be asked; then these
    columns are read.
    """
    try:
        row = from_footers(spark, paths, columns).first().asDict()
    except Exception as error:
        if "No min/max found" not in str(error):
            raise
        row = spark.read.parquet(*paths).agg(*_asked(spark.read.parquet(*paths), columns)).first().asDict()

    def text(value) -> str | None:
        return None if value is None else str(value).lower() if isinstance(value, bool) else str(value)

    rows = [
        (c, row["n_rows"], row["n_rows"] - row[f"{c}_n"], text(row.get(f"{c}_min")), text(row.get(f"{c}_max"))) for c in columns
    ]
    return spark.createDataFrame(rows, "column_name string, n_rows bigint, n_null bigint, least string, greatest string")
