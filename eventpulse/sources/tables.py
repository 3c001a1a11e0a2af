"""Table sinks and small seed files."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.checks import Observed
from .folders import children, remove, restore_all, staging_path, swap_in


def read_if_present(spark: SparkSession, path: str) -> DataFrame | None:
    try:
        return spark.read.parquet(path)
    except AnalysisException as error:
        if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def _laid_out(df: DataFrame, partition_by: Sequence[str], cluster_by: Sequence[str]) -> DataFrame:
    """Rows of a folder together in few files, sorted within them.

    The rebalance hint lets adaptive execution split a folder that holds much of the table.
    """
    rows = df.hint("rebalance", *partition_by) if partition_by else df
    return rows.sortWithinPartitions(*partition_by, *cluster_by) if cluster_by else rows


def replace_table(
    df: DataFrame, path: str, partition_by: Sequence[str] = (), cluster_by: Sequence[str] = ()
) -> None:
    """Create or replace a table: folders by ``partition_by``, files sorted by ``cluster_by``.

    It is written beside its place and moved there whole.
    """
    stage_table(df, staged := staging_path(path), partition_by, cluster_by)
    swap_in(df.sparkSession, staged, path)


def stage_table(
    df: DataFrame,
    staged: str,
    partition_by: Sequence[str] = (),
    cluster_by: Sequence[str] = (),
    observed: Observed | None = None,
) -> None:
    """Writes a table to a folder from which ``swap_in`` can move it, counting what ``observed`` asks on the way."""
    rows = _laid_out(df, partition_by, cluster_by)
    writer = (rows if observed is None else observed.on(rows)).write
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(staged)


def replace_dates(
    df: DataFrame,
    path: str,
    dates: Sequence[date],
    date_column: str,
    then_by: Sequence[str] = (),
    cluster_by: Sequence[str] = (),
) -> None:
    """Write the rows of some dates so that the table holds exactly these rows for them.

    The folders are ``date_column``, then ``then_by``. One job writes all dates to a
    folder beside the table; then each date's folder is moved in place of the old one,
    so nothing of an earlier delivery stays behind. Dates that an earlier run had moved out of the
    way when it ended are put back first.
    """
    spark, staged = df.sparkSession, staging_path(path)
    restore_all(spark, path)
    rows = df.where(F.col(date_column).isin(list(dates)))
    stage_table(rows, staged, [date_column, *then_by], cluster_by)
    put_dates(spark, staged, path, dates, date_column)


def put_dates(spark: SparkSession, staged: str, path: str, dates: Sequence[date], date_column: str) -> None:
    """Moves the folders of these dates from a staged table in place of the old ones, and drops the rest of it."""
    written = set(children(spark, staged))
    for day in sorted(dates):
        name = f"{date_column}={day.isoformat()}"
        if name in written:
            swap_in(spark, f"{staged}/{name}", f"{path}/{name}")
        else:
            remove(spark, f"{path}/{name}")
    remove(spark, staged)


def dates_in_folders(spark: SparkSession, path: str, date_column: str) -> DataFrame | None:
    """The dates that a table has folders for, from one row per file; the files are not opened."""
    try:
        files = spark.read.format("binaryFile").load(path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise
    if date_column not in files.columns:
        return None
    return files.select(F.col(date_column).cast("date")).distinct()


def landed_dates(spark: SparkSession, path: str, dates: Sequence[date], date_column: str) -> list[date]:
    """Which of the dates the table already holds."""
    found = dates_in_folders(spark, path, date_column)
    if found is None:
        return []
    return sorted(row[0] for row in found.where(F.col(date_column).isin(list(dates))).collect())


def read_seed(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A small CSV file with a header line and given column types; empty cells are NULL."""
    return spark.read.schema(schema).option("header", "true").option("enforceSchema", "false").csv(path)
