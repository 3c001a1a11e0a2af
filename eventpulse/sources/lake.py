"""The lake folder: raw lines of each date under ``raw/YYYY/MM/DD/YYYYMMDD.export.CSV``.

A date that this module lands is a folder of that name with one part or more; a
downloaded day file is a single file of that name. Both are read alike.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schema import RAW_COLUMNS
from .dayfiles import error_path, lake_path, present_files, read_archive_lines, read_day_files
from .folders import children, exists, remove, staging_path, swap_in


def tab_lines(raw: DataFrame) -> DataFrame:
    """Raw rows to tab-separated lines, NULL as an empty field. Other columns stay."""
    fields = [F.coalesce(F.col(name).cast("string"), F.lit("")) for name in RAW_COLUMNS]
    others = [c for c in raw.columns if c not in RAW_COLUMNS]
    return raw.select(F.concat_ws("\t", *fields).alias("line"), *others)


def _by_date(rows: DataFrame, root: str, path_of, overwrite: bool) -> list[date]:
    """Writes ``line`` for each ``file_date`` in one job, then moves each date to its path. Returns the dates moved."""
    spark, staged = rows.sparkSession, staging_path(f"{root.rstrip('/')}/raw")
    # Gathered by date, or each task would write a file for each date.
    rows.select("line", "file_date").hint("rebalance", "file_date").write.partitionBy("file_date").text(staged)
    moved = []
    for name in children(spark, staged):
        day = date.fromisoformat(name.partition("=")[2])
        if overwrite or not exists(spark, path_of(root, day)):
            swap_in(spark, f"{staged}/{name}", path_of(root, day))
            moved.append(day)
    remove(spark, staged)
    return moved


def land_lines(lines: DataFrame, root: str, overwrite: bool = False) -> None:
    """Write ``line`` to the place of its ``file_date``.

    Dates that are already there are left alone unless ``overwrite`` is set.
    """
    for day in _by_date(lines, root, lake_path, overwrite):
        remove(lines.sparkSession, error_path(root, day))


def land_archives(
    spark: SparkSession, archive_root: str, root: str, dates: Sequence[date], overwrite: bool = False
) -> None:
    """Unzip daily archives into the lake.

    Of an unreadable archive the error is noted beside the date's place, so a later
    load knows that it failed; an archive without a line lands an empty file.
    """
    if not overwrite:
        there = {r.file_date for r in present_files(spark, root, dates).collect()}
        dates = [d for d in dates if d not in there]
    if not dates:
        return
    read = read_archive_lines(spark, archive_root, dates).where(F.col("file_date").isNotNull())
    # An empty line per archive makes sure that each has a folder; the reader skips it.
    found = present_files(spark, archive_root, dates, zipped=True).withColumn("line", F.lit(""))
    failed = read.where(F.col("file_error").isNotNull()).select(F.col("file_error").alias("line"), "file_date")
    failed_days = _by_date(failed, root, error_path, overwrite=True)
    good = read.where(F.col("file_error").isNull()).unionByName(found, allowMissingColumns=True)
    land_lines(good.where(~F.col("file_date").isin(failed_days)) if failed_days else good, root, overwrite)
    if overwrite:
        for day in failed_days:
            remove(spark, lake_path(root, day))


def read_landed(spark: SparkSession, root: str, dates: Sequence[date] | None = None) -> DataFrame:
    """The 58 fields as text of the lake's lines, all or those of some dates."""
    return read_day_files(spark, root, dates)
