"""Daily event files: which files a date list names, and reading them plain or zipped."""

from __future__ import annotations

import io
import zipfile
import zlib
from collections.abc import Iterator, Sequence
from datetime import date, timedelta
from itertools import islice

import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schema import RAW_COLUMNS, RAW_TEXT_SCHEMA, RAW_TYPES

# Names and folders of the daily files.
FILE_NAME = "%Y%m%d.export.CSV"
ARCHIVE_NAME = "%Y%m%d.export.CSV.zip"
LAKE_FOLDER = "raw/%Y/%m/%d"

_LINES_PER_BATCH = 20_000
_READ_BYTES = 1 << 20


def backfill_dates(as_of: date, days: int | None = None, day: date | None = None) -> list[date]:
    """One given day, or the ``days`` days up to yesterday, oldest first."""
    if (days is None) == (day is None):
        raise ValueError("give either a day or a number of days")
    if day is not None:
        return [day]
    if days < 1:
        raise ValueError(f"days must be positive, got {days}")
    return [as_of - timedelta(days=n) for n in range(days, 0, -1)]


def date_frame(spark: SparkSession, dates: Sequence[date]) -> DataFrame:
    return spark.createDataFrame([(d,) for d in dates], "file_date date")


def lake_path(root: str, day: date) -> str:
    return f"{root.rstrip('/')}/{day.strftime(LAKE_FOLDER)}/{day.strftime(FILE_NAME)}"


def archive_path(root: str, day: date) -> str:
    return f"{root.rstrip('/')}/{day.strftime(ARCHIVE_NAME)}"


def error_path(root: str, day: date) -> str:
    """Where the lake notes that a date's archive could not be read."""
    return f"{lake_path(root, day)}.error"


def _glob(root: str, names: Sequence[str]) -> str:
    """One path pattern for several files, so that files which do not exist are simply not matched."""
    return f"{root.rstrip('/')}/{{{','.join(names)}}}" if len(names) > 1 else f"{root.rstrip('/')}/{names[0]}"


def file_date(name: Column) -> Column:
    """The date that a file name starts with, NULL when it does not start with one. ``name`` is worked out once per row."""
    return F.overlay(F.overlay(F.substring(name, 1, 8), F.lit("-"), 5, 0), F.lit("-"), 8, 0).try_cast("date")


def with_file(df: DataFrame) -> DataFrame:
    """Adds the file's path and date. A day file may be a folder of parts, so the date is looked for in the path."""
    path = F.col("_metadata.file_path")
    named = F.regexp_extract(path, r"(\d{8})\.export\.CSV", 1)
    return df.withColumn("file_path", path).withColumn("file_date", file_date(named))


def no_lines(spark: SparkSession) -> DataFrame:
    columns = ", ".join(f"`{c}` string" for c in RAW_COLUMNS)
    return spark.createDataFrame([], f"{columns}, file_path string, file_date date, file_error string")


def text_options(reader, schema=RAW_TEXT_SCHEMA):
    """Tab-separated, no header, no quoting. Short lines are filled with NULL, extra fields dropped."""
    return reader.schema(schema).option("sep", "\t").option("quote", "").option("header", "false")


def _or_none(load, *paths: str) -> DataFrame | None:
    """The frame, or nothing if no file matches."""
    try:
        return load(*paths)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def read_day_files(spark: SparkSession, root: str, dates: Sequence[date] | None = None) -> DataFrame:
    """The 58 fields as text, with the file's path and date, for the files present in the lake.

    All dates if none are given. A date whose archive could not be read has one row with the error.
    """
    def names(suffix: str) -> str:
        if dates is None:
            return f"{root.rstrip('/')}/raw/*/*/*/*.export.CSV{suffix}"
        return _glob(root, [f"{d.strftime(LAKE_FOLDER)}/{d.strftime(FILE_NAME)}{suffix}" for d in dates])

    result = no_lines(spark)
    if (lines := _or_none(text_options(spark.read).csv, names(""))) is not None:
        result = with_file(lines).withColumn("file_error", F.lit(None).cast("string"))
    if (errors := _or_none(spark.read.text, names(".error"))) is not None:
        failed = with_file(errors).withColumnRenamed("value", "file_error")
        result = result.unionByName(failed, allowMissingColumns=True)
    return result


def present_files(spark: SparkSession, root: str, dates: Sequence[date], zipped: bool = False) -> DataFrame:
    """The dates (``file_date``) that have a file, even one without a line. Files are listed, not opened."""
    if zipped:
        names = [d.strftime(ARCHIVE_NAME) for d in dates]
    else:
        names = [f"{d.strftime(LAKE_FOLDER)}/{d.strftime(FILE_NAME)}" for d in dates]
    found = _or_none(spark.read.format("binaryFile").load, _glob(root, names))
    if found is None:
        return date_frame(spark, [])
    return with_file(found.select("path", "length", "_metadata")).select("file_date").distinct()


def _member_lines(content: bytes) -> Iterator[str]:
    """Lines of the first member whose name ends in .CSV."""
    with zipfile.ZipFile(io.BytesIO(content)) as archive:
        member = next((name for name in archive.namelist() if name.endswith(".CSV")), None)
        if member is None:
            raise ValueError("archive has no .CSV member")
        with archive.open(member) as raw:  # read through once, so that damage shows before any line is given out
            while raw.read(_READ_BYTES):
                pass
        with archive.open(member) as raw:
            for line in io.TextIOWrapper(raw, encoding="utf-8", errors="replace"):
                line = line.rstrip("\n")
                if line:
                    yield line


def unzip_lines(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Archives to lines, a bounded number at a time. An unreadable archive gives one row with the error."""
    for batch in batches:
        for path, name, content in zip(batch["file_path"], batch["file_name"], batch["content"]):
            lines = _member_lines(content)
            try:
                while chunk := list(islice(lines, _LINES_PER_BATCH)):
                    yield pd.DataFrame({"file_path": path, "file_name": name, "line": chunk, "file_error": None})
            except (zipfile.BadZipFile, zlib.error, ValueError, EOFError, OSError) as error:
                yield pd.DataFrame(
                    {"file_path": [path], "file_name": [name], "line": [None], "file_error": [str(error)]}
                )


def archive_lines(archives: DataFrame) -> DataFrame:
    """A ``binaryFile`` frame of archives to their lines, with the file's path, date and error."""
    # A file is the unit of work: a zip member cannot be split, and one day's archive is small.
    packed = archives.select(
        F.col("_metadata.file_path").alias("file_path"), F.col("_metadata.file_name").alias("file_name"), "content"
    )
    return unzipped(packed)


def unzipped(packed: DataFrame) -> DataFrame:
    """Archives given by ``file_path``, ``file_name`` and ``content`` to their lines."""
    lines = packed.mapInPandas(unzip_lines, "file_path string, file_name string, line string, file_error string")
    return lines.select("line", "file_path", file_date(F.col("file_name")).alias("file_date"), "file_error")


def split_lines(lines: DataFrame) -> DataFrame:
    """A text column ``line`` to the 58 fields; an empty field is NULL. Other columns stay."""
    fields = lines.withColumn("_fields", F.split("line", "\t"))
    columns = [F.nullif(F.get("_fields", F.lit(i)), F.lit("")).alias(name) for i, name in enumerate(RAW_COLUMNS)]
    return fields.select(*columns, *[c for c in lines.columns if c != "line"])


def read_archive_lines(spark: SparkSession, root: str, dates: Sequence[date]) -> DataFrame:
    """The lines of the zipped daily files that are present."""
    archives = _or_none(spark.read.format("binaryFile").load, _glob(root, [d.strftime(ARCHIVE_NAME) for d in dates]))
    if archives is None:
        return spark.createDataFrame([], "line string, file_path string, file_date date, file_error string")
    return archive_lines(archives)


def read_archives(spark: SparkSession, root: str, dates: Sequence[date]) -> DataFrame:
    """As ``read_day_files``, from the zipped daily files."""
    return split_lines(read_archive_lines(spark, root, dates))


def _misfits() -> Column:
    """Names of the columns whose text does not fit their type, separated by commas. Numbers must be finite."""
    names = []
    for name, kind in RAW_TYPES.items():
        if kind == "string":
            continue
        value = F.col(name).try_cast(kind)
        unfit = value.isNull()
        if kind == "double":
            unfit = unfit | F.isnan(value) | (F.abs(value) == float("inf"))
        names.append(F.when(F.col(name).isNotNull() & unfit, name))
    return F.concat_ws(",", *names)


def is_bad() -> Column:
    """True for rows of ``typed`` that hold a value of the wrong type."""
    return F.col("bad_columns") != ""


def typed(lines: DataFrame) -> DataFrame:
    """Text fields to their types. A value that does not fit is NULL and its column is named in ``bad_columns``."""
    columns = [F.col(name).try_cast(kind).alias(name) for name, kind in RAW_TYPES.items()]
    others = [c for c in lines.columns if c not in RAW_TYPES]
    return lines.select(*columns, *others, _misfits().alias("bad_columns"))


def quarantined(lines: DataFrame) -> DataFrame:
    """The lines, as text, that hold a value of the wrong type."""
    return lines.withColumn("bad_columns", _misfits()).where(is_bad())
