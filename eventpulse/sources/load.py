"""Loading daily files into the raw table, with an outcome per date."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..schema import RAW_COLUMNS, RAW_TYPES
from .dayfiles import date_frame, is_bad, typed
from .folders import remove, restore_all, staging_path
from .snapshots import Transaction
from .tables import landed_dates, put_dates, read_if_present, replace_dates

MODES = ("replace", "skip", "append")
# The raw table's files are sorted by these, so that readers can skip what a filter rules out.
CLUSTER_BY = ("ActionGeo_CountryCode", "EventRootCode", "QuadClass")
ASIDE_SCHEMA = "line string, bad_columns string, file_path string, file_error string, ingest_date date"


def quarantine_path(table_path: str) -> str:
    """The table beside the raw table with the lines that were set aside."""
    return f"{table_path.rstrip('/')}_quarantine"


@dataclass(frozen=True)
class LoadResult:
    """``audit`` has one row per requested date. A missing or failed date makes the run not ok."""

    audit: DataFrame
    loaded: list[date]
    rows_inserted: int
    ok: bool
    table_path: str
    into: Transaction | None = None

    def table_rows(self) -> int:
        """Rows in the whole raw table, counted from the file footers when asked for."""
        if self.into is not None:
            table = self.into.read(self.table_path)
        else:
            table = read_if_present(self.audit.sparkSession, self.table_path)
        return 0 if table is None else table.count()


def load_days(
    spark: SparkSession,
    lines: DataFrame,
    dates: Sequence[date],
    table_path: str,
    mode: str = "replace",
    on_bad_value: str = "fail",
    present: DataFrame | None = None,
    into: Transaction | None = None,
) -> LoadResult:
    """Add typed rows to the raw table, in folders by the date of their file.

    ``mode``: ``replace`` makes a date hold exactly its file's rows, so a second
    run changes nothing; ``skip`` leaves dates alone that are already there;
    ``append`` adds rows again. ``on_bad_value``: ``fail`` rejects the whole file
    of a value with the wrong type; ``quarantine`` puts such rows, as they were read, into
    the table at ``quarantine_path(table_path)``. ``present`` lists the files that are
    there (``file_date``): one without a line is then loaded with no rows, not missing. With
    ``into``, the rows are part of what that run of a warehouse changes, ``table_path`` is the
    table's name there, and nothing is visible before the run is committed; ``append`` is not for that.

    One job reads and parses the text and writes good rows as the table holds them, to a folder
    beside it. The outcome per date is counted from there, and the folders of good dates are moved
    in place. Only when that job has seen lines that are set aside, a second one reads the text
    again for these. The driver gets one row per requested date.
    """
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}, got {mode!r}")
    if on_bad_value not in ("fail", "quarantine"):
        raise ValueError(f"on_bad_value must be fail or quarantine, got {on_bad_value!r}")
    if into is not None and mode == "append":
        raise ValueError("a run of a warehouse replaces or skips dates")
    dates = list(dates)
    if mode != "skip":
        skipped = []
    elif into is not None:
        skipped = into.landed(table_path, dates)
    else:
        skipped = landed_dates(spark, table_path, dates, "ingest_date")
    wanted = [d for d in dates if d not in set(skipped)]

    root = table_path if into is None else f"{into.warehouse.root}/{table_path}"
    staged, aside_path = staging_path(root) if into is None else into.staging_path(table_path), staging_path(root)
    if into is None:
        restore_all(spark, table_path)

    found = lines.where(F.col("file_date").isin(wanted)).withColumnRenamed("file_date", "ingest_date")
    # The observation keeps the filter and the casts in methods of their own; in one, they are too long to be compiled.
    parsed = typed(found.observe("lines", F.count(F.lit(1)).alias("read")))
    aside = F.col("file_error").isNotNull() | is_bad()
    # The count stands behind the shuffle, since adaptive execution leaves out what stands before an empty one.
    seen = Observation()
    good = parsed.select(*RAW_COLUMNS, "ingest_date", aside.alias("_aside")).hint("rebalance", "ingest_date")
    good = good.observe(seen, F.count_if("_aside").alias("aside")).where("NOT _aside").drop("_aside")
    good.sortWithinPartitions("ingest_date", *CLUSTER_BY).write.partitionBy("ingest_date").parquet(staged)

    schema = ", ".join(f"`{name}` {kind}" for name, kind in RAW_TYPES.items()) + ", ingest_date date"
    rows = spark.read.schema(schema).parquet(staged)
    zero = F.lit(0).cast("bigint")
    counts = rows.groupBy("ingest_date").agg(
        F.count(F.lit(1)).alias("rows_read"), zero.alias("rows_bad"), F.lit(None).cast("string").alias("file_error")
    )
    rejected = spark.createDataFrame([], ASIDE_SCHEMA)
    if seen.get["aside"]:
        as_read = F.concat_ws("\t", *[F.coalesce(F.col(name).cast("string"), F.lit("")) for name in RAW_COLUMNS])
        odd = typed(found.withColumn("line", as_read)).where(aside)
        odd.select("line", "bad_columns", "file_path", "file_error", "ingest_date").write.parquet(aside_path)
        rejected = spark.read.schema(ASIDE_SCHEMA).parquet(aside_path)
        counts = counts.unionByName(
            rejected.groupBy("ingest_date").agg(
                F.count_if(F.col("file_error").isNull()).alias("rows_read"),
                F.count_if(is_bad()).alias("rows_bad"),
                F.max("file_error").alias("file_error"),
            )
        )
    per_date = counts.groupBy(F.col("ingest_date").alias("file_date")).agg(
        F.sum("rows_read").alias("rows_read"), F.sum("rows_bad").alias("rows_bad"), F.max("file_error").alias("file_error")
    )
    if present is not None:
        there = present.where(F.col("file_date").isin(wanted)).select("file_date").distinct()
        per_date = there.join(per_date, "file_date", "full").fillna(0, ["rows_read", "rows_bad"])
    error = F.when(F.col("file_error").isNotNull(), F.col("file_error"))
    if on_bad_value == "fail":
        error = error.when(F.col("rows_bad") > 0, F.format_string("%d rows hold a bad value", "rows_bad"))
    # One row per requested date at most.
    report = per_date.withColumn("error", error).drop("file_error").collect()

    loaded = sorted(r.file_date for r in report if r.error is None)
    if loaded:
        if mode == "append":
            more = rows.where(F.col("ingest_date").isin(loaded)).hint("rebalance", "ingest_date")
            more = more.sortWithinPartitions("ingest_date", *CLUSTER_BY)
            more.write.mode("append").partitionBy("ingest_date").parquet(table_path)
        elif into is None:
            put_dates(spark, staged, table_path, loaded, "ingest_date")
        else:
            into.put_dates(rows, staged, table_path, loaded, "ingest_date")
            for day in {r.file_date for r in report} - set(loaded):
                remove(spark, f"{staged}/ingest_date={day.isoformat()}")
        if on_bad_value == "quarantine":
            bad = rejected.where(is_bad()).select("line", "bad_columns", "file_path", "ingest_date")
            if into is None:
                replace_dates(bad, quarantine_path(table_path), loaded, "ingest_date")
            else:
                into.replace_dates(bad, quarantine_path(table_path), loaded, "ingest_date")
    if into is None or not loaded:
        remove(spark, staged)
    remove(spark, aside_path)

    outcome = spark.createDataFrame(
        [(r.file_date, r.rows_read, r.rows_bad, r.error) for r in report],
        "file_date date, rows_read bigint, rows_bad bigint, error string",
    )
    status = (
        F.when(F.col("file_date").isin(skipped), "skipped")
        .when(F.col("error").isNotNull(), "failed")
        .when(F.col("rows_read").isNull(), "missing")
        .otherwise("loaded")
    )
    inserted = F.when(F.col("status") == "loaded", F.col("rows_read") - F.col("rows_bad")).otherwise(0)
    audit = (
        date_frame(spark, dates)
        .join(outcome, "file_date", "left")
        .withColumn("status", status)
        .withColumn("rows_inserted", inserted)
        .orderBy("file_date")
    )
    return LoadResult(
        audit=audit,
        loaded=loaded,
        rows_inserted=sum(r.rows_read - r.rows_bad for r in report if r.error is None),
        ok=len(loaded) + len(skipped) == len(dates),
        table_path=table_path,
        into=into,
    )


def summarise_load(audit: DataFrame) -> DataFrame:
    """Dates and rows by outcome."""
    return audit.groupBy("status").agg(
        F.count(F.lit(1)).alias("dates"), F.coalesce(F.sum("rows_inserted"), F.lit(0)).alias("rows_inserted")
    )
