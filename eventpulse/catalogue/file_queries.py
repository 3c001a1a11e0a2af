"""Files and tables: the feed is written out as daily files, read back and loaded."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import functions as F

from ..plans.daily import run_daily
from ..plans.marts import daily_event_tone
from ..plans.staging import bad_dates, stage
from ..session import work_dir
from ..sources.dayfiles import quarantined
from ..sources.lake import land_lines, read_landed, tab_lines
from ..sources.load import load_days, summarise_load
from ..sources.snapshots import Warehouse
from ..sources.tables import replace_table
from ..streaming.dayfiles import load_new_files, stream_landed
from .base import query
from .feed import AS_OF, NEWS_SQL, RAW_SQL, feed_days, news, raw_feed
from .model_queries import DAILY_SQL, STAGE_SQL


def _landed(spark, sf_dir) -> str:
    """A new lake folder holding the feed as tab-separated lines, one folder per file date."""
    lake = work_dir(spark, "lake")
    land_lines(tab_lines(raw_feed(spark, sf_dir)), lake)
    return lake


def _asked_for(spark, sf_dir):
    """The feed's days and three more, which have no file."""
    days = feed_days(spark, sf_dir)
    return [*days, *(days[-1] + timedelta(days=n) for n in (1, 2, 3))] if days else []


@query("load_files_and_stage", f"WITH {RAW_SQL} {STAGE_SQL}")
def load_files_and_stage(spark, sf_dir):
    """Lines to typed raw table to staged events."""
    lake, raw_table = _landed(spark, sf_dir), work_dir(spark, "raw")
    days = feed_days(spark, sf_dir)
    load_days(spark, read_landed(spark, lake, days), days, raw_table)
    return stage(spark.read.parquet(raw_table).drop("ingest_date"))


@query(
    "load_audit",
    f"""WITH {RAW_SQL}, wanted AS (
      SELECT DISTINCT file_date FROM raw_feed UNION SELECT CAST(max(file_date) + to_days(CAST(i AS INTEGER)) AS DATE)
        FROM raw_feed, range(1, 4) t(i) GROUP BY i
    )
    SELECT w.file_date, CASE WHEN count(r.file_date) > 0 THEN 'loaded' ELSE 'missing' END AS status,
      count(r.file_date) AS rows_inserted FROM wanted w LEFT JOIN raw_feed r ON r.file_date = w.file_date GROUP BY 1""",
)
def load_audit(spark, sf_dir):
    """Outcome per requested date; the last three dates have no file. A second load changes nothing."""
    lake, raw_table = _landed(spark, sf_dir), work_dir(spark, "raw")
    wanted = _asked_for(spark, sf_dir)
    for _ in range(2):
        load = load_days(spark, read_landed(spark, lake, wanted), wanted, raw_table)
    return load.audit.select("file_date", "status", "rows_inserted")


@query(
    "stream_files",
    f"""WITH {RAW_SQL} SELECT file_date AS ingest_date, count(*) AS n_events, count(QuadClass) AS n_classed,
      CAST(sum(NumArticles) AS BIGINT) AS n_articles FROM raw_feed GROUP BY 1""",
)
def stream_files(spark, sf_dir):
    """The same files loaded as a stream; the second run finds nothing new."""
    lake, raw_table, checkpoint = _landed(spark, sf_dir), work_dir(spark, "raw"), work_dir(spark, "progress")
    for _ in range(2):
        load_new_files(stream_landed(spark, lake), raw_table, checkpoint).awaitTermination()
    return (
        spark.read.parquet(raw_table)
        .groupBy("ingest_date")
        .agg(
            F.count(F.lit(1)).alias("n_events"),
            F.count("QuadClass").alias("n_classed"),
            F.sum("NumArticles").alias("n_articles"),
        )
    )


@query(
    "publish_daily_mart",
    f"WITH {NEWS_SQL}, {DAILY_SQL} SELECT * FROM daily",
)
def publish_daily_mart(spark, sf_dir):
    """The daily mart written as a table in folders by date and read back."""
    path = work_dir(spark, "mart")
    replace_table(daily_event_tone(news(spark, sf_dir), AS_OF), path, ["event_date"], ["quad_class_label"])
    return spark.read.parquet(path)


@query(
    "daily_run",
    f"""WITH {RAW_SQL}, cleaned AS ({STAGE_SQL})
    SELECT quad_class, quad_class_label, count(*) AS event_count, CAST(sum(num_mentions) AS BIGINT) AS total_mentions,
      CAST(sum(num_articles) AS BIGINT) AS total_articles, count(DISTINCT event_date) AS n_days
    FROM cleaned GROUP BY 1, 2""",
)
def daily_run(spark, sf_dir):
    """Load, stage, build and check in one run, then the published daily mart added up by class."""
    lake, warehouse = _landed(spark, sf_dir), work_dir(spark, "warehouse")
    days = feed_days(spark, sf_dir)
    run_daily(spark, read_landed(spark, lake, days), days, warehouse, AS_OF)
    return (
        Warehouse(spark, warehouse).read("mart_daily_event_tone")
        .groupBy("quad_class", "quad_class_label")
        .agg(
            F.sum("event_count").alias("event_count"),
            F.sum("total_mentions").alias("total_mentions"),
            F.sum("total_articles").alias("total_articles"),
            F.count(F.lit(1)).alias("n_days"),
        )
    )


_MISFIT = "value BETWEEN 50 AND 60 OR event_type = 'signup' AND value > 90"


@query(
    "quarantined_lines",
    f"""SELECT CAST(event_id AS VARCHAR) AS event_number, CAST(ts AS DATE) AS file_date,
      CASE WHEN value BETWEEN 50 AND 60 AND event_type = 'signup' THEN 'GoldsteinScale,AvgTone'
           WHEN event_type = 'signup' AND value > 90 THEN 'GoldsteinScale' ELSE 'AvgTone' END AS bad_columns
    FROM events WHERE {_MISFIT}""",
)
def quarantined_lines(spark, sf_dir):
    """Lines with a word where a number belongs, found after reading the landed files back."""
    raw = raw_feed(spark, sf_dir)
    low_tone, signup = F.col("AvgTone").between(0, 10), F.col("Actor1Code") == "SIGNUP"
    spoiled = raw.withColumns(
        {
            "AvgTone": F.when(low_tone, "none").otherwise(F.col("AvgTone").cast("string")),
            "GoldsteinScale": F.when(signup & (low_tone | (F.col("AvgTone") > 40)), "high").otherwise(
                F.col("GoldsteinScale").cast("string")
            ),
        }
    )
    lake = work_dir(spark, "lake")
    land_lines(tab_lines(spoiled), lake)
    return quarantined(read_landed(spark, lake)).select(
        F.col("GlobalEventID").alias("event_number"), "file_date", "bad_columns"
    )


@query(
    "load_outcomes",
    f"""WITH {RAW_SQL}, counted AS (
      SELECT d, count(r.file_date) AS n FROM (
        SELECT DISTINCT file_date AS d FROM raw_feed UNION SELECT CAST(max(file_date) + to_days(CAST(i AS INTEGER)) AS DATE)
        FROM raw_feed, range(1, 4) t(i) GROUP BY i)
      LEFT JOIN raw_feed r ON r.file_date = d GROUP BY d
    ) SELECT CASE WHEN n > 0 THEN 'loaded' ELSE 'missing' END AS status, count(*) AS dates,
      CAST(sum(n) AS BIGINT) AS rows_inserted FROM counted GROUP BY 1""",
)
def load_outcomes(spark, sf_dir):
    """Dates and rows by outcome of one load."""
    lake, raw_table = _landed(spark, sf_dir), work_dir(spark, "raw")
    wanted = _asked_for(spark, sf_dir)
    return summarise_load(load_days(spark, read_landed(spark, lake, wanted), wanted, raw_table).audit)


@query(
    "bad_dates",
    "SELECT event_id AS event_number, 20241399 AS day FROM events WHERE value > 300",
)
def q_bad_dates(spark, sf_dir):
    """Rows that staging sets aside because their day is no date."""
    raw = raw_feed(spark, sf_dir)
    spoiled = raw.withColumn("Day", F.when(F.col("AvgTone") > 250, F.lit(20241399)).otherwise(F.col("Day")))
    return bad_dates(spoiled).select(F.col("GlobalEventID").alias("event_number"), F.col("Day").alias("day"))
