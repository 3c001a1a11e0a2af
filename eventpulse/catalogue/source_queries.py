"""Sources, sinks and the catalog: archives, paths, outcomes, seeds, views and listed tables."""

from __future__ import annotations

import io
import uuid
import zipfile
from datetime import timedelta

import pandas as pd
from pyspark.sql import functions as F

from ..operators import checks as C
from ..operators import introspect as I
from ..operators.reshape import union_relations
from ..plans.daily import create_views, run_daily
from ..session import work_dir
from ..sources.dayfiles import (
    ARCHIVE_NAME,
    backfill_dates,
    error_path,
    lake_path,
    present_files,
    split_lines,
    typed,
    unzipped,
)
from ..sources.lake import land_lines, read_landed, tab_lines
from ..sources.load import load_days
from ..sources.tables import read_seed
from .base import query, table
from .feed import AS_OF, RAW_SQL, feed_days, raw_feed


# Lines of one archive; a day with more is delivered in several.
_LINES_OF_ARCHIVE = 50_000


def _zipped(rows: pd.DataFrame) -> pd.DataFrame:
    """Lines of one day as an archive."""
    out, day = io.BytesIO(), rows["file_date"].iloc[0]
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as archive:
        archive.writestr(day.strftime("%Y%m%d.export.CSV"), "\n".join(rows["line"]) + "\n")
    name = day.strftime(ARCHIVE_NAME)
    return pd.DataFrame([[f"zips/{rows['part'].iloc[0]}/{name}", name, out.getvalue()]], columns=["file_path", "file_name", "content"])


@query(
    "archived_lines",
    f"""WITH {RAW_SQL} SELECT file_date, count(*) AS n_events, CAST(sum(NumArticles) AS BIGINT) AS n_articles,
      count(DISTINCT SOURCEURL) AS n_urls FROM raw_feed GROUP BY 1""",
)
def archived_lines(spark, sf_dir):
    """Each day's lines zipped and unzipped again, then typed and counted."""
    lines = tab_lines(raw_feed(spark, sf_dir)).select("line", "file_date")
    # So many parts that even a day with all lines is dealt out in archives of about the size wanted.
    parts = 1 + lines.count() // _LINES_OF_ARCHIVE
    dealt = lines.withColumn("part", F.pmod(F.xxhash64("line"), F.lit(parts)))
    archives = dealt.groupBy("file_date", "part").applyInPandas(_zipped, "file_path string, file_name string, content binary")
    return typed(split_lines(unzipped(archives))).groupBy("file_date").agg(
        F.count(F.lit(1)).alias("n_events"),
        F.sum("NumArticles").alias("n_articles"),
        F.count_distinct("SOURCEURL").alias("n_urls"),
    )


@query(
    "backfill_paths",
    """SELECT CAST(d AS DATE) AS file_date, '/lake/raw/' || strftime(d, '%Y/%m/%d/%Y%m%d') || '.export.CSV' AS path
    FROM (SELECT unnest(generate_series(min(CAST(ts AS DATE)), max(CAST(ts AS DATE)), INTERVAL 1 DAY)) AS d FROM events)""",
)
def backfill_paths(spark, sf_dir):
    """The dates from the first to the last event as a backfill asks for them, with their place in the lake."""
    ends = table(spark, sf_dir, "events").agg(F.min("ts").cast("date").alias("a"), F.max("ts").cast("date").alias("b"))
    first, last = ends.first()
    days = backfill_dates(last, days=(last - first).days) if last > first else []
    rows = [(d, lake_path("/lake", d)) for d in [*days, *backfill_dates(last, day=last)]]
    return spark.createDataFrame(rows, "file_date date, path string")


@query(
    "load_outcome_of_odd_files",
    f"""WITH {RAW_SQL}, ends AS (SELECT max(file_date) AS last FROM raw_feed)
    SELECT file_date, 'loaded' AS status, count(*) AS rows_inserted FROM raw_feed GROUP BY 1
    UNION ALL SELECT CAST(last + INTERVAL 1 DAY AS DATE), 'loaded', 0 FROM ends
    UNION ALL SELECT CAST(last + INTERVAL 2 DAY AS DATE), 'failed', 0 FROM ends
    UNION ALL SELECT CAST(last + INTERVAL 3 DAY AS DATE), 'missing', 0 FROM ends""",
)
def load_outcome_of_odd_files(spark, sf_dir):
    """After the feed's days come one with an empty file, one whose archive was damaged, and one without a file."""
    lake, days = work_dir(spark, "lake"), feed_days(spark, sf_dir)
    land_lines(tab_lines(raw_feed(spark, sf_dir)), lake)
    empty, damaged, absent = (days[-1] + timedelta(days=n) for n in (1, 2, 3))
    nothing = spark.createDataFrame([("",)], "value string")
    nothing.write.text(lake_path(lake, empty))
    spark.createDataFrame([("File is not a zip file",)], "value string").write.text(error_path(lake, damaged))
    wanted = [*days, empty, damaged, absent]
    there = present_files(spark, lake, wanted)
    load = load_days(spark, read_landed(spark, lake, wanted), wanted, work_dir(spark, "raw"), present=there)
    return load.audit.select("file_date", "status", "rows_inserted")


@query(
    "seed_file",
    "SELECT n_nationkey, n_name, CASE WHEN n_regionkey <> 2 THEN n_regionkey END AS n_regionkey FROM nation",
)
def seed_file(spark, sf_dir):
    """The nations written as a small CSV file with a header, one column partly empty, and read as a seed."""
    path = work_dir(spark, "seed")
    region = F.when(F.col("n_regionkey") != 2, F.col("n_regionkey")).alias("n_regionkey")
    nations = table(spark, sf_dir, "nation").select("n_nationkey", "n_name", region)
    nations.write.option("header", "true").csv(path)
    kinds = dict(nations.dtypes)
    return read_seed(spark, path, ", ".join(f"{name} {kind}" for name, kind in kinds.items()))


@query(
    "views_by_layer",
    f"""WITH {RAW_SQL} SELECT 'raw' AS layer, count(*) AS n_rows FROM raw_feed
    UNION ALL SELECT 'staging', count(*) FROM raw_feed WHERE Day IS NOT NULL AND CAST(Day AS VARCHAR) LIKE '20%'""",
)
def views_by_layer(spark, sf_dir):
    """Rows of the raw and the staged events, asked by name from the views over a warehouse."""
    lake, warehouse, days = work_dir(spark, "lake"), work_dir(spark, "warehouse"), feed_days(spark, sf_dir)
    land_lines(tab_lines(raw_feed(spark, sf_dir)), lake)
    run_daily(spark, read_landed(spark, lake, days), days, warehouse, AS_OF)
    prefix = f"layers_{uuid.uuid4().hex[:12]}"
    create_views(spark, warehouse, prefix)
    parts = [("raw", "raw_events"), ("staging", "events")]
    found = spark.sql(
        " UNION ALL ".join(f"SELECT '{a}' AS layer, count(*) AS n_rows FROM {prefix}_{a}.{b}" for a, b in parts)
    )
    for layer in ("raw", "staging", "mart"):
        spark.sql(f"DROP DATABASE {prefix}_{layer} CASCADE")
    return found


def _event_tables(spark, sf_dir) -> str:
    """A database with one table per kind of event and a view of another name on the first. Its files outlive it."""
    name = f"listed_{uuid.uuid4().hex[:12]}"
    spark.sql(f"CREATE DATABASE {name}")
    events = table(spark, sf_dir, "events").select("event_id", "event_type", "value")
    # A table per kind is what is asked for, so as many names reach the driver.
    kinds = sorted(r[0] for r in events.select("event_type").distinct().collect() if r[0] is not None)
    for kind in kinds:
        rows = events.where(F.col("event_type") == kind)
        rows.write.option("path", work_dir(spark, f"events-{kind}")).saveAsTable(f"{name}.`events_{kind}`")
    spark.sql(f"CREATE VIEW {name}.all_events AS SELECT * FROM {name}.`events_{kinds[0]}`")
    return name


@query(
    "union_by_pattern",
    """SELECT 'events_' || event_type AS source, count(*) AS n_events, CAST(sum(event_id) AS BIGINT) AS id_sum FROM events
    WHERE event_type NOT LIKE '%error' GROUP BY 1""",
)
def union_by_pattern(spark, sf_dir):
    """The tables whose names match a pattern, less those of another, as one."""
    database = _event_tables(spark, sf_dir)
    names = [name for _, name, _ in I.get_relations_by_pattern(spark, database, "EVENTS_%", "%error")]
    frames = {name: spark.table(f"{database}.`{name}`") for name in names}
    spark.sql(f"DROP DATABASE {database} CASCADE")
    united = union_relations(frames, source_column_name="source")
    return united.groupBy("source").agg(F.count(F.lit(1)).alias("n_events"), F.sum("event_id").alias("id_sum"))


@query(
    "relations_by_prefix",
    """SELECT 'events_' || event_type AS name, 'external' AS kind, count(*) AS n_rows FROM events
    WHERE event_type IS NOT NULL GROUP BY 1
    UNION ALL SELECT 'all_events', 'view', count(*) FROM events WHERE event_type = (SELECT min(event_type) FROM events)""",
)
def relations_by_prefix(spark, sf_dir):
    """The listed tables with their plain kinds and numbers of rows."""
    database = _event_tables(spark, sf_dir)
    listed = [r for p in ("events_", "all_") for r in I.get_relations_by_prefix(spark, database, p)]
    parts = [
        spark.table(f"{database}.`{name}`").agg(F.count(F.lit(1)).alias("n_rows"))
        .select(F.lit(name).alias("name"), F.lit(kind).alias("kind"), "n_rows")
        for _, name, kind in listed
    ]
    spark.sql(f"DROP DATABASE {database} CASCADE")
    result = parts[0]
    for part in parts[1:]:
        result = result.unionAll(part)
    return result


@query(
    "results_as_dict",
    "SELECT event_type, count(*) AS n_events, max(value) AS most FROM events GROUP BY 1",
)
def results_as_dict(spark, sf_dir):
    """An aggregate as lists by column, and as a frame again."""
    df = table(spark, sf_dir, "events").groupBy("event_type").agg(
        F.count(F.lit(1)).alias("n_events"), F.max("value").alias("most")
    )
    found = I.get_query_results_as_dict(df)
    return spark.createDataFrame(list(zip(*(found[name] for name in df.columns))), df.schema)


@query(
    "q_expected_columns",
    """SELECT column_name, 'unexpected' AS problem FROM (DESCRIBE lineitem)
    WHERE column_name NOT IN ('l_orderkey', 'l_partkey', 'l_suppkey', 'l_quantity')
    UNION ALL SELECT 'l_colour', 'missing'""",
)
def q_expected_columns(spark, sf_dir):
    wanted = ["L_ORDERKEY", "l_partkey", "l_suppkey", "l_quantity", "l_colour"]
    return C.expected_columns(table(spark, sf_dir, "lineitem"), wanted).violations
