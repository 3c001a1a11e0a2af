"""Versions of a warehouse, merged deliveries, day states, and what filters, digests, footers and layouts spare."""

from __future__ import annotations

import uuid
from datetime import timedelta

from pyspark.sql import functions as F

from ..operators import checks as C
from ..operators.digests import equality_by_digests
from ..operators.footers import column_bounds
from ..operators.frequent import frequent_values
from ..operators.key_filters import key_filters, repeated_keys
from ..plans.day_states import marts_from_states, refresh_states
from ..plans.merge import merge_events
from ..plans.staging import stage
from ..session import work_dir
from ..sources.clustering import clustered, write_bucketed
from ..sources.snapshots import Warehouse
from .base import query, table
from .check_queries import BOTH_DIRECTIONS
from .feed import AS_OF, NEWS_SQL, RAW_SQL, feed_days, news, raw_feed
from .model_queries import COUNTRY_SQL, DAILY_SQL


def _staged_feed(spark, sf_dir):
    return stage(raw_feed(spark, sf_dir).withColumnRenamed("file_date", "ingest_date"), keep=["ingest_date"])


@query(
    "older_version",
    f"""WITH {RAW_SQL}, days AS (SELECT DISTINCT file_date FROM raw_feed), cut AS (
      SELECT file_date FROM days QUALIFY row_number() OVER (ORDER BY file_date) <= (SELECT count(*) // 2 FROM days)),
    staged AS (SELECT file_date, GlobalEventID FROM raw_feed WHERE Day IS NOT NULL AND CAST(Day AS VARCHAR) LIKE '20%')
    SELECT 1 AS version, file_date AS ingest_date, count(*) AS n_events FROM staged WHERE file_date IN (FROM cut) GROUP BY 2
    UNION ALL SELECT 2, file_date, count(*) FROM staged GROUP BY 2""",
)
def older_version(spark, sf_dir):
    """Events per date as of the first version, which had the earlier half of the days, and as of the second."""
    store, days = Warehouse(spark, work_dir(spark, "warehouse")), feed_days(spark, sf_dir)
    for some in (days[: len(days) // 2], days):
        run = store.begin()
        run.replace_dates(_staged_feed(spark, sf_dir), "events", some, "ingest_date", ["event_date"])
        run.commit()
    counts = [
        store.read("events", v).groupBy(F.lit(v).alias("version"), "ingest_date").agg(F.count(F.lit(1)).alias("n_events"))
        for v in (1, 2)
    ]
    return counts[0].unionAll(counts[1])


@query(
    "merged_deliveries",
    f"""WITH {RAW_SQL}, ends AS (SELECT max(file_date) AS last FROM raw_feed),
    delivered AS (
      SELECT * FROM raw_feed
      UNION ALL BY NAME
      SELECT * REPLACE (20240601 AS DATEADDED, SOURCEURL || '?again' AS SOURCEURL, CAST(last + INTERVAL 1 DAY AS DATE) AS file_date)
        FROM raw_feed, ends WHERE QuadClass = 3
      UNION ALL BY NAME
      SELECT * REPLACE (20230101 AS DATEADDED, SOURCEURL || '?late' AS SOURCEURL, CAST(last + INTERVAL 1 DAY AS DATE) AS file_date)
        FROM raw_feed, ends WHERE QuadClass = 4
    ), staged AS (
      SELECT file_date, GlobalEventID, DATEADDED, SOURCEURL FROM delivered WHERE Day IS NOT NULL AND CAST(Day AS VARCHAR) LIKE '20%'),
    once AS (SELECT * FROM staged QUALIFY row_number() OVER (PARTITION BY GlobalEventID ORDER BY DATEADDED DESC) = 1)
    SELECT file_date AS ingest_date, count(*) AS n_events, count(*) FILTER (SOURCEURL LIKE '%?again') AS n_again,
      count(*) FILTER (SOURCEURL LIKE '%?late') AS n_late FROM once GROUP BY 1""",
)
def merged_deliveries(spark, sf_dir):
    """Events of a later day that repeat stored ones, newer or older: each is stored once, in its newest form."""
    store, days = Warehouse(spark, work_dir(spark, "warehouse")), feed_days(spark, sf_dir)
    run = store.begin()
    feed = _staged_feed(spark, sf_dir)
    run.replace_dates(feed, "events", days, "ingest_date", ["event_date"])
    run.commit()
    next_day = days[-1] + timedelta(days=1)

    def again(quad_class, added, mark):
        return feed.where(F.col("quad_class") == quad_class).withColumns(
            {
                "date_added": F.lit(added).cast("date"),
                "source_url": F.concat("source_url", F.lit(mark)),
                "ingest_date": F.lit(next_day),
            }
        )

    new = again(3, "2024-06-01", "?again").unionByName(again(4, "2023-01-01", "?late"))
    run = store.begin()
    rows, dates = merge_events(new, run.read("events"), [next_day])
    run.replace_dates(rows, "events", dates, "ingest_date", ["event_date"])
    run.commit()
    return store.read("events").groupBy("ingest_date").agg(
        F.count(F.lit(1)).alias("n_events"),
        F.count_if(F.col("source_url").endswith("?again")).alias("n_again"),
        F.count_if(F.col("source_url").endswith("?late")).alias("n_late"),
    )


def _kept_states(spark, sf_dir):
    """A warehouse's states after two deliveries, the second of which replaces days of the first."""
    store, days = Warehouse(spark, work_dir(spark, "warehouse")), feed_days(spark, sf_dir)
    events = news(spark, sf_dir).withColumn("ingest_date", F.col("event_date"))
    before, run = None, None
    for some, rows in ((days, events.where("num_articles % 3 <> 0")), (days[::2], events), (days[1::2], events)):
        run = store.begin()
        run.replace_dates(rows, "events", some, "ingest_date", ["event_date"])
        refresh_states(run, before, run.read("events"), some)
        run.commit()
        before = store.read("events")
    return store.begin()


@query("daily_tone_from_states", f"WITH {NEWS_SQL}, {DAILY_SQL} SELECT * FROM daily")
def daily_tone_from_states(spark, sf_dir):
    """The daily mart from stored partial aggregates per day, made anew for changed days only."""
    return marts_from_states(_kept_states(spark, sf_dir), AS_OF)[0]


@query("country_activity_from_states", f"WITH {NEWS_SQL}, {COUNTRY_SQL} SELECT * FROM countries")
def country_activity_from_states(spark, sf_dir):
    """The country mart from the same states."""
    return marts_from_states(_kept_states(spark, sf_dir), AS_OF)[1]


@query(
    "q_unique_in_history",
    """WITH d AS (SELECT CAST(ts AS DATE) AS day, event_id, user_id FROM events),
    last AS (SELECT max(day) AS day FROM d),
    keyed AS (SELECT day, CASE WHEN event_id % 10 = 0 THEN user_id ELSE 1000000 + event_id END AS key FROM d)
    SELECT key AS unique_field, count(*) AS n_records FROM keyed
    WHERE key IN (SELECT key FROM keyed WHERE day = (SELECT day FROM last)) GROUP BY 1 HAVING count(*) > 1""",
)
def q_unique_in_history(spark, sf_dir):
    """Keys of the last day that are not unique among all days, found by stored filters of the earlier days."""
    key = F.when(F.col("event_id") % 10 == 0, F.col("user_id")).otherwise(F.col("event_id") + 1000000)
    rows = table(spark, sf_dir, "events").select(F.col("ts").cast("date").alias("day"), key.alias("key"))
    last = rows.agg(F.max("day")).first()[0]
    store = Warehouse(spark, work_dir(spark, "warehouse"))
    run, days = store.begin(), feed_days(spark, sf_dir)[:-1]
    run.replace_dates(rows, "keys", days, "day")
    run.replace_dates(key_filters(run.read("keys"), "key", "day"), "key_filters", days, "day")
    run.commit()
    new = rows.where(F.col("day") == F.lit(last))
    return repeated_keys(new, store.read("keys"), "key", store.read("key_filters"), "day")


@query(
    "q_equality_by_digests",
    f"""WITH a AS (SELECT event_id, user_id, value FROM events),
    b AS (SELECT event_id, CASE WHEN event_id % 1000 = 7 THEN user_id + 1 ELSE user_id END AS user_id, value FROM events
      WHERE event_id % 1000 <> 9)
    {BOTH_DIRECTIONS}""",
)
def q_equality_by_digests(spark, sf_dir):
    """Events found only in the table or only in a copy with some rows changed and some left out."""
    events = table(spark, sf_dir, "events").select("event_id", "user_id", "value")
    changed = F.when(F.col("event_id") % 1000 == 7, F.col("user_id") + 1).otherwise(F.col("user_id"))
    copy = events.where("event_id % 1000 <> 9").withColumn("user_id", changed)
    return equality_by_digests(events, copy).violations



@query(
    "frequent_values",
    """SELECT user_id AS value, count(*) AS n_records FROM events GROUP BY 1 ORDER BY n_records DESC, value LIMIT 12""",
)
def q_frequent_values(spark, sf_dir):
    """The users with most events, from a summary of bounded size and exact counts of its candidates."""
    return frequent_values(table(spark, sf_dir, "events"), "user_id", 12)


@query(
    "bounds_from_footers",
    """SELECT 'l_orderkey' AS column_name, count(*) AS n_rows, count(*) - count(l_orderkey) AS n_null,
      CAST(min(l_orderkey) AS VARCHAR) AS least, CAST(max(l_orderkey) AS VARCHAR) AS greatest FROM lineitem
    UNION ALL SELECT 'l_linenumber', count(*), count(*) - count(l_linenumber), CAST(min(l_linenumber) AS VARCHAR),
      CAST(max(l_linenumber) AS VARCHAR) FROM lineitem
    UNION ALL SELECT 'l_returnflag', count(*), count(*) - count(l_returnflag), NULL, NULL FROM lineitem""",
)
def bounds_from_footers(spark, sf_dir):
    """Rows, nulls and bounds of three columns, without reading them."""
    return column_bounds(spark, [f"{sf_dir}/lineitem.parquet"], ["l_orderkey", "l_linenumber", "l_returnflag"])


@query(
    "clustered_events",
    "SELECT event_type, count(*) AS n_events, CAST(sum(event_id) AS BIGINT) AS id_sum FROM events WHERE user_id % 16 = 3 GROUP BY 1",
)
def clustered_events(spark, sf_dir):
    """Events laid out along a curve through kind and user group, then those of one user group."""
    path = work_dir(spark, "clustered")
    events = table(spark, sf_dir, "events").withColumn("user_group", F.pmod("user_id", F.lit(16)))
    clustered(events, ["event_type", "user_group"], 16).write.parquet(path)
    some = spark.read.parquet(path).where("user_group = 3")
    return some.groupBy("event_type").agg(F.count(F.lit(1)).alias("n_events"), F.sum("event_id").alias("id_sum"))


@query(
    "q_relationships_bucketed",
    """SELECT o_custkey AS id, count(*) AS n_rows FROM orders
    WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_nationkey <> 3) GROUP BY 1""",
)
def q_relationships_bucketed(spark, sf_dir):
    """Orders of customers outside the listed nations, with both tables stored by hash of the customer."""
    database = f"bucketed_{uuid.uuid4().hex[:12]}"
    spark.sql(f"CREATE DATABASE {database}")
    for name, key in (("orders", "o_custkey"), ("customer", "c_custkey")):
        write_bucketed(table(spark, sf_dir, name), f"{database}.{name}", work_dir(spark, name), key, 8)
    orders, customers = spark.table(f"{database}.orders"), spark.table(f"{database}.customer")
    check = C.relationships_where(orders, "o_custkey", customers, "c_custkey", to_condition="c_nationkey <> 3")
    spark.sql(f"DROP DATABASE {database} CASCADE")  # the files stay
    return check.violations
