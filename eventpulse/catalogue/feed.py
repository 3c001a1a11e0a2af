"""The supplied ``events`` table seen as a news-event feed.

``raw_feed`` gives the 58 raw columns, ``news`` the staged columns that the marts
read. Both cover codes listed twice in the crosswalk, unmapped, empty and missing
country codes, missing place names, and an event class outside 1 to 4.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans.staging import class_label
from ..schema import RAW_TYPES
from .base import table

# The day on which the marts are built.
AS_OF = date(2024, 1, 31)

_QUAD_CLASS = (
    "CASE event_type WHEN 'signup' THEN 1 WHEN 'purchase' THEN 2 WHEN 'click' THEN 3"
    " WHEN 'error' THEN 4 ELSE 0 END"
)
_COUNTRY = (
    "CASE user_id % 8 WHEN 0 THEN 'US' WHEN 1 THEN 'UK' WHEN 2 THEN 'AU' WHEN 3 THEN 'MO'"
    " WHEN 4 THEN 'GM' WHEN 5 THEN 'XX' WHEN 6 THEN '' END"
)
_PLACE = "CASE WHEN event_type <> 'error' THEN 'Place ' || event_type END"
_LABEL = (
    "CASE quad_class WHEN 1 THEN 'Verbal Cooperation' WHEN 2 THEN 'Material Cooperation'"
    " WHEN 3 THEN 'Verbal Conflict' WHEN 4 THEN 'Material Conflict' ELSE 'Unknown' END"
)

# SQL shared by the comparison queries.
NEWS_SQL = f"""news AS (
  SELECT event_id AS global_event_id, CAST(ts AS DATE) AS event_date, {_QUAD_CLASS} AS quad_class,
         CAST(value AS DECIMAL(12,2)) - 50 AS avg_tone, CAST(user_id % 21 AS INTEGER) - 10 AS goldstein_scale,
         user_id AS num_mentions, CAST(regexp_extract(props, '[0-9]+') AS BIGINT) AS num_articles,
         {_COUNTRY} AS action_geo_country_code, {_PLACE} AS action_geo_fullname
  FROM events
), staged AS (SELECT *, {_LABEL} AS quad_class_label FROM news)"""


def news(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Staged columns the marts read."""
    staged = table(spark, sf_dir, "events").select(
        F.col("event_id").alias("global_event_id"),
        F.col("ts").cast("date").alias("event_date"),
        F.expr(_QUAD_CLASS).alias("quad_class"),
        (F.col("value") - 50).alias("avg_tone"),
        (F.col("user_id") % 21 - 10).cast("double").alias("goldstein_scale"),
        F.col("user_id").alias("num_mentions"),
        F.regexp_extract("props", "[0-9]+", 0).cast("bigint").alias("num_articles"),
        F.expr(_COUNTRY).alias("action_geo_country_code"),
        F.expr(_PLACE).alias("action_geo_fullname"),
    )
    return staged.withColumn("quad_class_label", class_label(F.col("quad_class")))


# Raw column, Spark expression over events, and SQL where it differs. Columns left out are NULL. Small
# values give a missing day or one before 2000, which staging leaves out.
_DAY = "CASE WHEN value < 1 THEN NULL WHEN value < 2 THEN 19991231 ELSE {} END"
_YMD = ("CAST(date_format(ts, 'yyyyMMdd') AS INT)", "CAST(strftime(ts, '%Y%m%d') AS INTEGER)")
_RAW = {
    "GlobalEventID": ("event_id",),
    "Day": (_DAY.format(_YMD[0]), _DAY.format(_YMD[1])),
    "MonthYear": ("CAST(year(ts) * 100 + month(ts) AS INT)",),
    "Year": ("CAST(year(ts) AS INT)",),
    "FractionDate": ("CAST(year(ts) AS DOUBLE)",),
    "Actor1Code": ("upper(event_type)",),
    "Actor1Name": ("'User ' || CAST(user_id AS STRING)", "'User ' || CAST(user_id AS VARCHAR)"),
    "Actor1CountryCode": ("CASE WHEN user_id % 3 = 0 THEN 'USA' WHEN user_id % 3 = 1 THEN 'GBR' END",),
    "Actor1Type1Code": ("substr(upper(event_type), 1, 3)",),
    "Actor1KnownGroupCode": ("CASE WHEN event_type = 'signup' THEN 'UNO' END",),
    "Actor2Code": ("CASE WHEN value > 100 THEN 'GOV' END",),
    "Actor2Name": ("CASE WHEN value > 100 THEN 'GOVERNMENT' END",),
    "Actor2CountryCode": ("CASE WHEN value > 100 THEN 'FRA' END",),
    "Actor2Type1Code": ("CASE WHEN value > 100 THEN 'GOV' END",),
    "IsRootEvent": ("CAST(user_id % 2 AS INT)", "CAST(user_id % 2 AS INTEGER)"),
    "EventCode": ("CASE WHEN event_type = 'view' THEN '010' ELSE '1' || substr(event_type, 1, 1) END",),
    "EventBaseCode": ("CASE WHEN event_type = 'view' THEN '010' ELSE '11' END",),
    "EventRootCode": ("CASE WHEN event_type = 'view' THEN '01' ELSE '11' END",),
    "QuadClass": (f"CASE WHEN value > 400 THEN NULL ELSE {_QUAD_CLASS} END",),
    "GoldsteinScale": ("CAST(user_id % 21 - 10 AS DOUBLE)",),
    "NumMentions": ("user_id",),
    "NumSources": ("user_id % 7",),
    "NumArticles": (
        "CAST(regexp_extract(props, '[0-9]+', 0) AS BIGINT)",
        "CAST(regexp_extract(props, '[0-9]+') AS BIGINT)",
    ),
    "AvgTone": ("value - 50",),
    "ActionGeo_Type": ("CAST(user_id % 5 AS INT)", "CAST(user_id % 5 AS INTEGER)"),
    "ActionGeo_Fullname": (_PLACE,),
    "ActionGeo_CountryCode": (f"nullif({_COUNTRY}, '')",),
    "ActionGeo_ADM1Code": (f"nullif({_COUNTRY}, '') || '01'",),
    "ActionGeo_Lat": ("CAST(user_id % 181 - 90 AS DOUBLE)",),
    "ActionGeo_Long": ("CAST(event_id % 361 - 180 AS DOUBLE)",),
    "ActionGeo_FeatureID": ("CAST(user_id AS STRING)", "CAST(user_id AS VARCHAR)"),
    "Actor1Geo_CountryCode": (f"nullif({_COUNTRY}, '')",),
    "Actor1Geo_Fullname": ("'\"Quoted ' || event_type",),
    "Actor1Geo_Lat": ("CAST(user_id % 181 - 90 AS DOUBLE)",),
    "Actor2Geo_Fullname": ("CASE WHEN value > 100 THEN 'Paris, France' END",),
    "Actor2Geo_Long": ("CASE WHEN value > 100 THEN CAST(2.35 AS DOUBLE) END",),
    "DATEADDED": _YMD,
    "SOURCEURL": (
        "'https://news.example.com/' || CAST(event_id AS STRING)",
        "'https://news.example.com/' || CAST(event_id AS VARCHAR)",
    ),
}
_SQL_TYPES = {"string": "VARCHAR", "int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE"}


def raw_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 58 typed raw columns, with the date of the file that would list each row."""
    columns = [F.expr(_RAW.get(name, ("NULL",))[0]).cast(kind).alias(name) for name, kind in RAW_TYPES.items()]
    return table(spark, sf_dir, "events").select(*columns, F.col("ts").cast("date").alias("file_date"))


def feed_days(spark: SparkSession, sf_dir: str) -> list[date]:
    """The days that the table has events of, in order. One row per day reaches the driver."""
    days = table(spark, sf_dir, "events").select(F.col("ts").cast("date").alias("day")).distinct()
    return sorted(r.day for r in days.collect() if r.day is not None)


RAW_SQL = (
    "raw_feed AS (SELECT CAST(ts AS DATE) AS file_date, "
    + ", ".join(
        f"CAST({_RAW.get(name, ('NULL',))[-1]} AS {_SQL_TYPES[kind]}) AS {name}" for name, kind in RAW_TYPES.items()
    )
    + " FROM events)"
)
