"""Staging, marts and dashboard tables over the events feed."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import checks as C
from ..plans import dashboard
from ..plans.crosswalk import AS_LISTED, ONE_PER_CODE, values_sql
from ..plans.daily import model_checks
from ..plans.marts import country_activity, daily_event_tone
from ..plans.staging import STAGED, stage
from ..session import work_dir
from ..sources.tables import replace_table
from .base import query, sql_round
from .feed import AS_OF, NEWS_SQL, RAW_SQL, news, raw_feed

_COMPUTED_SQL = {
    "event_date": "CAST(strptime(CAST(Day AS VARCHAR), '%Y%m%d') AS DATE)",
    "date_added": "CAST(strptime(CAST(DATEADDED AS VARCHAR), '%Y%m%d') AS DATE)",
    "quad_class_label": (
        "CASE QuadClass WHEN 1 THEN 'Verbal Cooperation' WHEN 2 THEN 'Material Cooperation'"
        " WHEN 3 THEN 'Verbal Conflict' WHEN 4 THEN 'Material Conflict' ELSE 'Unknown' END"
    ),
}
STAGED_COLUMNS_SQL = ", ".join(f"{_COMPUTED_SQL.get(name, source)} AS {name}" for name, source in STAGED.items())
STAGE_SQL = (
    f"SELECT {STAGED_COLUMNS_SQL} FROM raw_feed WHERE Day IS NOT NULL AND CAST(Day AS VARCHAR) LIKE '20%'"
)

_IN_WINDOW = "event_date >= DATE '2024-01-31' - INTERVAL 30 DAY AND event_date < DATE '2024-01-31'"
_MEAN_TONE = "CAST(sum(avg_tone) AS DOUBLE) / count(avg_tone)"
_MEAN_GOLDSTEIN = "CAST(sum(goldstein_scale) AS DOUBLE) / count(goldstein_scale)"
_WEIGHTED = "CAST(sum(avg_tone * num_articles) AS DOUBLE) / CAST(nullif(sum(num_articles), 0) AS DOUBLE)"
_CONFLICT = "CAST(count(*) FILTER (quad_class IN (3, 4)) AS DOUBLE) / count(*) * 100"

DAILY_SQL = f"""daily AS (
  SELECT event_date, quad_class, quad_class_label, count(*) AS event_count,
         CAST(sum(num_mentions) AS BIGINT) AS total_mentions, CAST(sum(num_articles) AS BIGINT) AS total_articles,
         {sql_round(_MEAN_TONE, 3)} AS avg_tone, {sql_round(_MEAN_GOLDSTEIN, 3)} AS avg_goldstein,
         {sql_round(_WEIGHTED, 3)} AS weighted_avg_tone, {sql_round(_CONFLICT, 2)} AS conflict_pct
  FROM staged WHERE {_IN_WINDOW}
  GROUP BY event_date, quad_class, quad_class_label
)"""


def _country_sql(pairs: list[tuple[str, str]]) -> str:
    return f"""base AS (
  SELECT * FROM staged
  WHERE {_IN_WINDOW} AND action_geo_country_code IS NOT NULL AND action_geo_country_code <> ''
), places AS (
  SELECT action_geo_country_code, action_geo_fullname,
         row_number() OVER (PARTITION BY action_geo_country_code
                            ORDER BY count(*) DESC, action_geo_fullname ASC NULLS LAST) AS pick
  FROM base GROUP BY action_geo_country_code, action_geo_fullname
), by_country AS (
  SELECT action_geo_country_code, count(*) AS event_count,
         CAST(sum(num_mentions) AS BIGINT) AS total_mentions, CAST(sum(num_articles) AS BIGINT) AS total_articles,
         {sql_round(_MEAN_TONE, 3)} AS avg_tone, {sql_round(_MEAN_GOLDSTEIN, 3)} AS avg_goldstein,
         {sql_round(_WEIGHTED, 3)} AS weighted_avg_tone,
         count(*) FILTER (quad_class = 1) AS verbal_coop_count,
         count(*) FILTER (quad_class = 2) AS material_coop_count,
         count(*) FILTER (quad_class = 3) AS verbal_conflict_count,
         count(*) FILTER (quad_class = 4) AS material_conflict_count,
         {sql_round(_CONFLICT, 2)} AS conflict_pct,
         min(event_date) AS first_event_date, max(event_date) AS last_event_date
  FROM base GROUP BY action_geo_country_code
), codes(fips, iso) AS (VALUES {values_sql(pairs)}
), countries AS (
  SELECT b.*, p.action_geo_fullname AS country_name_common,
         coalesce(c.iso, b.action_geo_country_code) AS iso_country_code,
         row_number() OVER (ORDER BY b.event_count DESC, b.action_geo_country_code,
                            coalesce(c.iso, b.action_geo_country_code)) AS country_rank
  FROM by_country b
  JOIN places p ON p.action_geo_country_code = b.action_geo_country_code AND p.pick = 1
  LEFT JOIN codes c ON c.fips = b.action_geo_country_code
)"""


COUNTRY_SQL = _country_sql(ONE_PER_CODE)


def _daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    return daily_event_tone(news(spark, sf_dir), AS_OF)


def _countries(spark: SparkSession, sf_dir: str, as_listed: bool = False) -> DataFrame:
    return country_activity(news(spark, sf_dir), AS_OF, crosswalk_as_listed=as_listed)


@query("stg_events", f"WITH {RAW_SQL} {STAGE_SQL}")
def stg_events(spark, sf_dir):
    return stage(raw_feed(spark, sf_dir))


@query(
    "stg_events_deduplicated",
    f"""WITH {RAW_SQL},
    delivered AS (
      SELECT * FROM raw_feed
      UNION ALL BY NAME
      SELECT * REPLACE (20240201 AS DATEADDED, SOURCEURL || '?again' AS SOURCEURL) FROM raw_feed WHERE QuadClass IN (3, 4)
    ), cleaned AS ({STAGE_SQL.replace('raw_feed', 'delivered')})
    SELECT * EXCLUDE (pick) FROM (
      SELECT *, row_number() OVER (PARTITION BY global_event_id ORDER BY date_added DESC NULLS LAST) AS pick FROM cleaned
    ) WHERE pick = 1""",
)
def stg_events_deduplicated(spark, sf_dir):
    """Events delivered again on a later date keep only the later delivery."""
    raw = raw_feed(spark, sf_dir)
    again = (
        raw.where(F.col("QuadClass").isin(3, 4))
        .withColumn("DATEADDED", F.lit(20240201))
        .withColumn("SOURCEURL", F.concat("SOURCEURL", F.lit("?again")))
    )
    return stage(raw.unionByName(again), dedupe=True)


@query("mart_daily_tone", f"WITH {NEWS_SQL}, {DAILY_SQL} SELECT * FROM daily")
def mart_daily_tone(spark, sf_dir):
    return _daily(spark, sf_dir)


@query("mart_country_activity", f"WITH {NEWS_SQL}, {COUNTRY_SQL} SELECT * FROM countries")
def mart_country_activity(spark, sf_dir):
    return _countries(spark, sf_dir)


@query("mart_country_activity_as_listed", f"WITH {NEWS_SQL}, {_country_sql(AS_LISTED)} SELECT * FROM countries")
def mart_country_activity_as_listed(spark, sf_dir):
    return _countries(spark, sf_dir, as_listed=True)


@query(
    "tone_over_time",
    f"WITH {NEWS_SQL}, {DAILY_SQL} SELECT event_date, quad_class_label, avg_tone, event_count FROM daily",
)
def tone_over_time(spark, sf_dir):
    return dashboard.tone_over_time(_daily(spark, sf_dir))


_BY_DAY_SQL = f"""by_day AS (
  SELECT event_date, CAST(sum(event_count) AS BIGINT) AS event_count,
         CAST(sum(CASE WHEN quad_class IN (3, 4) THEN event_count ELSE 0 END) AS BIGINT) AS conflict_count
  FROM daily GROUP BY event_date
), shares AS (
  SELECT *, {sql_round('CAST(conflict_count AS DOUBLE) / event_count * 100', 2)} AS conflict_pct FROM by_day
)"""


@query("conflict_by_day", f"WITH {NEWS_SQL}, {DAILY_SQL}, {_BY_DAY_SQL} SELECT * FROM shares")
def conflict_by_day(spark, sf_dir):
    return dashboard.conflict_by_day(_daily(spark, sf_dir))


@query(
    "most_volatile_day",
    f"""WITH {NEWS_SQL}, {DAILY_SQL}, {_BY_DAY_SQL}
    SELECT * FROM shares ORDER BY CAST(conflict_count AS DOUBLE) / event_count DESC, event_date LIMIT 1""",
)
def most_volatile_day(spark, sf_dir):
    return dashboard.most_volatile_day(_daily(spark, sf_dir))


@query(
    "top_countries",
    f"""WITH {NEWS_SQL}, {COUNTRY_SQL}
    SELECT country_rank, action_geo_country_code, country_name_common, event_count, avg_tone
    FROM countries ORDER BY country_rank LIMIT 10""",
)
def top_countries(spark, sf_dir):
    return dashboard.top_countries(_countries(spark, sf_dir))


@query(
    "sentiment_map",
    f"WITH {NEWS_SQL}, {COUNTRY_SQL} SELECT iso_country_code, avg_tone, event_count FROM countries",
)
def sentiment_map(spark, sf_dir):
    return dashboard.sentiment_map(_countries(spark, sf_dir))


def _summary_sql(checks: list[tuple[str, str, str, str, str]]) -> str:
    rows = [
        f"SELECT '{name}' AS check_name, '{relation}' AS relation, '{column}' AS column_name, "
        f"CAST(({sql}) AS BIGINT) AS failures, '{severity}' AS severity"
        for name, relation, column, severity, sql in checks
    ]
    return f"""SELECT *, failures <> 0 AS should_warn, failures <> 0 AS should_error,
      CASE WHEN failures = 0 THEN 'pass' WHEN severity = 'error' THEN 'error' ELSE 'warn' END AS status
    FROM ({' UNION ALL '.join(rows)})"""


def _nulls(relation: str, source: str, column: str) -> tuple[str, str, str, str, str]:
    return "not_null", relation, column, "error", f"SELECT count(*) FROM {source} WHERE {column} IS NULL"


def _repeats(relation: str, source: str, column: str, severity: str = "error") -> tuple[str, str, str, str, str]:
    counted = f"SELECT {column} FROM {source} WHERE {column} IS NOT NULL GROUP BY {column} HAVING count(*) > 1"
    return "unique", relation, column, severity, f"SELECT count(*) FROM ({counted})"


def _others(relation: str, source: str) -> tuple[str, str, str, str, str]:
    sql = f"SELECT count(DISTINCT quad_class) FROM {source} WHERE quad_class NOT IN (1, 2, 3, 4)"
    return "accepted_values", relation, "quad_class", "error", sql


_EVENTS, _DAILY, _COUNTRY = "events", "mart_daily_event_tone", "mart_country_activity"
_OUTSIDE = "SELECT count(*) FROM staged WHERE avg_tone < -100 OR avg_tone > 100"


@query(
    "check_summary",
    f"WITH {RAW_SQL}, {NEWS_SQL}, {DAILY_SQL}, {COUNTRY_SQL} "
    + _summary_sql(
        [
            _nulls("raw_events", "raw_feed", "GlobalEventID"),
            _nulls("raw_events", "raw_feed", "Day"),
            _nulls(_EVENTS, "staged", "global_event_id"),
            _repeats(_EVENTS, "staged", "global_event_id", "warn"),
            _nulls(_EVENTS, "staged", "event_date"),
            _nulls(_EVENTS, "staged", "quad_class"),
            _others(_EVENTS, "staged"),
            ("accepted_range", _EVENTS, "avg_tone", "error", _OUTSIDE),
            _nulls(_DAILY, "daily", "event_date"),
            _nulls(_DAILY, "daily", "quad_class"),
            _others(_DAILY, "daily"),
            _nulls(_DAILY, "daily", "event_count"),
            _nulls(_COUNTRY, "countries", "action_geo_country_code"),
            _repeats(_COUNTRY, "countries", "action_geo_country_code"),
            _nulls(_COUNTRY, "countries", "country_rank"),
            _repeats(_COUNTRY, "countries", "country_rank"),
            _nulls(_COUNTRY, "countries", "event_count"),
        ]
    ),
)
def check_summary(spark, sf_dir):
    """All declared checks of the source, the staged events and the published marts in one job."""
    staged, published = news(spark, sf_dir), work_dir(spark, "published")
    replace_table(daily_event_tone(staged, AS_OF), f"{published}/daily", ["event_date"], ["quad_class_label"])
    replace_table(country_activity(staged, AS_OF), f"{published}/countries", (), ["action_geo_country_code"])
    daily, countries = spark.read.parquet(f"{published}/daily"), spark.read.parquet(f"{published}/countries")
    return C.summarise(model_checks(raw_feed(spark, sf_dir), staged, daily, countries))
