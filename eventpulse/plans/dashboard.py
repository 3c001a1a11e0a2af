"""Tables behind the dashboard tiles, read from the marts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.numbers import round_half_away


def tone_over_time(daily: DataFrame) -> DataFrame:
    """Average tone and event count per day and class label."""
    return daily.select("event_date", "quad_class_label", "avg_tone", "event_count")


def conflict_by_day(daily: DataFrame) -> DataFrame:
    """Conflict share of each day over all its classes."""
    in_conflict = F.when(F.col("quad_class").isin(3, 4), F.col("event_count")).otherwise(0)
    sums = daily.groupBy("event_date").agg(
        F.sum("event_count").alias("event_count"), F.sum(in_conflict).alias("conflict_count")
    )
    share = F.col("conflict_count") / F.col("event_count") * F.lit(100)
    return sums.withColumn("conflict_pct", round_half_away(share, 2))


def most_volatile_day(daily: DataFrame) -> DataFrame:
    """The day with the highest conflict share, the earliest of equal ones."""
    return conflict_by_day(daily).orderBy(F.col("conflict_count") / F.col("event_count") * -1, "event_date").limit(1)


def top_countries(countries: DataFrame, n: int = 10) -> DataFrame:
    """The ``n`` most active countries with their tone."""
    columns = ["country_rank", "action_geo_country_code", "country_name_common", "event_count", "avg_tone"]
    return countries.select(*columns).orderBy("country_rank").limit(n)


def sentiment_map(countries: DataFrame) -> DataFrame:
    """Average tone per ISO country code."""
    return countries.select("iso_country_code", "avg_tone", "event_count")
