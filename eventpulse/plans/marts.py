"""The two 30-day marts over staged events."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.numbers import joined_sum, mean, round_half_away, share_pct, sum_parts, weighted_mean
from .crosswalk import crosswalk

WINDOW_DAYS = 30
SUM_PARTS = ("high", "low", "rest")


def recent(staged: DataFrame, as_of: date, days: int = WINDOW_DAYS) -> DataFrame:
    """Events of the ``days`` days before ``as_of``; that day itself is left out."""
    start = F.date_sub(F.lit(as_of), days)
    return staged.where((F.col("event_date") >= start) & (F.col("event_date") < F.lit(as_of)))


def _in_conflict() -> Column:
    return F.col("quad_class").isin(3, 4)


def daily_event_tone(staged: DataFrame, as_of: date, days: int = WINDOW_DAYS) -> DataFrame:
    """Volume, tone and stability per day and event class."""
    return (
        recent(staged, as_of, days)
        .groupBy("event_date", "quad_class", "quad_class_label")
        .agg(
            F.count(F.lit(1)).alias("event_count"),
            F.sum("num_mentions").alias("total_mentions"),
            F.sum("num_articles").alias("total_articles"),
            round_half_away(mean("avg_tone"), 3).alias("avg_tone"),
            round_half_away(mean("goldstein_scale"), 3).alias("avg_goldstein"),
            round_half_away(weighted_mean("avg_tone", "num_articles"), 3).alias("weighted_avg_tone"),
            round_half_away(share_pct(_in_conflict()), 2).alias("conflict_pct"),
        )
    )


def tone_parts(staged: DataFrame) -> DataFrame:
    """Partial aggregates per day and event class, from which ``tone_from_parts`` makes the daily mart."""
    tone, scale, articles = F.col("avg_tone"), F.col("goldstein_scale"), F.col("num_articles")
    summed = {"tone": tone, "stability": scale, "weighted_tone": tone.cast("double") * articles}
    return staged.groupBy("event_date", "quad_class", "quad_class_label").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum("num_mentions").alias("mentions"),
        F.sum("num_articles").alias("articles"),
        F.count("avg_tone").alias("n_tone"),
        F.count("goldstein_scale").alias("n_stability"),
        F.count_if(_in_conflict()).alias("n_conflict"),
        *[
            part.alias(f"{name}_{side}")
            for name, value in summed.items()
            for side, part in zip(SUM_PARTS, sum_parts(value))
        ],
    )


def tone_from_parts(parts: DataFrame) -> DataFrame:
    """The daily mart from one row per day and event class."""

    def ratio(name: str, divisor: str) -> Column:
        numerator = joined_sum(*[F.col(f"{name}_{side}") for side in SUM_PARTS])
        return round_half_away(F.try_divide(numerator, F.col(divisor).cast("double")), 3)

    return parts.select(
        "event_date", "quad_class", "quad_class_label",
        F.col("n").alias("event_count"),
        F.col("mentions").alias("total_mentions"),
        F.col("articles").alias("total_articles"),
        ratio("tone", "n_tone").alias("avg_tone"),
        ratio("stability", "n_stability").alias("avg_goldstein"),
        ratio("weighted_tone", "articles").alias("weighted_avg_tone"),
        round_half_away(F.col("n_conflict") / F.col("n") * F.lit(100), 2).alias("conflict_pct"),
    )


def country_activity(
    staged: DataFrame, as_of: date, days: int = WINDOW_DAYS, crosswalk_as_listed: bool = False
) -> DataFrame:
    """Activity per country of action with its most common place name, ISO code and rank.

    Rows are first summed per country and place, which spreads a country that
    holds much of the feed over many groups. The sums are then added up per
    country, where the most frequent place is picked: one scan, no join but the
    constant crosswalk. The rank orders the finished rows, one per country code.
    """
    return countries_from_places(place_parts(recent(staged, as_of, days)), crosswalk_as_listed)


def place_parts(staged: DataFrame, *by: str) -> DataFrame:
    """Partial aggregates per country and place, and per column of ``by``; ``added_places`` combines them."""
    in_scope = staged.where(F.col("action_geo_country_code").isNotNull() & (F.col("action_geo_country_code") != ""))
    summed = {
        "tone": F.col("avg_tone"),
        "stability": F.col("goldstein_scale"),
        "weighted_tone": F.col("avg_tone") * F.col("num_articles"),
    }
    parts = [
        part.alias(f"{name}_{side}")
        for name, value in summed.items()
        for side, part in zip(SUM_PARTS, sum_parts(value))
    ]
    return in_scope.groupBy(*by, "action_geo_country_code", "action_geo_fullname").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum("num_mentions").alias("mentions"),
        F.sum("num_articles").alias("articles"),
        F.count("avg_tone").alias("n_tone"),
        F.count("goldstein_scale").alias("n_stability"),
        *parts,
        *[F.count_if(F.col("quad_class") == k).alias(f"class_{k}") for k in (1, 2, 3, 4)],
        F.min("event_date").alias("first_date"),
        F.max("event_date").alias("last_date"),
    )


def added_places(parts: DataFrame) -> DataFrame:
    """Partial aggregates of several days, added up per country and place."""
    places = ("action_geo_country_code", "action_geo_fullname")
    how = {"first_date": F.min, "last_date": F.max}
    columns = [c for c in parts.columns if c not in (*places, "event_date")]
    return parts.groupBy(*places).agg(*[how.get(c, F.sum)(c).alias(c) for c in columns])


def countries_from_places(per_place: DataFrame, crosswalk_as_listed: bool = False) -> DataFrame:
    """The country mart from one row per country and place."""

    def total(column: str) -> Column:
        return F.sum(column)

    def ratio(name: str, divisor: str) -> Column:
        numerator = joined_sum(*[total(f"{name}_{side}") for side in SUM_PARTS])
        return round_half_away(F.try_divide(numerator, total(divisor).cast("double")), 3)

    # Most rows first, then names before NULL, then the lowest name.
    place = F.col("action_geo_fullname")
    preference = F.struct(-F.col("n"), place.isNull(), place)
    by_country = per_place.groupBy("action_geo_country_code").agg(
        F.min_by(place, preference).alias("country_name_common"),
        total("n").alias("event_count"),
        total("mentions").alias("total_mentions"),
        total("articles").alias("total_articles"),
        ratio("tone", "n_tone").alias("avg_tone"),
        ratio("stability", "n_stability").alias("avg_goldstein"),
        ratio("weighted_tone", "articles").alias("weighted_avg_tone"),
        total("class_1").alias("verbal_coop_count"),
        total("class_2").alias("material_coop_count"),
        total("class_3").alias("verbal_conflict_count"),
        total("class_4").alias("material_conflict_count"),
        round_half_away((total("class_3") + total("class_4")) / total("n") * F.lit(100), 2).alias("conflict_pct"),
        F.min("first_date").alias("first_event_date"),
        F.max("last_date").alias("last_event_date"),
    )
    codes = crosswalk(per_place.sparkSession, crosswalk_as_listed)
    with_iso = (
        by_country.join(F.broadcast(codes), F.col("action_geo_country_code") == F.col("fips"), "left")
        .withColumn("iso_country_code", F.coalesce("iso", "action_geo_country_code"))
        .drop("fips", "iso")
    )
    order = W.orderBy(F.desc("event_count"), F.asc("action_geo_country_code"), F.asc("iso_country_code"))
    return with_iso.withColumn("country_rank", F.row_number().over(order).cast("bigint"))
