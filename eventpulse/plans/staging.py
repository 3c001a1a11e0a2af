"""Staged events: typed dates, plain names, one readable class label."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.reshape import deduplicate

# Labels of the four event classes and of anything else.
CLASS_LABELS = {
    1: "Verbal Cooperation",
    2: "Material Cooperation",
    3: "Verbal Conflict",
    4: "Material Conflict",
}
OTHER_LABEL = "Unknown"

# Staged name and raw name, in output order. The dates and the label are computed.
STAGED_FROM = """
global_event_id          GlobalEventID
event_date               Day
date_added               DATEADDED
event_year               Year
event_month_year         MonthYear
actor1_code              Actor1Code
actor1_name              Actor1Name
actor1_country_code      Actor1CountryCode
actor1_type1_code        Actor1Type1Code
actor1_known_group_code  Actor1KnownGroupCode
actor2_code              Actor2Code
actor2_name              Actor2Name
actor2_country_code      Actor2CountryCode
actor2_type1_code        Actor2Type1Code
actor2_known_group_code  Actor2KnownGroupCode
is_root_event            IsRootEvent
event_code               EventCode
event_base_code          EventBaseCode
event_root_code          EventRootCode
quad_class               QuadClass
quad_class_label         QuadClass
goldstein_scale          GoldsteinScale
avg_tone                 AvgTone
num_mentions             NumMentions
num_sources              NumSources
num_articles             NumArticles
action_geo_type          ActionGeo_Type
action_geo_fullname      ActionGeo_Fullname
action_geo_country_code  ActionGeo_CountryCode
action_geo_adm1_code     ActionGeo_ADM1Code
action_geo_lat           ActionGeo_Lat
action_geo_long          ActionGeo_Long
action_geo_feature_id    ActionGeo_FeatureID
actor1_geo_country_code  Actor1Geo_CountryCode
actor1_geo_fullname      Actor1Geo_Fullname
actor1_geo_lat           Actor1Geo_Lat
actor1_geo_long          Actor1Geo_Long
actor2_geo_country_code  Actor2Geo_CountryCode
actor2_geo_fullname      Actor2Geo_Fullname
actor2_geo_lat           Actor2Geo_Lat
actor2_geo_long          Actor2Geo_Long
source_url               SOURCEURL
"""

STAGED: dict[str, str] = dict(line.split() for line in STAGED_FROM.strip().splitlines())


def class_label(quad_class: Column) -> Column:
    label = F.lit(OTHER_LABEL)
    for number, text in reversed(CLASS_LABELS.items()):
        label = F.when(quad_class == number, text).otherwise(label)
    return label


def _parsed(number: str, lenient: bool) -> Column:
    text = F.col(number).cast("string")
    return F.try_to_date(text, "yyyyMMdd") if lenient else F.to_date(text, "yyyyMMdd")


def usable_day() -> Column:
    """The day is given and its digits start with 20."""
    return F.col("Day").isNotNull() & F.col("Day").cast("string").startswith("20")


def stage(
    raw: DataFrame, on_bad_date: str = "fail", dedupe: bool = False, keep: Sequence[str] = ()
) -> DataFrame:
    """Raw events to the 42 staged columns, with the raw columns named in ``keep`` after them.

    ``on_bad_date``: ``fail`` raises on a day number that is no date; ``quarantine``
    leaves such rows out, and ``bad_dates`` returns them. ``dedupe`` keeps the row
    added last for each event id.
    """
    if on_bad_date not in ("fail", "quarantine"):
        raise ValueError(f"on_bad_date must be fail or quarantine, got {on_bad_date!r}")
    lenient = on_bad_date == "quarantine"
    rows = raw.where(usable_day())
    if lenient:
        rows = rows.where(~_has_bad_date())
    computed = {
        "event_date": _parsed("Day", lenient),
        "date_added": _parsed("DATEADDED", lenient),
        "quad_class_label": class_label(F.col("QuadClass")),
    }
    staged = rows.select(*[computed.get(name, F.col(source)).alias(name) for name, source in STAGED.items()], *keep)
    if dedupe:
        staged = deduplicate(staged, ["global_event_id"], newest_first())
    return staged


def newest_first() -> list[Column]:
    """The order in which deliveries of an event are preferred.

    Those that agree in dates and source are told apart by all columns, so every run keeps the same one.
    """
    return [F.desc("date_added"), F.desc("event_date"), F.asc_nulls_last("source_url"), F.xxhash64(*STAGED).asc()]


def _has_bad_date() -> Column:
    def unreadable(column: str) -> Column:
        return F.col(column).isNotNull() & _parsed(column, lenient=True).isNull()

    return unreadable("Day") | unreadable("DATEADDED")


def bad_dates(raw: DataFrame) -> DataFrame:
    """The raw rows that ``stage`` leaves out with ``on_bad_date='quarantine'``."""
    return raw.where(usable_day() & _has_bad_date())
