"""Stored partial aggregates per day, so that a window of days is added up from small rows.

A state holds sums in the parts that can be summed again, counts, and the rows per country and
place of one event date. A run makes the states of the days anew that its deliveries touch; both
marts of any window are then built from the states alone, and equal those built from all events.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.snapshots import Transaction
from .marts import WINDOW_DAYS, added_places, countries_from_places, place_parts, recent, tone_from_parts, tone_parts

TONE, PLACES = "state_tone", "state_places"


def changed_days(deliveries: Iterable[DataFrame | None], rewritten: Sequence[date] | None) -> list[date]:
    """Event dates with rows in the rewritten folders, before or after; one row per day reaches the driver.

    Only the columns that name folders are used. ``None`` means all folders.
    """
    days: set[date] = set()
    for events in deliveries:
        if events is not None:
            some = events if rewritten is None else events.where(F.col("ingest_date").isin(list(rewritten)))
            days |= {r[0] for r in some.select("event_date").distinct().collect()}
    return sorted(d for d in days if d is not None)


def refresh_states(run: Transaction, before: DataFrame | None, after: DataFrame, rewritten: Sequence[date]) -> list[date]:
    """Makes the states of the changed days anew, reading the events of these days only. Returns the days."""
    fresh = run.read(TONE) is None or run.read(PLACES) is None
    days = changed_days([after] if fresh else [before, after], None if fresh else rewritten)
    if days or fresh:
        events = after.where(F.col("event_date").isin(days))
        run.replace_dates(tone_parts(events), TONE, days, "event_date")
        run.replace_dates(place_parts(events, "event_date"), PLACES, days, "event_date")
    return days


def marts_from_states(
    run: Transaction, as_of: date, crosswalk_as_listed: bool = False, days: int = WINDOW_DAYS
) -> tuple[DataFrame, DataFrame]:
    """Both marts for the days before ``as_of``. Folders of other days are not read."""
    tone = tone_from_parts(recent(run.read(TONE), as_of, days))
    return tone, countries_from_places(added_places(recent(run.read(PLACES), as_of, days)), crosswalk_as_listed)
