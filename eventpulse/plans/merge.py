"""Merging a delivery into stored events: an event delivered again is there once, in its newest form."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.reshape import deduplicate
from ..session import cut
from .staging import newest_first

KEY, DATE = "global_event_id", "ingest_date"
# Of two deliveries the one added later stays, then the one of the later event date, then the one loaded last.
AGE = ("date_added", "event_date")


def _age() -> Column:
    return F.struct(*AGE)


def merge_events(
    new: DataFrame, stored: DataFrame | None, loaded: Sequence[date]
) -> tuple[DataFrame, list[date]]:
    """The rows to write, and the dates whose folders they replace; all other folders stay as they are.

    ``new`` has the staged rows of the ``loaded`` dates, which are replaced in any case. Of stored rows of
    other dates only key and age are read, and only those whose key is delivered again go on. A date is
    rewritten if one of its rows is beaten; a delivery that is older than the stored row is left out. Rows
    without an id are never the same event. The driver gets the dates to rewrite, no rows.
    """
    has_key = F.col(KEY).isNotNull()
    once = deduplicate(new.where(has_key), [KEY], newest_first())
    nameless = new.where(~has_key)
    if stored is None:
        return once.unionByName(nameless), sorted(loaded)
    stored = stored.where(~F.col(DATE).isin(list(loaded)))
    ages = once.select(F.col(KEY).alias("new_key"), _age().alias("new_age"))
    again = stored.where(has_key).select(KEY, DATE, _age().alias("age")).join(ages, F.col(KEY) == F.col("new_key"))
    again = cut(again.groupBy(KEY, DATE).agg(F.max("age").alias("age"), F.first("new_age").alias("new_age")))

    # An event may be stored under several dates, from before deliveries were merged: the newest decides.
    verdict = again.groupBy(KEY).agg((F.first("new_age") >= F.max("age")).alias("new_wins"))
    beaten = again.join(verdict.where("new_wins"), KEY).select(F.col(KEY).alias("beaten_key"), F.col(DATE).alias("beaten_date"))
    late = verdict.where("NOT new_wins").select(F.col(KEY).alias("late_key"))
    touched = sorted(r[0] for r in beaten.select("beaten_date").distinct().collect())

    coming = once.join(late, F.col(KEY) == F.col("late_key"), "left_anti").unionByName(nameless)
    if not touched:
        return coming, sorted(loaded)
    same = (F.col(KEY) == F.col("beaten_key")) & (F.col(DATE) == F.col("beaten_date"))
    rest = stored.where(F.col(DATE).isin(touched)).join(beaten, same, "left_anti")
    return rest.unionByName(coming), sorted({*loaded, *touched})
