"""Number series and date spines, generated on the executors."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_CLOCK_UNITS = ("hour", "minute", "second")
_UNITS = ("year", "quarter", "month", "week", "day", *_CLOCK_UNITS)

Moment = date | datetime | str | Column


def _moment(value: Moment) -> Column:
    """A point in time without a zone, so that no unit is longer or shorter where clocks change."""
    if isinstance(value, (date, datetime)):
        value = value.isoformat()
    column = value if isinstance(value, Column) else F.lit(value)
    return column.cast("timestamp_ntz")


def _unit(datepart: str) -> str:
    unit = datepart.lower()
    if unit not in _UNITS:
        raise ValueError(f"datepart must be one of {_UNITS}, got {datepart!r}")
    return unit


def _week_start(moment: Column) -> Column:
    """The Sunday on or before the moment."""
    day = moment.cast("date")
    return F.date_sub(day, F.dayofweek(day) - 1)


def intervals_between(start: Moment, end: Moment, datepart: str) -> Column:
    """How many boundaries of the unit lie between two moments; weeks start on Sunday."""
    unit, lo, hi = _unit(datepart), _moment(start), _moment(end)
    days = F.date_diff(hi.cast("date"), lo.cast("date"))
    years = F.year(hi) - F.year(lo)
    if unit == "year":
        count = years
    elif unit == "quarter":
        count = years * 4 + F.quarter(hi) - F.quarter(lo)
    elif unit == "month":
        count = years * 12 + F.month(hi) - F.month(lo)
    elif unit == "week":
        count = F.date_diff(_week_start(hi), _week_start(lo)) / 7
    else:
        count = days.cast("bigint")
        if unit in _CLOCK_UNITS:
            count = count * 24 + F.hour(hi) - F.hour(lo)
        if unit in ("minute", "second"):
            count = count * 60 + F.minute(hi) - F.minute(lo)
        if unit == "second":
            count = count * 60 + F.second(hi) - F.second(lo)
    return count.cast("bigint")


def generate_series(spark: SparkSession, upper_bound: int) -> DataFrame:
    """The numbers 1 to ``upper_bound`` in a column ``generated_number``."""
    if upper_bound <= 0:
        raise ValueError(f"upper_bound must be positive, got {upper_bound}")
    return spark.range(1, upper_bound + 1).withColumnRenamed("id", "generated_number")


def date_spine(spark: SparkSession, datepart: str, start: Moment, end: Moment) -> DataFrame:
    """One row per unit from ``start``, ending before ``end``, in a column ``date_<unit>``.

    Dates for units of a day and longer when the start is a date, otherwise timestamps.
    """
    unit = _unit(datepart)
    if unit == "day" and all(isinstance(x, date) and not isinstance(x, datetime) for x in (start, end)):
        count = (end - start).days
    else:
        count = spark.range(1).select(intervals_between(start, end, unit).alias("n")).first().n
    steps = generate_series(spark, count or 0).select((F.col("generated_number") - 1).cast("int").alias("step"))
    column = f"date_{unit}"
    spine = steps.select(F.timestamp_add(unit.upper(), F.col("step"), _moment(start)).alias(column))
    spine = spine.where(F.col(column) <= _moment(end))
    whole_days = unit not in _CLOCK_UNITS and isinstance(start, date) and not isinstance(start, datetime)
    return spine.withColumn(column, F.col(column).cast("date")) if whole_days else spine
