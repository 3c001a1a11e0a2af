"""Safe arithmetic, weighted means, shares, rounding and bucketing."""

from __future__ import annotations

import functools
import operator
from collections.abc import Sequence
from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnLike = Column | str

# Doubles up to this size are added up in whole units of this many decimals where they are such units.
SUM_DECIMALS = 9
MOST_IN_UNITS = 1e5
_LOW_BITS = 20


def as_column(value: ColumnLike) -> Column:
    return F.col(value) if isinstance(value, str) else value


def _column_list(fields: Sequence[ColumnLike], caller: str) -> list[Column]:
    if isinstance(fields, (str, dict, Column)):
        raise TypeError(f"{caller} takes one list of columns")
    columns = [as_column(f) for f in fields]
    if not columns:
        raise ValueError(f"{caller} needs at least one column")
    return columns


def safe_add(fields: Sequence[ColumnLike]) -> Column:
    """Sum of the columns with NULL counted as zero."""
    terms = [F.coalesce(c, F.lit(0)) for c in _column_list(fields, "safe_add")]
    return functools.reduce(operator.add, terms)


def safe_subtract(fields: Sequence[ColumnLike]) -> Column:
    """First column minus the others with NULL counted as zero."""
    terms = [F.coalesce(c, F.lit(0)) for c in _column_list(fields, "safe_subtract")]
    return functools.reduce(operator.sub, terms)


def safe_divide(numerator: ColumnLike, denominator: ColumnLike) -> Column:
    """Quotient, NULL when the denominator is zero."""
    return F.try_divide(as_column(numerator), as_column(denominator))


def round_half_away(value: ColumnLike, places: int) -> Column:
    """Round a double half away from zero by plain arithmetic, so other engines give the same digits.

    Doubles too large to have a fraction at this scale are returned as they are.
    """
    x = as_column(value).cast("double")
    scale = float(10**places)
    scaled = F.abs(x) * F.lit(scale) + F.lit(0.5)
    return F.when(scaled < F.lit(2.0**52), F.signum(x) * F.floor(scaled) / F.lit(scale)).otherwise(x)


def sum_parts(value: ColumnLike) -> tuple[Column, Column, Column]:
    """The aggregates that ``joined_sum`` turns into a sum; parts may be summed again in between.

    A plain sum of doubles depends on the order of the rows, and a decimal sum
    costs several times as much. Here a value of up to 1e5 that is a number of whole
    units of 1e-9, to a double's own precision, is split into high and low bits of
    that number, and both are summed as integers, which is exact below 9e10 rows in a
    group. Any other value (smaller, larger or finer) is added as the double it is.
    """
    x = as_column(value).cast("double")
    scale = F.lit(float(10**SUM_DECIMALS))
    in_range = F.abs(x) <= F.lit(MOST_IN_UNITS)
    rounded = F.rint(F.when(in_range, x) * scale)
    whole = in_range & (F.abs(rounded / scale - x) <= F.abs(x) * F.lit(1e-15))
    units = F.when(whole, rounded).cast("bigint")
    low_bits = F.lit((1 << _LOW_BITS) - 1)
    return F.sum(F.shiftright(units, _LOW_BITS)), F.sum(units.bitwiseAND(low_bits)), F.sum(F.when(~whole, x))


def joined_sum(high: Column, low: Column, rest: Column) -> Column:
    """The sum from summed parts, NULL when there is none."""
    units = high.cast("decimal(20,0)") * F.lit(1 << _LOW_BITS) + low
    exact = (units.cast("decimal(28,0)") * F.lit(Decimal(1).scaleb(-SUM_DECIMALS))).cast("double")
    return F.coalesce(exact + rest, exact, rest)


def exact_sum(value: ColumnLike) -> Column:
    """Sum of doubles of any size. Of ordinary decimal numbers it is the same in whatever order the rows come."""
    return joined_sum(*sum_parts(value))


def mean(value: ColumnLike) -> Column:
    """Average over the non-NULL rows."""
    return F.try_divide(exact_sum(value), F.count(as_column(value)))


def weighted_mean(value: ColumnLike, weight: ColumnLike) -> Column:
    """Sum of value times weight over the sum of weights; NULL when the weights add to zero.

    A row whose value is NULL still adds its weight to the divisor, as the marts define it.
    """
    x, w = as_column(value), as_column(weight)
    return F.try_divide(exact_sum(x.cast("double") * w), F.sum(w).cast("double"))


def share_pct(condition: Column) -> Column:
    """Rows meeting the condition as a percentage of all rows in the group."""
    return F.count_if(condition) / F.count(F.lit(1)) * F.lit(100)


def width_bucket(value: ColumnLike, low: ColumnLike, high: ColumnLike, buckets: int | Column) -> Column:
    """Equal-width bucket number: 0 below the range, ``buckets + 1`` from the upper bound on."""
    n = F.lit(buckets) if isinstance(buckets, int) else buckets
    bounds = [F.lit(float(b)) if isinstance(b, (int, float)) else as_column(b).cast("double") for b in (low, high)]
    return F.width_bucket(as_column(value).cast("double"), *bounds, n)
