"""Data-quality checks.

Each function returns a ``Check``: a frame of violations and an aggregate that
counts failures over it. The frames are lazy, but for the two checks of order within
a table: these deal the table out in ranges, and write it so, when they are called. Where many rows can violate in the same way, the
frame holds one row per distinct violation and ``n_rows`` says how many rows it
stands for, so a value that fills a third of the table is not sent to one task.
A condition that is NULL is not a violation.
"""

from __future__ import annotations

import functools
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field, replace
from datetime import datetime
from typing import Any

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.numbers import ColumnLike, as_column
from .neighbours import with_next
from .reshape import filtered_columns, quoted, quoted_name


def _row_count() -> Column:
    return F.count(F.lit(1))


def _total(column: str) -> Column:
    return F.coalesce(F.sum(column), F.lit(0))


@dataclass(frozen=True)
class Check:
    """Violations of one rule and how they are judged.

    ``error_if`` and ``warn_if`` are comparisons of the failure count, such as
    ``!= 0`` or ``< 1``. A check of severity ``warn`` never errors. A check that
    only filters rows also names its ``source`` and ``condition``, so that all
    such checks of one table can be counted in a single scan.
    """

    name: str
    violations: DataFrame
    column: str | None = None
    relation: str | None = None
    failures: Column = field(default_factory=_row_count)
    severity: str = "error"
    error_if: str = "!= 0"
    warn_if: str = "!= 0"
    source: DataFrame | None = None
    condition: Column | None = None

    def configured(self, **changes) -> Check:
        """The same check with another name, relation, severity or threshold."""
        return replace(self, **changes)


def _filter_check(name: str, source: DataFrame, condition: Column, column: str | None) -> Check:
    return Check(name, source.where(condition), column, source=source, condition=condition)


def _summary_row(check: Check, failures: Column) -> Column:
    if check.severity not in ("warn", "error"):
        raise ValueError(f"severity must be warn or error, got {check.severity!r}")
    return F.struct(
        F.lit(check.name).alias("check_name"),
        F.lit(check.relation).cast("string").alias("relation"),
        F.lit(check.column).cast("string").alias("column_name"),
        F.coalesce(failures, F.lit(0)).cast("bigint").alias("failures"),
        F.lit(check.severity).alias("severity"),
        F.lit(check.warn_if).alias("_warn_if"),
        F.lit(check.error_if).alias("_error_if"),
    )


def summarise(checks: Sequence[Check]) -> DataFrame:
    """One row per check: failures, whether it warns or errors, and its status. One Spark job for all."""
    filters: dict[int, list[Check]] = {}
    parts = []
    for check in checks:
        if check.condition is not None:
            filters.setdefault(id(check.source), []).append(check)
        else:
            parts.append(check.violations.agg(check.failures.alias("n")).select(_summary_row(check, F.col("n")).alias("r")))
    for group in filters.values():
        counts = group[0].source.agg(*[F.count_if(c.condition).alias(f"n{i}") for i, c in enumerate(group)])
        rows = F.array(*[_summary_row(c, F.col(f"n{i}")) for i, c in enumerate(group)])
        parts.append(counts.select(F.explode(rows).alias("r")))
    summary = functools.reduce(DataFrame.unionAll, parts).select("r.*")

    def judged(threshold: str, texts: set[str]) -> Column:
        result = F.lit(None).cast("boolean")
        for text in sorted(texts):
            result = F.when(F.col(threshold) == text, F.expr(f"failures {text}")).otherwise(result)
        return result

    summary = summary.withColumn("should_warn", judged("_warn_if", {c.warn_if for c in checks}))
    summary = summary.withColumn("should_error", judged("_error_if", {c.error_if for c in checks}))
    status = (
        F.when((F.col("severity") == "error") & F.col("should_error"), "error")
        .when(F.col("should_warn"), "warn")
        .otherwise("pass")
    )
    return summary.withColumn("status", status).drop("_warn_if", "_error_if")


class Observed:
    """Checks that only filter rows, counted while their table is written, without another scan of it.

    Counts are taken in the stage that writes, whose tasks count once however often they are tried.
    """

    def __init__(self, checks: Sequence[Check]):
        self.checks = list(checks)
        self.observation = Observation()
        self._asked = [c for c in self.checks if c.condition is not None]

    def on(self, df: DataFrame) -> DataFrame:
        """The rows, with the counts attached to whatever action runs over them first."""
        if not self._asked:
            return df
        return df.observe(self.observation, *[F.count_if(c.condition).alias(f"n{i}") for i, c in enumerate(self._asked)])

    def told(self, stored: DataFrame, checks_of: Callable[[DataFrame], Sequence[Check]]) -> list[Check]:
        """The checks of the stored table, those that were counted with their counts; call it after the write."""
        counts = self.observation.get if self._asked else {}
        places = {id(c): f"n{i}" for i, c in enumerate(self._asked)}
        out = []
        for before, check in zip(self.checks, checks_of(stored), strict=True):
            if id(before) in places:
                number = stored.sparkSession.range(1).select(F.lit(counts[places[id(before)]]).cast("bigint").alias("n_rows"))
                check = replace(check, violations=number, failures=F.sum("n_rows"), source=None, condition=None)
            out.append(check)
        return out


def _scope(df: DataFrame, where: ColumnLike | None) -> DataFrame:
    return df if where is None else df.where(where)


def _grouped(df: DataFrame, group_by: Sequence[str], *aggregates: Column) -> DataFrame:
    return df.groupBy(*map(quoted, group_by)).agg(*aggregates) if group_by else df.agg(*aggregates)


def _moment_type(df: DataFrame, column: str) -> str:
    """The timestamp type to compare a column in: instants stay instants, dates and clock readings have no zone."""
    return "timestamp" if isinstance(df.schema[column].dataType, T.TimestampType) else "timestamp_ntz"


# --- one row at a time: a filter, no shuffle ---------------------------------


def not_null(df: DataFrame, column: str, where: ColumnLike | None = None) -> Check:
    return _filter_check("not_null", _scope(df, where), quoted(column).isNull(), column)


def expression_is_true(
    df: DataFrame, expression: str | Column, column: str | None = None, where: ColumnLike | None = None
) -> Check:
    """Rows where the expression is false. With a column, a text expression continues it, as in ``+ b = 1``."""
    if isinstance(expression, Column):
        condition = expression
    else:
        condition = F.expr(expression if column is None else f"{quoted_name(column)} {expression}")
    return _filter_check("expression_is_true", _scope(df, where), ~condition, column)


def accepted_range(
    df: DataFrame,
    column: str,
    min_value: Any = None,
    max_value: Any = None,
    inclusive: bool = True,
    where: ColumnLike | None = None,
) -> Check:
    """Rows outside the bounds. A bound may be a literal or a column."""
    value, outside = quoted(column), F.lit(False)
    if min_value is not None:
        outside = outside | ((value < min_value) if inclusive else (value <= min_value))
    if max_value is not None:
        outside = outside | ((value > max_value) if inclusive else (value >= max_value))
    return _filter_check("accepted_range", _scope(df, where), outside, column)


def not_empty_string(
    df: DataFrame, column: str, trim_whitespace: bool = True, where: ColumnLike | None = None
) -> Check:
    text = F.trim(quoted(column)) if trim_whitespace else quoted(column)
    check = _filter_check("not_empty_string", _scope(df, where), text == "", column)
    return replace(check, violations=check.violations.select(text.alias(column)))


# --- one aggregate -----------------------------------------------------------


def unique(df: DataFrame, column: str, where: ColumnLike | None = None) -> Check:
    rows = _scope(df, where).where(quoted(column).isNotNull())
    counted = rows.groupBy(quoted(column).alias("unique_field")).agg(_row_count().alias("n_records"))
    return Check("unique", counted.where("n_records > 1"), column)


def unique_combination_of_columns(
    df: DataFrame, columns: Sequence[str], where: ColumnLike | None = None
) -> Check:
    """Combinations that occur more than once; NULLs count as equal."""
    counted = _scope(df, where).groupBy(*map(quoted, columns)).agg(_row_count().alias("n_records"))
    return Check("unique_combination_of_columns", counted.where("n_records > 1").select(*map(quoted, columns)), ", ".join(columns))


def accepted_values(df: DataFrame, column: str, values: Sequence[Any], where: ColumnLike | None = None) -> Check:
    """Values outside the list with their row counts."""
    counted = (
        _scope(df, where).groupBy(quoted(column).alias("value_field")).agg(_row_count().alias("n_records"))
    )
    return Check("accepted_values", counted.where(~F.col("value_field").isin(list(values))), column)


def not_accepted_values(df: DataFrame, column: str, values: Sequence[Any], where: ColumnLike | None = None) -> Check:
    rows = _scope(df, where).select(quoted(column).alias("value_field"))
    return Check("not_accepted_values", rows.where(F.col("value_field").isin(list(values))).distinct(), column)


def at_least_one(
    df: DataFrame, column: str, group_by: Sequence[str] = (), where: ColumnLike | None = None
) -> Check:
    """Groups, or the whole table, without any value in the column."""
    rows = _scope(df, where)
    if not group_by:
        rows = rows.select(quoted(column)).where(quoted(column).isNotNull()).limit(1)
    counted = _grouped(rows, group_by, F.count(quoted(column)).alias("n_values"))
    return Check("at_least_one", counted.where("n_values = 0"), column)


def not_constant(
    df: DataFrame, column: str, group_by: Sequence[str] = (), where: ColumnLike | None = None
) -> Check:
    """Groups holding a single distinct value; groups of only NULLs pass.

    One distinct value means that least and greatest are equal, which needs no
    shuffle of the values themselves.
    """
    ends = _grouped(_scope(df, where), group_by, F.min(quoted(column)).alias("_least"), F.max(quoted(column)).alias("_greatest"))
    constant = ends.where(F.col("_least") == F.col("_greatest"))
    return Check("not_constant", constant.select(*map(quoted, group_by), F.col("_least").alias("constant_value")), column)


def not_null_proportion(
    df: DataFrame,
    column: str,
    at_least: float,
    at_most: float = 1.0,
    group_by: Sequence[str] = (),
    where: ColumnLike | None = None,
) -> Check:
    share = F.try_divide(F.count(quoted(column)), _row_count()).alias("not_null_proportion")
    shares = _grouped(_scope(df, where), group_by, share)
    outside = (F.col("not_null_proportion") < at_least) | (F.col("not_null_proportion") > at_most)
    return Check("not_null_proportion", shares.where(outside), column)


def recency(
    df: DataFrame,
    column: str,
    datepart: str,
    interval: int,
    now: datetime,
    ignore_time_component: bool = False,
    group_by: Sequence[str] = (),
    where: ColumnLike | None = None,
) -> Check:
    """Groups whose latest value is older than ``interval`` units before ``now``; an empty table passes.

    ``now`` is a clock reading in the session's time zone.
    """
    moment = _moment_type(df, column)
    kind = "date" if ignore_time_component else moment
    latest = _grouped(_scope(df, where), group_by, F.max(quoted(column)).cast(kind).alias("most_recent"))
    threshold = F.timestamp_add(datepart.upper(), F.lit(-interval), F.lit(now.isoformat()).cast(moment)).cast(kind)
    late = latest.withColumn("threshold", threshold).where("most_recent < threshold")
    return Check("recency", late, column)


def expected_columns(df: DataFrame, columns: Sequence[str]) -> Check:
    """Columns that are missing from the table or not expected in it, ignoring case."""
    found, wanted = {c.lower() for c in df.columns}, {c.lower() for c in columns}
    rows = [(c, "missing") for c in sorted(wanted - found)] + [(c, "unexpected") for c in sorted(found - wanted)]
    violations = df.sparkSession.createDataFrame(rows, "column_name string, problem string")
    return Check("expected_columns", violations)


# --- two tables: one pass over their union, no join --------------------------


def _both_counts(df: DataFrame, other: DataFrame, group_by: Sequence[str]) -> DataFrame:
    """Row counts of two tables per group, NULL where a table has no row in the group."""
    sides = df.select(*map(quoted, group_by), F.lit(1).alias("_side")).unionAll(
        other.select(*map(quoted, group_by), F.lit(2).alias("_side"))
    )
    counted = _grouped(
        sides,
        group_by,
        F.nullif(F.count_if(F.col("_side") == 1), F.lit(0)).alias("count_a"),
        F.nullif(F.count_if(F.col("_side") == 2), F.lit(0)).alias("count_b"),
    )
    return counted


def _compared_counts(df, other, group_by, strict_groups) -> DataFrame:
    """``_both_counts`` with the counts that are not compared set to NULL.

    A group found in one table only, or whose key holds a NULL, is compared only
    with ``strict_groups``; so is a whole table against an empty one.
    """
    counts = _both_counts(df, other, group_by)
    if strict_groups:
        return counts.fillna(0, ["count_a", "count_b"])
    if not group_by:
        return counts
    whole = functools.reduce(lambda a, b: a & b, [quoted(g).isNotNull() for g in group_by])
    return counts.withColumn("count_a", F.when(whole, F.col("count_a")))


def equal_rowcount(
    df: DataFrame,
    other: DataFrame,
    group_by: Sequence[str] = (),
    strict_groups: bool = False,
    where: ColumnLike | None = None,
) -> Check:
    """Row counts of two tables per group and their difference; failures are the summed differences."""
    counts = _compared_counts(_scope(df, where), other, group_by, strict_groups)
    compared = counts.withColumn("diff_count", F.abs(F.col("count_a") - F.col("count_b")))
    return Check("equal_rowcount", compared, failures=_total("diff_count"))


def fewer_rows_than(
    df: DataFrame,
    other: DataFrame,
    group_by: Sequence[str] = (),
    strict_groups: bool = False,
    where: ColumnLike | None = None,
) -> Check:
    """Failures: the surplus of rows per group, and one where the counts are equal."""
    counts = _compared_counts(_scope(df, where), other, group_by, strict_groups)
    surplus = F.col("count_a") - F.col("count_b")
    delta = F.when(surplus > 0, surplus).when(surplus == 0, F.lit(1).cast("bigint")).otherwise(F.lit(0).cast("bigint"))
    return Check("fewer_rows_than", counts.withColumn("row_count_delta", delta), failures=_total("row_count_delta"))


def cardinality_equality(
    df: DataFrame, column: str, other: DataFrame, other_column: str, where: ColumnLike | None = None
) -> Check:
    """Values whose row counts differ between two columns: one row for each side that has the value."""
    counts = _both_counts(
        _scope(df, where).select(quoted(column).alias("value_field")),
        other.select(quoted(other_column).alias("value_field")),
        ["value_field"],
    )
    differing = counts.where(~F.col("count_a").eqNullSafe(F.col("count_b")))
    sides = differing.unpivot("value_field", ["count_a", "count_b"], "side", "num_rows")
    return Check(
        "cardinality_equality", sides.where("num_rows IS NOT NULL").select("value_field", "num_rows"), column
    )


def equality(
    df: DataFrame,
    other: DataFrame,
    compare_columns: Sequence[str] | None = None,
    exclude_columns: Sequence[str] | None = None,
    precision: int | None = None,
    where: ColumnLike | None = None,
) -> Check:
    """Distinct rows found in only one of two tables.

    Failures are these rows plus the imbalance between the two directions.
    Numbers are rounded to ``precision`` decimals first when it is given: as decimals
    of nine places, as the warehouse does, or of as many as a greater precision needs.
    """
    if precision is not None and not 0 <= precision <= 18:
        raise ValueError(f"precision must be between 0 and 18, got {precision}")
    if compare_columns and exclude_columns:
        raise ValueError("give compare_columns or exclude_columns, not both")
    if compare_columns:
        columns = list(compare_columns)
    else:
        columns = filtered_columns(df, exclude_columns or ())
        if {c.lower() for c in columns} != {c.lower() for c in filtered_columns(other, exclude_columns or ())}:
            raise ValueError("the tables have different columns: name the ones to compare or to exclude")

    types = {f.name.lower(): f.dataType for f in df.schema}

    def side(frame: DataFrame, number: int) -> DataFrame:
        chosen = []
        for name in columns:
            value = quoted(name)
            if precision is not None and isinstance(types[name.lower()], T.NumericType):
                value = F.round(value.cast(f"decimal(38,{max(9, precision)})"), precision)
            chosen.append(value.alias(name))
        return frame.select(
            *chosen, F.lit(number == 1).alias("_in_a"), F.lit(number == 2).alias("_in_b")
        )

    both = side(_scope(df, where), 1).unionAll(side(other, 2))
    found = both.groupBy(*[quoted(c) for c in columns]).agg(
        F.bool_or("_in_a").alias("_in_a"), F.bool_or("_in_b").alias("_in_b")
    )
    one_sided = found.where(F.col("_in_a") != F.col("_in_b")).select(
        F.when(F.col("_in_a"), "a_minus_b").otherwise("b_minus_a").alias("which_diff"), *[quoted(c) for c in columns]
    )
    in_a = F.count_if(F.col("which_diff") == "a_minus_b")
    in_b = F.count_if(F.col("which_diff") == "b_minus_a")
    return Check("equality", one_sided, failures=_row_count() + F.abs(in_a - in_b))


def relationships_where(
    df: DataFrame,
    column: str,
    to: DataFrame,
    to_column: str,
    from_condition: ColumnLike | None = None,
    to_condition: ColumnLike | None = None,
) -> Check:
    """Values without a partner in the other table, with the number of rows that hold them.

    Both sides are reduced to one row per value before the join, so a frequent value does not weigh on it.
    """
    left = _scope(df, from_condition).select(quoted(column).alias("id")).where("id IS NOT NULL")
    right = _scope(to, to_condition).select(quoted(to_column).alias("id")).where("id IS NOT NULL").distinct()
    counted = left.groupBy("id").agg(_row_count().alias("n_rows"))
    return Check("relationships_where", counted.join(right, "id", "left_anti"), column, failures=_total("n_rows"))


# --- order within a table ----------------------------------------------------


def sequential_values(
    df: DataFrame,
    column: str,
    interval: int | float = 1,
    datepart: str | None = None,
    group_by: Sequence[str] = (),
    where: ColumnLike | None = None,
) -> Check:
    """Values that are not exactly ``interval`` after the one before them in their group.

    Copies of a value follow each other with a distance of zero; ``n_rows``
    counts the rows that share a value and a predecessor. Equal rows are counted
    first and distinct ones put in order by ranges, so no group is too large.
    """
    group, previous = list(group_by), f"previous_{column}"
    names = [quoted(g) for g in group]
    rows = _scope(df, where).where(quoted(column).isNotNull())
    counted = rows.groupBy(*names, quoted(column)).agg(_row_count().alias("n_rows"))
    placed = with_next(counted, group, [column])
    one = F.lit(1).cast("bigint").alias("n_rows")
    steps = placed.where("NOT is_last").select(
        *names, F.col("next_value").alias(column), quoted(column).alias(previous), one
    )
    copies = placed.where("n_rows > 1").select(
        *names, quoted(column), quoted(column).alias(previous), (F.col("n_rows") - 1).alias("n_rows")
    )
    steps = steps.unionAll(copies)
    if datepart:
        moment = _moment_type(df, column)
        expected = F.timestamp_add(datepart.upper(), F.lit(interval), quoted(previous).cast(moment))
        in_step = quoted(column).cast(moment) == expected
    else:
        in_step = quoted(column) == quoted(previous) + F.lit(interval)
    return Check("sequential_values", steps.where(~in_step), column, failures=_total("n_rows"))


# How an upper bound may relate to the next lower bound.
_GAPS = {
    "not_allowed": lambda upper, following: upper == following,
    "allowed": lambda upper, following: upper <= following,
    "required": lambda upper, following: upper < following,
}


def mutually_exclusive_ranges(
    df: DataFrame,
    lower_bound: ColumnLike,
    upper_bound: ColumnLike,
    partition_by: ColumnLike | None = None,
    gaps: str = "allowed",
    zero_length_range_allowed: bool = False,
    where: ColumnLike | None = None,
) -> Check:
    """Ranges that are empty or reversed, or that do not end as ``gaps`` asks before the next one starts.

    Bounds and group may be columns or expressions. Ranges are ordered by lower, then
    upper bound. ``n_rows`` counts equal violations. Equal ranges are counted first and
    distinct ones put in order by ranges of the table, so no group is too large.
    """
    if gaps not in _GAPS:
        raise ValueError(f"gaps must be one of {sorted(_GAPS)}, got {gaps!r}")
    group = ["partition_by_col"] if partition_by is not None else []
    keys = [as_column(partition_by).alias("partition_by_col")] if group else []
    ranges = _scope(df, where).select(
        *keys, as_column(lower_bound).alias("lower_bound"), as_column(upper_bound).alias("upper_bound")
    )
    counted = ranges.groupBy(*ranges.columns).agg(_row_count().alias("n_rows"))
    placed = with_next(counted, group, ["lower_bound", "upper_bound"])
    lower, upper, n_rows = F.col("lower_bound"), F.col("upper_bound"), F.col("n_rows")
    # Of equal ranges, all but the last are followed by their own lower bound.
    like_copies = ~F.col("is_last") & F.col("next_value").eqNullSafe(lower)

    def follower(bound: Column, last: Column, n: Column) -> Column:
        return F.struct(
            bound.alias("next_lower_bound"), last.alias("is_last_record"), n.cast("bigint").alias("n_rows")
        )

    last_copy = follower(F.col("next_value"), F.col("is_last"), F.when(like_copies, n_rows).otherwise(F.lit(1)))
    others = F.when(~like_copies & (n_rows > 1), follower(lower, F.lit(False), n_rows - 1))
    rows = placed.select(*ranges.columns, F.explode(F.array_compact(F.array(last_copy, others))).alias("f"))
    rows = rows.select(*ranges.columns, "f.*")
    has_length = F.coalesce((lower <= upper) if zero_length_range_allowed else (lower < upper), F.lit(False))
    ends_before = F.coalesce(_GAPS[gaps](upper, F.col("next_lower_bound")), F.col("is_last_record"))
    checked = rows.withColumn("has_length", has_length).withColumn("ends_before_next", ends_before)
    return Check(
        "mutually_exclusive_ranges",
        checked.where(~(F.col("has_length") & F.col("ends_before_next"))),
        lower_bound if isinstance(lower_bound, str) else None,
        failures=_total("n_rows"),
    )
