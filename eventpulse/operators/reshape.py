"""Reshaping: pivot, unpivot, schema-tolerant union, star, de-duplication, column clean-up."""

from __future__ import annotations

import functools
from collections.abc import Callable, Mapping, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.numbers import ColumnLike, as_column
from ..functions.text import empty_to_null, slugify

# Fixed value: default name of the column that tells which input a row came from.
SOURCE_COLUMN = "_dbt_source_relation"

_COMPARISONS: dict[str, Callable[[Column, Column], Column]] = {
    "=": lambda a, b: a == b,
    "!=": lambda a, b: a != b,
    "<>": lambda a, b: a != b,
    "<": lambda a, b: a < b,
    "<=": lambda a, b: a <= b,
    ">": lambda a, b: a > b,
    ">=": lambda a, b: a >= b,
    "like": lambda a, b: F.like(a, b),
    "ilike": lambda a, b: F.ilike(a, b),
}

_DISTINCT = {"sum": F.sum_distinct, "count": F.count_distinct, "min": F.min, "max": F.max}


def quoted_name(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def quoted(name: str) -> Column:
    """A column by its exact name, whatever characters it holds."""
    return F.col(quoted_name(name))


def _lower(names: Sequence[str]) -> set[str]:
    return {n.lower() for n in names}


def pivot_columns(
    column: ColumnLike,
    values: Sequence[Any],
    agg: str = "sum",
    cmp: str = "=",
    prefix: str = "",
    suffix: str = "",
    then_value: Any = 1,
    else_value: Any = 0,
    alias: bool = True,
    quote_identifiers: bool = True,
    distinct: bool = False,
) -> list[Column]:
    """One conditional aggregate per value, to be used in ``groupBy(...).agg(*...)``.

    ``then_value`` and ``else_value`` may be literals or columns. With
    ``quote_identifiers`` off, the result names are made plain with ``slugify``.
    """
    if cmp.lower() not in _COMPARISONS:
        raise ValueError(f"cmp must be one of {sorted(_COMPARISONS)}, got {cmp!r}")
    compare = _COMPARISONS[cmp.lower()]
    if distinct and agg not in _DISTINCT:
        raise ValueError(f"with distinct, agg must be one of {sorted(_DISTINCT)}, got {agg!r}")
    aggregate = _DISTINCT[agg] if distinct else getattr(F, agg)
    columns = []
    for value in values:
        result = aggregate(F.when(compare(as_column(column), F.lit(value)), then_value).otherwise(else_value))
        if alias:
            name = f"{prefix}{value}{suffix}"
            result = result.alias(name if quote_identifiers else slugify(name))
        columns.append(result)
    return columns


def pivot(df: DataFrame, group_by: Sequence[str], column: ColumnLike, values: Sequence[Any], **options) -> DataFrame:
    """Rows to columns for a known list of values: a single pass with map-side aggregation."""
    return df.groupBy(*group_by).agg(*pivot_columns(column, values, **options))


def unpivot(
    df: DataFrame,
    cast_to: str = "string",
    exclude: Sequence[str] = (),
    remove: Sequence[str] = (),
    field_name: str = "field_name",
    value_name: str = "value",
) -> DataFrame:
    """Columns to rows. ``exclude`` columns are kept beside each value, ``remove`` columns are dropped."""
    kept, dropped = _lower(exclude), _lower(remove)
    by_lower = {c.lower(): c for c in df.columns}
    ids = [by_lower[c.lower()] for c in exclude]
    values = [c for c in df.columns if c.lower() not in kept | dropped]
    return df.unpivot(
        [quoted(c) for c in ids],
        [quoted(c).cast(cast_to).alias(c) for c in values],
        field_name,
        value_name,
    )


def union_relations(
    relations: Mapping[str, DataFrame],
    column_override: Mapping[str, str] | None = None,
    include: Sequence[str] = (),
    exclude: Sequence[str] = (),
    source_column_name: str | None = SOURCE_COLUMN,
    where: ColumnLike | None = None,
) -> DataFrame:
    """UNION ALL of tables with differing columns; a column a table lacks is NULL for its rows.

    Names are compared without regard to case. Columns keep the order in which they are first seen. The type is the first
    seen one unless ``column_override`` names another.
    """
    if include and exclude:
        raise ValueError("give include or exclude, not both")
    wanted, unwanted = _lower(include), _lower(exclude)
    superset: dict[str, tuple[str, T.DataType | str]] = {}
    for df in relations.values():
        for field in df.schema:
            key = field.name.lower()
            if key not in unwanted and (not wanted or key in wanted):
                superset.setdefault(key, (field.name, field.dataType))
    if not superset:
        raise ValueError(f"no columns to union for {', '.join(relations)}")
    for name, kind in (column_override or {}).items():
        if name.lower() in superset:
            superset[name.lower()] = (superset[name.lower()][0], kind)

    parts = []
    for source, df in relations.items():
        rows = df if where is None else df.where(where)
        present = _lower(df.columns)
        columns = [
            (quoted(name) if key in present else F.lit(None)).cast(kind).alias(name)
            for key, (name, kind) in superset.items()
        ]
        if source_column_name is not None:
            columns.insert(0, F.lit(source).alias(source_column_name))
        parts.append(rows.select(*columns))
    return functools.reduce(DataFrame.unionAll, parts)


def filtered_columns(df: DataFrame, exclude: Sequence[str] = ()) -> list[str]:
    """Column names of ``df`` without the excluded ones, ignoring case."""
    unwanted = _lower(exclude)
    return [c for c in df.columns if c.lower() not in unwanted]


def star(
    df: DataFrame, exclude: Sequence[str] = (), prefix: str = "", suffix: str = "", relation_alias: str | None = None
) -> list[Column]:
    """All columns but the excluded ones, renamed with a prefix and suffix, for use in ``select``."""
    qualifier = f"{relation_alias}." if relation_alias else ""
    return [
        F.col(f"{qualifier}{quoted_name(c)}").alias(f"{prefix}{c}{suffix}") for c in filtered_columns(df, exclude)
    ]


def deduplicate(df: DataFrame, partition_by: Sequence[ColumnLike], order_by: Sequence[ColumnLike]) -> DataFrame:
    """The first row of each group in the given order.

    The rank filter lets Spark keep one row per group and input partition before
    the shuffle, so a group holding much of the table costs no more than others.
    """
    order = W.partitionBy(*partition_by).orderBy(*order_by)
    return df.withColumn("_row", F.row_number().over(order)).where("_row = 1").drop("_row")


def nullcheck_table(df: DataFrame) -> DataFrame:
    """'' becomes NULL in every text column."""
    return df.select(*[empty_to_null(f) for f in df.schema])


def group_by_n(df: DataFrame, n: int):
    """Grouping by the first ``n`` columns."""
    if not 1 <= n <= len(df.columns):
        raise ValueError(f"n must be between 1 and {len(df.columns)}")
    return df.groupBy(*[quoted(c) for c in df.columns[:n]])
