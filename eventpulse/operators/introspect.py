"""Small results about tables: a column's values, one cell, column lists, table listings."""

from __future__ import annotations

import re
from collections.abc import Sequence
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .reshape import quoted

# Names the catalog gives a table kind, and the plain kind they stand for.
TABLE_KINDS = {
    "MANAGED": "table",
    "BASE TABLE": "table",
    "EXTERNAL TABLE": "external",
    "MATERIALIZED VIEW": "materializedview",
}


def _table(spark: SparkSession | None, table: DataFrame | str) -> DataFrame | None:
    if isinstance(table, DataFrame):
        return table
    return spark.table(table) if spark.catalog.tableExists(table) else None


def column_values(
    df: DataFrame,
    column: str,
    order_by: Sequence[Column | str] = (),
    max_records: int | None = None,
    where: Column | str | None = None,
) -> DataFrame:
    """Distinct values of a column with their row counts, most frequent first and ties by value.

    Another order may use ``value`` and ``n_records``.
    """
    rows = df if where is None else df.where(where)
    counted = rows.groupBy(quoted(column).alias("value")).agg(F.count(F.lit(1)).alias("n_records"))
    ranked = counted.orderBy(*(order_by or [F.desc("n_records"), F.asc_nulls_last("value")]))
    return ranked if max_records is None else ranked.limit(max_records)


def get_column_values(
    spark: SparkSession, table: DataFrame | str, column: str, default: list | None = None, **options
) -> list | None:
    """``column_values`` as a Python list; the default when the table is missing or has no rows.

    The list comes to the driver whole: ``max_records`` bounds it, and ``column_values``
    gives the same as a frame of any size.
    """
    df = _table(spark, table)
    if df is None:
        if default is None:
            raise ValueError(f"table {table} does not exist and there is no default")
        return default
    values = [row.value for row in column_values(df, column, **options).collect()]
    return values or default


def get_single_value(df: DataFrame, default: Any = None) -> Any:
    """First column of the first row, or the default when there are no rows."""
    row = df.select(quoted(df.columns[0])).first()
    return default if row is None else row[0]


def get_query_results_as_dict(df: DataFrame, max_records: int | None = None) -> dict[str, list]:
    """A result as one list per column. All its rows come to the driver, or ``max_records`` of them."""
    rows = (df if max_records is None else df.limit(max_records)).collect()
    return {name: [row[i] for row in rows] for i, name in enumerate(df.columns)}


def table_kind(kind: str) -> str:
    return TABLE_KINDS.get(kind.upper(), kind.lower())


def _like(pattern: str) -> re.Pattern:
    """A case-insensitive LIKE pattern as a regular expression."""
    parts = {"%": ".*", "_": "."}
    return re.compile("".join(parts.get(ch, re.escape(ch)) for ch in pattern), re.IGNORECASE | re.DOTALL)


def get_relations_by_pattern(
    spark: SparkSession, schema_pattern: str, table_pattern: str, exclude: str = ""
) -> list[tuple[str, str, str]]:
    """(schema, table, kind) of the catalog tables whose names match LIKE patterns, ignoring case."""
    schema, table, unwanted = _like(schema_pattern), _like(table_pattern), _like(exclude)
    found = []
    for database in spark.catalog.listDatabases():
        if not schema.fullmatch(database.name):
            continue
        for entry in spark.catalog.listTables(database.name):
            temporary = not entry.namespace
            if not temporary and table.fullmatch(entry.name) and not unwanted.fullmatch(entry.name):
                found.append((database.name, entry.name, table_kind(entry.tableType)))
    return sorted(found)


def get_relations_by_prefix(
    spark: SparkSession, schema: str, prefix: str, exclude: str = ""
) -> list[tuple[str, str, str]]:
    """``get_relations_by_pattern`` for names starting with a prefix."""
    return get_relations_by_pattern(spark, schema, f"{prefix}%", exclude)
