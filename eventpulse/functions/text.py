"""String functions: URL parts, keys, empty-string handling and name clean-up."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .numbers import ColumnLike, as_column

# The text that stands for NULL in a surrogate key, and the schemes
# removed from a URL before its host or path is cut out.
NULL_KEY = "_dbt_utils_surrogate_key_null_"
HOST_SCHEMES = ("android-app://", "http://", "https://")
PATH_SCHEMES = ("http://", "https://")


def _without(url: Column, schemes: Sequence[str]) -> Column:
    for scheme in schemes:
        url = F.replace(url, F.lit(scheme), F.lit(""))
    return url


def _part(text: Column, separator: str, number: int) -> Column:
    return F.split_part(text, F.lit(separator), F.lit(number))


def url_host(url: ColumnLike) -> Column:
    """Host of a URL with or without a scheme."""
    return _part(_part(_without(as_column(url), HOST_SCHEMES), "/", 1), "?", 1)


def url_path(url: ColumnLike) -> Column:
    """Text between the first slash after the host and the query string.

    A URL without a slash has an empty path when it has a query string, and is
    returned whole when it has neither. A fragment stays in the path.
    """
    rest = _without(as_column(url), PATH_SCHEMES)
    slash, question = F.position(F.lit("/"), rest), F.position(F.lit("?"), rest)
    start = F.when(slash > 0, slash).otherwise(question - 1)
    return _part(F.when(start >= 0, F.substring(rest, start + 1, F.length(rest))).otherwise(rest), "?", 1)


def url_parameter(url: ColumnLike, name: str) -> Column:
    """Value after ``name=`` up to the next ampersand, NULL when absent or empty."""
    return F.nullif(_part(_part(as_column(url), f"{name}=", 2), "&", 1), F.lit(""))


def surrogate_key(fields: Sequence[ColumnLike], nulls_as_empty: bool = False) -> Column:
    """MD5 of the fields' text joined by dashes, NULL replaced by a marker.

    Cast doubles to decimal first: their text form differs between engines.
    """
    marker = F.lit("" if nulls_as_empty else NULL_KEY)
    return F.md5(F.concat_ws("-", *[F.coalesce(as_column(f).cast("string"), marker) for f in fields]))


def empty_to_null(field: T.StructField) -> Column:
    """The column itself, with '' read as NULL when it holds text."""
    column = F.col(f"`{field.name}`")
    if isinstance(field.dataType, T.StringType):
        return F.nullif(column, F.lit("")).alias(field.name)
    return column


def slugify(name: str | None) -> str:
    """A text made usable as a plain column name."""
    if not name:
        return ""
    slug = re.sub(r"[^a-z0-9_]", "", re.sub(r"[ -]+", "_", name.lower()))
    return f"_{slug}" if slug[:1].isdigit() else slug
