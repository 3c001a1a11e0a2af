"""Uniqueness against a long history by stored Bloom filters, one per date.

A filter is rows of a word's number and 64 bits. A key sets ``BITS`` bits of one word, so asking a filter is
one join by word, and filters of dates are built once, with one combining aggregate. New keys are
tested against all dates; only dates with a hit are read, and of these only the key, to count exactly.
"""

from __future__ import annotations

import functools
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import cut

BITS = 5
# Words of a date's filter. At eight keys a word about one key in a hundred is a false hit, which costs a look, no result.
WORDS = 1 << 17
# Keys of this many rows at most go to all tasks; more are joined by a shuffle.
MOST_BROADCAST = 1_000_000


def _word(key: Column, words: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(words)).cast("int")


def _mask(key: Column) -> Column:
    spread = F.xxhash64(key, F.lit(1))
    places = [F.shiftrightunsigned(spread, 6 * i).bitwiseAND(F.lit(63)).cast("int") for i in range(BITS)]
    ones = [F.call_function("shiftleft", F.lit(1).cast("bigint"), p) for p in places]
    return functools.reduce(lambda a, b: a.bitwiseOR(b), ones)


def key_filters(df: DataFrame, key: str, date_column: str, words: int = WORDS) -> DataFrame:
    """The filters of all dates of a table: date, word, bits. Null keys are left out."""
    rows = df.where(F.col(key).isNotNull()).select(
        F.col(date_column), _word(F.col(key), words).alias("word"), _mask(F.col(key)).alias("bits")
    )
    return rows.groupBy(date_column, "word").agg(F.bit_or("bits").alias("bits"))


def possible_dates(new: DataFrame, key: str, filters: DataFrame, date_column: str, words: int = WORDS) -> DataFrame:
    """Distinct new keys with each date whose filter has them: all dates that hold the key, and a few that do not."""
    asked = new.where(F.col(key).isNotNull()).select(
        F.col(key).alias("key"), _word(F.col(key), words).alias("word"), _mask(F.col(key)).alias("wanted")
    )
    held = filters.join(asked.distinct(), "word").where(F.col("bits").bitwiseAND(F.col("wanted")) == F.col("wanted"))
    return held.select("key", F.col(date_column).alias("date"))


def repeated_keys(
    new: DataFrame, history: DataFrame, key: str, filters: DataFrame, date_column: str,
    words: int = WORDS, most_broadcast: int = MOST_BROADCAST,
) -> DataFrame:
    """Keys of new rows that are not unique, with how many rows of history and new together have them.

    The same rows as a check of uniqueness over both would give for these keys. ``filters`` must cover all
    dates of ``history``. The driver gets the dates with a hit, no keys.
    """
    hits = cut(possible_dates(new, key, filters, date_column, words))
    dates: Sequence = sorted(r[0] for r in hits.select("date").distinct().collect())
    asked = hits.select("key").distinct()
    if hits.count() <= most_broadcast:
        asked = F.broadcast(asked)
    old = history.where(F.col(date_column).isin(dates)) if dates else history.limit(0)
    of_old = old.select(F.col(key).alias("key")).join(asked, "key").groupBy("key").agg(F.count(F.lit(1)).alias("n"))
    of_new = new.where(F.col(key).isNotNull()).groupBy(F.col(key).alias("key")).agg(F.count(F.lit(1)).alias("n"))
    # A false hit that is in no date has no old rows; an old row is only counted for keys that are new.
    return (
        of_new.unionByName(of_old).groupBy(F.col("key").alias("unique_field")).agg(F.sum("n").alias("n_records")).where("n_records > 1")
    )
