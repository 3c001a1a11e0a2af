"""A bitmap of keys, of fixed size, that spares most rows a shuffle. Built and asked with DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import written

# 2 ** 23 bits are 1 MB. When they fill up, more rows pass; no key that was put in is ever missed.
FILTER_BITS = 23
_WORD_BITS = 6


def _place(key: Column | str) -> Column:
    return F.shiftrightunsigned(F.xxhash64(key), 64 - FILTER_BITS)


def key_filter(keys: DataFrame, name: str = "key") -> Column:
    """The bitmap of the keys as one value, for ``may_be_in``.

    Each task sets bits in words of its own, so a key that a third of all rows share is one word
    per task, and at most 131,072 words, whatever the number of keys, come together.
    """
    place = _place(name)
    bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), place.bitwiseAND(F.lit(63)).cast("int"))
    words = keys.select(F.shiftright(place, _WORD_BITS).alias("word"), bit.alias("bit")).groupBy("word").agg(F.bit_or("bit").alias("bits"))
    every = keys.sparkSession.range(1 << (FILTER_BITS - _WORD_BITS)).join(words, F.col("id") == F.col("word"), "left")
    in_order = F.sort_array(F.collect_list(F.struct("id", F.coalesce("bits", F.lit(0).cast("bigint")).alias("bits"))))
    return written(every.agg(F.transform(in_order, lambda w: w["bits"]).alias("bitmap")), "key-filter").scalar()


def may_be_in(key: Column | str, bitmap: Column) -> Column:
    """False only for keys that were not put in. A null key is asked for like any other."""
    place = _place(key)
    word = F.element_at(bitmap, (F.shiftright(place, _WORD_BITS) + 1).cast("int"))
    return F.getbit(word, place.bitwiseAND(F.lit(63)).cast("int")) == 1


def row_key(id_col: str, text_col: str) -> Column:
    """Rows that agree in id and text share a key of 16 bytes; what is found for one holds for all of them."""
    return F.unhex(F.md5(F.concat(F.coalesce(F.col(id_col).cast("string"), F.lit("-")), F.lit("\n"), F.col(text_col)).cast("binary")))
