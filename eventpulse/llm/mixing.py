"""Mixing sources to target weights with hash-threshold histograms.

Each document has a 52-bit hash of its id and text. A source that is to give R
words beyond its whole copies takes the documents whose hash lies below a
threshold. To find it, sizes are summed by source and hash bucket, the bucket in
which the running sum passes R is refined by the next bits, and so on; the last
level is a single hash value. Rows are filtered by the threshold, never sorted.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import WORD, cut, text_or_empty

BITS, LEVELS = 13, 4
# Thresholds are copied this often, so the join with them deals out a source that holds most rows.
SALTS = 64
# With no more sources than this, a row of some 50 bytes each, their limits are sent to all tasks instead.
BROADCAST_SOURCES = 10_000
WEIGHTS = (5, 2, 1)
MOST_COPIES = 3


def document_hash(id_col: str, text_col: str) -> Column:
    key = F.concat(text_or_empty(F.col(id_col).cast("string")), F.lit("\n"), text_or_empty(text_col))
    return F.conv(F.substring(F.md5(key.cast("binary")), 1, BITS * LEVELS // 4), 16, 10).cast("bigint")


def source_targets(sizes: DataFrame) -> DataFrame:
    """Adds the target of each source to a table of ``source`` and ``source_size``.

    The sources, in code-point order with null last, weigh 5, 2, 1 and so on. They
    share the words of all sources; none gets more than three times its own, and what
    is over goes to the others by weight. The water level of that sharing is the
    largest of the levels found when sources are held at their limit one by one.
    The table has one row per source and is ordered in one task.
    """
    place = F.row_number().over(W.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*map(F.lit, WEIGHTS)), (place % len(WEIGHTS) + 1).cast("int")).cast("double")
    weighed = sizes.withColumn("weight", weight).withColumn("most", (F.col("source_size") * MOST_COPIES).cast("double"))
    everything = W.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    before = W.orderBy(F.col("most") / F.col("weight"), F.col("source").asc_nulls_last()).rowsBetween(
        W.unboundedPreceding, -1
    )
    total = F.sum("source_size").over(everything).cast("double")
    left = total - F.coalesce(F.sum("most").over(before), F.lit(0.0))
    weights_left = F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))
    level = F.max("level").over(everything)
    return (
        weighed.withColumn("level", left / weights_left)
        .withColumn("target", F.least("most", F.col("weight") * level))
        .select("source", "source_size", "target")
    )


def _thresholds(rows: DataFrame, targets: DataFrame) -> DataFrame:
    """For each source: whole copies of every document, and the hash up to which documents are taken once more."""
    budget = targets.withColumn(
        "copies",
        F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0)),
    ).withColumn("rest", F.col("target") - F.col("copies") * F.col("source_size"))
    # The edge: hashes of this prefix are still open, all lower ones are taken.
    edge = budget.select(
        F.col("source").alias("edge_source"), "copies", "rest", F.lit(0).cast("bigint").alias("prefix"),
        F.lit(True).alias("open"), F.lit(0).cast("bigint").alias("last_words"),
    )
    same_source = F.col("source").eqNullSafe(F.col("edge_source"))
    for level in range(LEVELS):
        shift = BITS * (LEVELS - 1 - level)
        inside = rows.withColumn("hash_prefix", F.shiftright("hash", shift + BITS))
        if level:
            at_edge = edge.where("open").select("edge_source", "prefix")
            inside = inside.join(at_edge, same_source & (F.col("hash_prefix") == F.col("prefix")), "left_semi")
        histogram = inside.groupBy("source", F.shiftright("hash", shift).alias("bucket")).agg(
            F.sum("size").alias("words")
        )
        upto = F.sum("words").over(W.partitionBy("source").orderBy("bucket").rowsBetween(W.unboundedPreceding, 0))
        running = histogram.withColumn("upto", upto).withColumn("under", F.col("upto") - F.col("words"))
        passed = F.col("open") & (F.col("under") <= F.col("rest")) & (F.col("rest") < F.col("upto"))
        here = F.col("bucket").isNotNull()
        edge = cut(edge.join(running, same_source & passed, "left").select(
            "edge_source", "copies",
            F.when(here, F.col("rest") - F.col("under")).otherwise(F.col("rest")).alias("rest"),
            F.when(here, F.col("bucket")).otherwise(F.lit(-1)).cast("bigint").alias("prefix"),
            here.alias("open"), F.col("words").alias("last_words"),
        ))
    # The hash on the edge is taken when that comes nearer to the target.
    nearer = F.col("last_words") - F.col("rest") < F.col("rest")
    last = F.when(~F.col("open"), F.lit(-1)).when(nearer, F.col("prefix")).otherwise(F.col("prefix") - 1)
    return edge.select(F.col("edge_source").alias("limit_source"), "copies", last.alias("last_hash"))


def _sized(docs: DataFrame, id_col: str, text_col: str, source_col: str) -> list[Column]:
    return [
        F.col(source_col).cast("string").alias("source"),
        F.regexp_count(text_or_empty(text_col), F.lit(WORD)).cast("bigint").alias("size"),
        document_hash(id_col, text_col).alias("hash"),
    ]


def _limits(rows: DataFrame) -> DataFrame:
    """One row per source: limit_source, source_size, target, copies, last_hash."""
    targets = cut(source_targets(rows.groupBy("source").agg(F.sum("size").alias("source_size"))))
    own = targets.select(F.col("source").alias("own_source"), "source_size", "target")
    return _thresholds(rows, targets).join(own, F.col("limit_source").eqNullSafe(F.col("own_source"))).drop("own_source")


def _copies(rows: DataFrame, limits: DataFrame) -> DataFrame:
    """Adds the limits of the source, and the copies that the mix takes, to rows with source and hash."""
    if limits.count() <= BROADCAST_SOURCES:
        joined = rows.join(F.broadcast(limits), F.col("source").eqNullSafe(F.col("limit_source")))
    else:
        salts = F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(SALTS - 1).cast("bigint")))
        salted = limits.select("*", salts.alias("salt"))
        same = F.col("source").eqNullSafe(F.col("limit_source")) & (F.col("hash") % SALTS == F.col("salt"))
        joined = rows.join(salted, same).drop("salt")
    once_more = (F.col("hash") <= F.col("last_hash")).cast("bigint")
    copies = F.least(F.col("copies") + once_more, F.lit(MOST_COPIES)).cast("bigint")
    return joined.withColumn("copies", copies).drop("limit_source", "last_hash")


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """One row per document: doc_id, source, size, source_size, target, copies, taken.

    A document's size is its number of words (null text: 0). ``copies`` says how
    often the mix takes it (0 to 3) and ``taken`` is size times copies. A null
    source is a source of its own. Rows equal in id and text have one hash and are
    taken together. Sources without a word have target 0. The result does not
    depend on partitioning or row order. Other columns are ignored.
    """
    rows = cut(docs.select(F.col(id_col).cast("bigint").alias("doc_id"), *_sized(docs, id_col, text_col, source_col)))
    found = _copies(rows, cut(_limits(rows)))
    return found.select(
        "doc_id", "source", "size", "source_size", "target", "copies", (F.col("size") * F.col("copies")).alias("taken")
    )


def mixed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """The documents, with all their columns, each as often as the mix takes it. Their texts are not shuffled.

    A document without a word, which no number of words can ask for, stays once.
    """
    sized = _sized(docs, id_col, text_col, source_col)
    limits = cut(_limits(cut(docs.select(*sized))))
    whole = docs.select(F.struct(*docs.columns).alias("doc"), *sized)
    copies = F.when(F.col("size") == 0, F.lit(1)).otherwise(F.col("copies")).cast("int")
    found = _copies(whole, limits).select("doc", F.explode(F.array_repeat(F.lit(0), copies)))
    return found.select("doc.*")
