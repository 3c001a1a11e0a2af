"""Comparing two tables by trees of digests that do not depend on the order of rows.

A row falls into a leaf by its hash; a leaf's digest is its number of rows and sums of pieces of two hashes,
a parent's the sums of its children. Two tables are compared from the root downwards, and rows
are only read again from leaves that differ. A stored tree spares even the first reading of its table.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import cut
from . import checks as C

LEVELS, CHILD_BITS = 3, 5
LEAVES = 1 << (LEVELS * CHILD_BITS)
# A digest is 96 bits of sums and the number of rows. Pieces of 24 bits add up exactly for 2 ** 39 rows in a leaf.
_SUMS, _PIECE = ("a1", "a2", "b1", "b2"), 1 << 24


def _plain(df: DataFrame, columns: Sequence[str]) -> list[Column]:
    """Columns in an order of their own, with one zero for both zeros, as grouping takes them."""
    kinds = {f.name.lower(): f.dataType for f in df.schema}
    plain = []
    for name in sorted(columns, key=str.lower):
        value = F.col(f"`{name}`")
        zero = isinstance(kinds[name.lower()], (T.DoubleType, T.FloatType))
        # A null and what stands beside it must not hash as the next column's.
        plain += [F.when(value == 0, F.lit(0.0)).otherwise(value) if zero else value, value.isNull()]
    return plain


def leaf_of(df: DataFrame, columns: Sequence[str]) -> Column:
    return F.pmod(F.xxhash64(*_plain(df, columns)), F.lit(LEAVES)).cast("int")


def digest_tree(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Rows of level, bucket, n and sums; level 0 is the root. At most ``LEAVES`` rows leave a task, whatever it reads.

    Sums are kept by their remainders. The bits that choose a row's leaf are not among those summed.
    """
    columns = columns or df.columns
    values = _plain(df, columns)
    first, second = F.xxhash64(*values), F.xxhash64(F.lit(97), *values)
    pieces = [F.shiftrightunsigned(x, n).bitwiseAND(F.lit(_PIECE - 1)) for x in (first, second) for n in (16, 40)]

    def summed(rows: DataFrame) -> DataFrame:
        left = [F.pmod(F.sum(name), F.lit(_PIECE)).cast("bigint").alias(name) for name in _SUMS]
        return rows.groupBy("bucket").agg(F.sum("n").cast("bigint").alias("n"), *left)

    leaves = df.select(leaf_of(df, columns).alias("bucket"), F.lit(1).alias("n"), *[v.alias(k) for k, v in zip(_SUMS, pieces)])
    level = cut(summed(leaves))
    tree = level.withColumn("level", F.lit(LEVELS))
    for number in range(LEVELS - 1, -1, -1):
        level = summed(level.withColumn("bucket", F.shiftright("bucket", CHILD_BITS)))
        tree = tree.unionByName(level.withColumn("level", F.lit(number)))
    return cut(tree.select("level", "bucket", "n", *_SUMS))


def differing_leaves(tree: DataFrame, other: DataFrame) -> list[int]:
    """Leaves whose digests differ, found from the root downwards: below equal buckets nothing is compared."""
    asked: list[int] = [0]
    for level in range(LEVELS + 1):
        if level:
            asked = [b << CHILD_BITS | child for b in asked for child in range(1 << CHILD_BITS)]
        sides = [t.where((F.col("level") == level) & F.col("bucket").isin(asked)) for t in (tree, other)]
        # As many as there are buckets of the level at most.
        found = sides[0].unionByName(sides[1]).groupBy("bucket", "n", *_SUMS).count().where("count = 1")
        asked = sorted({r.bucket for r in found.select("bucket").distinct().collect()})
        if not asked:
            return []
    return asked


def equality_by_digests(
    df: DataFrame, other: DataFrame, compare_columns: Sequence[str] | None = None,
    tree: DataFrame | None = None, other_tree: DataFrame | None = None,
) -> C.Check:
    """What ``checks.equality`` gives, with rows shuffled from differing leaves only; none if the tables are equal.

    Digests count repeated rows, so tables that differ in these alone are compared there, and found equal.
    The columns of both tables must have the same types.
    """
    columns = list(compare_columns or df.columns)
    kinds = [{c.lower(): t for c, t in d.select(*[f"`{x}`" for x in columns]).dtypes} for d in (df, other)]
    if kinds[0] != kinds[1]:
        raise ValueError("the columns to compare have different types")
    trees = [t or digest_tree(d, columns) for t, d in ((tree, df), (other_tree, other))]
    leaves = differing_leaves(*trees)
    sides = []
    for side in (df, other):
        chosen = side.select(*[f"`{c}`" for c in columns])
        if leaves:
            wanted = side.sparkSession.createDataFrame([(x,) for x in leaves], "_leaf int")
            chosen = chosen.withColumn("_leaf", leaf_of(chosen, columns)).join(F.broadcast(wanted), "_leaf").drop("_leaf")
        else:
            chosen = chosen.limit(0)
        sides.append(chosen)
    return C.equality(sides[0], sides[1], compare_columns=columns)
