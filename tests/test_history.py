"""Uniqueness by stored filters and comparison by digests, against the full checks, and their plans."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from eventpulse.operators import checks as C
from eventpulse.operators.digests import LEAVES, LEVELS, differing_leaves, digest_tree, equality_by_digests
from eventpulse.operators.key_filters import key_filters, possible_dates, repeated_keys

DAYS = [dt.date(2024, 1, d) for d in range(1, 9)]


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def keyed(spark):
    dice = random.Random(3)
    rows = [(dice.choice(DAYS), dice.randint(0, 4000) if dice.random() < 0.97 else None) for _ in range(3000)]
    rows += [(DAYS[-1], 7)] * 400 + [(DAYS[0], 7)] * 400
    return spark.createDataFrame(rows, "day date, k int").cache()


@pytest.mark.parametrize("words", [2, 64, 1 << 12])
@pytest.mark.parametrize("most_broadcast", [0, 10**6])
def test_repeated_keys_equal_the_full_check(keyed, words, most_broadcast):
    """Also with filters so small that nearly every key is a false hit."""
    new, history = keyed.where(F.col("day") == DAYS[-1]), keyed.where(F.col("day") < DAYS[-1])
    filters = key_filters(history, "k", "day", words)
    got = repeated_keys(new, history, "k", filters, "day", words, most_broadcast)
    full = C.unique(keyed, "k").violations
    want = full.join(new.select(F.col("k").alias("unique_field")).distinct(), "unique_field", "left_semi").select(*got.columns)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    assert got.columns == ["unique_field", "n_records"] and got.where("unique_field = 7").first().n_records >= 800


def test_filters_miss_no_key_and_few_dates_are_false(keyed):
    history = keyed.where(F.col("day") < DAYS[-1])
    held = possible_dates(history, "k", key_filters(history, "k", "day"), "day")
    truth = history.where("k IS NOT NULL").select(F.col("k").alias("key"), F.col("day").alias("date")).distinct()
    assert truth.join(held, ["key", "date"], "left_anti").isEmpty()
    assert held.count() < 1.05 * truth.count()


def test_history_is_not_shuffled(spark, keyed, tmp_path):
    """Of the history only dates with a hit are read, and its rows are counted where they are."""
    history = keyed.where(F.col("day") < DAYS[-1])
    history.write.partitionBy("day").parquet(str(tmp_path / "h"))
    stored = spark.read.parquet(str(tmp_path / "h"))
    filters = key_filters(stored, "k", "day")
    one = spark.createDataFrame([(3,), (5001,)], "k int")
    got = repeated_keys(one, stored, "k", filters, "day")
    plan = plan_of(got)
    old = plan[: plan.index("FileScan")]
    assert "BroadcastHashJoin" in old and "SortMergeJoin" not in plan
    scan = next(x for x in plan.splitlines() if "FileScan" in x)
    assert "day" in scan.partition("PartitionFilters: [")[2].partition("]")[0] and "ReadSchema: struct<k:int>" in scan
    want = [(3, n)] if (n := keyed.where(F.col("day") < DAYS[-1]).where("k = 3").count() + 1) > 1 else []
    assert [tuple(r) for r in got.collect()] == want


def test_empty_sides(spark, keyed):
    none = keyed.where("false")
    assert repeated_keys(none, keyed, "k", key_filters(keyed, "k", "day"), "day").collect() == []
    got = repeated_keys(keyed, none, "k", key_filters(none, "k", "day"), "day")
    assert got.count() == C.unique(keyed, "k").violations.count()


@pytest.fixture(scope="module")
def table(spark):
    dice = random.Random(4)
    rows = [(i % 700, dice.choice([None, "a", "b", ""]), dice.choice([0.0, -0.0, 1.5, None, float("nan")])) for i in range(3000)]
    return spark.createDataFrame(rows, "k int, s string, x double").cache()


def found(check):
    return sorted(map(str, check.violations.collect()))


def test_equal_tables_shuffle_no_rows(table):
    other = table.repartition(5).withColumn("x", F.when(F.col("x") == 0, -F.col("x")).otherwise(F.col("x")))
    assert differing_leaves(digest_tree(table), digest_tree(other)) == []
    check = equality_by_digests(table, other)
    assert found(check) == [] == found(C.equality(table, other))
    # Rows of neither table are left to be compared.
    assert "FileScan" not in plan_of(check.violations) and check.violations.isEmpty()


@pytest.mark.parametrize("change", ["k + CASE WHEN k IN (3, 500) THEN 1000 ELSE 0 END", "CASE WHEN k <> 9 THEN k END", "k * 2"])
def test_differences_equal_the_full_check(table, change):
    other = table.withColumn("k", F.expr(change).cast("int"))
    assert found(equality_by_digests(table, other)) == found(C.equality(table, other))
    assert found(equality_by_digests(table, other, ["s", "k"])) == found(C.equality(table, other, ["s", "k"]))


def test_repeated_rows_count_in_digests_and_not_in_differences(table):
    more = table.unionAll(table.limit(10))
    assert differing_leaves(digest_tree(table), digest_tree(more))
    assert found(equality_by_digests(table, more)) == []


def test_a_tree_adds_up_and_stored_trees_serve(spark, table, tmp_path):
    digest_tree(table).write.parquet(str(tmp_path / "tree"))
    tree = spark.read.parquet(str(tmp_path / "tree"))
    by_level = {r.level: (r.n, r.buckets) for r in tree.groupBy("level").agg(F.sum("n").alias("n"), F.count("*").alias("buckets")).collect()}
    assert {n for n, _ in by_level.values()} == {3000} and set(by_level) == set(range(LEVELS + 1))
    assert by_level[0][1] == 1 and by_level[LEVELS][1] <= LEAVES
    other = table.where("k <> 42")
    leaves = differing_leaves(tree, digest_tree(other))
    assert 0 < len(leaves) <= table.where("k = 42").distinct().count()
    assert found(equality_by_digests(table, other, tree=tree)) == found(C.equality(table, other))


def test_empty_tables_and_types(spark, table):
    none = table.where("false")
    assert differing_leaves(digest_tree(none), digest_tree(none)) == []
    assert found(equality_by_digests(none, table)) == found(C.equality(none, table))
    with pytest.raises(ValueError, match="types"):
        equality_by_digests(table, table.withColumn("k", F.col("k").cast("bigint")))
