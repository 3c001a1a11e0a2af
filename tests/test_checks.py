import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from eventpulse.operators import checks as C
from eventpulse.operators.neighbours import in_ranges
from eventpulse.operators.reshape import star


def failures(check):
    return C.summarise([check]).first().failures


def ids(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "id double")


def test_not_null_and_unique(spark, rows):
    df = spark.createDataFrame([(1,), (1,), (2,), (None,), (None,)], "v int")
    assert failures(C.not_null(df, "v")) == 2
    assert failures(C.not_null(df, "v", where="v = 2")) == 0
    assert rows(C.unique(df, "v").violations) == [(1, 2)]


def test_accepted_range(spark):
    df = ids(spark, -1.0, 11.0, None)
    assert failures(C.accepted_range(df, "id", -1, 11)) == 0
    assert failures(C.accepted_range(df, "id", -2, 11.1, inclusive=False)) == 0
    assert failures(C.accepted_range(df, "id", -1, 11, inclusive=False)) == 2
    assert failures(C.accepted_range(df, "id", 0, where="id <> -1")) == 0
    assert failures(C.accepted_range(df, "id", 0)) == 1
    assert failures(C.accepted_range(df, "id")) == 0


def test_at_least_one(spark, rows):
    df = spark.createDataFrame([("a", 1), ("b", None)], "field string, value int")
    assert failures(C.at_least_one(df, "field")) == 0
    assert failures(C.at_least_one(df, "value")) == 0
    assert rows(C.at_least_one(df, "value", ["field"]).violations) == [("b", 0)]
    assert failures(C.at_least_one(df.where("field = 'b'"), "value")) == 1
    assert failures(C.at_least_one(df.limit(0), "value")) == 1


def test_cardinality_equality(spark, rows):
    a = spark.createDataFrame([(1,), (2,), (3,)], "same_name int")
    b = spark.createDataFrame([(1, 2), (2, 3), (3, 1)], "same_name int, different_name int")
    assert failures(C.cardinality_equality(a, "same_name", b, "same_name")) == 0
    assert failures(C.cardinality_equality(a, "same_name", b, "different_name")) == 0
    more = a.unionAll(spark.createDataFrame([(3,), (None,)], "same_name int"))
    assert rows(C.cardinality_equality(more, "same_name", b, "same_name").violations) == [(None, 1), (3, 1), (3, 2)]


def test_equal_rowcount(spark, rows):
    df = spark.createDataFrame([(1,), (1,), (2,)], "field int")
    assert failures(C.equal_rowcount(df, df)) == 0
    assert failures(C.equal_rowcount(df, df, ["field"])) == 0
    fewer = spark.createDataFrame([(1,), (2,)], "field int")
    assert failures(C.equal_rowcount(df, fewer)) == 1
    assert rows(C.equal_rowcount(df, fewer, ["field"]).violations) == [(1, 2, 1, 1), (2, 1, 1, 0)]


def test_groups_of_one_side_only_count_when_strict(spark):
    a = spark.createDataFrame([(1,), (1,), (None,)], "g int")
    b = spark.createDataFrame([(2,)], "g int")
    assert failures(C.equal_rowcount(a, b, ["g"])) == 0
    assert failures(C.equal_rowcount(a, b, ["g"], strict_groups=True)) == 4
    assert failures(C.fewer_rows_than(a, b, ["g"])) == 0
    assert failures(C.fewer_rows_than(a, b, ["g"], strict_groups=True)) == 3
    assert failures(C.equal_rowcount(a, b.limit(0))) == 0
    assert failures(C.equal_rowcount(a, b.limit(0), strict_groups=True)) == 3


def test_fewer_rows_than(spark):
    one = spark.createDataFrame([(1, 1), (1, 2), (1, 3)], "col_a int, field int")
    two = spark.createDataFrame([(1, 1), (1, 2), (1, 3), (1, 4)], "col_a int, field int")
    assert failures(C.fewer_rows_than(one, two)) == 0
    assert failures(C.fewer_rows_than(one, two, ["col_a"])) == 0
    assert failures(C.fewer_rows_than(one, one)) == 1
    assert failures(C.fewer_rows_than(two.unionAll(one), one)) == 4


def equality_tables(spark):
    schema = "col_a int, col_b int, col_c int"
    return (
        spark.createDataFrame([(1, 1, 3), (1, 2, 1), (2, 3, 3)], schema),
        spark.createDataFrame([(1, 1, 2), (1, 2, 2), (2, 3, 2)], schema),
    )


def test_equality(spark, rows):
    a, b = equality_tables(spark)
    assert failures(C.equality(a, a)) == 0
    assert failures(C.equality(a, b)) == 6
    assert failures(C.equality(a, b, compare_columns=["col_a", "col_b"])) == 0
    assert failures(C.equality(a, b, exclude_columns=["COL_C"])) == 0
    assert rows(C.equality(a, b).violations)[0] == ("a_minus_b", 1, 1, 3)


def test_equality_adds_the_imbalance_and_ignores_copies(spark):
    a, _ = equality_tables(spark)
    assert failures(C.equality(a, a.where("col_a = 1"))) == 2
    assert failures(C.equality(a, a.unionAll(a))) == 0
    empty = spark.createDataFrame([(None,)], "v int")
    assert failures(C.equality(empty, empty)) == 0


def test_equality_wants_the_same_columns(spark):
    a, b = equality_tables(spark)
    with pytest.raises(ValueError):
        C.equality(a, b.drop("col_c"))
    with pytest.raises(ValueError):
        C.equality(a, b, compare_columns=["col_a"], exclude_columns=["col_b"])
    assert failures(C.equality(a, b.drop("col_c"), exclude_columns=["col_c"])) == 0


def test_equality_with_precision(spark):
    schema = "id string, float_number double, to_ignore string"
    a = spark.createDataFrame([("x", 17.5000004, "a"), ("y", 3.1415926, "a")], schema)
    b = spark.createDataFrame([("x", 17.5000005, "b"), ("y", 3.1415927, "b")], schema)
    numbers = ["id", "float_number"]
    assert failures(C.equality(a.select(numbers), b.select(numbers), precision=4)) == 0
    assert failures(C.equality(a.select(numbers), b.select(numbers), precision=8)) == 4
    assert failures(C.equality(a, b, compare_columns=numbers, precision=4)) == 0
    assert failures(C.equality(a, b, exclude_columns=["to_ignore"], precision=4)) == 0
    assert failures(C.equality(a, b, precision=4)) == 4


def test_expression_is_true(spark):
    df = spark.createDataFrame([(0.0, 1.0), (1.0, 0.0), (0.5, 0.5), (None, 1.0)], "col_a double, col_b double")
    assert failures(C.expression_is_true(df, "col_a + col_b = 1")) == 0
    assert failures(C.expression_is_true(df, "+ col_b = 1", "col_a")) == 0
    assert failures(C.expression_is_true(df, "col_a = 0.5", where="col_b = 0.5")) == 0
    assert failures(C.expression_is_true(df, F.col("col_a") == 0.5)) == 2


def test_accepted_and_not_accepted_values(spark, rows):
    df = spark.createDataFrame([("Oslo",), ("Lima",), ("Cairo",), ("Cairo",), (None,)], "city string")
    assert failures(C.not_accepted_values(df, "city", ["Quito", "Seoul"])) == 0
    assert rows(C.not_accepted_values(df, "city", ["Cairo"]).violations) == [("Cairo",)]
    assert rows(C.accepted_values(df, "city", ["Oslo", "Lima"]).violations) == [("Cairo", 2)]


def test_not_constant(spark):
    df = spark.createDataFrame([(1, 1, None), (1, 1, None), (1, 2, None)], "col_a int, field int, nothing int")
    assert failures(C.not_constant(df, "field")) == 0
    assert failures(C.not_constant(df, "field", ["col_a"])) == 0
    assert failures(C.not_constant(df, "col_a")) == 1
    assert failures(C.not_constant(df, "nothing")) == 0


def test_not_empty_string(spark):
    df = spark.createDataFrame([("   ",), (None,), ("a",)], "s string")
    assert failures(C.not_empty_string(df, "s", trim_whitespace=False)) == 0
    assert failures(C.not_empty_string(df, "s")) == 1
    assert failures(C.not_empty_string(spark.createDataFrame([("",)], "s string"), "s", False)) == 1


def test_not_null_proportion(spark):
    fives = [1, None, None, 4, 5, 6, None, None, None, 10]
    nines = [1, 2, 3, 4, 5, 6, 7, 8, None, 10]
    df = spark.createDataFrame(list(zip(fives, nines)), "point_5 int, point_9 int")
    assert failures(C.not_null_proportion(df, "point_5", 0.5, 0.5)) == 0
    assert failures(C.not_null_proportion(df, "point_5", 0, group_by=["point_9"])) == 0
    assert failures(C.not_null_proportion(df, "point_9", 0.9)) == 0
    assert failures(C.not_null_proportion(df, "point_9", 0.95)) == 1


def test_recency(spark):
    now = dt.datetime(2024, 5, 10, 9, 30)
    fresh = spark.createDataFrame([(1, 2, now - dt.timedelta(hours=23))], "col1 int, col2 int, created_at timestamp")
    for group in ([], ["col1"], ["col1", "col2"]):
        assert failures(C.recency(fresh, "created_at", "day", 1, now, group_by=group)) == 0
    midnight = spark.createDataFrame([(dt.datetime(2024, 5, 9),)], "created_at timestamp")
    assert failures(C.recency(midnight, "created_at", "day", 1, now, ignore_time_component=True)) == 0
    assert failures(C.recency(midnight, "created_at", "day", 1, now)) == 1
    assert failures(C.recency(midnight.limit(0), "created_at", "day", 1, now)) == 0


@pytest.fixture
def zone_with_changing_clocks(spark):
    spark.conf.set("spark.sql.session.timeZone", "Europe/Berlin")
    yield
    spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_clock_readings_ignore_the_session_zone(spark, zone_with_changing_clocks):
    # Clocks skip 02:00 to 03:00 on this day.
    hours = [(f"2024-03-31 0{h}:{m}0:00",) for h in range(6) for m in (0, 3)]
    df = spark.createDataFrame(hours, "t string").select(F.col("t").cast("timestamp_ntz").alias("t")).repartition(3)
    assert failures(C.sequential_values(df, "t", 30, "minute")) == 0
    late = C.recency(df, "t", "hour", 1, dt.datetime(2024, 3, 31, 6, 31))
    assert failures(late) == 1 and failures(C.recency(df, "t", "hour", 1, dt.datetime(2024, 3, 31, 6, 30))) == 0


def test_relationships_where(spark, rows):
    one = spark.createDataFrame([(1,), (2,), (3,), (3,)], "id int")
    two = spark.createDataFrame([(1,), (2,), (4,), (4,), (None,)], "id int")
    assert failures(C.relationships_where(two, "id", one, "id", "id <> 4")) == 0
    check = C.relationships_where(two, "id", one, "id")
    assert rows(check.violations) == [(4, 2)] and failures(check) == 2
    assert failures(C.relationships_where(one, "id", two, "id", to_condition="id <> 1")) == 3


def test_unique_combination_of_columns(spark, rows):
    df = spark.createDataFrame([("2019-01", "a"), ("2019-01", "b"), ("2019-02", "a"), (None, "c"), (None, "c")], "m string, p string")
    assert rows(C.unique_combination_of_columns(df, ["m", "p"]).violations) == [(None, "c")]
    assert failures(C.unique_combination_of_columns(df.where("m is not null"), ["m", "p"])) == 0
    assert failures(C.unique_combination_of_columns(df.where("m is not null"), ["m"])) == 1


def test_expected_columns(spark, rows):
    df = spark.createDataFrame([(1, 2)], "a int, B int")
    assert failures(C.expected_columns(df, ["A", "b"])) == 0
    assert rows(C.expected_columns(df, ["a", "c"]).violations) == [("b", "unexpected"), ("c", "missing")]


def test_sequential_values(spark):
    df = spark.createDataFrame([(1, 12), (1, 14), (1, 16), (2, 18), (2, 20)], "col_a int, my_even_sequence int")
    assert failures(C.sequential_values(df, "my_even_sequence", 2)) == 0
    assert failures(C.sequential_values(df, "my_even_sequence", 2, group_by=["col_a"])) == 0
    assert failures(C.sequential_values(df, "my_even_sequence", 1)) == 4
    hours = [(dt.datetime(2021, 1, 1, h),) for h in range(4)]
    times = spark.createDataFrame(hours, "my_timestamp timestamp")
    assert failures(C.sequential_values(times, "my_timestamp", 1, "hour")) == 0
    assert failures(C.sequential_values(times, "my_timestamp", 2, "hour")) == 3


def sequential_by_hand(data, interval):
    """(group, value, previous) of every row out of step, row by row."""
    found, groups = [], {}
    for group, value in data:
        groups.setdefault(group, []).append(value)
    for group, values in groups.items():
        values = sorted(v for v in values if v is not None)
        found += [(group, b, a) for a, b in zip(values, values[1:]) if b != a + interval]
    return sorted(found, key=str)


HEAVY = pytest.mark.parametrize("copies", [0, 2000], ids=["spread", "heavy value"])


@HEAVY
def test_sequential_values_with_a_hot_group(spark, copies):
    rng = random.Random(5)
    data = [("hot", rng.randrange(4000)) for _ in range(2000)] + [("hot", 77)] * copies
    data += [(f"g{rng.randrange(20)}", rng.randrange(60)) for _ in range(600)]
    data += [(None, 3), (None, 4), (None, 9), ("g1", None), ("hot", None)]
    df = spark.createDataFrame(data, "g string, v int").repartition(5)
    check = C.sequential_values(df, "v", group_by=["g"])
    got = [(r.g, r.v, r.previous_v) for r in check.violations.collect() for _ in range(r.n_rows)]
    assert sorted(got, key=str) == sequential_by_hand(data, 1)


def ranges_by_hand(data, gaps, zero_length):
    """Violations of every range, from the definition: order by lower then upper bound, NULL first."""
    follows = {"allowed": lambda u, n: u <= n, "not_allowed": lambda u, n: u == n, "required": lambda u, n: u < n}[gaps]
    groups, found = {}, []
    for group, lower, upper in data:
        groups.setdefault(group, []).append((lower, upper))
    for group, ranges in groups.items():
        ranges.sort(key=lambda r: [(v is not None, v) for v in r])
        for i, (lower, upper) in enumerate(ranges):
            last = i == len(ranges) - 1
            following = None if last else ranges[i + 1][0]
            missing = lower is None or upper is None
            has_length = not missing and (lower <= upper if zero_length else lower < upper)
            ends = last if upper is None or following is None else follows(upper, following)
            if not (has_length and ends):
                found.append((group, lower, upper, following, last))
    return sorted(found, key=str)


@pytest.mark.parametrize("gaps", ["allowed", "not_allowed", "required"])
@pytest.mark.parametrize("zero_length", [False, True])
@HEAVY
def test_ranges_against_the_definition(spark, gaps, zero_length, copies):
    rng = random.Random(11)

    def some_range(group, lower):
        upper = None if rng.random() < 0.05 else lower + rng.choice([0, 1, 1, 2, 3, -1])
        return group, lower, upper

    data = [some_range("hot", rng.randrange(600)) for _ in range(400)]
    data += [("hot", 50, 50 + rng.randrange(5)) for _ in range(copies // 5)]  # one bound shared by many ranges
    data += [some_range(rng.choice("abcdef"), rng.randrange(30)) for _ in range(120)]
    data += [("a", None, 3), ("a", None, None), ("hot", None, 7), (None, 1, 2), (None, 2, 3)]
    df = spark.createDataFrame(data, "g string, lo int, hi int").repartition(4)
    check = C.mutually_exclusive_ranges(df, "lo", "hi", "g", gaps, zero_length)
    got = [
        (r.partition_by_col, r.lower_bound, r.upper_bound, r.next_lower_bound, r.is_last_record)
        for r in check.violations.collect()
        for _ in range(r.n_rows)
    ]
    assert sorted(got, key=str) == ranges_by_hand(data, gaps, zero_length)


def test_ranges_with_mostly_missing_lower_bounds(spark):
    data = [("a", None, i % 7) for i in range(60)] + [("a", i, i + 1) for i in range(30)] + [("b", 3, 4), ("b", None, None)]
    df = spark.createDataFrame(data, "g string, lo int, hi int").repartition(4)
    check = C.mutually_exclusive_ranges(df, "lo", "hi", "g")
    got = [
        (r.partition_by_col, r.lower_bound, r.upper_bound, r.next_lower_bound, r.is_last_record)
        for r in check.violations.collect()
        for _ in range(r.n_rows)
    ]
    assert sorted(got, key=str) == ranges_by_hand(data, "allowed", False)


def test_ranges_examples(spark):
    plain = spark.createDataFrame([(0, 1), (1, 2), (2, 4)], "lower_bound int, upper_bound int")
    assert failures(C.mutually_exclusive_ranges(plain, "lower_bound", "upper_bound", gaps="not_allowed")) == 0
    overlap = plain.unionAll(spark.createDataFrame([(3, 5)], "l int, u int"))
    assert failures(C.mutually_exclusive_ranges(overlap, "lower_bound", "upper_bound")) == 1

    def day(text):
        return dt.date.fromisoformat(text) if text else None

    data = [(1, "2019-01-01", "2019-02-01"), (1, "2019-03-03", "2019-04-01"), (2, "2019-05-06", "2019-07-02"), (2, "2019-07-03", None)]
    gaps = spark.createDataFrame([(i, day(a), day(b)) for i, a, b in data], "subscription_id int, valid_from date, valid_to date")
    until = F.coalesce("valid_to", F.lit(dt.date(2099, 1, 1)))
    for kind, want in (("allowed", 0), ("required", 0), ("not_allowed", 2)):
        check = C.mutually_exclusive_ranges(gaps, "valid_from", until, "subscription_id", kind)
        assert failures(check) == want

    data = [(3, 6, 7), (3, 8, 10), (3, 8, 8), (3, 12, 15), (4, 6, 7), (4, 8, 8), (4, 9, 10)]
    zero = spark.createDataFrame(data, "subscription_id int, valid_from int, valid_to int")
    for allowed, want in ((True, 0), (False, 2)):
        check = C.mutually_exclusive_ranges(
            zero, "valid_from", "valid_to", "subscription_id", zero_length_range_allowed=allowed
        )
        assert failures(check) == want


def test_ranges_of_texts(spark):
    rng = random.Random(2)
    days = sorted({f"2024-0{rng.randrange(1, 10)}-{rng.randrange(10, 29)}" for _ in range(120)})
    data = [("a", d, e) for d, e in zip(days, days[1:])] + [("a", days[5], days[9]), ("b", "2024", "2024-"), ("b", "2024é", "x")]
    df = spark.createDataFrame(data, "g string, lo string, hi string").repartition(3)
    check = C.mutually_exclusive_ranges(df, "lo", "hi", "g", "not_allowed")
    got = [
        (r.partition_by_col, r.lower_bound, r.upper_bound, r.next_lower_bound, r.is_last_record)
        for r in check.violations.collect()
        for _ in range(r.n_rows)
    ]
    assert sorted(got, key=str) == ranges_by_hand(data, "not_allowed", False)


def test_ranges_of_booleans_and_of_expressions(spark, rows):
    df = spark.createDataFrame([(True, True), (False, True), (False, True)], "lo boolean, hi boolean")
    check = C.mutually_exclusive_ranges(df, "lo", "hi")
    got = [(r.lower_bound, r.upper_bound, r.next_lower_bound, r.n_rows) for r in check.violations.collect()]
    assert sorted(got, key=str) == [(False, True, False, 1), (True, True, None, 1)]
    df = spark.createDataFrame([("a-1", 1, 2), ("a-2", 3, 4), ("b-1", 1, 9)], "k string, lo int, hi int")
    whole = C.mutually_exclusive_ranges(df, F.col("lo") * 10, F.col("hi") * 10, F.substring("k", 1, 1), "required")
    assert failures(whole) == 0 and whole.column is None
    with pytest.raises(ValueError):
        C.mutually_exclusive_ranges(df, "lo", "hi", gaps="some")


def test_ranges_are_even_for_any_type(spark):
    spark_rows = spark.range(4000)
    texts = spark_rows.select(F.format_string("https://example.com/%05d", "id").alias("x"))
    frames = {
        "one outlier": texts.unionAll(spark.createDataFrame([("ftp://x",)], "x string")),
        "within a second": spark_rows.select(
            (F.lit("2024-01-01 00:00:00").cast("timestamp") + F.expr("make_dt_interval(0, 0, 0, id / 1e5)")).alias("x")
        ),
    }
    for name, df in frames.items():
        sizes = [r["count"] for r in in_ranges(df, ["x"], 16).groupBy("_range").count().collect()]
        assert len(sizes) > 12 and max(sizes) < 3 * sum(sizes) / 16, name
    hot = spark_rows.select(F.when(F.col("id") % 4 > 0, "hot").otherwise(F.col("id").cast("string")).alias("g"), F.col("id").alias("x"))
    sizes = [r["count"] for r in in_ranges(hot, ["g", "x"], 16).groupBy("_range").count().collect()]
    assert len(sizes) > 12 and max(sizes) < 3 * sum(sizes) / 16


def test_names_with_dots_and_backticks(spark):
    df = spark.createDataFrame([(1, "a"), (2, ""), (2, None)], "x int, y string").toDF("a.b", "c`d")
    assert failures(C.not_null(df, "c`d")) == 1
    assert failures(C.unique(df, "a.b")) == 1
    assert failures(C.not_empty_string(df, "c`d")) == 1
    assert failures(C.accepted_range(df, "a.b", 0, 1)) == 2
    assert failures(C.sequential_values(df, "a.b")) == 1
    assert failures(C.expression_is_true(df, "> 0", "a.b")) == 0
    assert df.select(star(df, prefix="p_")).columns == ["p_a.b", "p_c`d"]


def test_equality_beyond_nine_decimals(spark):
    one, two = (spark.createDataFrame([(x,)], "x double") for x in (1.0, 1.0000000004))
    assert failures(C.equality(one, two, precision=9)) == 0
    assert failures(C.equality(one, two, precision=12)) == 2
    with pytest.raises(ValueError):
        C.equality(one, two, precision=19)


def test_summary_statuses(spark):
    df = spark.createDataFrame([(1,), (None,)], "v int")
    bad = C.not_null(df, "v")
    summary = C.summarise(
        [
            bad.configured(name="error"),
            bad.configured(name="warn", severity="warn"),
            bad.configured(name="lenient", error_if="> 5"),
            bad.configured(name="sneaky", error_if="< 1", warn_if="< 0"),
            C.unique(df, "v").configured(name="pass", relation="t"),
        ]
    )
    assert {r.check_name: (r.failures, r.status) for r in summary.collect()} == {
        "error": (1, "error"),
        "warn": (1, "warn"),
        "lenient": (1, "warn"),
        "sneaky": (1, "pass"),
        "pass": (0, "pass"),
    }
    with pytest.raises(ValueError):
        C.summarise([bad.configured(severity="fatal")])


def test_filter_checks_of_one_table_share_a_scan(spark, tmp_path):
    spark.range(10).withColumn("v", F.col("id")).write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    summary = C.summarise([C.not_null(df, "v"), C.not_null(df, "id"), C.accepted_range(df, "v", 0, 5)])
    assert summary._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1
