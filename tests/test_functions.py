import math
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from eventpulse.functions import geo, numbers, text


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first().x


def frame(spark, data, schema):
    return spark.createDataFrame(data, schema)


def test_safe_add_and_subtract(spark):
    df = frame(spark, [(7, 11, -4), (5, None, 20), (None, None, -9), (None, None, None)], "a int, b int, c int")
    assert [r.x for r in df.select(numbers.safe_add(["a", "b", "c"]).alias("x")).collect()] == [14, 25, -9, 0]
    assert [r.x for r in df.select(numbers.safe_subtract(["a", "b", "c"]).alias("x")).collect()] == [0, -15, 9, 0]


@pytest.mark.parametrize("function", [numbers.safe_add, numbers.safe_subtract])
def test_safe_arithmetic_wants_a_list(spark, function):
    with pytest.raises(TypeError):
        function("a")


def test_safe_divide(spark):
    data = [(9, 0, None), (21, 4, 5.25), (None, None, None), (None, 0, None), (-8, None, None), (None, 3, None), (0, 7, 0.0)]
    df = frame(spark, data, "n int, d int, want double")
    for r in df.select("want", numbers.safe_divide("n", "d").alias("x")).collect():
        assert r.x == r.want
    df = frame(spark, [(0, 3, 4, 0.0), (5, 6, 0, None), (7, 2, None, None), (None, 1, 8, None), (9, 4, 12, 3.0)], "a int, b int, d int, want double")
    ratio = numbers.safe_divide(F.col("a") * F.col("b"), F.col("d"))
    for r in df.select("want", ratio.alias("x")).collect():
        assert r.x == r.want


def test_round_half_away(spark):
    data = [(2.5, 3.0), (-2.5, -3.0), (0.4, 0.0), (1e18, 1e18), (None, None)]
    df = frame(spark, data, "v double, want double")
    for r in df.select("want", numbers.round_half_away("v", 0).alias("x")).collect():
        assert r.x == r.want


def test_weighted_mean_counts_the_weight_of_missing_values(spark):
    df = frame(spark, [("a", 10.0, 1), ("a", None, 3), ("b", 1.0, 0)], "g string, x double, w int")
    got = dict(df.groupBy("g").agg(numbers.weighted_mean("x", "w")).collect())
    assert got == {"a": 2.5, "b": None}


def test_exact_sum_does_not_depend_on_order(spark):
    rng = random.Random(3)
    data = [round(rng.uniform(-100, 100), rng.randrange(10)) for _ in range(3000)] + [1e5, -1e5, 0.1, None]
    want = float(sum(Decimal(repr(v)) for v in data if v is not None))
    for _ in range(3):
        rng.shuffle(data)
        df = frame(spark, [(v,) for v in data], "v double").repartition(rng.randrange(1, 9))
        assert df.agg(numbers.exact_sum("v").alias("x")).first().x == want
    assert df.limit(0).agg(numbers.exact_sum("v").alias("x")).first().x is None


def test_exact_sum_of_a_hot_group_does_not_overflow(spark):
    df = spark.range(2_000_000).select(F.lit(99_999.999999999).alias("v"))
    assert df.agg(numbers.exact_sum("v").alias("x")).first().x == float(Decimal("99999.999999999") * 2_000_000)


@pytest.mark.parametrize(
    "values", [[4e-10, 4e-10], [1e10, 2e10], [1e300, 3e300], [-1e300, 1e300, 4.0], [5e-324, 5e-324], [1e5, 100000.5], [1e-9, 1e9, -1e9]]
)
def test_means_of_any_size(spark, values):
    df = frame(spark, [(v, 3) for v in values] + [(None, 0)], "v double, w int")
    got = df.agg(numbers.mean("v").alias("m"), numbers.weighted_mean("v", "w").alias("w")).first()
    assert got.m == pytest.approx(sum(values) / len(values), rel=1e-12)
    assert got.w == pytest.approx(sum(values) / len(values), rel=1e-12)


def test_means_of_values_that_are_not_finite(spark):
    df = frame(spark, [(float("inf"),), (1.0,)], "v double").unionAll(frame(spark, [(float("nan"),)], "v double").limit(0))
    assert df.agg(numbers.mean("v").alias("m")).first().m == float("inf")


def test_width_bucket(spark):
    data = [(-0.5, 0), (0.0, 1), (2.4, 1), (2.5, 2), (4.9, 2), (7.5, 4), (9.99, 4), (10.0, 5), (88.0, 5)]
    df = frame(spark, data, "amount double, want int")
    for r in df.select("want", numbers.width_bucket("amount", 0.0, 10.0, 4).alias("x")).collect():
        assert r.x == r.want


@pytest.mark.parametrize("unit, radius", [("mi", 3961), ("km", 6371)])
def test_haversine(spark, unit, radius):
    a, b, c, d = (math.radians(v) for v in (10.0, 20.0, -35.5, 80.25))
    angle = math.acos(math.sin(a) * math.sin(c) + math.cos(a) * math.cos(c) * math.cos(b - d))
    distance = geo.haversine_distance(*[F.lit(v) for v in (10.0, 20.0, -35.5, 80.25)], unit=unit)
    assert one(spark, distance) == pytest.approx(radius * angle, rel=2e-3)


def test_haversine_antipodes_and_units(spark):
    far = geo.haversine_distance(*[F.lit(v) for v in (0.0, 0.0, 0.0, 180.0)])
    assert one(spark, far) == pytest.approx(3961 * 3.141592653589793)
    with pytest.raises(ValueError):
        geo.haversine_distance("a", "b", "c", "d", unit="m")


TAGGED = "shop.example.org?utm_source=letter&utm_medium=mail&utm_campaign=may"
LONG = "http://notes.example.net/a/2031/walking-in-the-rain/"


@pytest.mark.parametrize(
    "url, want",
    [
        (TAGGED, "shop.example.org"),
        (LONG, "notes.example.net"),
        ("https://www.example.com/x/y", "www.example.com"),
        ("android-app://app.example.com/", "app.example.com"),
        ("files.example.com/1/2.js?utm_source=z", "files.example.com"),
        ("https://app.example.com/", "app.example.com"),
    ],
)
def test_url_host(spark, url, want):
    assert one(spark, text.url_host(F.lit(url))) == want


@pytest.mark.parametrize(
    "url, want",
    [
        (TAGGED, ""),
        (LONG, "a/2031/walking-in-the-rain/"),
        ("https://www.example.com/x/y", "x/y"),
        (LONG + "?utm_source=letter&utm_medium=mail", "a/2031/walking-in-the-rain/"),
        ("plainhost", "plainhost"),
        ("?a=b", ""),
        ("https://a.b/c#top", "c#top"),
    ],
)
def test_url_path(spark, url, want):
    assert one(spark, text.url_path(F.lit(url))) == want


@pytest.mark.parametrize(
    "url, medium, source",
    [
        ("http://a.example/b?utm_medium=mail", "mail", None),
        ("http://a.example/b?utm_medium=mail&utm_source=letter", "mail", "letter"),
        ("http://x.y/?utm_medium=&utm_source=a", None, "a"),
    ],
)
def test_url_parameter(spark, url, medium, source):
    assert one(spark, text.url_parameter(F.lit(url), "utm_medium")) == medium
    assert one(spark, text.url_parameter(F.lit(url), "utm_source")) == source


# Digests of these keys must be those of other tools.
def test_surrogate_key(spark):
    data = [
        ("a", "b", "c", "0cc175b9c0f1b6a831c399e269772661", "7b193b3d33184464106f41ddf733783b"),
        ("a", None, "c", "0cc175b9c0f1b6a831c399e269772661", "4f32a73dc87b7bbb7a654d8898d58c7e"),
        (None, None, "c", "f14cc5cdce0420f4a5a6b6d9d7b85f39", "d9c538b129f1a3ad6ecfe55345c32a05"),
        (None, None, None, "f14cc5cdce0420f4a5a6b6d9d7b85f39", "2fa5491950d66d153d23cfbcfea4e164"),
    ]
    df = frame(spark, data, "a string, b string, c string, one string, all string")
    keys = df.select("one", "all", text.surrogate_key(["a"]).alias("x"), text.surrogate_key(["a", "b", "c"]).alias("y"))
    for r in keys.collect():
        assert (r.x, r.y) == (r.one, r["all"])


def test_surrogate_key_with_nulls_as_empty(spark):
    key = text.surrogate_key([F.lit(None), F.lit("c")], nulls_as_empty=True)
    assert one(spark, key) == one(spark, F.md5(F.lit("-c")))


@pytest.mark.parametrize(
    "name, want",
    [("", ""), (None, ""), ("?Green 4pples or-pears", "green_4pples_or_pears"), ("9 Lives", "_9_lives")],
)
def test_slugify(name, want):
    assert text.slugify(name) == want
