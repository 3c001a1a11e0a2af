"""Operators against plain Python on generated rows, many of them on one key."""

from collections import Counter

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from eventpulse.functions import text
from eventpulse.operators import checks as C
from eventpulse.operators.aggregates import most_frequent
from eventpulse.operators.reshape import deduplicate, unpivot

few = settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
# The first key comes up far more often than the others.
keys = st.sampled_from(["hot", "hot", "hot", "a", "b", None])
pairs = st.lists(st.tuples(keys, st.one_of(st.none(), st.integers(-3, 6))), min_size=1, max_size=60)


def frame(spark, data):
    return spark.createDataFrame(data, "k string, v int").repartition(3)


def null_last(value):
    return value is None, value


@few
@given(data=pairs)
def test_deduplicate(spark, data):
    best = {}
    for k, v in data:
        if k not in best or null_last(v) < null_last(best[k]):
            best[k] = v
    got = deduplicate(frame(spark, data), ["k"], [F.asc_nulls_last("v")])
    assert Counter(map(tuple, got.collect())) == Counter(best.items())


@few
@given(data=pairs)
def test_most_frequent(spark, data):
    counts = Counter(data)
    want = {}
    for k in {k for k, _ in data}:
        top = min((v for kk, v in counts if kk == k), key=lambda v: (-counts[k, v], *null_last(v)))
        want[k] = (top, counts[k, top])
    got = most_frequent(frame(spark, data), ["k"], "v", "m").collect()
    assert {r.k: (r.m, r.n_rows) for r in got} == want


@few
@given(left=pairs, right=pairs)
def test_comparisons_of_two_tables(spark, left, right):
    a, b = frame(spark, left), frame(spark, right)
    rows = [("a_minus_b", *r) for r in set(left) - set(right)] + [("b_minus_a", *r) for r in set(right) - set(left)]
    assert Counter(map(tuple, C.equality(a, b).violations.collect())) == Counter(rows)

    count_a, count_b = Counter(v for _, v in left), Counter(v for _, v in right)
    differing = {v for v in count_a | count_b if count_a[v] != count_b[v]}
    want = [(v, n[v]) for n in (count_a, count_b) for v in differing if n[v]]
    assert Counter(map(tuple, C.cardinality_equality(a, "v", b, "v").violations.collect())) == Counter(want)

    known = {v for _, v in right}
    missing = Counter(v for _, v in left if v is not None and v not in known)
    assert dict(map(tuple, C.relationships_where(a, "v", b, "v").violations.collect())) == dict(missing)


@few
@given(data=pairs)
def test_grouped_checks(spark, data):
    df = frame(spark, data)
    values = {k: [v for kk, v in data if kk == k and v is not None] for k, _ in data}
    sizes = Counter(k for k, _ in data)
    got = {r.k for r in C.at_least_one(df, "v", ["k"]).violations.collect()}
    assert got == {k for k, found in values.items() if not found}
    got = {r.k for r in C.not_constant(df, "v", ["k"]).violations.collect()}
    assert got == {k for k, found in values.items() if len(set(found)) == 1}
    got = {r.k for r in C.not_null_proportion(df, "v", 0.5, 0.9, ["k"]).violations.collect()}
    assert got == {k for k, found in values.items() if not 0.5 <= len(found) / sizes[k] <= 0.9}


@few
@given(data=pairs)
def test_unpivot_keeps_every_cell(spark, data):
    got = unpivot(frame(spark, data), field_name="f", value_name="x").collect()
    cells = [("k", k) for k, _ in data] + [("v", None if v is None else str(v)) for _, v in data]
    assert Counter(map(tuple, got)) == Counter(cells)


urls = st.builds(
    "{}{}{}{}".format,
    st.sampled_from(["", "http://", "https://", "android-app://"]),
    st.sampled_from(["a.b", "www.x.org", "h"]),
    st.sampled_from(["", "/", "/p/q", "/p?z=/"]),
    st.sampled_from(["", "?page=2", "?a=1&page=", "&page=3#t"]),
)


@few
@given(data=st.lists(urls, min_size=1, max_size=40))
def test_url_parts(spark, data):
    df = spark.createDataFrame([(u,) for u in data], "u string")
    for r in df.select("u", text.url_host("u").alias("host"), text.url_parameter("u", "page").alias("page")).collect():
        rest = r.u.replace("android-app://", "").replace("http://", "").replace("https://", "")
        assert r.host == rest.split("/")[0].split("?")[0]
        after = r.u.split("page=")
        assert r.page == (after[1].split("&")[0] or None if len(after) > 1 else None)
