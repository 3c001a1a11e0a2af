import pytest

from eventpulse.operators import introspect as I
from eventpulse.operators.reshape import filtered_columns, union_relations
from eventpulse.sources.tables import read_seed


@pytest.fixture(scope="module")
def catalog(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS feed_tests")
    days = [("20180101", [(1, "play"), (2, "pause")]), ("20180102", [(3, "play"), (4, "pause")])]
    for day, data in [*days, ("20180103", [(5, "play"), (6, "pause")])]:
        df = spark.createDataFrame(data, "user_id long, event string")
        df.write.mode("overwrite").saveAsTable(f"feed_tests.Data_Events_{day}")
    spark.createDataFrame([(1,)], "x int").write.mode("overwrite").saveAsTable("feed_tests.other")
    spark.createDataFrame([(1,)], "x int").createOrReplaceTempView("data_events_view")
    yield
    spark.sql("DROP DATABASE feed_tests CASCADE")


def values(spark):
    data = [(v, "left" if i % 2 == 0 else "right") for i, v in enumerate("abcdefggggg")]
    return spark.createDataFrame(data, "field string, condition string")


def test_column_values(spark):
    df = values(spark)
    assert I.get_column_values(spark, df, "field") == ["g", "a", "b", "c", "d", "e", "f"]
    assert I.get_column_values(spark, df, "field", max_records=2) == ["g", "a"]
    assert I.get_column_values(spark, df, "field", where="condition = 'left'") == ["g", "a", "c", "e"]
    assert I.get_column_values(spark, df, "field", order_by=["value"], max_records=1) == ["a"]
    assert I.get_column_values(spark, df, "field", ["none"], where="field = 'z'") == ["none"]


def test_column_values_of_a_missing_table(spark):
    assert I.get_column_values(spark, "no_such_table", "field", ["y"]) == ["y"]
    with pytest.raises(ValueError):
        I.get_column_values(spark, "no_such_table", "field")


def test_only_the_caller_bounds_a_result(spark):
    df = spark.range(120_000)
    assert len(I.get_column_values(spark, df, "id")) == 120_000
    assert len(I.get_column_values(spark, df, "id", max_records=3)) == 3
    assert len(I.get_query_results_as_dict(df)["id"]) == 120_000
    assert len(I.get_query_results_as_dict(df, max_records=4)["id"]) == 4


def test_single_value(spark):
    df = spark.createDataFrame([(3.3, "a"), (4.0, "b")], "f double, s string")
    assert I.get_single_value(df.orderBy("f")) == 3.3
    assert I.get_single_value(df.where("f > 5"), default="d") == "d"
    assert I.get_single_value(spark.sql("SELECT CAST(NULL AS INT) AS x"), default=1) is None


def test_results_as_dict(spark):
    df = spark.createDataFrame([(1, "a", True), (2, "b", False), (3, "c", None)], "col_1 int, col_2 string, col_3 boolean")
    assert I.get_query_results_as_dict(df.orderBy("col_1")) == {
        "col_1": [1, 2, 3],
        "col_2": ["a", "b", "c"],
        "col_3": [True, False, None],
    }


def test_relations_by_pattern_and_their_union(spark, catalog, rows):
    found = I.get_relations_by_pattern(spark, "FEED_%", "data\\_events\\_%".replace("\\", ""))
    assert [name for _, name, _ in found] == [f"data_events_2018010{d}" for d in (1, 2, 3)]
    assert {kind for _, _, kind in found} == {"table"}
    tables = {f"{s}.{t}": spark.table(f"{s}.{t}") for s, t, _ in found}
    assert rows(union_relations(tables, source_column_name=None)) == [
        (1, "play"), (2, "pause"), (3, "play"), (4, "pause"), (5, "play"), (6, "pause"),
    ]


def test_relations_by_prefix(spark, catalog):
    found = I.get_relations_by_prefix(spark, "feed_tests", "data_events_", exclude="%0103")
    assert [name for _, name, _ in found] == ["data_events_20180101", "data_events_20180102"]
    assert I.get_relations_by_prefix(spark, "feed_tests", "none") == []


@pytest.mark.parametrize(
    "kind, want",
    [("MANAGED", "table"), ("BASE TABLE", "table"), ("EXTERNAL TABLE", "external"), ("EXTERNAL", "external"),
     ("MATERIALIZED VIEW", "materializedview"), ("VIEW", "view")],
)
def test_table_kind(kind, want):
    assert I.table_kind(kind) == want


def test_filtered_columns(spark):
    df = spark.createDataFrame([("a", "b", "c"), ("g", "h", "i")], "field_1 string, field_2 string, field_3 string")
    names = filtered_columns(df, exclude=["FIELD_1"])
    assert names == ["field_2", "field_3"]
    assert tuple(df.groupBy().agg({n: "max" for n in names}).select("max(field_2)", "max(field_3)").first()) == ("h", "i")


def test_seed(spark, tmp_path, rows):
    (tmp_path / "seed.csv").write_text('id,code,day\n1,"01",2024-01-01\n2,,\n')
    seed = read_seed(spark, str(tmp_path / "seed.csv"), "id bigint, code string, day date")
    assert [r.code for r in seed.orderBy("id").collect()] == ["01", None]
    assert dict(seed.dtypes) == {"id": "bigint", "code": "string", "day": "date"}
