"""Table operators and column functions over the supplied tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.geo import haversine_distance
from ..functions.numbers import (
    mean,
    round_half_away,
    safe_add,
    safe_divide,
    safe_subtract,
    share_pct,
    weighted_mean,
    width_bucket,
)
from ..functions.text import NULL_KEY, surrogate_key, url_host, url_parameter, url_path
from ..operators.aggregates import most_frequent
from ..operators.introspect import column_values, get_column_values, get_single_value
from ..operators.reshape import (
    SOURCE_COLUMN,
    deduplicate,
    group_by_n,
    nullcheck_table,
    pivot,
    star,
    union_relations,
    unpivot,
)
from ..operators.series import date_spine, generate_series, intervals_between
from .base import query, sql_round, table

# --- aggregates --------------------------------------------------------------


@query(
    "weighted_mean",
    f"""SELECT l_returnflag, l_linestatus,
      {sql_round('''CAST(sum(CAST(l_discount AS DECIMAL(18,10)) * CAST(l_quantity AS DECIMAL(10,0))) AS DOUBLE)
        / CAST(nullif(sum(CAST(l_quantity AS DECIMAL(10,0))), 0) AS DOUBLE)''', 6)} AS weighted_discount
    FROM lineitem GROUP BY l_returnflag, l_linestatus""",
)
def q_weighted_mean(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem")
    mean = round_half_away(weighted_mean("l_discount", F.col("l_quantity").cast("bigint")), 6)
    return lines.groupBy("l_returnflag", "l_linestatus").agg(mean.alias("weighted_discount"))


# Multiples of powers of two, so that sums of these sizes are the same in any order.
_TINY, _HUGE = 2.0**-60, 2.0**900


@query(
    "mean_of_any_size",
    f"""SELECT event_type, avg(user_id * {_TINY!r}) AS tiny, avg(user_id * {_HUGE!r}) AS huge,
      sum(user_id * {_HUGE!r} * event_id) / sum(event_id) AS weighted
    FROM events GROUP BY event_type""",
)
def q_mean_of_any_size(spark, sf_dir):
    """Means of values far below and far above those of the feed."""
    user = F.col("user_id").cast("double")
    return table(spark, sf_dir, "events").groupBy("event_type").agg(
        mean(user * F.lit(_TINY)).alias("tiny"),
        mean(user * F.lit(_HUGE)).alias("huge"),
        weighted_mean(user * F.lit(_HUGE), "event_id").alias("weighted"),
    )


@query(
    "count_if",
    f"""SELECT o_orderpriority, count(*) AS n_orders, count(*) FILTER (o_orderstatus = 'F') AS n_filled,
      {sql_round("CAST(count(*) FILTER (o_orderstatus = 'F') AS DOUBLE) / count(*) * 100", 2)} AS filled_pct
    FROM orders GROUP BY o_orderpriority""",
)
def q_count_if(spark, sf_dir):
    filled = F.col("o_orderstatus") == "F"
    return (
        table(spark, sf_dir, "orders")
        .groupBy("o_orderpriority")
        .agg(
            F.count(F.lit(1)).alias("n_orders"),
            F.count_if(filled).alias("n_filled"),
            round_half_away(share_pct(filled), 2).alias("filled_pct"),
        )
    )


@query(
    "modal_value",
    """SELECT l_suppkey, l_quantity AS common_quantity, n AS n_rows FROM (
      SELECT l_suppkey, l_quantity, count(*) AS n,
             row_number() OVER (PARTITION BY l_suppkey ORDER BY count(*) DESC, l_quantity ASC NULLS LAST) AS pick
      FROM lineitem GROUP BY l_suppkey, l_quantity) WHERE pick = 1""",
)
def q_modal_value(spark, sf_dir):
    return most_frequent(table(spark, sf_dir, "lineitem"), ["l_suppkey"], "l_quantity", "common_quantity")


@query(
    "group_by_n",
    """SELECT l_returnflag, l_linestatus, count(*) AS n_lines, CAST(sum(l_linenumber) AS BIGINT) AS line_numbers
    FROM lineitem GROUP BY 1, 2""",
)
def q_group_by_n(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select("l_returnflag", "l_linestatus", "l_linenumber")
    return group_by_n(lines, 2).agg(
        F.count(F.lit(1)).alias("n_lines"), F.sum("l_linenumber").cast("bigint").alias("line_numbers")
    )


# --- reshape -----------------------------------------------------------------


@query(
    "deduplicate",
    """SELECT * EXCLUDE (pick) FROM (
      SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS pick
      FROM orders) WHERE pick = 1""",
)
def q_deduplicate(spark, sf_dir):
    newest = [F.desc("o_orderdate"), F.desc("o_orderkey")]
    return deduplicate(table(spark, sf_dir, "orders"), ["o_custkey"], newest)


@query(
    "surrogate_key",
    f"""SELECT l_orderkey, l_linenumber, l_returnflag, md5(
        coalesce(CAST(l_orderkey AS VARCHAR), '{NULL_KEY}') || '-' || coalesce(CAST(l_linenumber AS VARCHAR), '{NULL_KEY}')
        || '-' || coalesce(nullif(l_returnflag, 'N'), '{NULL_KEY}') || '-'
        || coalesce(CAST(CAST(l_extendedprice AS DECIMAL(12,2)) AS VARCHAR), '{NULL_KEY}')) AS line_key,
      md5(coalesce(nullif(l_returnflag, 'N'), '') || '-' || l_linestatus) AS flag_key
    FROM lineitem""",
)
def q_surrogate_key(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem")
    flag = F.nullif("l_returnflag", F.lit("N"))
    price = F.col("l_extendedprice").cast("decimal(12,2)")
    return lines.select(
        "l_orderkey",
        "l_linenumber",
        "l_returnflag",
        surrogate_key(["l_orderkey", "l_linenumber", flag, price]).alias("line_key"),
        surrogate_key([flag, "l_linestatus"], nulls_as_empty=True).alias("flag_key"),
    )


@query(
    "star_prefix",
    """SELECT o_orderkey AS ord_o_orderkey_x, o_custkey AS ord_o_custkey_x, o_orderstatus AS ord_o_orderstatus_x,
      o_totalprice AS ord_o_totalprice_x, o_orderdate AS ord_o_orderdate_x FROM orders""",
)
def q_star_prefix(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    return orders.select(star(orders, exclude=["O_ORDERPRIORITY"], prefix="ord_", suffix="_x"))


@query(
    "nullcheck",
    """SELECT event_id, nullif(CASE event_type WHEN 'error' THEN '' ELSE event_type END, '') AS event_type,
      value, nullif(props, '') AS props FROM events""",
)
def q_nullcheck(spark, sf_dir):
    """Event types blanked to '' become NULL; other types of column are left alone."""
    blanked = F.when(F.col("event_type") == "error", "").otherwise(F.col("event_type")).alias("event_type")
    return nullcheck_table(table(spark, sf_dir, "events").select("event_id", blanked, "value", "props"))


@query(
    "union_relations",
    f"""SELECT 'customer' AS {SOURCE_COLUMN}, c_custkey AS key, c_name AS name, c_nationkey AS nationkey,
      CAST(c_acctbal AS DECIMAL(12,2)) AS acctbal, c_mktsegment AS mktsegment FROM customer WHERE c_acctbal > 0
    UNION ALL
    SELECT 'supplier', s_suppkey, s_name, s_nationkey, CAST(s_acctbal AS DECIMAL(12,2)), NULL
    FROM supplier WHERE s_acctbal > 0""",
)
def q_union_relations(spark, sf_dir):
    customer, supplier = table(spark, sf_dir, "customer"), table(spark, sf_dir, "supplier")
    plain = {
        "customer": customer.withColumnsRenamed({c: c.removeprefix("c_") for c in customer.columns}),
        "supplier": supplier.withColumnsRenamed({"s_suppkey": "key"}).withColumnsRenamed(
            {c: c.removeprefix("s_") for c in supplier.columns}
        ),
    }
    plain["customer"] = plain["customer"].withColumnRenamed("custkey", "key")
    return union_relations(plain, column_override={"acctbal": "decimal(12,2)"}, where=F.col("acctbal") > 0)


@query(
    "union_relations_include",
    """SELECT c_nationkey AS nationkey, c_name AS name FROM customer
    UNION ALL SELECT s_nationkey, s_name FROM supplier
    UNION ALL SELECT n_nationkey, n_name FROM nation""",
)
def q_union_relations_include(spark, sf_dir):
    """Three tables cut to two columns, without the source column."""
    parts = {
        name: table(spark, sf_dir, name).withColumnsRenamed({f"{p}_name": "name", f"{p}_nationkey": "nationkey"})
        for name, p in (("customer", "c"), ("supplier", "s"), ("nation", "n"))
    }
    return union_relations(parts, include=["NATIONKEY", "name"], source_column_name=None)


_STATUSES = ["F", "O", "P"]


@query(
    "pivot_counts",
    """SELECT o_orderpriority, CAST(sum(CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END) AS BIGINT) AS n_F_orders,
      CAST(sum(CASE WHEN o_orderstatus = 'O' THEN 1 ELSE 0 END) AS BIGINT) AS n_O_orders,
      CAST(sum(CASE WHEN o_orderstatus = 'P' THEN 1 ELSE 0 END) AS BIGINT) AS n_P_orders
    FROM orders GROUP BY o_orderpriority""",
)
def q_pivot_counts(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    return pivot(orders, ["o_orderpriority"], "o_orderstatus", _STATUSES, prefix="n_", suffix="_orders")


@query(
    "pivot_values",
    """SELECT l_shipmonth, CAST(sum(CASE WHEN l_returnflag = 'A' THEN quantity END) AS DECIMAL(22,2)) AS a_quantity,
      CAST(sum(CASE WHEN l_returnflag = 'N' THEN quantity END) AS DECIMAL(22,2)) AS n_quantity,
      CAST(sum(CASE WHEN l_returnflag = 'R' THEN quantity END) AS DECIMAL(22,2)) AS r_quantity
    FROM (SELECT CAST(date_trunc('month', l_shipdate) AS DATE) AS l_shipmonth, l_returnflag,
                 CAST(l_quantity AS DECIMAL(12,2)) AS quantity FROM lineitem)
    GROUP BY l_shipmonth""",
)
def q_pivot_values(spark, sf_dir):
    """Quantities per month and flag, NULL where a month has none, under plain lower-case names."""
    lines = table(spark, sf_dir, "lineitem").select(
        F.trunc("l_shipdate", "month").alias("l_shipmonth"),
        "l_returnflag",
        F.col("l_quantity").cast("decimal(12,2)").alias("quantity"),
    )
    return pivot(
        lines,
        ["l_shipmonth"],
        "l_returnflag",
        ["A", "N", "R"],
        then_value=F.col("quantity"),
        else_value=None,
        suffix=" Quantity",
        quote_identifiers=False,
    )


@query(
    "pivot_at_least",
    """SELECT l_suppkey, count(DISTINCT CASE WHEN l_quantity >= 10 THEN l_partkey END) AS parts_10,
      count(DISTINCT CASE WHEN l_quantity >= 40 THEN l_partkey END) AS parts_40
    FROM lineitem GROUP BY l_suppkey""",
)
def q_pivot_at_least(spark, sf_dir):
    """Distinct parts per supplier sold in at least the given quantities."""
    lines = table(spark, sf_dir, "lineitem")
    options = dict(agg="count", cmp=">=", distinct=True, then_value=F.col("l_partkey"), else_value=None)
    return pivot(lines, ["l_suppkey"], "l_quantity", [10, 40], prefix="parts_", **options)


@query(
    "unpivot_numeric",
    """SELECT l_orderkey, l_linenumber, 'l_quantity' AS measure, l_quantity AS amount FROM lineitem
    UNION ALL SELECT l_orderkey, l_linenumber, 'l_extendedprice', l_extendedprice FROM lineitem
    UNION ALL SELECT l_orderkey, l_linenumber, 'l_discount', l_discount FROM lineitem
    UNION ALL SELECT l_orderkey, l_linenumber, 'l_tax', l_tax FROM lineitem""",
)
def q_unpivot_numeric(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem")
    dropped = ["l_partkey", "l_suppkey", "l_returnflag", "l_linestatus", "l_shipdate"]
    return unpivot(lines, "double", ["l_orderkey", "l_linenumber"], dropped, "measure", "amount")


@query(
    "unpivot_text",
    """SELECT o_orderkey, 'o_custkey' AS field_name, CAST(o_custkey AS VARCHAR) AS value FROM orders
    UNION ALL SELECT o_orderkey, 'o_orderstatus', o_orderstatus FROM orders
    UNION ALL SELECT o_orderkey, 'o_orderpriority', o_orderpriority FROM orders
    UNION ALL SELECT o_orderkey, 'is_large', CAST(o_totalprice > 200000 AS VARCHAR) FROM orders""",
)
def q_unpivot_text(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").withColumn("is_large", F.col("o_totalprice") > 200000)
    return unpivot(orders, exclude=["o_orderkey"], remove=["o_totalprice", "o_orderdate"])


# --- series ------------------------------------------------------------------


@query(
    "generate_series",
    """SELECT s.n AS generated_number, coalesce(c.n_lines, 0) AS n_lines
    FROM (SELECT unnest(generate_series(1, (SELECT max(l_orderkey) FROM lineitem))) AS n) s
    LEFT JOIN (SELECT l_orderkey, count(*) AS n_lines FROM lineitem GROUP BY l_orderkey) c ON c.l_orderkey = s.n""",
)
def q_generate_series(spark, sf_dir):
    """Line counts for every order number up to the largest, also where an order has no line."""
    lines = table(spark, sf_dir, "lineitem")
    largest = lines.agg(F.max("l_orderkey")).first()[0]
    counted = lines.groupBy(F.col("l_orderkey").alias("generated_number")).agg(F.count(F.lit(1)).alias("n_lines"))
    series = generate_series(spark, largest)
    return series.join(counted, "generated_number", "left").fillna(0, ["n_lines"])


_FIRST_LAST = "SELECT min(o_orderdate) AS first_day, max(o_orderdate) AS last_day FROM orders"


def _order_days(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    ends = orders.agg(F.min("o_orderdate").cast("date").alias("lo"), F.max("o_orderdate").cast("date").alias("hi"))
    return orders, ends.first()


@query(
    "date_spine",
    f"""SELECT CAST(m AS DATE) AS date_month,
      (SELECT count(*) FROM orders WHERE date_trunc('month', o_orderdate) = date_trunc('month', m)) AS n_orders
    FROM (SELECT unnest(generate_series(first_day, date_trunc('month', last_day) + to_days(day(first_day) - 1)
                                        - INTERVAL 1 MONTH, INTERVAL 1 MONTH)) AS m FROM ({_FIRST_LAST}))""",
)
def q_date_spine(spark, sf_dir):
    """One row per month from the first order on, with the orders of that calendar month."""
    orders, ends = _order_days(spark, sf_dir)
    spine = date_spine(spark, "month", ends.lo, ends.hi)
    counted = orders.groupBy(F.trunc("o_orderdate", "month").alias("month")).agg(F.count(F.lit(1)).alias("n_orders"))
    joined = spine.join(counted, F.trunc("date_month", "month") == F.col("month"), "left")
    return joined.select("date_month", F.coalesce("n_orders", F.lit(0)).cast("bigint").alias("n_orders"))


@query(
    "date_spine_daily_counts",
    """SELECT CAST(d AS DATE) AS date_day, count(e.event_id) AS n_events,
      count(e.event_id) FILTER (e.event_type = 'error') AS n_errors
    FROM (SELECT unnest(generate_series(min(CAST(ts AS DATE)) - INTERVAL 3 DAY, max(CAST(ts AS DATE)) + INTERVAL 2 DAY,
                                        INTERVAL 1 DAY)) AS d FROM events)
    LEFT JOIN events e ON CAST(e.ts AS DATE) = CAST(d AS DATE) GROUP BY 1""",
)
def q_date_spine_daily_counts(spark, sf_dir):
    """Event counts per day, with days around the first and last event that have none."""
    events = table(spark, sf_dir, "events").select(F.col("ts").cast("date").alias("date_day"), "event_type")
    ends = events.agg(
        F.date_sub(F.min("date_day"), 3).alias("lo"), F.date_add(F.max("date_day"), 3).alias("hi")
    ).first()
    counted = events.groupBy("date_day").agg(
        F.count(F.lit(1)).alias("n_events"), F.count_if(F.col("event_type") == "error").alias("n_errors")
    )
    spine = date_spine(spark, "day", ends.lo, ends.hi)
    return spine.join(counted, "date_day", "left").fillna(0, ["n_events", "n_errors"])


@query(
    "date_spine_hourly",
    """SELECT h AS date_hour, count(e.event_id) AS n_events
    FROM (SELECT unnest(generate_series(date_trunc('hour', min(ts)), date_trunc('hour', max(ts)) - INTERVAL 1 HOUR,
                                        INTERVAL 1 HOUR)) AS h FROM events)
    LEFT JOIN events e ON date_trunc('hour', e.ts) = h GROUP BY h""",
)
def q_date_spine_hourly(spark, sf_dir):
    events = table(spark, sf_dir, "events").select(F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("date_hour"))
    ends = events.agg(F.min("date_hour").alias("lo"), F.max("date_hour").alias("hi")).first()
    counted = events.groupBy("date_hour").agg(F.count(F.lit(1)).alias("n_events"))
    return date_spine(spark, "hour", ends.lo, ends.hi).join(counted, "date_hour", "left").fillna(0, ["n_events"])


@query(
    "intervals_between",
    """SELECT l_orderkey, l_linenumber, date_diff('day', o_orderdate, l_shipdate) AS days,
      CAST(date_diff('day', date_trunc('week', o_orderdate + INTERVAL 1 DAY),
                     date_trunc('week', l_shipdate + INTERVAL 1 DAY)) / 7 AS BIGINT) AS weeks,
      date_diff('month', o_orderdate, l_shipdate) AS months, date_diff('quarter', o_orderdate, l_shipdate) AS quarters,
      date_diff('year', o_orderdate, l_shipdate) AS years, date_diff('hour', o_orderdate, l_shipdate) AS hours
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
)
def q_intervals_between(spark, sf_dir):
    """Time from order to shipping in units of the calendar."""
    lines, orders = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "orders")
    joined = lines.join(orders, lines.l_orderkey == orders.o_orderkey)
    span = [
        intervals_between(F.col("o_orderdate"), F.col("l_shipdate"), unit).alias(f"{unit}s")
        for unit in ("day", "week", "month", "quarter", "year", "hour")
    ]
    return joined.select("l_orderkey", "l_linenumber", *span)


# --- column functions --------------------------------------------------------

_LINE = "l_orderkey, l_linenumber"
_SMALL = "nullif(l_linenumber, 1)"


@query(
    "safe_add",
    f"""SELECT {_LINE}, coalesce({_SMALL}, 0) + coalesce(l_partkey, 0) + coalesce(nullif(l_suppkey, 7), 0) AS total
    FROM lineitem""",
)
def q_safe_add(spark, sf_dir):
    total = safe_add([F.expr(_SMALL), "l_partkey", F.expr("nullif(l_suppkey, 7)")])
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", total.alias("total"))


@query(
    "safe_subtract",
    f"""SELECT {_LINE}, coalesce({_SMALL}, 0) - coalesce(l_partkey, 0) - coalesce(nullif(l_suppkey, 7), 0) AS remainder
    FROM lineitem""",
)
def q_safe_subtract(spark, sf_dir):
    remainder = safe_subtract([F.expr(_SMALL), "l_partkey", F.expr("nullif(l_suppkey, 7)")])
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", remainder.alias("remainder"))


@query("safe_divide", f"SELECT {_LINE}, l_extendedprice / nullif(l_tax, 0) AS price_per_tax FROM lineitem")
def q_safe_divide(spark, sf_dir):
    ratio = safe_divide("l_extendedprice", "l_tax").alias("price_per_tax")
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", ratio)


@query(
    "width_bucket",
    """SELECT p_partkey, CAST(CASE WHEN p_retailprice < 950 THEN 0 WHEN p_retailprice >= 1050 THEN 9
      ELSE floor((p_retailprice - 950) / 12.5) + 1 END AS BIGINT) AS bucket FROM part""",
)
def q_width_bucket(spark, sf_dir):
    bucket = width_bucket("p_retailprice", 950, 1050, 8).alias("bucket")
    return table(spark, sf_dir, "part").select("p_partkey", bucket)


_POINTS = """(SELECT event_id, CAST(user_id % 181 AS DOUBLE) - 90 AS lat1, CAST(event_id % 361 AS DOUBLE) - 180 AS lon1,
      value / 490.02 * 180 - 90 AS lat2, value / 490.02 * 360 - 180 AS lon2 FROM events)"""


def _haversine_sql(factor: str) -> str:
    distance = f"""(2 * 3961 * asin(sqrt(least(1.0, power(sin((radians(lat2) - radians(lat1)) / 2), 2)
        + cos(radians(lat1)) * cos(radians(lat2)) * power(sin((radians(lon2) - radians(lon1)) / 2), 2)))) * {factor})"""
    return f"SELECT event_id, {sql_round(distance, 3)} AS distance FROM {_POINTS}"


def _haversine(spark, sf_dir, unit):
    points = table(spark, sf_dir, "events").select(
        "event_id",
        (F.col("user_id") % 181 - 90).cast("double").alias("lat1"),
        (F.col("event_id") % 361 - 180).cast("double").alias("lon1"),
        (F.col("value") / 490.02 * 180 - 90).alias("lat2"),
        (F.col("value") / 490.02 * 360 - 180).alias("lon2"),
    )
    distance = haversine_distance("lat1", "lon1", "lat2", "lon2", unit)
    return points.select("event_id", round_half_away(distance, 3).alias("distance"))


@query("haversine_miles", _haversine_sql("1.0e0"))
def q_haversine_miles(spark, sf_dir):
    return _haversine(spark, sf_dir, "mi")


@query("haversine_kilometres", _haversine_sql("1.60934e0"))
def q_haversine_kilometres(spark, sf_dir):
    return _haversine(spark, sf_dir, "km")


@query(
    "url_host",
    r"""SELECT page_id, regexp_extract(replace(replace(replace(url, 'android-app://', ''), 'http://', ''),
      'https://', ''), '^[^/?]*') AS host FROM pages""",
)
def q_url_host(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", url_host("url").alias("host"))


@query(
    "url_path",
    r"""SELECT page_id, CASE WHEN strpos(rest, '/') > 0 THEN split_part(substr(rest, strpos(rest, '/') + 1), '?', 1)
      WHEN strpos(rest, '?') > 0 THEN '' ELSE rest END AS path
    FROM (SELECT page_id, replace(replace(url, 'http://', ''), 'https://', '') AS rest FROM pages)""",
)
def q_url_path(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", url_path("url").alias("path"))


@query(
    "url_parameter",
    """SELECT page_id, nullif(split_part(split_part(url, 'utm_source=', 2), '&', 1), '') AS utm_source,
      nullif(split_part(split_part(url, 'page=', 2), '&', 1), '') AS page,
      nullif(split_part(split_part(url, 'ref=', 2), '&', 1), '') AS ref FROM pages""",
)
def q_url_parameter(spark, sf_dir):
    names = ("utm_source", "page", "ref")
    return table(spark, sf_dir, "pages").select("page_id", *[url_parameter("url", n).alias(n) for n in names])


# --- introspection -----------------------------------------------------------


@query(
    "column_values",
    "SELECT p_brand AS value, count(*) AS n_records FROM part WHERE p_size > 10 GROUP BY 1",
)
def q_column_values(spark, sf_dir):
    return column_values(table(spark, sf_dir, "part"), "p_brand", where="p_size > 10")


@query(
    "column_values_top",
    "SELECT o_custkey AS value, count(*) AS n_records FROM orders GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 20",
)
def q_column_values_top(spark, sf_dir):
    """The twenty customers with most orders."""
    return column_values(table(spark, sf_dir, "orders"), "o_custkey", max_records=20)


@query(
    "pivot_of_column_values",
    """SELECT CAST(month(l_shipdate) AS INTEGER) AS ship_month, count(*) FILTER (l_linestatus = 'F') AS "status_F",
      count(*) FILTER (l_linestatus = 'O') AS "status_O" FROM lineitem GROUP BY 1""",
)
def q_pivot_of_column_values(spark, sf_dir):
    """The values found in the table become the columns."""
    lines = table(spark, sf_dir, "lineitem").select(F.month("l_shipdate").alias("ship_month"), "l_linestatus")
    statuses = get_column_values(spark, lines, "l_linestatus", max_records=100)
    return pivot(lines, ["ship_month"], "l_linestatus", sorted(statuses), prefix="status_")


@query(
    "single_value",
    "SELECT o_orderkey, o_custkey FROM orders WHERE o_orderdate = (SELECT max(o_orderdate) FROM orders)",
)
def q_single_value(spark, sf_dir):
    """Orders of the last day, which is looked up first."""
    orders = table(spark, sf_dir, "orders")
    last = get_single_value(orders.agg(F.max("o_orderdate").cast("string")))
    return orders.where(F.col("o_orderdate") == F.lit(last).cast("timestamp_ntz")).select("o_orderkey", "o_custkey")


@query(
    "star_aggregate",
    """SELECT l_returnflag, l_linestatus, CAST(sum(l_linenumber) AS BIGINT) AS l_linenumber_sum,
      max(l_shipdate) AS last_shipped FROM lineitem GROUP BY 1, 2""",
)
def q_star_aggregate(spark, sf_dir):
    """Grouped by all columns but the ones that are aggregated."""
    lines = table(spark, sf_dir, "lineitem").select("l_returnflag", "l_linestatus", "l_linenumber", "l_shipdate")
    keys = star(lines, exclude=["l_linenumber", "l_shipdate"])
    total = F.sum("l_linenumber").cast("bigint").alias("l_linenumber_sum")
    return lines.groupBy(*keys).agg(total, F.max("l_shipdate").alias("last_shipped"))
