"""Data-quality checks over the supplied tables. Each query gives the violations."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from ..operators import checks as C
from .base import query, table
from .feed import NEWS_SQL, news


@query(
    "q_not_null",
    f"WITH {NEWS_SQL} SELECT global_event_id, event_date FROM staged WHERE action_geo_fullname IS NULL",
)
def q_not_null(spark, sf_dir):
    return C.not_null(news(spark, sf_dir), "action_geo_fullname").violations.select("global_event_id", "event_date")


@query(
    "q_unique",
    "SELECT o_custkey AS unique_field, count(*) AS n_records FROM orders GROUP BY 1 HAVING count(*) > 1",
)
def q_unique(spark, sf_dir):
    return C.unique(table(spark, sf_dir, "orders"), "o_custkey").violations


@query(
    "q_accepted_values",
    f"""WITH {NEWS_SQL} SELECT quad_class AS value_field, count(*) AS n_records FROM staged
    GROUP BY 1 HAVING quad_class NOT IN (1, 2, 3, 4)""",
)
def q_accepted_values(spark, sf_dir):
    return C.accepted_values(news(spark, sf_dir), "quad_class", [1, 2, 3, 4]).violations


@query(
    "q_tone_in_range",
    """SELECT event_id AS global_event_id, value - 50 AS avg_tone FROM events
    WHERE value - 50 < -100 OR value - 50 > 100""",
)
def q_tone_in_range(spark, sf_dir):
    found = C.accepted_range(news(spark, sf_dir), "avg_tone", -100, 100).violations
    return found.select("global_event_id", "avg_tone")


@query(
    "q_accepted_range",
    """SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem
    WHERE NOT l_quantity > 3 OR NOT l_quantity < l_linenumber * 10""",
)
def q_accepted_range(spark, sf_dir):
    """Quantities between 3 and ten times the line number, both excluded."""
    lines = table(spark, sf_dir, "lineitem")
    check = C.accepted_range(lines, "l_quantity", 3, F.col("l_linenumber") * 10, inclusive=False)
    return check.violations.select("l_orderkey", "l_linenumber", "l_quantity")


@query(
    "q_at_least_one",
    """SELECT o_custkey, 0::BIGINT AS n_values FROM orders
    GROUP BY o_custkey HAVING count(CASE WHEN o_orderstatus = 'P' THEN o_orderkey END) = 0""",
)
def q_at_least_one(spark, sf_dir):
    """Customers without any pending order."""
    pending = F.when(F.col("o_orderstatus") == "P", F.col("o_orderkey"))
    orders = table(spark, sf_dir, "orders").select("o_custkey", pending.alias("pending_order"))
    return C.at_least_one(orders, "pending_order", ["o_custkey"]).violations


@query(
    "q_at_least_one_ungrouped",
    "SELECT count(value) AS n_values FROM events WHERE value > 1000000 HAVING count(value) = 0",
)
def q_at_least_one_ungrouped(spark, sf_dir):
    """No event has a value above a million, so the check over the whole table reports one row."""
    huge = F.when(F.col("value") > 1_000_000, F.col("value"))
    return C.at_least_one(table(spark, sf_dir, "events").select(huge.alias("huge_value")), "huge_value").violations


@query(
    "q_cardinality_equality",
    """WITH a AS (SELECT o_custkey AS v, count(*) AS n FROM orders GROUP BY 1),
    b AS (SELECT c_custkey AS v, count(*) AS n FROM customer GROUP BY 1)
    SELECT v AS value_field, n AS num_rows FROM (SELECT * FROM a EXCEPT SELECT * FROM b)
    UNION ALL SELECT v, n FROM (SELECT * FROM b EXCEPT SELECT * FROM a)""",
)
def q_cardinality_equality(spark, sf_dir):
    orders, customer = table(spark, sf_dir, "orders"), table(spark, sf_dir, "customer")
    return C.cardinality_equality(orders, "o_custkey", customer, "c_custkey").violations


@query(
    "q_equal_rowcount",
    """WITH a AS (SELECT o_orderkey AS k, count(*) AS n FROM orders GROUP BY 1),
    b AS (SELECT l_orderkey AS k, count(*) AS n FROM lineitem GROUP BY 1)
    SELECT coalesce(a.k, b.k) AS order_key, a.n AS count_a, b.n AS count_b, abs(a.n - b.n) AS diff_count
    FROM a FULL JOIN b ON a.k = b.k""",
)
def q_equal_rowcount(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("order_key"))
    lines = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("order_key"))
    return C.equal_rowcount(orders, lines, ["order_key"]).violations


@query(
    "q_equal_rowcount_ungrouped",
    """SELECT a.n AS count_a, b.n AS count_b, abs(a.n - b.n) AS diff_count
    FROM (SELECT count(*) AS n FROM orders) a, (SELECT count(*) AS n FROM events) b""",
)
def q_equal_rowcount_ungrouped(spark, sf_dir):
    return C.equal_rowcount(table(spark, sf_dir, "orders"), table(spark, sf_dir, "events")).violations


@query(
    "q_fewer_rows_than",
    """WITH a AS (SELECT c_nationkey AS k, count(*) AS n FROM customer GROUP BY 1),
    b AS (SELECT s_nationkey AS k, count(*) AS n FROM supplier GROUP BY 1)
    SELECT coalesce(a.k, b.k) AS nationkey, a.n AS count_a, b.n AS count_b,
      CASE WHEN a.n > b.n THEN a.n - b.n WHEN a.n = b.n THEN 1 ELSE 0 END AS row_count_delta
    FROM a FULL JOIN b ON a.k = b.k""",
)
def q_fewer_rows_than(spark, sf_dir):
    customer = table(spark, sf_dir, "customer").select(F.col("c_nationkey").alias("nationkey"))
    supplier = table(spark, sf_dir, "supplier").select(F.col("s_nationkey").alias("nationkey"))
    return C.fewer_rows_than(customer, supplier, ["nationkey"]).violations


BOTH_DIRECTIONS = """SELECT 'a_minus_b' AS which_diff, * FROM (SELECT * FROM a EXCEPT SELECT * FROM b)
    UNION ALL SELECT 'b_minus_a', * FROM (SELECT * FROM b EXCEPT SELECT * FROM a)"""


@query(
    "q_equality",
    f"""WITH a AS (SELECT l_partkey AS partkey, l_suppkey AS suppkey FROM lineitem WHERE l_returnflag = 'A'),
    b AS (SELECT l_partkey AS partkey, l_suppkey AS suppkey FROM lineitem WHERE l_returnflag <> 'A')
    {BOTH_DIRECTIONS}""",
)
def q_equality(spark, sf_dir):
    """Part and supplier pairs found only among returned or only among other lines."""
    lines = table(spark, sf_dir, "lineitem")
    pairs = [F.col("l_partkey").alias("partkey"), F.col("l_suppkey").alias("suppkey")]
    returned = F.col("l_returnflag") == "A"
    return C.equality(lines.where(returned).select(*pairs), lines.where(~returned).select(*pairs)).violations


@query(
    "q_equality_precision",
    f"""WITH a AS (SELECT o_orderkey, CAST(round(CAST(o_totalprice AS DECIMAL(38,9)), 1) AS DECIMAL(38,1)) AS o_totalprice
      FROM orders),
    b AS (SELECT o_orderkey, CAST(round(CAST(o_totalprice AS DECIMAL(38,9)) + 0.02, 1) AS DECIMAL(38,1)) AS o_totalprice
      FROM orders)
    SELECT which_diff, o_orderkey, CAST(o_totalprice AS DOUBLE) AS o_totalprice FROM ({BOTH_DIRECTIONS})""",
)
def q_equality_precision(spark, sf_dir):
    """Orders whose price differs from the price plus two hundredths after rounding to tenths."""
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", F.col("o_totalprice").cast("decimal(38,9)").alias("o_totalprice"), "o_orderstatus"
    )
    moved = orders.withColumn("o_totalprice", F.col("o_totalprice") + F.lit("0.02").cast("decimal(9,2)"))
    found = C.equality(orders, moved, exclude_columns=["O_ORDERSTATUS"], precision=1).violations
    return found.select("which_diff", F.col("o_orderkey").cast("bigint"), F.col("o_totalprice").cast("double"))


@query(
    "q_expression_is_true",
    """SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem
    WHERE NOT (l_extendedprice * (1 - l_discount) > 1000 * l_quantity)""",
)
def q_expression_is_true(spark, sf_dir):
    check = C.expression_is_true(
        table(spark, sf_dir, "lineitem"), "l_extendedprice * (1 - l_discount) > 1000 * l_quantity"
    )
    return check.violations.select("l_orderkey", "l_linenumber", "l_quantity")


@query(
    "q_not_accepted_values",
    "SELECT DISTINCT o_orderpriority AS value_field FROM orders WHERE o_orderpriority IN ('5-LOW', '1-URGENT', 'NONE')",
)
def q_not_accepted_values(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    return C.not_accepted_values(orders, "o_orderpriority", ["5-LOW", "1-URGENT", "NONE"]).violations


@query(
    "q_not_constant",
    """SELECT l_orderkey, min(l_returnflag) AS constant_value FROM lineitem
    GROUP BY l_orderkey HAVING count(DISTINCT l_returnflag) = 1""",
)
def q_not_constant(spark, sf_dir):
    return C.not_constant(table(spark, sf_dir, "lineitem"), "l_returnflag", ["l_orderkey"]).violations


@query(
    "q_not_empty_string",
    """SELECT trim(label) AS label FROM (SELECT CASE event_type WHEN 'view' THEN '   ' ELSE event_type END AS label
    FROM events) WHERE trim(label) = ''""",
)
def q_not_empty_string(spark, sf_dir):
    blanked = F.when(F.col("event_type") == "view", "   ").otherwise(F.col("event_type"))
    return C.not_empty_string(table(spark, sf_dir, "events").select(blanked.alias("label")), "label").violations


@query(
    "q_not_null_proportion",
    """SELECT user_id, count(CASE WHEN value > 50 THEN value END) / count(*) AS not_null_proportion FROM events
    GROUP BY user_id HAVING count(CASE WHEN value > 50 THEN value END) / count(*) < 0.35
                         OR count(CASE WHEN value > 50 THEN value END) / count(*) > 0.5""",
)
def q_not_null_proportion(spark, sf_dir):
    high = F.when(F.col("value") > 50, F.col("value"))
    events = table(spark, sf_dir, "events").select("user_id", high.alias("high_value"))
    return C.not_null_proportion(events, "high_value", 0.35, 0.5, ["user_id"]).violations


@query(
    "q_recency",
    """SELECT user_id, max(ts) AS most_recent, TIMESTAMP '2024-01-31 00:00:00' - INTERVAL 12 HOUR AS threshold
    FROM events GROUP BY user_id HAVING max(ts) < TIMESTAMP '2024-01-31 00:00:00' - INTERVAL 12 HOUR""",
)
def q_recency(spark, sf_dir):
    """Users without an event in the twelve hours before the end of the data."""
    check = C.recency(
        table(spark, sf_dir, "events"), "ts", "hour", 12, datetime(2024, 1, 31), group_by=["user_id"]
    )
    return check.violations


@query(
    "q_recency_by_date",
    """SELECT o_custkey, CAST(max(o_orderdate) AS DATE) AS most_recent, DATE '2001-05-01' AS threshold FROM orders
    GROUP BY o_custkey HAVING CAST(max(o_orderdate) AS DATE) < DATE '2001-05-01'""",
)
def q_recency_by_date(spark, sf_dir):
    """Customers whose last order is more than three months before August 2001."""
    orders, now = table(spark, sf_dir, "orders"), datetime(2001, 8, 1, 15, 30)
    return C.recency(orders, "o_orderdate", "month", 3, now, True, ["o_custkey"]).violations


@query(
    "q_relationships_where",
    """SELECT l_partkey AS id, count(*) AS n_rows FROM lineitem
    LEFT JOIN (SELECT p_partkey FROM part WHERE p_size > 5) p ON l_partkey = p_partkey
    WHERE p_partkey IS NULL AND l_quantity > 10 GROUP BY 1""",
)
def q_relationships_where(spark, sf_dir):
    """Parts on larger lines that are missing among the parts above size 5."""
    lines, part = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "part")
    return C.relationships_where(lines, "l_partkey", part, "p_partkey", "l_quantity > 10", "p_size > 5").violations


@query(
    "q_sequential_values",
    """SELECT *, count(*) AS n_rows FROM (
      SELECT l_orderkey, l_linenumber,
             lag(l_linenumber) OVER (PARTITION BY l_orderkey ORDER BY l_linenumber) AS previous_l_linenumber
      FROM lineitem) WHERE NOT (l_linenumber = previous_l_linenumber + 1) GROUP BY ALL""",
)
def q_sequential_values(spark, sf_dir):
    return C.sequential_values(table(spark, sf_dir, "lineitem"), "l_linenumber", group_by=["l_orderkey"]).violations


@query(
    "q_sequential_values_ungrouped",
    """SELECT *, count(*) AS n_rows FROM (
      SELECT l_partkey, lag(l_partkey) OVER (ORDER BY l_partkey) AS previous_l_partkey FROM lineitem)
    WHERE NOT (l_partkey = previous_l_partkey + 1) GROUP BY ALL""",
)
def q_sequential_values_ungrouped(spark, sf_dir):
    """One sequence over the whole table."""
    return C.sequential_values(table(spark, sf_dir, "lineitem"), "l_partkey").violations


@query(
    "q_sequential_dates",
    """SELECT *, count(*) AS n_rows FROM (
      SELECT o_orderdate, lag(o_orderdate) OVER (ORDER BY o_orderdate) AS previous_o_orderdate FROM orders)
    WHERE NOT (o_orderdate = previous_o_orderdate + INTERVAL 1 DAY) GROUP BY ALL""",
)
def q_sequential_dates(spark, sf_dir):
    return C.sequential_values(table(spark, sf_dir, "orders"), "o_orderdate", 1, "day").violations


# The last record is taken in the same order as the next lower bound. Counting from the other end
# would let equal last ranges be numbered differently from run to run.
def _ranges_sql(source: str, key: str, lower: str, upper: str, gap: str, length: str) -> str:
    partition = f"PARTITION BY {key}" if key else ""
    picked, grouped = (f"{key} AS partition_by_col, ", "partition_by_col, ") if key else ("", "")
    return f"""WITH found AS (
      SELECT {picked}{lower} AS lower_bound, {upper} AS upper_bound,
        lead({lower}) OVER ({partition} ORDER BY {lower} NULLS FIRST, {upper} NULLS FIRST) AS next_lower_bound,
        row_number() OVER ({partition} ORDER BY {lower} NULLS FIRST, {upper} NULLS FIRST)
          = count(*) OVER ({partition}) AS is_last_record
      FROM {source}
    ), judged AS (
      SELECT *, coalesce(lower_bound {length} upper_bound, false) AS has_length,
        coalesce(upper_bound {gap} next_lower_bound, is_last_record, false) AS ends_before_next FROM found
    )
    SELECT {grouped}lower_bound, upper_bound, next_lower_bound, is_last_record, has_length, ends_before_next,
      count(*) AS n_rows
    FROM judged WHERE NOT (has_length AND ends_before_next) GROUP BY ALL"""


def _shipping(spark, sf_dir):
    """Each line as a range from shipping until as many days later as its quantity above 25."""
    until = F.timestamp_add("DAY", (F.col("l_quantity") - 25).cast("int"), F.col("l_shipdate"))
    return table(spark, sf_dir, "lineitem").select("l_suppkey", "l_shipdate", until.alias("until"))


_UNTIL = "l_shipdate + to_days(CAST(l_quantity - 25 AS INTEGER))"


@query("q_ranges_gaps_allowed", _ranges_sql("lineitem", "l_suppkey", "l_shipdate", _UNTIL, "<=", "<"))
def q_ranges_gaps_allowed(spark, sf_dir):
    return C.mutually_exclusive_ranges(_shipping(spark, sf_dir), "l_shipdate", "until", "l_suppkey").violations


@query("q_ranges_gaps_required", _ranges_sql("lineitem", "l_suppkey", "l_shipdate", _UNTIL, "<", "<="))
def q_ranges_gaps_required(spark, sf_dir):
    """Ranges without any extent are allowed here."""
    check = C.mutually_exclusive_ranges(_shipping(spark, sf_dir), "l_shipdate", "until", "l_suppkey", "required", True)
    return check.violations


_END = "CASE WHEN event_type <> 'error' THEN event_id + CAST(floor(value / 100) AS INTEGER) END"


@query("q_ranges_no_gaps", _ranges_sql("events", "", "event_id", _END, "=", "<"))
def q_ranges_no_gaps(spark, sf_dir):
    """One sequence of ranges over the whole table, some with a missing end."""
    until = F.when(F.col("event_type") != "error", F.col("event_id") + F.floor(F.col("value") / 100).cast("int"))
    events = table(spark, sf_dir, "events").select("event_id", until.alias("until"))
    return C.mutually_exclusive_ranges(events, "event_id", "until", gaps="not_allowed").violations


_HOST = "regexp_extract(url, '^https?://([^/]+)', 1)"


@query("q_ranges_of_urls", _ranges_sql("pages", _HOST, "substr(url, 1, 28)", "url", "<", "<"))
def q_ranges_of_urls(spark, sf_dir):
    """Addresses as ranges of text that mostly begin alike, with a bound and a group that are expressions."""
    pages = table(spark, sf_dir, "pages")
    host = F.regexp_extract("url", "^https?://([^/]+)", 1)
    lower = F.substring("url", 1, 28)
    return C.mutually_exclusive_ranges(pages, lower, "url", host, "required", False).violations


@query("q_ranges_of_urls_ungrouped", _ranges_sql("pages", "", "url", "substr(url, 1, 20)", "<=", "<="))
def q_ranges_of_urls_ungrouped(spark, sf_dir):
    """The same over the whole table, with bounds that mostly end too early."""
    upper = F.substring("url", 1, 20)
    check = C.mutually_exclusive_ranges(table(spark, sf_dir, "pages"), "url", upper, None, "allowed", True)
    return check.violations


@query(
    "q_sequential_clocks",
    """SELECT *, count(*) AS n_rows FROM (
      SELECT event_type, ts, lag(ts) OVER (PARTITION BY event_type ORDER BY ts) AS previous_ts FROM events)
    WHERE NOT (ts = previous_ts + INTERVAL 5 SECOND) GROUP BY ALL""",
)
def q_sequential_clocks(spark, sf_dir):
    """Clock readings finer than a second, in a few large groups."""
    events = table(spark, sf_dir, "events")
    return C.sequential_values(events, "ts", 5, "second", group_by=["event_type"]).violations


@query(
    "q_unique_combination",
    "SELECT l_partkey, l_suppkey FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1",
)
def q_unique_combination(spark, sf_dir):
    return C.unique_combination_of_columns(table(spark, sf_dir, "lineitem"), ["l_partkey", "l_suppkey"]).violations


_SOLD, _LISTED = "SELECT l_partkey FROM lineitem WHERE l_quantity > 49", "SELECT p_partkey FROM part WHERE p_size > 5"
_PARTS_SQL = f"""SELECT which_diff FROM (
      SELECT 'a' AS which_diff, * FROM ({_SOLD} EXCEPT {_LISTED})
      UNION ALL SELECT 'b', * FROM ({_LISTED} EXCEPT {_SOLD}))"""


@query(
    "q_comparison_failures",
    f"""SELECT check_name, failures, CASE WHEN severity = 'error' AND failures > error_above THEN 'error'
      WHEN failures <> 0 THEN 'warn' ELSE 'pass' END AS status
    FROM (
      SELECT 'equality' AS check_name, 'error' AS severity, 0 AS error_above,
        count(*) + coalesce(abs(count(*) FILTER (which_diff = 'a') - count(*) FILTER (which_diff = 'b')), 0) AS failures
      FROM ({_PARTS_SQL})
      UNION ALL
      SELECT 'equal_rowcount', 'warn', 0, CAST(sum(coalesce(abs(a.n - b.n), 0)) AS BIGINT)
      FROM (SELECT o_orderkey AS k, count(*) AS n FROM orders GROUP BY 1) a
      FULL JOIN (SELECT l_orderkey AS k, count(*) AS n FROM lineitem GROUP BY 1) b ON a.k = b.k
      UNION ALL
      SELECT 'relationships_where', 'error', 1000000000, count(*) FROM lineitem
      WHERE l_partkey NOT IN (SELECT p_partkey FROM part WHERE p_size > 5)
      UNION ALL
      SELECT 'sequential_values', 'error', 10, count(*) FROM (
        SELECT o_custkey, lag(o_custkey) OVER (ORDER BY o_custkey) AS p FROM orders) WHERE NOT (o_custkey = p + 1))""",
)
def q_comparison_failures(spark, sf_dir):
    """Failure counts of checks that do not simply count violating rows, with severities and thresholds."""
    orders, lines = table(spark, sf_dir, "orders"), table(spark, sf_dir, "lineitem")
    part = table(spark, sf_dir, "part").where("p_size > 5")
    found = [
        C.equality(
            lines.where("l_quantity > 49").select(F.col("l_partkey").alias("partkey")),
            part.select(F.col("p_partkey").alias("partkey")),
        ),
        C.equal_rowcount(
            orders.select(F.col("o_orderkey").alias("order_key")),
            lines.select(F.col("l_orderkey").alias("order_key")),
            ["order_key"],
        ).configured(severity="warn"),
        C.relationships_where(lines, "l_partkey", part, "p_partkey").configured(error_if="> 1000000000"),
        C.sequential_values(orders, "o_custkey").configured(error_if="> 10"),
    ]
    return C.summarise(found).select("check_name", "failures", "status")
