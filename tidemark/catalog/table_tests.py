"""Generic table tests."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import rules
from ..operators import table_tests as g
from ..operators.suite import Check, Result, run_checks, test_result
from .registry import query, rounded, text


@query("unique", "SELECT o_custkey, count(*) AS n_records FROM orders GROUP BY 1 HAVING count(*) > 1")
def unique(t):
    return g.unique(t.orders, "o_custkey")


@query("not_null", "SELECT o_orderkey FROM orders WHERE nullif(o_orderstatus, 'F') IS NULL")
def not_null(t):
    rows = t.orders.withColumn("status", F.nullif("o_orderstatus", F.lit("F")))
    return g.not_null(rows, "status").select("o_orderkey")


@query(
    "accepted_values",
    "SELECT event_type, count(*) AS n_records FROM events WHERE event_type NOT IN ('view', 'Click') GROUP BY 1",
)
def accepted_values(t):
    return g.accepted_values(t.events, "event_type", ["view", "Click"])


@query("not_accepted_values", "SELECT DISTINCT event_type FROM events WHERE event_type IN ('error', 'crash')")
def not_accepted_values(t):
    return g.not_accepted_values(t.events, "event_type", ["error", "crash"])


@query(
    "relationships",
    "SELECT doc_id, count(*) AS failing_rows FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels) GROUP BY 1",
)
def relationships(t):
    return g.relationships(t.documents, "doc_id", t.labels, "doc_id")


@query(
    "relationships_where",
    "SELECT o_custkey, count(*) AS failing_rows FROM orders WHERE o_orderstatus = 'O'"
    " AND o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_mktsegment <> 'BUILDING') GROUP BY 1",
)
def relationships_where(t):
    return g.relationships_where(
        t.orders, "o_custkey", t.customer, "c_custkey", "o_orderstatus = 'O'", "c_mktsegment <> 'BUILDING'"
    )


@query(
    "test_result",
    """
    WITH f AS (
      SELECT 'not_null_orders' AS "check", count(*) FILTER (o_orderkey IS NULL) AS failures FROM orders UNION ALL
      SELECT 'status_is_o', count(*) FILTER (o_orderstatus <> 'O') FROM orders UNION ALL
      SELECT 'few_low', count(*) FILTER (o_orderpriority = '5-LOW') FROM orders UNION ALL
      SELECT 'unique_customer', count(*) FROM (SELECT o_custkey FROM orders GROUP BY 1 HAVING count(*) > 1))
    SELECT *, CASE WHEN "check" = 'few_low' THEN 'warn' WHEN failures = 0 THEN 'pass' ELSE 'error' END AS status FROM f
    """,
)
def result(t):
    """Row rules fused into one pass; a keyed test counted beside them."""
    fused = run_checks(
        t.orders,
        [
            Check("not_null_orders", rules.is_missing("o_orderkey")),
            Check("status_is_o", rules.not_in_set("o_orderstatus", ["O"])),
            Check("few_low", rules.in_set("o_orderpriority", ["5-LOW"]), warn_if="> 10", error_if="< 0"),
        ],
    )
    keyed = test_result([Result(Check("unique_customer"), g.unique(t.orders, "o_custkey"))])
    return fused.drop("rows_tested").unionByName(keyed)


@query("accepted_range", "SELECT p_partkey, p_size FROM part WHERE NOT (p_size > 1 AND p_size < 50)")
def accepted_range(t):
    return g.accepted_range(t.part, "p_size", 1, 50, inclusive=False).select("p_partkey", "p_size")


@query(
    "at_least_one",
    "SELECT l_returnflag, count(nullif(l_returnflag, 'A')) AS n_present FROM lineitem GROUP BY 1 HAVING count(nullif(l_returnflag, 'A')) = 0",
)
def at_least_one(t):
    rows = t.lineitem.withColumn("flag", F.nullif("l_returnflag", F.lit("A")))
    return g.at_least_one(rows, "flag", ["l_returnflag"])


@query(
    "not_constant",
    "SELECT l_orderkey, count(DISTINCT l_returnflag) AS n_distinct FROM lineitem GROUP BY 1 HAVING count(DISTINCT l_returnflag) = 1",
)
def not_constant(t):
    return g.not_constant(t.lineitem, "l_returnflag", ["l_orderkey"])


@query(
    "not_empty_string",
    "SELECT o_orderkey FROM orders WHERE trim(replace(o_orderstatus, 'P', '  ')) = ''",
)
def not_empty_string(t):
    rows = t.orders.withColumn("status", F.replace(F.col("o_orderstatus"), F.lit("P"), F.lit("  ")))
    return g.not_empty_string(rows, "status").select("o_orderkey")


@query(
    "not_null_proportion",
    "SELECT o_custkey, round(count(nullif(o_orderstatus, 'P')) / count(*), 6) AS not_null_proportion FROM orders"
    " GROUP BY 1 HAVING count(nullif(o_orderstatus, 'P')) / count(*) < 0.5",
)
def not_null_proportion(t):
    rows = t.orders.withColumn("status", F.nullif("o_orderstatus", F.lit("P")))
    failing = g.not_null_proportion(rows, "status", 0.5, group_by=["o_custkey"])
    return failing.withColumn("not_null_proportion", rounded("not_null_proportion", 6))


@query(
    "unique_combination_of_columns",
    "SELECT user_id, day, count(*) AS n_records FROM (SELECT nullif(user_id, 1) AS user_id, CAST(CAST(ts AS DATE) AS VARCHAR) AS day FROM events)"
    " GROUP BY 1, 2 HAVING count(*) > 1",
)
def unique_combination(t):
    rows = t.events.select(F.nullif("user_id", F.lit(1)).alias("user_id"), F.to_date("ts").cast("string").alias("day"))
    return g.unique_combination_of_columns(rows, ["user_id", "day"])


@query(
    "row_expression_is_true",
    "SELECT l_orderkey, l_linenumber FROM lineitem WHERE NOT (l_quantity * 2000 >= l_extendedprice)",
)
def row_expression(t):
    failing = g.row_expression_is_true(t.lineitem, "* 2000 >= l_extendedprice", "l_quantity")
    return failing.select("l_orderkey", "l_linenumber")


# --- two tables --------------------------------------------------------------

_CARDINALITY = """
    WITH a AS (SELECT CAST(c_nationkey + CASE WHEN c_acctbal > 9000 THEN 0 ELSE 30 END AS BIGINT) AS value_field, count(*) AS n_records FROM customer GROUP BY 1),
    b AS (SELECT CAST(s_nationkey AS BIGINT) AS value_field, count(*) AS n_records FROM supplier GROUP BY 1)
    SELECT 'a_minus_b' AS which_diff, * FROM (SELECT * FROM a EXCEPT SELECT * FROM b)
    UNION ALL SELECT 'b_minus_a', * FROM (SELECT * FROM b EXCEPT SELECT * FROM a)
"""


@query("cardinality_equality", _CARDINALITY)
def cardinality_equality(t):
    """Customers by nation, all but the richest by a shifted one."""
    return g.cardinality_equality(_shifted(t, 9000), "nation", _supplier_nations(t), "nation")


def _shifted(t, balance):
    nation = F.col("c_nationkey") + F.when(F.col("c_acctbal") > balance, 0).otherwise(30)
    return t.customer.select(nation.cast("bigint").alias("nation"))


def _supplier_nations(t):
    return t.supplier.select(F.col("s_nationkey").cast("bigint").alias("nation"))


_EQUALITY = """
    WITH a AS (SELECT o_custkey, o_orderpriority FROM orders),
    b AS (SELECT o_custkey, CASE WHEN o_orderstatus = 'F' THEN '1-URGENT' ELSE o_orderpriority END AS o_orderpriority FROM orders),
    d AS (SELECT 'a_minus_b' AS which_diff, * FROM (SELECT * FROM a EXCEPT SELECT * FROM b)
      UNION ALL SELECT 'b_minus_a', * FROM (SELECT * FROM b EXCEPT SELECT * FROM a))
"""


def _equality(t):
    urgent = F.when(F.col("o_orderstatus") == "F", "1-URGENT").otherwise(F.col("o_orderpriority"))
    return g.equality(t.orders, t.orders.withColumn("o_orderpriority", urgent), ["o_custkey", "o_orderpriority"])


@query("equality", _EQUALITY + "SELECT * FROM d")
def equality(t):
    return _equality(t)


@query(
    "equality_failures",
    _EQUALITY
    + "SELECT count(*) + abs(count(*) FILTER (which_diff = 'a_minus_b') - count(*) FILTER (which_diff = 'b_minus_a')) AS failures FROM d",
)
def equality_failures(t):
    return g.equality_failures(_equality(t))


_COUNTS = """
    WITH a AS (SELECT CAST(c_nationkey + CASE WHEN c_acctbal > 9500 THEN 0 ELSE 30 END AS BIGINT) AS nation, count(*) AS count_a FROM customer GROUP BY 1),
    b AS (SELECT CAST(s_nationkey AS BIGINT) AS nation, count(*) AS count_b FROM supplier GROUP BY 1)
"""


def _nations(t):
    return _shifted(t, 9500), _supplier_nations(t)


@query(
    "equal_rowcount",
    _COUNTS + "SELECT nation, count_a, count_b, abs(count_a - count_b) AS diff_count FROM a FULL JOIN b USING (nation) WHERE count_a <> count_b",
)
def equal_rowcount(t):
    return g.equal_rowcount(*_nations(t), ["nation"])


@query(
    "fewer_rows_than",
    _COUNTS
    + "SELECT nation, count_a, count_b, CASE WHEN count_a = count_b THEN 1 ELSE count_a - count_b END AS row_count_delta"
    " FROM a FULL JOIN b USING (nation) WHERE count_a >= count_b",
)
def fewer_rows_than(t):
    return g.fewer_rows_than(*_nations(t), ["nation"])


# --- neighbours and recency --------------------------------------------------


@query(
    "sequential_values",
    """
    WITH d AS (SELECT event_type, date_trunc('hour', ts) AS h, count(*) AS copies FROM events GROUP BY 1, 2),
    l AS (SELECT *, lag(h) OVER (PARTITION BY event_type ORDER BY h) AS p FROM d),
    f AS (SELECT *, CASE WHEN p IS NOT NULL AND h <> p + INTERVAL 1 HOUR THEN 1 ELSE 0 END + copies - 1 AS failing_rows FROM l)
    SELECT event_type, CAST(h AS VARCHAR) AS hour, CAST(p AS VARCHAR) AS previous, CAST(failing_rows AS BIGINT) AS failing_rows FROM f WHERE failing_rows > 0
    """,
)
def sequential_values(t):
    rows = t.events.select("event_type", F.date_trunc("hour", "ts").alias("hour"))
    failing = g.sequential_values(rows, "hour", 1, "hour", ["event_type"])
    return failing.select("event_type", text("hour"), text("previous"), "failing_rows")


@query(
    "sequential_values_of_numbers",
    """
    WITH d AS (SELECT p_brand, p_partkey, lag(p_partkey) OVER (PARTITION BY p_brand ORDER BY p_partkey) AS previous FROM part)
    SELECT *, CAST(1 AS BIGINT) AS failing_rows FROM d WHERE NOT p_partkey = previous + 2
    """,
)
def sequential_numbers(t):
    return g.sequential_values(t.part, "p_partkey", 2, group_by=["p_brand"])


@query(
    "mutually_exclusive_ranges",
    """
    WITH r AS (SELECT o_custkey, CAST(o_orderdate AS DATE) AS a, CAST(o_orderdate + INTERVAL 30 DAY AS DATE) AS b, count(*) AS copies FROM orders GROUP BY 1, 2, 3),
    l AS (SELECT *, lead(a) OVER (PARTITION BY o_custkey ORDER BY a, b) AS n FROM r),
    f AS (SELECT *, CASE WHEN n IS NULL OR b <= n THEN 0 ELSE 1 END + copies - 1 AS failing_rows FROM l)
    SELECT o_custkey, CAST(a AS VARCHAR) AS valid_from, CAST(b AS VARCHAR) AS valid_to, CAST(n AS VARCHAR) AS next_lower_bound,
      CAST(failing_rows AS BIGINT) AS failing_rows FROM f WHERE failing_rows > 0
    """,
)
def mutually_exclusive_ranges(t):
    rows = t.orders.select(
        "o_custkey",
        F.to_date("o_orderdate").alias("valid_from"),
        F.date_add(F.to_date("o_orderdate"), 30).alias("valid_to"),
    )
    failing = g.mutually_exclusive_ranges(rows, "valid_from", "valid_to", "o_custkey")
    return failing.select(
        "o_custkey", text("valid_from"), text("valid_to"), text("next_lower_bound"), "failing_rows"
    )


@query(
    "recency",
    "SELECT user_id, CAST(max(ts) AS DATE)::VARCHAR AS most_recent, '2024-01-30' AS threshold FROM events"
    " GROUP BY 1 HAVING CAST(max(ts) AS DATE) < DATE '2024-01-30'",
)
def recency(t):
    failing = g.recency(
        t.events, "ts", "day", 1, "2024-01-31 00:00:00", ignore_time_component=True, group_by=["user_id"]
    )
    return failing.select("user_id", text("most_recent"), text("threshold"))
