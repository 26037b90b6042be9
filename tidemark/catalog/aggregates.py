"""Expectations on aggregates, and the expression core."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import core as c
from ..operators import expect_aggregates as e
from .registry import query, rounded

PRICE = "CAST(l_extendedprice AS DOUBLE)"


def _shown(failing, digits: int = 4):
    return failing.withColumn("value", rounded("value", digits))


@query(
    "expression_is_true",
    "SELECT l_returnflag, l_linestatus, false AS expression FROM lineitem"
    " GROUP BY 1, 2 HAVING NOT (min(l_quantity) >= 1 AND count(*) > 12000)",
)
def expression_is_true(t):
    return c.expression_is_true(
        t.lineitem, "min(l_quantity) >= 1 and count(*) > 12000", ["l_returnflag", "l_linestatus"]
    )


@query(
    "expression_between",
    "SELECT p_brand, round(max(p_retailprice) - min(p_retailprice), 2) AS value FROM part WHERE p_size > 5"
    " GROUP BY 1 HAVING NOT (max(p_retailprice) - min(p_retailprice) > 60 AND max(p_retailprice) - min(p_retailprice) < 97.5)",
)
def expression_between(t):
    spread = F.max("p_retailprice") - F.min("p_retailprice")
    return _shown(c.expression_between(t.part, spread, 60, 97.5, ["p_brand"], "p_size > 5", True), 2)


@query(
    "get_select",
    "SELECT l_returnflag AS col_1, l_linestatus AS col_2, count(DISTINCT l_suppkey) AS expression"
    " FROM lineitem WHERE l_quantity > 10 GROUP BY 1, 2",
)
def get_select(t):
    keys = ["l_returnflag", "l_linestatus"]
    return c.get_select(t.lineitem, F.count_distinct("l_suppkey"), keys, "l_quantity > 10")


@query(
    "equal_expression",
    """
    WITH a AS (SELECT c_nationkey AS k, count(*) AS e FROM customer GROUP BY 1),
    b AS (SELECT s_nationkey AS k, count(*) AS e FROM supplier WHERE s_acctbal > 0 GROUP BY 1),
    f AS (SELECT coalesce(a.k, b.k) AS col_1, a.e AS expression, b.e AS compare_expression,
      abs(coalesce(a.e, 0) - coalesce(b.e, 0)) AS expression_difference FROM a FULL JOIN b ON a.k = b.k)
    SELECT *, round(expression_difference / nullif(expression, 0), 6) AS expression_difference_percent
    FROM f WHERE expression_difference / nullif(expression, 0) > 0.93
    """,
)
def equal_expression(t):
    rows = F.count(F.lit(1))
    compared = c.equal_expression(
        t.customer, rows, t.supplier, rows, ["c_nationkey"], ["s_nationkey"],
        row_condition="true", compare_row_condition="s_acctbal > 0", tolerance_percent=0.93,
    )
    return compared.withColumn("expression_difference_percent", rounded("expression_difference_percent", 6))


def _between_query(name, metric_sql, low, high, table, column, group, where=None, strictly=False, digits=4):
    """Register a ``*_to_be_between`` expectation with its SQL."""
    op = "" if strictly else "="
    where_sql = f" WHERE {where}" if where else ""
    inside = " AND ".join(
        p for p in (
            f"{metric_sql} >{op} {low}" if low is not None else "",
            f"{metric_sql} <{op} {high}" if high is not None else "",
        ) if p
    )
    sql = (
        f"SELECT {group}, round({metric_sql}, {digits}) AS value FROM {table}{where_sql}"
        f" GROUP BY {group} HAVING NOT ({inside})"
    )
    expectation = getattr(e, name)

    @query(name, sql)
    def run(t):
        failing = expectation(
            getattr(t, table), column, min_value=low, max_value=high,
            group_by=[group], row_condition=where, strictly=strictly,
        )
        return _shown(failing, digits)


_between_query("expect_column_max_to_be_between", "max(p_retailprice)", None, 998, "part", "p_retailprice", "p_brand")
_between_query("expect_column_min_to_be_between", "min(p_retailprice)", 901, None, "part", "p_retailprice", "p_brand")
_between_query(
    "expect_column_mean_to_be_between", "avg(l_quantity)", 25.4, 25.6, "lineitem", "l_quantity", "l_suppkey", "l_tax > 0"
)
_between_query("expect_column_sum_to_be_between", "sum(l_quantity)", 15000, 16000, "lineitem", "l_quantity", "l_suppkey", digits=2)
_between_query(
    "expect_column_stdev_to_be_between", "stddev(l_quantity)", 14.3, 14.6, "lineitem", "l_quantity", "l_suppkey", strictly=True
)
_between_query(
    "expect_column_unique_value_count_to_be_between", "count(DISTINCT l_partkey)", 500, 520, "lineitem", "l_partkey", "l_suppkey",
)
_between_query(
    "expect_column_proportion_of_unique_values_to_be_between",
    "(count(DISTINCT l_partkey) * 1.0 / count(l_partkey))", 0, 0.85, "lineitem", "l_partkey", "l_suppkey",
)


@query(
    "expect_column_median_to_be_between",
    "SELECT l_suppkey, round(median(l_extendedprice), 4) AS value FROM lineitem GROUP BY 1"
    " HAVING NOT (median(l_extendedprice) >= 35000 AND median(l_extendedprice) <= 40000)",
)
def expect_median(t):
    return _shown(
        e.expect_column_median_to_be_between(t.lineitem, "l_extendedprice", 35000, 40000, ["l_suppkey"])
    )


@query(
    "expect_column_quantile_values_to_be_between",
    "SELECT l_suppkey, round(quantile_cont(l_quantity, 0.95), 4) AS value FROM lineitem WHERE l_returnflag <> 'A' GROUP BY 1"
    " HAVING NOT (quantile_cont(l_quantity, 0.95) <= 48)",
)
def expect_quantile(t):
    failing = e.expect_column_quantile_values_to_be_between(
        t.lineitem, "l_quantity", 0.95, max_value=48, group_by=["l_suppkey"], row_condition="l_returnflag <> 'A'"
    )
    return _shown(failing)


def _distinct_query(suffix, operator, value):
    name = f"expect_column_distinct_count_to_{suffix}"

    @query(
        name,
        f"SELECT p_type, count(DISTINCT p_size) AS value FROM part WHERE p_size > 3 GROUP BY 1"
        f" HAVING NOT (count(DISTINCT p_size) {operator} {value})",
    )
    def run(t):
        return getattr(e, name)(t.part, "p_size", value, ["p_type"], "p_size > 3")


_distinct_query("equal", "=", 46)
_distinct_query("be_greater_than", ">", 47)
_distinct_query("be_less_than", "<", 47)


@query(
    "expect_column_distinct_count_to_equal_other_table",
    "SELECT a AS expression, b AS compare_expression, abs(a - b) AS expression_difference FROM"
    " (SELECT count(DISTINCT l_partkey) AS a FROM lineitem), (SELECT count(DISTINCT p_name) AS b FROM part) WHERE abs(a - b) > 0",
)
def distinct_other(t):
    return e.expect_column_distinct_count_to_equal_other_table(
        t.lineitem, "l_partkey", t.part, "p_name", row_condition="true"
    ).drop("expression_difference_percent")


@query(
    "expect_column_distinct_values_to_be_in_set",
    "SELECT DISTINCT nullif(event_type, 'error') AS value_field FROM events"
    " WHERE coalesce(nullif(event_type, 'error') NOT IN ('view', 'click'), true)",
)
def distinct_in_set(t):
    rows = t.events.select(F.nullif("event_type", F.lit("error")).alias("event_type"))
    return e.expect_column_distinct_values_to_be_in_set(rows, "event_type", ["view", "click"])


@query(
    "expect_column_distinct_values_to_contain_set",
    "SELECT v AS value_field FROM (VALUES ('view'), ('refund'), ('login')) s(v) WHERE v NOT IN (SELECT event_type FROM events)",
)
def distinct_contain_set(t):
    return e.expect_column_distinct_values_to_contain_set(t.events, "event_type", ["view", "refund", "login"])


@query(
    "expect_column_distinct_values_to_equal_set",
    """
    WITH a AS (SELECT DISTINCT event_type AS v FROM events), b AS (SELECT v FROM (VALUES ('view'), ('refund')) s(v))
    SELECT coalesce(a.v, b.v) AS value_field, a.v IS NOT NULL AS in_column, b.v IS NOT NULL AS in_set
    FROM a FULL JOIN b ON a.v = b.v WHERE a.v IS NULL OR b.v IS NULL
    """,
)
def distinct_equal_set(t):
    return e.expect_column_distinct_values_to_equal_set(t.events, "event_type", ["view", "refund"])


@query(
    "expect_column_most_common_value_to_be_in_set",
    "SELECT value_field, n_rows FROM (SELECT l_suppkey AS value_field, count(*) AS n_rows FROM lineitem GROUP BY 1"
    " ORDER BY 2 DESC, 1 LIMIT 1 OFFSET 1) WHERE value_field NOT IN (-1, -2)",
)
def most_common(t):
    return e.expect_column_most_common_value_to_be_in_set(t.lineitem, "l_suppkey", [-1, -2], top_n=2)
