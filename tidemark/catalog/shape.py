"""Table shape, and the contract report."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import rules
from ..operators import expect_shape as e
from ..operators.suite import Check, run_checks
from ..plans.report import BusinessRule, ReportFailed, report_table, validate_table
from ..sources.contract import contract_from
from .registry import query, rounded

ORDER_COLUMNS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]


def _column_query(name, table, failures, check):
    """A check of the schema, graded beside a count of the table's rows."""

    @query(
        name,
        f"SELECT '{name}' AS \"check\", CAST({failures} AS BIGINT) AS failures, count(*) AS rows_tested,"
        f" CASE WHEN {failures} = 0 THEN 'pass' ELSE 'error' END AS status FROM {table}",
    )
    def run(t):
        return run_checks(getattr(t, table), [Check(name, found=check(t, getattr(t, table)))])


_column_query("expect_column_to_exist", "orders", 1, lambda t, df: e.expect_column_to_exist(df, "O_TOTALPRICE", 2))
_column_query(
    "expect_table_column_count_to_be_between", "orders", 0,
    lambda t, df: e.expect_table_column_count_to_be_between(df, 1, 6),
)
_column_query("expect_table_column_count_to_equal", "orders", 1, lambda t, df: e.expect_table_column_count_to_equal(df, 7))
_column_query(
    "expect_table_column_count_to_equal_other_table", "orders", 0,
    lambda t, df: e.expect_table_column_count_to_equal_other_table(df, t.part),
)
_column_query(
    "expect_table_columns_to_contain_set", "orders", 1,
    lambda t, df: e.expect_table_columns_to_contain_set(df, ["O_ORDERKEY", "o_comment"]),
)
_column_query(
    "expect_table_columns_to_match_ordered_list", "orders", 4,
    lambda t, df: e.expect_table_columns_to_match_ordered_list(df, [*ORDER_COLUMNS[1::-1], *ORDER_COLUMNS[2:]]),
)
_column_query(
    "expect_table_columns_to_match_set", "orders", 0,
    lambda t, df: e.expect_table_columns_to_match_set(df, ORDER_COLUMNS[::-1]),
)
_column_query(
    "expect_table_columns_to_not_contain_set", "orders", 1,
    lambda t, df: e.expect_table_columns_to_not_contain_set(df, ["o_custkey", "o_comment"]),
)
_column_query(
    "expect_column_values_to_be_in_type_list", "orders", 0,
    lambda t, df: e.expect_column_values_to_be_in_type_list(df, "o_totalprice", ["DOUBLE", "FLOAT"]),
)
_column_query(
    "expect_column_values_to_be_of_type", "orders", 1,
    lambda t, df: e.expect_column_values_to_be_of_type(df, "o_custkey", "string"),
)


@query(
    "expect_table_row_count_to_be_between",
    "SELECT o_custkey, count(*) AS value FROM orders WHERE o_orderstatus <> 'P' GROUP BY 1 HAVING NOT (count(*) >= 3 AND count(*) <= 10)",
)
def row_count_between(t):
    return e.expect_table_row_count_to_be_between(t.orders, 3, 10, ["o_custkey"], "o_orderstatus <> 'P'")


@query("expect_table_row_count_to_equal", "SELECT o_custkey, count(*) AS value FROM orders GROUP BY 1 HAVING count(*) <> 10")
def row_count_equal(t):
    return e.expect_table_row_count_to_equal(t.orders, 10, ["o_custkey"])


_SIDES = """
    WITH a AS (SELECT c_nationkey AS k, {a} AS e FROM customer GROUP BY 1),
    b AS (SELECT s_nationkey AS k, {b} AS e FROM supplier GROUP BY 1)
    SELECT coalesce(a.k, b.k) AS col_1, a.e AS expression, b.e AS compare_expression,
      abs(coalesce(a.e, 0) - coalesce(b.e, 0)) AS expression_difference
    FROM a FULL JOIN b ON a.k = b.k WHERE abs(coalesce(a.e, 0) - coalesce(b.e, 0)) > {tolerance}
"""
_KEYS = {"group_by": ["c_nationkey"], "compare_group_by": ["s_nationkey"]}


@query(
    "expect_table_aggregation_to_equal_other_table",
    _SIDES.format(
        a="CAST(floor(max(c_acctbal)) AS BIGINT)", b="CAST(floor(max(s_acctbal)) AS BIGINT)", tolerance=500
    ),
)
def aggregation_other(t):
    return e.expect_table_aggregation_to_equal_other_table(
        t.customer, F.floor(F.max("c_acctbal")), t.supplier,
        compare_expression=F.floor(F.max("s_acctbal")), tolerance=500, **_KEYS,
    ).drop("expression_difference_percent")


@query("expect_table_row_count_to_equal_other_table", _SIDES.format(a="count(*)", b="count(*)", tolerance=55))
def row_count_other(t):
    return e.expect_table_row_count_to_equal_other_table(t.customer, t.supplier, tolerance=55, **_KEYS).drop(
        "expression_difference_percent"
    )


@query(
    "expect_table_row_count_to_equal_other_table_times_factor",
    _SIDES.format(a="count(*)", b="count(*) * 15", tolerance=10),
)
def row_count_factor(t):
    return e.expect_table_row_count_to_equal_other_table_times_factor(
        t.customer, t.supplier, 15, tolerance=10, **_KEYS
    ).drop("expression_difference_percent")


# --- contract report ---------------------------------------------------------

CONTRACT = contract_from(
    {
        "table": "vendas",
        "fields": [
            {"name": "id", "type": "integer", "unique": True, "nullable": False},
            {"name": "cliente_id", "type": "integer", "nullable": False},
            {"name": "valor_total", "type": "double"},
            {"name": "quantidade", "type": "integer"},
            {"name": "metodo_pagto", "type": "string"},
            {"name": "canal", "type": "string"},
        ],
    }
)


def sales_rows(t):
    return t.lineitem.select(
        F.col("l_orderkey").alias("id"),
        F.nullif("l_suppkey", F.lit(1)).alias("cliente_id"),
        (F.col("l_extendedprice") - 5000).alias("valor_total"),
        (F.col("l_quantity") - 3).cast("bigint").alias("quantidade"),
        F.when(F.col("l_returnflag") == "A", "Pix").otherwise("Cheque").alias("metodo_pagto"),
        "l_tax",
    )


@query(
    "contract_report",
    """
    WITH r AS (SELECT l_orderkey AS id, nullif(l_suppkey, 1) AS c, l_extendedprice - 5000 AS v, CAST(l_quantity - 3 AS BIGINT) AS q,
      CASE WHEN l_returnflag = 'A' THEN 'Pix' ELSE 'Cheque' END AS m FROM lineitem),
    f AS (
      SELECT 'schema_missing_columns' AS rule, 'canal' AS "column", 'ERROR' AS severity, 1 AS failures UNION ALL
      SELECT 'schema_extra_columns', 'l_tax', 'WARNING', 1 UNION ALL
      SELECT 'not_null', 'id', 'ERROR', 0 UNION ALL
      SELECT 'not_null', 'cliente_id', 'ERROR', (SELECT count(*) FROM r WHERE c IS NULL) UNION ALL
      SELECT 'business_positive_value', 'valor_total', 'ERROR', (SELECT count(*) FROM r WHERE NOT v > 0) UNION ALL
      SELECT 'business_min_quantity', 'quantidade', 'ERROR', (SELECT count(*) FROM r WHERE NOT q >= 1) UNION ALL
      SELECT 'business_valid_payment', 'metodo_pagto', 'ERROR', (SELECT count(*) FROM r WHERE m <> 'Pix') UNION ALL
      SELECT 'unique_id', 'id', 'WARNING', (SELECT count(id) - count(DISTINCT id) FROM r))
    SELECT rule, "column", severity, CAST(failures AS BIGINT) AS failures, (SELECT count(*) FROM r) AS rows_tested,
      round(1 - failures / (SELECT count(*) FROM r), 6) AS conformity_rate FROM f
    """,
)
def contract_report(t):
    report = report_table(sales_rows(t), CONTRACT)
    return report.withColumn("conformity_rate", rounded("conformity_rate", 6))


CUSTOMERS = contract_from(
    {"table": "clientes", "fields": [{"name": n, "type": "string"} for n in ("email", "estado", "status")]}
)


def _customer_rows(t):
    """The customer table with some broken mails, states and statuses."""
    mark = F.when(F.col("c_mktsegment") == "BUILDING", F.lit("")).otherwise(F.lit("@mail.com"))
    return t.customer.select(
        F.concat(F.lower("c_mktsegment"), mark).alias("email"),
        F.col("c_nationkey").cast("string").alias("estado"),
        F.when(F.col("c_acctbal") < 0, "Suspenso").otherwise("Ativo").alias("status"),
    )


@query(
    "contract_report_customers",
    """
    WITH f AS (
      SELECT 'business_email_format' AS rule, 'email' AS "column", (SELECT count(*) FROM customer WHERE c_mktsegment = 'BUILDING') AS failures UNION ALL
      SELECT 'business_state_length', 'estado', (SELECT count(*) FROM customer WHERE c_nationkey < 10) UNION ALL
      SELECT 'business_valid_status', 'status', (SELECT count(*) FROM customer WHERE c_acctbal < 0))
    SELECT rule, "column", 'ERROR' AS severity, failures, (SELECT count(*) FROM customer) AS rows_tested,
      round(1 - failures / (SELECT count(*) FROM customer), 6) AS conformity_rate FROM f
    """,
)
def contract_report_customers(t):
    report = report_table(_customer_rows(t), CUSTOMERS)
    return report.withColumn("conformity_rate", rounded("conformity_rate", 6))


@query(
    "conformity_rate",
    "SELECT 'positive' AS rule, round(avg(CASE WHEN c_acctbal > 0 THEN 1 ELSE 0 END), 6) AS conformity_rate FROM customer",
)
def conformity_rate(t):
    rule = BusinessRule("positive", "c_acctbal", rules.outside("c_acctbal", 0, strictly=True))
    contract = contract_from({"table": "customer", "fields": [{"name": c, "type": "string"} for c in t.customer.columns]})
    return report_table(t.customer, contract, [rule]).select("rule", rounded("conformity_rate", 6).alias("conformity_rate"))


# --- the report's rules one by one -------------------------------------------


def _rule_query(name, rows_sql, failures, severity, column, report, rule=None):
    """One rule of a report with its failures and conformity."""

    @query(
        name,
        f"SELECT '{column}' AS \"column\", '{severity}' AS severity, CAST({failures} AS BIGINT) AS failures,"
        f" count(*) AS rows_tested, round(1 - {failures} / count(*), 6) AS conformity_rate FROM {rows_sql}",
    )
    def run(t):
        found = report(t).where((F.col("rule") == (rule or name)) & (F.col("column") == column))
        return found.select(
            "column", "severity", "failures", "rows_tested", rounded("conformity_rate", 6).alias("conformity_rate")
        )


_SALES = (
    "(SELECT l_orderkey AS id, nullif(l_suppkey, 1) AS c, l_extendedprice - 5000 AS v, CAST(l_quantity - 3 AS BIGINT) AS q,"
    " l_returnflag AS f FROM lineitem)"
)


def _sales(name, failures, severity, column, rule=None):
    _rule_query(name, _SALES, failures, severity, column, contract_report, rule)


_sales("schema_missing_columns", "1", "ERROR", "canal")
_sales("schema_extra_columns", "1", "WARNING", "l_tax")
_sales("not_null_rule", "count(*) FILTER (c IS NULL)", "ERROR", "cliente_id", "not_null")
_sales("business_positive_value", "count(*) FILTER (NOT v > 0)", "ERROR", "valor_total")
_sales("business_min_quantity", "count(*) FILTER (NOT q >= 1)", "ERROR", "quantidade")
_sales("business_valid_payment", "count(*) FILTER (f <> 'A')", "ERROR", "metodo_pagto")
_sales("unique_id_warning", "(count(id) - count(DISTINCT id))", "WARNING", "id", "unique_id")


def _customers(name, failures, column):
    _rule_query(name, "customer", f"count(*) FILTER ({failures})", "ERROR", column, contract_report_customers)


_customers("business_email_format", "c_mktsegment = 'BUILDING'", "email")
_customers("business_state_length", "c_nationkey < 10", "estado")
_customers("business_valid_status", "c_acctbal < 0", "status")


@query(
    "raise_on_failure",
    """
    SELECT message FROM (VALUES ('business_email_format(email), business_state_length(estado), business_valid_status(status)')) m(message)
    WHERE (SELECT count(*) FROM customer WHERE c_mktsegment = 'BUILDING') > 0
    """,
)
def raise_on_failure(t):
    """The message a failed report raises."""
    try:
        validate_table(_customer_rows(t), {"clientes": CUSTOMERS}, "clientes").raise_on_failure()
        message = None
    except ReportFailed as failure:
        message = str(failure)
    return t.spark.createDataFrame([(message,)], "message string").where("message is not null")
