"""Expectations on values, column tuples and strings."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import expect_values as e
from .registry import query, rounded

LINE = ["l_orderkey", "l_linenumber"]


@query(
    "expect_column_values_to_be_between",
    "SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem WHERE l_tax > 0 AND NOT (l_quantity > 2 AND l_quantity < 49)",
)
def be_between(t):
    failing = e.expect_column_values_to_be_between(t.lineitem, "l_quantity", 2, 49, "l_tax > 0", strictly=True)
    return failing.select(*LINE, "l_quantity")


def _nullable(t):
    return t.orders.select(
        "o_orderkey", F.nullif("o_orderstatus", F.lit("P")).alias("status"), "o_orderpriority"
    )


_NULLABLE = "(SELECT o_orderkey, nullif(o_orderstatus, 'P') AS status, o_orderpriority FROM orders)"


@query(
    "expect_column_values_to_be_in_set",
    f"SELECT o_orderkey, status FROM {_NULLABLE} WHERE status IS NULL OR status NOT IN ('O')",
)
def be_in_set(t):
    return e.expect_column_values_to_be_in_set(_nullable(t), "status", ["O"]).select("o_orderkey", "status")


@query(
    "expect_column_values_to_not_be_in_set",
    f"SELECT o_orderkey, status FROM {_NULLABLE} WHERE status IN ('O', 'X')",
)
def not_be_in_set(t):
    return e.expect_column_values_to_not_be_in_set(_nullable(t), "status", ["O", "X"]).select("o_orderkey", "status")


@query(
    "expect_column_values_to_be_null",
    f"SELECT o_orderkey, status FROM {_NULLABLE} WHERE o_orderpriority = '5-LOW' AND status IS NOT NULL",
)
def be_null(t):
    return e.expect_column_values_to_be_null(_nullable(t), "status", "o_orderpriority = '5-LOW'").select("o_orderkey", "status")


@query(
    "expect_column_values_to_not_be_null",
    f"SELECT o_orderkey, o_orderpriority FROM {_NULLABLE} WHERE o_orderpriority <> '5-LOW' AND status IS NULL",
)
def not_be_null(t):
    failing = e.expect_column_values_to_not_be_null(_nullable(t), "status", "o_orderpriority <> '5-LOW'")
    return failing.select("o_orderkey", "o_orderpriority")


@query(
    "expect_column_values_to_be_unique",
    "SELECT text, count(*) AS n_records FROM documents GROUP BY 1 HAVING count(*) > 1",
)
def be_unique(t):
    return e.expect_column_values_to_be_unique(t.documents, "text", wide=True)


@query(
    "expect_column_values_to_have_consistent_casing",
    """
    WITH v AS (SELECT DISTINCT word FROM (SELECT unnest(string_split(text, ' ')) AS word FROM documents))
    SELECT count(*) AS set_count, count(DISTINCT lower(word)) AS set_count_case_insensitive FROM v
    HAVING count(*) <> count(DISTINCT lower(word))
    """,
)
def consistent_casing(t):
    words = t.documents.select(F.explode(F.split("text", " ")).alias("word"))
    return e.expect_column_values_to_have_consistent_casing(words, "word")


@query(
    "expect_column_values_to_have_consistent_casing_listed",
    """
    WITH v AS (SELECT DISTINCT word FROM (SELECT unnest(string_split(text, ' ')) AS word FROM documents))
    SELECT lower(word) AS inconsistent_columns, count(*) AS set_count_case_insensitive FROM v GROUP BY 1 HAVING count(*) > 1
    """,
)
def consistent_casing_listed(t):
    words = t.documents.select(F.explode(F.split("text", " ")).alias("word"))
    return e.expect_column_values_to_have_consistent_casing(words, "word", display_inconsistent_columns=True)


def _monotone_sql(operator: str) -> str:
    return f"""
    WITH g AS (SELECT event_type, CAST(date_trunc('hour', ts) AS VARCHAR) AS h, value, count(*) AS copies FROM events GROUP BY 1, 2, 3),
    l AS (SELECT *, lag(value) OVER (PARTITION BY event_type ORDER BY h, value) AS previous FROM g)
    SELECT event_type, h AS hour, value, previous, CAST(CASE WHEN NOT value {operator} previous THEN 1 ELSE 0 END
      + {'copies - 1' if '=' not in operator else '0'} AS BIGINT) AS failing_rows
    FROM l WHERE (previous IS NOT NULL AND NOT value {operator} previous) {'OR copies > 1' if '=' not in operator else ''}
    """


def _hourly(t):
    return t.events.select("event_type", F.date_trunc("hour", "ts").cast("string").alias("hour"), "value")


@query("expect_column_values_to_be_increasing", _monotone_sql(">"))
def be_increasing(t):
    return e.expect_column_values_to_be_increasing(_hourly(t), "value", "hour", group_by=["event_type"])


@query("expect_column_values_to_be_decreasing", _monotone_sql("<="))
def be_decreasing(t):
    return e.expect_column_values_to_be_decreasing(
        _hourly(t), "value", "hour", strictly=False, group_by=["event_type"]
    )


@query(
    "expect_column_values_to_be_increasing_ungrouped",
    """
    WITH l AS (SELECT o_orderkey, o_totalprice, lag(o_totalprice) OVER (ORDER BY o_orderkey) AS previous FROM orders)
    SELECT o_orderkey, o_totalprice, previous, CAST(1 AS BIGINT) AS failing_rows FROM l WHERE NOT o_totalprice > previous
    """,
)
def be_increasing_ungrouped(t):
    return e.expect_column_values_to_be_increasing(t.orders, "o_totalprice", "o_orderkey")


# --- several columns ---------------------------------------------------------


@query(
    "expect_column_pair_values_A_to_be_greater_than_B",
    "SELECT l_orderkey, l_linenumber, l_discount, l_tax FROM lineitem WHERE NOT l_discount > l_tax",
)
def pair_greater(t):
    failing = e.expect_column_pair_values_A_to_be_greater_than_B(t.lineitem, "l_discount", "l_tax")
    return failing.select(*LINE, "l_discount", "l_tax")


@query(
    "expect_column_pair_values_to_be_equal",
    "SELECT l_orderkey, l_linenumber, l_returnflag, l_linestatus FROM lineitem"
    " WHERE l_quantity < 10 AND NOT replace(l_returnflag, 'R', 'O') = l_linestatus",
)
def pair_equal(t):
    flag = F.replace(F.col("l_returnflag"), F.lit("R"), F.lit("O"))
    failing = e.expect_column_pair_values_to_be_equal(t.lineitem, flag, "l_linestatus", "l_quantity < 10")
    return failing.select(*LINE, "l_returnflag", "l_linestatus")


@query(
    "expect_column_pair_values_to_be_in_set",
    "SELECT l_orderkey, l_linenumber, l_returnflag, l_linestatus FROM lineitem"
    " WHERE NOT ((l_returnflag = 'A' AND l_linestatus = 'F') OR (l_returnflag = 'N' AND l_linestatus = 'O'))",
)
def pair_in_set(t):
    failing = e.expect_column_pair_values_to_be_in_set(
        t.lineitem, "l_returnflag", "l_linestatus", [("A", "F"), ("N", "O")]
    )
    return failing.select(*LINE, "l_returnflag", "l_linestatus")


@query(
    "expect_compound_columns_to_be_unique",
    """
    WITH r AS (SELECT nullif(l_returnflag, 'N') AS flag, nullif(l_tax, 0) AS tax, l_shipdate FROM lineitem)
    SELECT flag, tax, count(*) AS n_records FROM r WHERE NOT (flag IS NULL OR tax IS NULL) GROUP BY 1, 2 HAVING count(*) > 1
    """,
)
def compound_unique(t):
    rows = t.lineitem.select(F.nullif("l_returnflag", F.lit("N")).alias("flag"), F.nullif("l_tax", F.lit(0.0)).alias("tax"))
    return e.expect_compound_columns_to_be_unique(rows, ["flag", "tax"], "any_value_is_missing")


@query(
    "expect_multicolumn_sum_to_equal",
    """
    SELECT l_suppkey, round(sum(l_extendedprice), 2) AS expected, round(sum(l_quantity) + sum(l_linenumber), 2) AS found
    FROM lineitem GROUP BY 1 HAVING NOT abs(sum(l_quantity) + sum(l_linenumber) - sum(l_extendedprice)) <= 23000000
    """,
)
def multicolumn_sum(t):
    failing = e.expect_multicolumn_sum_to_equal(
        t.lineitem, ["l_quantity", "l_linenumber"], "l_extendedprice", ["l_suppkey"], tolerance=23000000
    )
    return failing.withColumns({c: rounded(c, 2) for c in ("expected", "found")})


@query(
    "expect_select_column_values_to_be_unique_within_record",
    "SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey FROM lineitem"
    " WHERE l_linenumber = l_partkey OR l_linenumber = l_suppkey OR l_partkey = l_suppkey",
)
def unique_within_record(t):
    columns = ["l_linenumber", "l_partkey", "l_suppkey"]
    failing = e.expect_select_column_values_to_be_unique_within_record(t.lineitem, columns)
    return failing.select("l_orderkey", *columns)


# --- strings -----------------------------------------------------------------


@query(
    "expect_column_value_lengths_to_be_between",
    "SELECT doc_id, CAST(length(text) AS INTEGER) AS length FROM documents WHERE NOT (length(text) >= 50 AND length(text) <= 5000)",
)
def lengths_between(t):
    failing = e.expect_column_value_lengths_to_be_between(t.documents, "text", 50, 5000)
    return failing.select("doc_id", F.length("text").alias("length"))


@query(
    "expect_column_value_lengths_to_equal",
    "SELECT p_partkey, p_type FROM part WHERE NOT length(p_type) = 8",
)
def lengths_equal(t):
    return e.expect_column_value_lengths_to_equal(t.part, "p_type", 8).select("p_partkey", "p_type")


def _pattern_query(name, condition, table, key, column, *args, **kw):
    @query(name, f"SELECT {key} FROM {table} WHERE NOT ({condition})")
    def run(t):
        return getattr(e, name)(getattr(t, table), column, *args, **kw).select(*key.split(", "))


_LIKES = ["%the%", "%th%"]
_REGEXES = ["[0-9]{2}", "[A-Z][a-z]+ou"]
_LIKE_SQL = [f"text LIKE '{p}'" for p in _LIKES]
_REGEX_SQL = [f"regexp_matches(text, '{p}')" for p in _REGEXES]
_TURN = "conv_id, turn"

_pattern_query("expect_column_values_to_match_like_pattern", _LIKE_SQL[0], "documents", "doc_id", "text", _LIKES[0])
_pattern_query(
    "expect_column_values_to_not_match_like_pattern", f"NOT {_LIKE_SQL[0]}", "documents", "doc_id", "text", _LIKES[0]
)
_pattern_query(
    "expect_column_values_to_match_like_pattern_list", " AND ".join(_LIKE_SQL), "conversations", _TURN, "text", _LIKES, "all"
)
_pattern_query(
    "expect_column_values_to_not_match_like_pattern_list",
    " OR ".join(f"NOT {p}" for p in _LIKE_SQL), "conversations", _TURN, "text", _LIKES, "any",
)
_pattern_query(
    "expect_column_values_to_match_regex", "regexp_matches(text, '(?i)[A-Z]{9}')", "documents", "doc_id", "text", "[A-Z]{9}", flags="i"
)
_pattern_query(
    "expect_column_values_to_not_match_regex", f"NOT {_REGEX_SQL[0]}", "documents", "doc_id", "text", _REGEXES[0]
)
_pattern_query(
    "expect_column_values_to_match_regex_list", " OR ".join(_REGEX_SQL), "documents", "doc_id", "text", _REGEXES, "any"
)
_pattern_query(
    "expect_column_values_to_not_match_regex_list",
    " AND ".join(f"NOT {p}" for p in _REGEX_SQL), "documents", "doc_id", "text", _REGEXES, "all",
)
