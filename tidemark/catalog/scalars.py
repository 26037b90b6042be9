"""Projections, masks and scalar columns as table jobs."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import rules
from ..functions import scalars as s
from ..operators import reshape as r
from ..operators.core import failing_rows, only
from ..plans import quality
from ..plans.quality import SensitiveField
from ..sources.contract import contract_from
from .registry import query, rounded, text

CUSTOMER_CONTRACT = contract_from(
    {
        "table": "customer",
        "fields": [
            {"name": "c_custkey", "type": "integer", "unique": True},
            {"name": "c_name", "type": "string", "regex": "^Customer#[0-9]*[02468]$", "pii": True},
            {"name": "c_acctbal", "type": "double"},
            {"name": "c_mktsegment", "type": "StringType", "in_set": ["BUILDING", "MACHINERY"]},
        ],
    }
)


@query(
    "normalise_strings",
    "SELECT trim(CAST(o_orderkey AS VARCHAR)) AS o_orderkey, trim(o_orderpriority) AS o_orderpriority,"
    " trim('  ' || o_orderstatus || ' ') AS o_orderstatus FROM orders",
)
def normalise_strings(t):
    rows = t.orders.select(
        "o_orderkey",
        "o_orderpriority",
        F.concat(F.lit("  "), "o_orderstatus", F.lit(" ")).alias("o_orderstatus"),
    )
    return quality.normalise_strings(rows, rows.columns)


@query(
    "apply_contract_types",
    "SELECT c_custkey, c_name, c_acctbal, c_mktsegment FROM customer",
)
def apply_contract_types(t):
    names = CUSTOMER_CONTRACT.names
    return quality.apply_contract_types(
        quality.normalise_strings(t.customer, names), CUSTOMER_CONTRACT
    ).select(*names)


@query(
    "contract_schema",
    "SELECT c_custkey, c_name, c_acctbal, c_mktsegment, '2024-01-31' AS dt_ingest,"
    " CAST(NULL AS VARCHAR) AS _run_id, CAST(NULL AS VARCHAR) AS _loaded_at FROM customer",
)
def contract_schema(t):
    rows = t.customer.withColumns(
        {"dt_ingest": F.lit("2024-01-31"), "_run_id": F.lit(None), "_loaded_at": F.lit(None)}
    )
    typed = rows.select(
        *[F.col(f.name).cast(f.dataType) for f in CUSTOMER_CONTRACT.warehouse_schema().fields]
    )
    return typed.withColumns({c: text(c) for c in ("dt_ingest", "_loaded_at")})


@query(
    "type_rule",
    "SELECT p_partkey, p_type || CAST(p_size AS VARCHAR) AS odd FROM part"
    " WHERE TRY_CAST(p_type || CAST(p_size AS VARCHAR) AS BIGINT) IS NULL",
)
def type_rule(t):
    rows = t.part.select("p_partkey", F.concat("p_type", F.col("p_size").cast("string")).alias("odd"))
    return failing_rows(rows, rules.bad_type("odd", "bigint"))


@query(
    "regex_rule",
    "SELECT c_custkey, c_name FROM customer WHERE NOT regexp_matches(c_name, '^Customer#[0-9]*[02468]$')",
)
def regex_rule(t):
    rule = quality.contract_rules(CUSTOMER_CONTRACT)["regex:c_name"]
    return failing_rows(t.customer.select("c_custkey", "c_name"), rule)


@query(
    "in_set_rule",
    "SELECT c_custkey, c_mktsegment FROM customer WHERE c_mktsegment NOT IN ('BUILDING', 'MACHINERY')",
)
def in_set_rule(t):
    rule = quality.contract_rules(CUSTOMER_CONTRACT)["in_set:c_mktsegment"]
    return failing_rows(t.customer.select("c_custkey", "c_mktsegment"), rule)


@query(
    "split_valid_invalid",
    """
    WITH doubled AS (
      SELECT c_custkey, c_name, c_acctbal, c_mktsegment, 0 AS copy FROM customer
      UNION ALL
      SELECT c_custkey, c_name, c_acctbal, c_mktsegment, 1 AS copy FROM customer WHERE c_acctbal < 0),
    flagged AS (
      SELECT *, concat_ws(',',
        CASE WHEN NOT regexp_matches(c_name, '^Customer#[0-9]*[02468]$') THEN 'regex:c_name' END,
        CASE WHEN c_mktsegment NOT IN ('BUILDING', 'MACHINERY') THEN 'in_set:c_mktsegment' END,
        CASE WHEN row_number() OVER (PARTITION BY c_custkey ORDER BY copy) > 1 THEN 'unique:c_custkey' END
      ) AS reasons FROM doubled)
    SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, sha256(c_name) AS c_name, reasons, reasons = '' AS valid
    FROM flagged
    """,
)
def split_valid_invalid(t):
    doubled = t.customer.withColumn("copy", F.lit(0)).unionByName(
        t.customer.where("c_acctbal < 0").withColumn("copy", F.lit(1))
    )
    checked = quality.validate(doubled, CUSTOMER_CONTRACT, ["c_custkey", "copy"])
    valid, invalid = quality.split_valid_invalid(checked)
    columns = ["c_custkey", "c_name"]
    good = valid.select(*columns, F.lit("").alias("reasons"), F.lit(True).alias("valid"))
    bad = invalid.select(
        *columns, F.concat_ws(",", "_reasons").alias("reasons"), F.lit(False).alias("valid")
    )
    return good.unionByName(bad)


@query("pii_hash", "SELECT c_custkey, sha256(c_name) AS c_name FROM customer")
def pii_hash(t):
    return quality.pii_hash(t.customer, CUSTOMER_CONTRACT).select("c_custkey", "c_name")


@query("mask_email", "SELECT s_suppkey, sha256(trim(' ' || s_name || '@mail.com ')) AS masked FROM supplier")
def mask_email(t):
    mail = F.concat(F.lit(" "), "s_name", F.lit("@mail.com "))
    return t.supplier.select("s_suppkey", s.mask_email(mail).alias("masked"))


@query(
    "mask_partial",
    "SELECT p_partkey, CASE WHEN length(p_name) <= 8 THEN '***'"
    " ELSE left(p_name, 4) || '***' || right(p_name, 4) END AS masked FROM part",
)
def mask_partial(t):
    return t.part.select("p_partkey", s.mask_partial("p_name").alias("masked"))


@query(
    "sensitive_field_policy",
    """
    SELECT c.c_custkey, left(sha256(c.c_name), 16) AS c_name,
      sha256(CAST(c.c_nationkey AS VARCHAR)) AS c_nationkey,
      CASE WHEN length(c.c_mktsegment) <= 8 THEN '***'
        ELSE left(c.c_mktsegment, 4) || '***' || right(c.c_mktsegment, 4) END AS c_mktsegment,
      CAST(floor(date_diff('month', b.born, DATE '2024-01-01') / 120) * 10 AS INTEGER) AS born
    FROM customer c JOIN (
      SELECT o_custkey, CAST(date_trunc('month', min(o_orderdate)) AS DATE) AS born
      FROM orders GROUP BY 1) b ON c.c_custkey = b.o_custkey
    """,
)
def sensitive_field_policy(t):
    first = t.orders.groupBy(F.col("o_custkey").alias("c_custkey")).agg(
        F.trunc(F.min("o_orderdate"), "month").alias("born")
    )
    rows = t.customer.join(first, "c_custkey").drop("c_acctbal")
    policies = [
        SensitiveField("c_name", "pseudonymize"),
        SensitiveField("c_nationkey", "hash_sha256"),
        SensitiveField("c_mktsegment", "mask_partial"),
        SensitiveField("born", "generalize_age"),
        SensitiveField("not_there", "hash_sha256"),
    ]
    return quality.sensitive_field_policy(rows, policies, as_of="2024-01-01")


@query(
    "rename_project",
    "SELECT o_orderkey AS venda_id, o_custkey AS cliente_id, o_totalprice AS valor_total FROM orders",
)
def rename_project(t):
    names = {"o_orderkey": "venda_id", "o_custkey": "cliente_id", "o_totalprice": "valor_total"}
    return r.rename_project(t.orders, names)


@query(
    "star",
    "SELECT c_custkey AS a_c_custkey_z, c_name AS a_c_name_z, c_nationkey AS a_c_nationkey_z FROM customer",
)
def star(t):
    return t.customer.select(*r.star(t.customer, ["C_ACCTBAL", "c_mktsegment"], "a_", "_z"))


@query(
    "get_filtered_columns_in_relation",
    "SELECT l_orderkey, l_linenumber, l_quantity, l_returnflag FROM lineitem",
)
def get_filtered_columns_in_relation(t):
    skip = "L_PARTKEY L_SUPPKEY L_EXTENDEDPRICE L_DISCOUNT L_TAX L_LINESTATUS L_SHIPDATE".split()
    return t.lineitem.select(*r.get_filtered_columns_in_relation(t.lineitem, skip))


def _blanked(t):
    """Orders with some statuses and priorities empty."""
    return t.orders.select(
        "o_orderkey",
        F.replace(F.col("o_orderstatus"), F.lit("P"), F.lit("")).alias("o_orderstatus"),
        F.replace(F.col("o_orderpriority"), F.lit("5-LOW"), F.lit("")).alias("o_orderpriority"),
    )


@query(
    "nullcheck",
    "SELECT o_orderkey, nullif(replace(o_orderstatus, 'P', ''), '') AS o_orderstatus FROM orders",
)
def nullcheck(t):
    rows = _blanked(t)
    return rows.select(*r.nullcheck(rows, ["o_orderkey", "o_orderstatus"]))


@query(
    "nullcheck_table",
    "SELECT o_orderkey, nullif(replace(o_orderstatus, 'P', ''), '') AS o_orderstatus,"
    " nullif(replace(o_orderpriority, '5-LOW', ''), '') AS o_orderpriority FROM orders",
)
def nullcheck_table(t):
    return r.nullcheck_table(_blanked(t))


@query(
    "row_condition",
    "SELECT o_orderkey, o_totalprice FROM orders"
    " WHERE o_orderstatus = 'F' AND NOT (o_totalprice >= 1000 AND o_totalprice <= 450000)",
)
def row_condition(t):
    rule = rules.outside("o_totalprice", 1000, 450000)
    return failing_rows(t.orders, rule, "o_orderstatus = 'F'").select("o_orderkey", "o_totalprice")


@query(
    "ignore_row_if_expression",
    """
    WITH r AS (SELECT o_orderkey, nullif(o_orderstatus, 'P') AS a, nullif(o_orderpriority, '5-LOW') AS b FROM orders)
    SELECT o_orderkey, 'any_value_is_missing' AS kept_by FROM r WHERE NOT (a IS NULL OR b IS NULL)
    UNION ALL
    SELECT o_orderkey, 'all_values_are_missing' FROM r WHERE NOT (a IS NULL AND b IS NULL)
    """,
)
def ignore_row_if_expression(t):
    rows = r.nullcheck_table(_blanked(t))
    parts = [
        only(rows, rules.row_is_counted(["o_orderstatus", "o_orderpriority"], mode)).select(
            "o_orderkey", F.lit(mode).alias("kept_by")
        )
        for mode in ("any_value_is_missing", "all_values_are_missing")
    ]
    return parts[0].union(parts[1])


# --- arithmetic --------------------------------------------------------------


@query(
    "safe_add",
    "SELECT l_orderkey, l_linenumber, coalesce(nullif(l_linenumber, 3), 0) + coalesce(nullif(l_quantity, 5.0), 0)"
    " AS total FROM lineitem",
)
def safe_add(t):
    parts = [F.nullif("l_linenumber", F.lit(3)), F.nullif("l_quantity", F.lit(5.0))]
    return t.lineitem.select("l_orderkey", "l_linenumber", s.safe_add(parts).alias("total"))


@query(
    "safe_subtract",
    "SELECT l_orderkey, l_linenumber, coalesce(nullif(l_quantity, 5.0), 0) - coalesce(nullif(l_linenumber, 3), 0)"
    " AS rest FROM lineitem",
)
def safe_subtract(t):
    parts = [F.nullif("l_quantity", F.lit(5.0)), F.nullif("l_linenumber", F.lit(3))]
    return t.lineitem.select("l_orderkey", "l_linenumber", s.safe_subtract(parts).alias("rest"))


@query(
    "safe_divide",
    "SELECT l_orderkey, l_linenumber, round(l_quantity / nullif(l_discount, 0), 4) AS ratio FROM lineitem",
)
def safe_divide(t):
    return t.lineitem.select(
        "l_orderkey", "l_linenumber", rounded(s.safe_divide("l_quantity", "l_discount")).alias("ratio")
    )


@query(
    "width_bucket",
    """
    SELECT bucket, count(*) AS n_orders FROM (
      SELECT CAST(CASE WHEN o_totalprice < 50000 THEN 0 WHEN o_totalprice >= 450000 THEN 11
        ELSE floor((o_totalprice - 50000) / (400000 / 10)) + 1 END AS BIGINT) AS bucket FROM orders)
    GROUP BY bucket
    """,
)
def width_bucket(t):
    bucket = s.width_bucket("o_totalprice", 50000, 450000, 10)
    return t.orders.groupBy(bucket.alias("bucket")).agg(F.count(F.lit(1)).alias("n_orders"))


_PLACES = """
    SELECT c.c_nationkey AS a, s.s_nationkey AS b, count(*) AS n_lines
    FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
    JOIN customer c ON o.o_custkey = c.c_custkey JOIN supplier s ON l.l_suppkey = s.s_suppkey
    GROUP BY 1, 2
"""


def _lat(key: str):
    return F.col(key) * 6.5 - 78


def _lon(key: str):
    return F.col(key) * 13.5 - 160


def _shipping_lanes(t):
    """Lines per pair of nations: pairs are at most the square of the nations."""
    lines = (
        t.lineitem.select(F.col("l_orderkey").alias("o_orderkey"), F.col("l_suppkey").alias("s_suppkey"))
        .join(t.orders.select("o_orderkey", F.col("o_custkey").alias("c_custkey")), "o_orderkey")
        .join(t.customer.select("c_custkey", F.col("c_nationkey").alias("a")), "c_custkey")
        .join(t.supplier.select("s_suppkey", F.col("s_nationkey").alias("b")), "s_suppkey")
    )
    return lines.groupBy("a", "b").agg(F.count(F.lit(1)).alias("n_lines"))


@query(
    "haversine_distance",
    f"""
    WITH lanes AS ({_PLACES}), g AS (
      SELECT a, b, n_lines, radians(a * 6.5 - 78) AS p1, radians(b * 6.5 - 78) AS p2,
        radians((b - a) * 13.5) AS dl FROM lanes), d AS (
      SELECT a, b, n_lines, 2 * 3961 * asin(sqrt(pow(sin((p2 - p1) / 2), 2)
        + cos(p1) * cos(p2) * pow(sin(dl / 2), 2))) AS miles FROM g)
    SELECT a, b, n_lines, round(miles, 3) AS miles, round(miles * 1.60934, 3) AS km FROM d
    """,
)
def haversine_distance(t):
    ends = [_lat("a"), _lon("a"), _lat("b"), _lon("b")]
    return _shipping_lanes(t).select(
        "a",
        "b",
        "n_lines",
        rounded(s.haversine_distance(*ends), 3).alias("miles"),
        rounded(s.haversine_distance(*ends, unit="km"), 3).alias("km"),
    )


@query(
    "degrees_to_radians",
    "SELECT c_custkey, round(acos(-1) * (c_nationkey * 6.5 - 78) / 180, 6) AS radians FROM customer",
)
def degrees_to_radians(t):
    return t.customer.select("c_custkey", rounded(s.degrees_to_radians(_lat("c_nationkey")), 6).alias("radians"))


@query(
    "log_natural",
    "SELECT event_id, CASE WHEN value > 0 THEN round(ln(value), 6) END AS log_value FROM events",
)
def log_natural(t):
    return t.events.select("event_id", rounded(s.log_natural("value"), 6).alias("log_value"))


@query(
    "_get_metric_expression",
    "SELECT event_id, CASE WHEN value > 0 THEN round(ln(value), 6) ELSE 0 END AS logged,"
    " coalesce(nullif(value, 6.55), 0) AS plain FROM events",
)
def metric_expression(t):
    return t.events.select(
        "event_id",
        rounded(s.metric_expression("value", True), 6).alias("logged"),
        s.metric_expression(F.nullif("value", F.lit(6.55)), False).alias("plain"),
    )


@query(
    "rand",
    "SELECT count(*) AS n_rows, true AS in_bounds, true AS all_different, true AS centred FROM events",
)
def rand(t):
    """What holds of any draw: a number per row from 0 to 1, hardly ever twice, around a half."""
    drawn = t.events.select(s.random_uniform(42).alias("u"))
    return drawn.agg(
        F.count("u").alias("n_rows"),
        ((F.min("u") >= 0) & (F.max("u") < 1)).alias("in_bounds"),
        # Of very many draws a few are equal by chance.
        (100 * F.count_distinct("u") >= 99 * F.count("u")).alias("all_different"),
        (F.abs(F.avg("u") - 0.5) < 0.1).alias("centred"),
    )


# --- urls --------------------------------------------------------------------

_HOST = (
    "split_part(split_part(replace(replace(replace(url, 'android-app://', ''), 'http://', ''),"
    " 'https://', ''), '/', 1), '?', 1)"
)


@query(
    "get_url_host",
    f"SELECT {_HOST} AS host, count(*) AS n_pages, min(page_id) AS first_page FROM pages GROUP BY 1",
)
def get_url_host(t):
    return t.pages.groupBy(s.get_url_host("url").alias("host")).agg(
        F.count(F.lit(1)).alias("n_pages"), F.min("page_id").alias("first_page")
    )


@query(
    "get_url_path",
    """
    WITH b AS (SELECT page_id, replace(replace(url, 'http://', ''), 'https://', '') AS u FROM pages)
    SELECT page_id, split_part(substr(u, CASE WHEN instr(u, '/') > 0 THEN instr(u, '/') + 1
      WHEN instr(u, '?') > 0 THEN instr(u, '?') ELSE 1 END), '?', 1) AS path FROM b
    """,
)
def get_url_path(t):
    return t.pages.select("page_id", s.get_url_path("url").alias("path"))


@query(
    "get_url_parameter",
    "SELECT page_id, nullif(split_part(split_part(url, 'page=', 2), '&', 1), '') AS page,"
    " nullif(split_part(split_part(url, 'utm_source=', 2), '&', 1), '') AS utm_source FROM pages",
)
def get_url_parameter(t):
    names = ("page", "utm_source")
    return t.pages.select("page_id", *[s.get_url_parameter("url", n).alias(n) for n in names])


@query(
    "generate_surrogate_key",
    "SELECT l_orderkey, md5(concat_ws('-', CAST(l_orderkey AS VARCHAR), CAST(l_linenumber AS VARCHAR),"
    " coalesce(nullif(l_returnflag, 'N'), '_null_'))) AS line_id FROM lineitem",
)
def generate_surrogate_key(t):
    flag = F.nullif("l_returnflag", F.lit("N"))
    key = s.generate_surrogate_key(["l_orderkey", "l_linenumber", flag])
    return t.lineitem.select("l_orderkey", key.alias("line_id"))


@query(
    "regexp_instr",
    """
    SELECT doc_id, CAST(CASE WHEN regexp_extract(text, '[0-9]+') = '' THEN 0
      ELSE instr(text, regexp_extract(text, '[0-9]')) END AS INTEGER) AS first_digit,
      CAST(CASE WHEN regexp_matches(text, '(?i)THE') THEN instr(lower(text), 'the') ELSE 0 END AS INTEGER) AS first_the
    FROM documents
    """,
)
def regexp_instr(t):
    return t.documents.select(
        "doc_id",
        s.regexp_instr("text", "[0-9]").alias("first_digit"),
        s.regexp_instr("text", "THE", flags="i").alias("first_the"),
    )


@query(
    "_get_like_pattern_expression",
    "SELECT p_partkey, p_name LIKE '%ring%' AS is_like, p_name NOT LIKE '%ring%' AS is_not_like FROM part",
)
def like_pattern_expression(t):
    patterns = ["%ring%"]
    return t.part.select(
        "p_partkey",
        rules.like_condition("p_name", patterns).alias("is_like"),
        rules.like_condition("p_name", patterns, positive=False).alias("is_not_like"),
    )
