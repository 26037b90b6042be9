"""Joins, windows, set operations and reshaping."""

from __future__ import annotations

from contextlib import contextmanager
from types import SimpleNamespace

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import dates
from ..operators import joins as j
from ..operators import reshape as r
from ..operators.calendar import fiscal_year_ranges, get_date_dimension
from ..operators.core import equal_expression
from ..operators.expect_aggregates import nth_most_common
from ..operators.ordered import exact_quantile, with_neighbour
from ..plans import models
from ..plans.build import silver_tests
from ..plans.quality import flag_duplicates_in_batch
from .registry import query, rounded, text


def bronze_customers(t):
    """The customer table in the columns of the raw customer contract."""
    return t.customer.select(
        F.col("c_custkey").alias("id"),
        F.col("c_name").alias("nome"),
        F.concat(F.lower("c_mktsegment"), F.lit("@mail.com")).alias("email"),
        F.lit(None).cast("string").alias("telefone"),
        F.concat(F.lit("cidade "), "c_nationkey").alias("cidade"),
        F.lpad(F.col("c_nationkey").cast("string"), 2, "0").alias("estado"),
        F.lit("Ativo").alias("status"),
        F.to_date(F.lit("2020-01-01")).alias("data_cadastro"),
    )


def bronze_sales(t):
    """Order lines as sales: several rows per order key."""
    return t.lineitem.join(
        t.orders.select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey", "o_orderpriority"),
        "l_orderkey",
    ).select(
        F.col("l_orderkey").alias("id"),
        F.col("o_custkey").alias("cliente_id"),
        F.col("l_partkey").alias("produto_id"),
        F.to_date("l_shipdate").alias("data_venda"),
        F.col("l_extendedprice").alias("valor_total"),
        F.col("l_quantity").cast("bigint").alias("quantidade"),
        F.col("o_orderpriority").alias("metodo_pagto"),
    )


SALES_SQL = """
  SELECT l_orderkey AS venda_id, o_custkey AS cliente_id, l_partkey AS produto_id,
    CAST(l_shipdate AS DATE) AS data_venda, l_extendedprice AS valor_total,
    CAST(l_quantity AS BIGINT) AS quantidade, o_orderpriority AS metodo_pagto
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
  QUALIFY row_number() OVER (PARTITION BY l_orderkey ORDER BY CAST(l_shipdate AS DATE) DESC,
    o_custkey DESC, l_partkey DESC, l_extendedprice DESC, CAST(l_quantity AS BIGINT) DESC, o_orderpriority DESC) = 1
"""

DATAMART_SQL = f"""
  SELECT v.venda_id, c.c_custkey AS cliente_id, c.c_name AS cliente_nome,
    'cidade ' || c.c_nationkey AS cliente_cidade, lpad(CAST(c.c_nationkey AS VARCHAR), 2, '0') AS cliente_estado,
    v.produto_id, CAST(v.data_venda AS VARCHAR) AS data_venda, v.valor_total, v.quantidade, v.metodo_pagto,
    v.cliente_id AS venda_cliente_id
  FROM ({SALES_SQL}) v LEFT JOIN customer c ON v.cliente_id = c.c_custkey
"""


@query("latest_per_key", f"SELECT * REPLACE (CAST(data_venda AS VARCHAR) AS data_venda) FROM ({SALES_SQL})")
def latest_per_key(t):
    sales = models.silver_sales(bronze_sales(t))
    return sales.withColumn("data_venda", text("data_venda"))


@query(
    "silver_model_tests",
    """
    WITH f AS (
      SELECT 'customer_id_unique' AS "check", 0 AS failures UNION ALL SELECT 'customer_id_not_null', 0 UNION ALL
      SELECT 'customer_email_unique', (SELECT count(*) FROM (SELECT 1 FROM customer GROUP BY c_mktsegment HAVING count(*) > 1)) UNION ALL
      SELECT 'customer_email_not_null', 0 UNION ALL SELECT 'customer_status_accepted', 0 UNION ALL
      SELECT 'sale_id_unique', 0 UNION ALL SELECT 'sale_id_not_null', 0 UNION ALL SELECT 'sale_customer_not_null', 0 UNION ALL
      SELECT 'sale_customer_exists', (SELECT count(DISTINCT l_orderkey) FROM lineitem JOIN orders ON l_orderkey = o_orderkey
        WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal >= 0)))
    SELECT "check", failures, CASE WHEN failures = 0 THEN 'pass' ELSE 'error' END AS status FROM f
    """,
)
def silver_model_tests(t):
    """Tests of the silver models; customers in debt go by another key, so their sales are orphans."""
    key = F.when(F.col("c_acctbal") >= 0, F.col("c_custkey")).otherwise(-F.col("c_custkey"))
    customers = t.customer.withColumn("c_custkey", key)
    bronze = bronze_customers(SimpleNamespace(customer=customers))
    return silver_tests(models.silver_customers(bronze), models.silver_sales(bronze_sales(t)))


def datamart(t):
    sales = models.silver_sales(bronze_sales(t))
    customers = models.silver_customers(bronze_customers(t))
    return models.sales_datamart(sales, customers).withColumn("data_venda", text("data_venda"))


query("sales_datamart_left_join", DATAMART_SQL)(datamart)


@query("sales_datamart_left_join_heavy_keys", DATAMART_SQL)
def datamart_heavy_keys(t):
    """The same join, both sides shuffled and sorted."""
    sales = models.silver_sales(bronze_sales(t))
    customers = models.silver_customers(bronze_customers(t)).select(
        "cliente_id",
        F.col("nome").alias("cliente_nome"),
        F.col("cidade").alias("cliente_cidade"),
        F.col("estado").alias("cliente_estado"),
        F.col("cliente_id").alias("_found"),
    )
    joined = j.lookup_join(sales, customers.hint("merge"), ["cliente_id"])
    return joined.select(
        "venda_id",
        F.col("_found").alias("cliente_id"),
        "cliente_nome",
        "cliente_cidade",
        "cliente_estado",
        "produto_id",
        text("data_venda"),
        "valor_total",
        "quantidade",
        "metodo_pagto",
        F.col("cliente_id").alias("venda_cliente_id"),
    )


@query(
    "lookup_join_hot_key",
    """
    WITH o AS (SELECT o_orderkey, CASE WHEN o_orderstatus = 'O' THEN 7 ELSE nullif(o_custkey, 8) END AS c_custkey FROM orders)
    SELECT o_orderkey, c_custkey, c_name, c_mktsegment FROM o LEFT JOIN customer USING (c_custkey)
    """,
)
def lookup_join_hot_key(t):
    """A third of the orders share a customer and some have none; both sides are shuffled."""
    key = F.when(F.col("o_orderstatus") == "O", 7).otherwise(F.nullif("o_custkey", F.lit(8)))
    orders = t.orders.select("o_orderkey", key.cast("bigint").alias("c_custkey"))
    customers = t.customer.select("c_custkey", "c_name", "c_mktsegment")
    return j.lookup_join(orders, customers.hint("merge"), ["c_custkey"])


@query(
    "full_outer_compare_join",
    """
    WITH a AS (SELECT CAST(c_nationkey + CASE WHEN c_acctbal < 0 THEN 20 ELSE 10 END AS BIGINT) AS nation, count(*) AS customers FROM customer GROUP BY 1),
    b AS (SELECT CAST(s_nationkey AS BIGINT) AS nation, count(*) AS suppliers FROM supplier GROUP BY 1)
    SELECT nation, customers, suppliers FROM a FULL JOIN b USING (nation)
    """,
)
def full_outer_compare_join(t):
    """Customers by a shifted nation, so that either side has keys of its own."""
    shifted = F.col("c_nationkey") + F.when(F.col("c_acctbal") < 0, 20).otherwise(10)
    a = t.customer.groupBy(shifted.cast("bigint").alias("nation"))
    b = t.supplier.groupBy(F.col("s_nationkey").cast("bigint").alias("nation"))
    return j.compare_join(
        a.agg(F.count(F.lit(1)).alias("customers")), b.agg(F.count(F.lit(1)).alias("suppliers")), ["nation"]
    )


@query(
    "cross_join_compare",
    """
    WITH a AS (SELECT CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS expression FROM lineitem),
    b AS (SELECT count(*) AS compare_expression FROM orders)
    SELECT expression, compare_expression, CAST(abs(expression - compare_expression) AS BIGINT) AS expression_difference,
      round(abs(expression - compare_expression) / expression, 6) AS expression_difference_percent FROM a CROSS JOIN b
    """,
)
def cross_join_compare(t):
    quantity = F.sum(F.col("l_quantity").cast("bigint"))
    compared = equal_expression(t.lineitem, quantity, t.orders, F.count(F.lit(1)))
    return compared.withColumn(
        "expression_difference_percent", rounded("expression_difference_percent", 6)
    )


@query(
    "anti_join_check",
    "SELECT l_partkey, count(*) AS failing_rows FROM lineitem"
    " WHERE l_partkey NOT IN (SELECT p_partkey FROM part WHERE p_retailprice < 950) GROUP BY 1",
)
def anti_join_check(t):
    """Dear parts have a null key here, which matches nothing."""
    parts = t.part.select(F.when(F.col("p_retailprice") < 950, F.col("p_partkey")).alias("p_partkey"))
    return j.keys_without_match(t.lineitem, "l_partkey", parts, "p_partkey")


@query(
    "semi_join_check",
    "SELECT l_partkey, count(*) AS failing_rows FROM lineitem"
    " WHERE l_partkey IN (SELECT p_partkey FROM part WHERE p_type = 'ECONOMY') GROUP BY 1",
)
def semi_join_check(t):
    parts = t.part.select(F.when(F.col("p_type") == "ECONOMY", F.col("p_partkey")).alias("p_partkey"))
    return j.keys_with_match(t.lineitem, "l_partkey", parts, "p_partkey")


@query(
    "spine_left_join",
    """
    WITH s AS (SELECT unnest(generate_series(min(date_trunc('hour', ts)), max(date_trunc('hour', ts)), INTERVAL 1 HOUR)) AS h FROM events)
    SELECT CAST(h AS VARCHAR) AS date_hour FROM s
    WHERE h NOT IN (SELECT date_trunc('hour', ts) FROM events WHERE event_type = 'purchase')
    """,
)
def spine_left_join(t):
    spine = r.date_spine_of(t.events, "ts", "hour")
    hours = t.events.select(F.when(F.col("event_type") == "purchase", dates.truncate("hour", "ts")).alias("date_hour"))
    return spine.join(hours.distinct(), "date_hour", "left_anti").select(text("date_hour"))


# --- windows -----------------------------------------------------------------


@query(
    "deduplicate",
    "SELECT user_id, event_type, event_id, value FROM events"
    " QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) = 1",
)
def deduplicate(t):
    latest = r.deduplicate(t.events, ["user_id", "event_type"], [F.desc("ts"), F.desc("event_id")])
    return latest.select("user_id", "event_type", "event_id", "value")


@query(
    "natural_join_dedup",
    "SELECT min(doc_id) AS doc_id, text FROM documents GROUP BY text",
)
def natural_join_dedup(t):
    """One document per text, told apart by its hash so that no long key is sorted."""
    hashed = t.documents.select("doc_id", "text", F.sha2("text", 256).alias("text_hash"))
    return r.deduplicate(hashed, ["text_hash"], ["doc_id"]).drop("text_hash")


@query(
    "flag_duplicates_in_batch",
    "SELECT doc_id, row_number() OVER (PARTITION BY sha256(text) ORDER BY doc_id) > 1 AS repeated FROM documents",
)
def flag_duplicates(t):
    """Repeated texts by their hash, so that no text is shuffled."""
    rows = t.documents.select("doc_id", F.sha2("text", 256).alias("text_hash"))
    flagged = flag_duplicates_in_batch(rows, "text_hash", ["doc_id"], "repeated")
    return flagged.select("doc_id", "repeated")


_LAG = (
    "SELECT event_id, lag(value) OVER (PARTITION BY event_type ORDER BY ts, event_id) AS previous,"
    " lag(value) OVER (PARTITION BY event_type ORDER BY ts, event_id) IS NOT NULL AS previous_exists FROM events"
)


@query("lag_monotone", _LAG)
def lag_monotone(t):
    rows = with_neighbour(t.events, "value", ["ts", "event_id"], ["event_type"])
    return rows.select("event_id", "previous", "previous_exists")


@query(
    "lag_sequence",
    "SELECT o_orderkey, lag(o_orderkey) OVER (ORDER BY o_orderkey) AS previous FROM orders",
)
def lag_sequence(t):
    return with_neighbour(t.orders, "o_orderkey", ["o_orderkey"]).select("o_orderkey", "previous")


@query(
    "lead_range",
    "SELECT event_id, lead(event_id) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS next_event,"
    " row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1 AS is_last FROM events",
)
def lead_range(t):
    rows = with_neighbour(
        t.events, "event_id", ["ts", "event_id"], ["user_id"], into="next_event", ahead=True
    )
    return rows.select("event_id", "next_event", (~F.col("next_event_exists")).alias("is_last"))


def _daily(t):
    """Events per type and day: the windows below run on this aggregate."""
    return t.events.groupBy("event_type", F.to_date("ts").alias("day")).agg(
        F.count(F.lit(1)).alias("n"), F.sum("value").alias("total")
    )


_DAILY = "SELECT event_type, CAST(ts AS DATE) AS day, count(*) AS n, sum(value) AS total FROM events GROUP BY 1, 2"


@query(
    "rolling_avg_stddev",
    f"""
    SELECT event_type, CAST(day AS VARCHAR) AS day, round(avg(n) OVER w, 6) AS average, round(stddev(n) OVER w, 6) AS deviation
    FROM ({_DAILY}) WINDOW w AS (PARTITION BY event_type ORDER BY day ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING)
    """,
)
def rolling_avg_stddev(t):
    trend = Window.partitionBy("event_type").orderBy("day").rowsBetween(-7, -1)
    return _daily(t).select(
        "event_type",
        text("day"),
        rounded(F.avg("n").over(trend), 6).alias("average"),
        rounded(F.stddev_samp("n").over(trend), 6).alias("deviation"),
    )


@query(
    "lag_n_periods",
    f"SELECT event_type, CAST(day AS VARCHAR) AS day, n - lag(n, 3) OVER (PARTITION BY event_type ORDER BY day) AS change FROM ({_DAILY})",
)
def lag_n_periods(t):
    in_time = Window.partitionBy("event_type").orderBy("day")
    return _daily(t).select("event_type", text("day"), (F.col("n") - F.lag("n", 3).over(in_time)).alias("change"))


@query(
    "global_zscore",
    """
    WITH g AS (SELECT user_id, sum(value) AS metric FROM events GROUP BY 1),
    m AS (SELECT avg(metric) AS a, stddev(metric) AS d FROM g)
    SELECT user_id, round((metric - a) / nullif(d, 0), 6) AS sigma FROM g, m
    """,
)
def global_zscore(t):
    sums = t.events.groupBy("user_id").agg(F.sum("value").alias("metric"))
    moments = sums.agg(F.avg("metric").alias("a"), F.stddev_samp("metric").alias("d"))
    scored = j.compare_join(sums, F.broadcast(moments), ())
    sigma = F.try_divide(F.col("metric") - F.col("a"), F.col("d"))
    return scored.select("user_id", rounded(sigma, 6).alias("sigma"))


def _order_calendar(t):
    return get_date_dimension(r.date_spine_of(t.orders, "o_orderdate"))


_WEEK_ENDS = """
  WITH x AS (SELECT min(CAST(o_orderdate AS DATE)) AS a, max(CAST(o_orderdate AS DATE)) AS b FROM orders),
  days AS (SELECT CAST(unnest(generate_series(a, b, INTERVAL 1 DAY)) AS DATE) AS d FROM x),
  jan AS (SELECT year(d) - 1 AS fy, d, last_day(d) AS me FROM days WHERE month(d) = 1),
  ends AS (SELECT fy, max(me) AS me FROM jan GROUP BY 1),
  weeks AS (SELECT fy, CAST(d + INTERVAL 6 DAY AS DATE) AS we FROM jan WHERE dayofweek(d) = 0),
  years AS (SELECT fy, we FROM weeks JOIN ends USING (fy)
    QUALIFY rank() OVER (PARTITION BY fy ORDER BY abs(date_diff('day', we, me))) = 1)
"""


@query(
    "rank_closest",
    _WEEK_ENDS + "SELECT CAST(fy AS INTEGER) AS fiscal_year_number, CAST(we AS VARCHAR) AS fiscal_year_end_date FROM years",
)
def rank_closest(t):
    years = fiscal_year_ranges(_order_calendar(t), year_end_month=1)
    return years.select("fiscal_year_number", text("fiscal_year_end_date"))


@query(
    "range_join_dates",
    _WEEK_ENDS
    + """, spans AS (SELECT fy, CAST(lag(we) OVER (ORDER BY we) + INTERVAL 1 DAY AS DATE) AS ys, we AS ye FROM years)
    SELECT CAST(fy AS INTEGER) AS fiscal_year_number, CAST(ys AS VARCHAR) AS first_day, count(*) AS n_lines
    FROM lineitem JOIN spans ON CAST(l_shipdate AS DATE) BETWEEN ys AND ye GROUP BY 1, 2""",
)
def range_join_dates(t):
    """Lines per fiscal year: the few ranges are spread to days, facts meet them by day."""
    years = fiscal_year_ranges(_order_calendar(t), year_end_month=1)
    days = j.dates_in_ranges(years, "fiscal_year_start_date", "fiscal_year_end_date")
    shipped = t.lineitem.groupBy(F.to_date("l_shipdate").alias("date_day")).agg(
        F.count(F.lit(1)).alias("n")
    )
    return (
        shipped.join(days, "date_day")
        .groupBy("fiscal_year_number", text("fiscal_year_start_date", "first_day"))
        .agg(F.sum("n").alias("n_lines"))
    )


@query(
    "lag_year_start",
    _WEEK_ENDS
    + "SELECT CAST(fy AS INTEGER) AS fiscal_year_number, CAST(CAST(lag(we) OVER (ORDER BY we) + INTERVAL 1 DAY AS DATE) AS VARCHAR)"
    " AS fiscal_year_start_date FROM years",
)
def lag_year_start(t):
    years = fiscal_year_ranges(_order_calendar(t), year_end_month=1)
    return years.select("fiscal_year_number", text("fiscal_year_start_date"))


@query(
    "dense_rank_week",
    """
    WITH w AS (SELECT CAST(o_orderdate AS DATE) AS day, count(*) AS n FROM orders GROUP BY 1)
    SELECT CAST(day AS VARCHAR) AS day, n, CAST(dense_rank() OVER (PARTITION BY year(day)
      ORDER BY CAST(date_trunc('week', day) AS DATE)) AS INTEGER) AS week_of_year FROM w
    """,
)
def dense_rank_week(t):
    """Week number within the year per day, ranked on the daily aggregate."""
    days = t.orders.groupBy(F.to_date("o_orderdate").alias("day")).agg(F.count(F.lit(1)).alias("n"))
    weeks = Window.partitionBy(F.year("day")).orderBy(dates.iso_week_start("day"))
    return days.select(text("day"), "n", F.dense_rank().over(weeks).alias("week_of_year"))


@query(
    "running_sum",
    f"SELECT event_type, CAST(day AS VARCHAR) AS day, CAST(sum(n) OVER (PARTITION BY event_type ORDER BY day) AS BIGINT) AS up,"
    f" CAST(sum(n) OVER (PARTITION BY event_type ORDER BY day DESC) AS BIGINT) AS down FROM ({_DAILY})",
)
def running_sum(t):
    up = Window.partitionBy("event_type").orderBy("day")
    down = Window.partitionBy("event_type").orderBy(F.desc("day"))
    return _daily(t).select("event_type", text("day"), F.sum("n").over(up).alias("up"), F.sum("n").over(down).alias("down"))


# --- sorts -------------------------------------------------------------------


@query(
    "nth_most_common",
    "SELECT l_partkey AS value_field, count(*) AS n_rows FROM lineitem GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 1 OFFSET 2",
)
def nth_common(t):
    return nth_most_common(t.lineitem, "l_partkey", 3)


@query(
    "ordered_output",
    "SELECT CAST(o_orderdate AS DATE)::VARCHAR AS day, count(*) AS n_orders FROM orders GROUP BY 1 ORDER BY 1",
)
def ordered_output(t):
    days = t.orders.groupBy(F.to_date("o_orderdate").cast("string").alias("day"))
    return days.agg(F.count(F.lit(1)).alias("n_orders")).orderBy("day")


@query(
    "limit_one",
    "SELECT count(nullif(l_returnflag, 'N')) > 0 AS has_value, count(nullif(l_linestatus, l_linestatus)) > 0 AS has_none FROM lineitem",
)
def limit_one(t):
    """Existence as an aggregate: no row is moved to find out."""
    return t.lineitem.agg(
        (F.count(F.nullif("l_returnflag", F.lit("N"))) > 0).alias("has_value"),
        (F.count(F.nullif("l_linestatus", "l_linestatus")) > 0).alias("has_none"),
    )


# --- aggregates --------------------------------------------------------------


@query(
    "sum_avg_min_max_count",
    "SELECT l_returnflag, l_linestatus, round(sum(l_extendedprice), 2) AS total, round(avg(l_extendedprice), 4) AS average,"
    " min(l_quantity) AS least, max(l_quantity) AS most, count(*) AS n_rows FROM lineitem GROUP BY 1, 2",
)
def sum_avg_min_max_count(t):
    return t.lineitem.groupBy("l_returnflag", "l_linestatus").agg(
        rounded(F.sum("l_extendedprice"), 2).alias("total"),
        rounded(F.avg("l_extendedprice")).alias("average"),
        F.min("l_quantity").alias("least"),
        F.max("l_quantity").alias("most"),
        F.count(F.lit(1)).alias("n_rows"),
    )


@query(
    "count_distinct",
    "SELECT l_returnflag, count(DISTINCT l_partkey) AS parts FROM lineitem GROUP BY 1",
)
def count_distinct(t):
    return t.lineitem.groupBy("l_returnflag").agg(F.count_distinct("l_partkey").alias("parts"))


@query(
    "unique_proportion",
    "SELECT l_linestatus, round(count(DISTINCT l_partkey) * 1.0 / count(l_partkey), 6) AS share FROM lineitem GROUP BY 1",
)
def unique_share(t):
    from ..operators.expect_aggregates import unique_proportion

    return t.lineitem.groupBy("l_linestatus").agg(rounded(unique_proportion("l_partkey"), 6).alias("share"))


@query(
    "stddev",
    "SELECT l_returnflag, round(stddev(l_quantity), 6) AS deviation FROM lineitem GROUP BY 1",
)
def stddev(t):
    return t.lineitem.groupBy("l_returnflag").agg(rounded(F.stddev_samp("l_quantity"), 6).alias("deviation"))


@query(
    "percentile_cont",
    "SELECT l_returnflag, round(quantile_cont(l_extendedprice, 0.9), 4) AS p90 FROM lineitem GROUP BY 1",
)
def percentile_cont(t):
    quantiles = exact_quantile(t.lineitem, "l_extendedprice", 0.9, ["l_returnflag"], into="p90")
    return quantiles.withColumn("p90", rounded("p90"))


@query("median", "SELECT round(median(o_totalprice), 4) AS median_price FROM orders")
def median(t):
    return exact_quantile(t.orders, "o_totalprice", 0.5, into="median_price").select(
        rounded("median_price").alias("median_price")
    )


@query(
    "group_having",
    "SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1",
)
def group_having(t):
    counts = t.lineitem.groupBy("l_orderkey", "l_linenumber").agg(F.count(F.lit(1)).alias("n"))
    return counts.where("n > 1")


@query(
    "optional_grouping",
    """
    SELECT 'all' AS grain, CAST(NULL AS VARCHAR) AS event_type, count(*) AS n FROM events
    UNION ALL SELECT 'type', event_type, count(*) FROM events GROUP BY event_type
    """,
)
def optional_grouping(t):
    from ..operators.core import aggregate

    whole = aggregate(t.events, (), n=F.count(F.lit(1)))
    grouped = aggregate(t.events, ["event_type"], n=F.count(F.lit(1)))
    return whole.select(F.lit("all").alias("grain"), F.lit(None).cast("string").alias("event_type"), "n").union(
        grouped.select(F.lit("type"), "event_type", "n")
    )


@query(
    "get_column_values",
    """
    SELECT o_orderkey FROM (SELECT o_orderkey, max(o_totalprice) AS price FROM orders WHERE o_orderstatus <> 'P' GROUP BY 1)
    ORDER BY price DESC, o_orderkey LIMIT 12000
    """,
)
def get_column_values(t):
    """The first values of a column of many, in the order of an aggregate."""
    return r.get_column_values(
        t.orders, "o_orderkey", max_records=12_000, where="o_orderstatus <> 'P'", order_by=F.max("o_totalprice")
    )


@query(
    "column_value_counts",
    "SELECT l_orderkey, count(*) AS n_rows FROM lineitem GROUP BY 1",
)
def column_value_counts(t):
    """All values with their counts, however many."""
    return r.column_value_counts(t.lineitem, "l_orderkey")


@query(
    "pivot",
    """
    SELECT p_brand, sum(CASE WHEN p_type = 'ECONOMY' THEN 1 ELSE 0 END)::BIGINT AS n_ECONOMY,
      sum(CASE WHEN p_type = 'PROMO' THEN 1 ELSE 0 END)::BIGINT AS n_PROMO,
      max(CASE WHEN p_size >= 10 THEN p_retailprice ELSE 0 END) AS size_10,
      max(CASE WHEN p_size >= 40 THEN p_retailprice ELSE 0 END) AS size_40
    FROM part GROUP BY 1
    """,
)
def pivot(t):
    return t.part.groupBy("p_brand").agg(
        *r.pivot("p_type", ["ECONOMY", "PROMO"], prefix="n_"),
        *r.pivot("p_size", [10, 40], agg="max", cmp=">=", prefix="size_", then_value="p_retailprice"),
    )


# --- sets --------------------------------------------------------------------


@query(
    "union_relations",
    """
    SELECT 'customer' AS _source_relation, c_custkey AS key, c_name AS name, c_acctbal AS balance, c_mktsegment AS segment FROM customer
    UNION ALL SELECT 'supplier', s_suppkey, s_name, s_acctbal, NULL FROM supplier
    """,
)
def union_relations(t):
    customers = t.customer.selectExpr("c_custkey AS key", "c_name AS name", "c_acctbal AS balance", "c_mktsegment AS segment")
    suppliers = t.supplier.selectExpr("s_suppkey AS key", "s_name AS name", "s_acctbal AS balance", "s_nationkey AS nation")
    return r.union_relations({"customer": customers, "supplier": suppliers}, exclude=["NATION"])


@contextmanager
def _views(t, prefix, names):
    """Tables as temporary views, while names are looked up."""
    for name in names:
        getattr(t, name).createOrReplaceTempView(f"{prefix}{name}")
    try:
        yield
    finally:
        for name in names:
            t.spark.catalog.dropTempView(f"{prefix}{name}")


@query(
    "union_by_pattern",
    """
    SELECT 'tmk_p_orders' AS _source_relation, o_orderkey, CAST(NULL AS VARCHAR) AS c_name FROM orders
    UNION ALL SELECT 'tmk_p_customer', NULL, c_name FROM customer
    """,
)
def union_by_pattern(t):
    """Whatever the pattern finds, less what is excluded."""
    with _views(t, "tmk_p_", ["orders", "customer", "nation"]):
        tables = r.get_relations_by_pattern(t.spark, "%", "TMK_P_%", "tmk_p_nat%")
        return r.union_relations(tables, include=["c_name", "o_orderkey"])


@query(
    "union_by_prefix",
    "SELECT 'tmk_q_lineitem' AS _source_relation, l_orderkey, l_linenumber FROM lineitem",
)
def union_by_prefix(t):
    with _views(t, "tmk_q_", ["lineitem", "orders"]):
        tables = r.get_relations_by_prefix(t.spark, "%", "TMK_Q_line")
        return r.union_relations(tables, include=["l_orderkey", "l_linenumber"])


@query(
    "except_both_ways",
    """
    WITH a AS (SELECT CAST(c_nationkey AS BIGINT) AS nation, c_mktsegment AS segment FROM customer),
    b AS (SELECT CAST(c_nationkey + CASE WHEN c_acctbal > 5000 THEN 15 ELSE 0 END AS BIGINT) AS nation, c_mktsegment AS segment FROM customer)
    SELECT 'a_minus_b' AS which_diff, * FROM (SELECT * FROM a EXCEPT SELECT * FROM b)
    UNION ALL SELECT 'b_minus_a', * FROM (SELECT * FROM b EXCEPT SELECT * FROM a)
    """,
)
def except_both_ways(t):
    """All customers on both sides; rich ones live elsewhere on the second."""
    a = t.customer.selectExpr("CAST(c_nationkey AS BIGINT) AS nation", "c_mktsegment AS segment")
    moved = "CAST(c_nationkey + CASE WHEN c_acctbal > 5000 THEN 15 ELSE 0 END AS BIGINT) AS nation"
    return r.except_both_ways(a, t.customer.selectExpr(moved, "c_mktsegment AS segment"))


@query(
    "unpivot",
    """
    WITH p AS (SELECT p_partkey, p_brand, CAST(nullif(p_size, 10) AS VARCHAR) AS p_size FROM part)
    SELECT p_partkey, 'p_brand' AS prop, p_brand AS val FROM p UNION ALL SELECT p_partkey, 'p_size', p_size FROM p
    """,
)
def unpivot(t):
    rows = t.part.withColumn("p_size", F.nullif("p_size", F.lit(10)))
    rows = rows.select("p_partkey", "p_name", "p_brand", "p_size")
    return r.unpivot(rows, "string", ["p_partkey"], ["p_name"], "prop", "val")


@query("distinct", "SELECT DISTINCT lang, source FROM documents")
def distinct(t):
    return t.documents.select("lang", "source").distinct()


@query(
    "generate_series",
    """
    WITH k AS (SELECT DISTINCT l_linenumber FROM lineitem)
    SELECT s.generated_number, l_linenumber IS NOT NULL AS present FROM
      (SELECT unnest(generate_series(1, (SELECT max(o_orderkey) + 1 FROM orders))) AS generated_number) s
      LEFT JOIN k ON k.l_linenumber = s.generated_number
    """,
)
def generate_series(t):
    """Numbers 1 to the order count, and whether a line number has them."""
    upper = t.orders.agg(F.max("o_orderkey") + 1).first()[0]
    used = t.lineitem.select(F.col("l_linenumber").cast("bigint").alias("generated_number")).distinct()
    return (
        r.generate_series(t.spark, upper)
        .join(used.withColumn("present", F.lit(True)), "generated_number", "left")
        .select("generated_number", F.coalesce("present", F.lit(False)).alias("present"))
    )


@query(
    "date_spine",
    """
    WITH x AS (SELECT min(CAST(o_orderdate AS DATE)) AS a, max(CAST(o_orderdate AS DATE)) AS b FROM orders),
    s AS (SELECT unnest(generate_series(a, b, INTERVAL 1 MONTH)) AS m, b FROM x)
    SELECT CAST(CAST(m AS DATE) AS VARCHAR) AS date_month, count(o_orderkey) AS n_orders
    FROM s LEFT JOIN orders ON date_trunc('month', o_orderdate) = m WHERE m < b GROUP BY 1
    """,
)
def date_spine(t):
    """Orders per month over a spine whose end, the last order day, is left out."""
    ends = t.orders.agg(F.min("o_orderdate").alias("a"), F.max("o_orderdate").alias("b")).first()
    spine = r.date_spine(t.spark, "month", ends["a"], ends["b"])
    months = t.orders.groupBy(dates.truncate("month", "o_orderdate").alias("date_month")).agg(
        F.count(F.lit(1)).alias("n")
    )
    joined = spine.join(months, "date_month", "left")
    return joined.select(
        F.to_date("date_month").cast("string").alias("date_month"),
        F.coalesce("n", F.lit(0)).alias("n_orders"),
    )


@query(
    "get_intervals_between",
    """
    SELECT o_orderkey, date_diff('day', o_orderdate, TIMESTAMP '2002-02-15 13:00:00') AS days,
      date_diff('month', o_orderdate, TIMESTAMP '2002-02-15 13:00:00') AS months,
      date_diff('quarter', o_orderdate, TIMESTAMP '2002-02-15 13:00:00') AS quarters,
      date_diff('year', o_orderdate, TIMESTAMP '2002-02-15 13:00:00') AS years,
      date_diff('hour', o_orderdate, TIMESTAMP '2002-02-15 13:00:00') AS hours FROM orders
    """,
)
def get_intervals_between(t):
    end = F.lit("2002-02-15 13:00:00").cast("timestamp")
    parts = ("day", "month", "quarter", "year", "hour")
    return t.orders.select(
        "o_orderkey",
        *[dates.get_intervals_between("o_orderdate", end, p).alias(f"{p}s") for p in parts],
    )


@query(
    "get_base_dates",
    """
    WITH s AS (SELECT CAST(unnest(generate_series(DATE '2024-01-30' - INTERVAL 20 DAY, DATE '2024-01-30', INTERVAL 1 DAY)) AS DATE) AS d)
    SELECT CAST(d AS VARCHAR) AS date_day, count(event_id) AS n_events FROM s LEFT JOIN events ON CAST(ts AS DATE) = d GROUP BY 1
    """,
)
def get_base_dates(t):
    spine = r.get_base_dates(t.spark, n_dateparts=20, as_of="2024-01-30")
    counts = t.events.groupBy(dates.truncate("day", "ts").alias("date_day")).agg(F.count(F.lit(1)).alias("n"))
    joined = spine.join(counts, "date_day", "left")
    return joined.select(
        F.to_date("date_day").cast("string").alias("date_day"), F.coalesce("n", F.lit(0)).alias("n_events")
    )
