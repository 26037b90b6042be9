"""Expectations on distribution over time, gaps and recency."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import expect_time as e
from .registry import query, rounded, text

AS_OF = "2024-01-30 12:00:00"


@query(
    "expect_column_values_to_be_within_n_moving_stdevs",
    """
    WITH g AS (SELECT event_type, date_trunc('day', ts) AS p, sum(value) AS v FROM events GROUP BY 1, 2),
    d AS (SELECT *, coalesce(ln(nullif(v, 0)), 0) - coalesce(ln(nullif(lag(v) OVER (PARTITION BY event_type ORDER BY p), 0)), 0) AS x FROM g),
    m AS (SELECT *, avg(x) OVER w AS a, stddev(x) OVER w AS s FROM d
      WINDOW w AS (PARTITION BY event_type ORDER BY p ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING)),
    z AS (SELECT *, (x - a) / nullif(s, 0) AS sigma FROM m)
    SELECT event_type, CAST(CAST(p AS DATE) AS VARCHAR) AS metric_period, round(v, 2) AS agg_metric_value, round(sigma, 4) AS metric_test_sigma
    FROM z WHERE p >= TIMESTAMP '2024-01-16' AND p < TIMESTAMP '2024-01-30' AND NOT (sigma >= -1.5 AND sigma <= 1)
    """,
)
def moving_stdevs(t):
    failing = e.expect_column_values_to_be_within_n_moving_stdevs(
        t.events, "value", "ts", AS_OF, ["event_type"], sigma_threshold_upper=1, sigma_threshold_lower=-1.5
    )
    return failing.select(
        "event_type",
        F.to_date("metric_period").cast("string").alias("metric_period"),
        rounded("agg_metric_value", 2).alias("agg_metric_value"),
        rounded("metric_test_sigma").alias("metric_test_sigma"),
    )


@query(
    "expect_column_values_to_be_within_n_moving_stdevs_plain",
    """
    WITH g AS (SELECT date_trunc('day', ts) AS p, sum(value) AS v FROM events GROUP BY 1),
    m AS (SELECT *, avg(v) OVER w AS a, stddev(v) OVER w AS s FROM g WINDOW w AS (ORDER BY p ROWS BETWEEN 5 PRECEDING AND 1 PRECEDING)),
    z AS (SELECT *, (v - a) / nullif(s, 0) AS sigma FROM m)
    SELECT CAST(CAST(p AS DATE) AS VARCHAR) AS metric_period, round(sigma, 4) AS metric_test_sigma
    FROM z WHERE p >= TIMESTAMP '2024-01-10' AND p < TIMESTAMP '2024-01-30' AND NOT (sigma >= -1 AND sigma <= 1)
    """,
)
def moving_stdevs_plain(t):
    failing = e.expect_column_values_to_be_within_n_moving_stdevs(
        t.events, "value", "ts", AS_OF, trend_periods=5, test_periods=20, sigma_threshold=1,
        take_diffs=False, take_logs=False,
    )
    return failing.select(
        F.to_date("metric_period").cast("string").alias("metric_period"),
        rounded("metric_test_sigma").alias("metric_test_sigma"),
    )


@query(
    "expect_column_values_to_be_within_n_stdevs",
    """
    WITH g AS (SELECT l_suppkey, sum(l_quantity) AS metric FROM lineitem GROUP BY 1),
    m AS (SELECT avg(metric) AS a, stddev(metric) AS d FROM g)
    SELECT l_suppkey, round(metric, 2) AS metric, round((metric - a) / nullif(d, 0), 4) AS metric_sigma FROM g, m
    WHERE abs((metric - a) / nullif(d, 0)) > 1.5
    """,
)
def n_stdevs(t):
    failing = e.expect_column_values_to_be_within_n_stdevs(t.lineitem, "l_quantity", ["l_suppkey"], 1.5)
    return failing.select("l_suppkey", rounded("metric", 2).alias("metric"), rounded("metric_sigma").alias("metric_sigma"))


@query(
    "expect_row_values_to_have_data_for_every_n_datepart",
    """
    WITH x AS (SELECT min(CAST(ts AS DATE)) AS a, max(CAST(ts AS DATE)) AS b FROM events WHERE event_type = 'purchase'),
    s AS (SELECT unnest(generate_series(CAST(a AS TIMESTAMP), CAST(b AS TIMESTAMP), INTERVAL 1 HOUR)) AS h, b FROM x)
    SELECT CAST(h AS VARCHAR) AS date_hour, true AS is_missing, 0 AS row_cnt FROM s
    WHERE h < b AND h NOT IN (SELECT date_trunc('hour', ts) FROM events WHERE event_type = 'purchase') AND hour(h) <> 3
    """,
)
def every_hour(t):
    failing = e.expect_row_values_to_have_data_for_every_n_datepart(
        t.events, "ts", "hour", row_condition="event_type = 'purchase'", exclusion_condition="hour(date_hour) <> 3"
    )
    return failing.select(text("date_hour"), "is_missing", "row_cnt")


@query(
    "expect_row_values_to_have_data_for_every_n_datepart_interval",
    """
    WITH s AS (SELECT CAST(unnest(generate_series(DATE '1995-01-01', DATE '2002-06-01' - INTERVAL 1 DAY, INTERVAL 5 DAY)) AS DATE) AS d),
    p AS (SELECT DISTINCT CAST(CAST(o_orderdate AS DATE) - CAST(date_diff('day', DATE '1995-01-01', CAST(o_orderdate AS DATE)) % 5 AS INTEGER) AS DATE) AS d FROM orders)
    SELECT CAST(d AS VARCHAR) AS date_day, true AS is_missing, 0 AS row_cnt FROM s WHERE d NOT IN (SELECT d FROM p)
    """,
)
def every_five_days(t):
    failing = e.expect_row_values_to_have_data_for_every_n_datepart(
        t.orders, "o_orderdate", "day", 5, test_start_date="1995-01-01", test_end_date="2002-06-01"
    )
    return failing.select(F.to_date("date_day").cast("string").alias("date_day"), "is_missing", "row_cnt")


@query(
    "expect_grouped_row_values_to_have_recent_data",
    """
    SELECT user_id, event_type, CAST(max(epoch_us(ts)) AS BIGINT) AS latest_us FROM events
    WHERE ts <= TIMESTAMP '2024-01-30 12:00:00' GROUP BY 1, 2 HAVING max(ts) < TIMESTAMP '2024-01-25 12:00:00'
    """,
)
def grouped_recent(t):
    failing = e.expect_grouped_row_values_to_have_recent_data(
        t.events, ["user_id", "event_type"], "ts", "day", 5, AS_OF
    )
    return failing.select("user_id", "event_type", F.unix_micros("latest").alias("latest_us"))


@query(
    "expect_row_values_to_have_recent_data",
    """
    SELECT CAST(max(epoch_us(ts)) AS BIGINT) AS latest_us FROM events WHERE ts <= TIMESTAMP '2024-03-01 00:00:00' AND event_type = 'error'
    HAVING coalesce(max(ts), TIMESTAMP '1970-01-01') < TIMESTAMP '2024-02-20 00:00:00'
    """,
)
def recent(t):
    failing = e.expect_row_values_to_have_recent_data(
        t.events, "ts", "day", 10, "2024-03-01 00:00:00", "event_type = 'error'"
    )
    return failing.select(F.unix_micros("latest").alias("latest_us"))


@query(
    "source_freshness",
    """
    WITH a AS (SELECT CAST(floor(epoch(TIMESTAMP '2024-01-31 13:00:00')) - floor(epoch(max(ts))) AS BIGINT) AS age_seconds FROM events)
    SELECT age_seconds, CASE WHEN age_seconds > 86400 THEN 'error' WHEN age_seconds > 43200 THEN 'warn' ELSE 'pass' END AS status FROM a
    """,
)
def freshness(t):
    return e.source_freshness(t.events, "ts", "2024-01-31 13:00:00").select("age_seconds", "status")


def _gaps(part: str, interval: int | None):
    """Periods without a customer's first order; the first day lies inside its period."""
    step = interval or 1
    sql = f"""
    WITH d AS (SELECT CAST(min(o_orderdate) AS TIMESTAMP) AS day FROM orders GROUP BY o_custkey),
    x AS (SELECT date_trunc('{part}', min(day)) AS a, max(day) AS b FROM d),
    s AS (SELECT unnest(generate_series(CAST(a AS TIMESTAMP), b, to_{part}s({step}))) AS p, b FROM x)
    SELECT CAST(CAST(p AS DATE) AS VARCHAR) AS period, true AS is_missing, 0 AS row_cnt FROM s
    WHERE p < b AND NOT EXISTS (SELECT 1 FROM d WHERE day >= p AND day < p + to_{part}s({step}))
    """.replace("to_quarters(", "3 * to_months(")

    def run(t):
        first = t.orders.groupBy("o_custkey").agg(F.min("o_orderdate").alias("day"))
        missing = e.expect_row_values_to_have_data_for_every_n_datepart(first, "day", part, interval)
        return missing.select(F.to_date(f"date_{part}").cast("string").alias("period"), "is_missing", "row_cnt")

    query(f"gaps_of_{step}_{part}", sql)(run)


for _part in ("week", "month", "quarter", "year"):
    for _interval in (None, 2):
        _gaps(_part, _interval)
