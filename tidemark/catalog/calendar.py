"""Date dimension, fiscal calendar and calendar columns on facts."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import dates as d
from ..operators.calendar import get_date_dimension, get_fiscal_periods, get_fiscal_year_dates
from ..operators.reshape import date_spine_of
from .registry import query, text


def as_text(df):
    """Date columns as text."""
    return df.select(
        *[text(f.name) if isinstance(f.dataType, T.DateType) else F.col(f.name) for f in df.schema.fields]
    )


def order_calendar(t):
    """Dimension over the days the orders cover."""
    return get_date_dimension(date_spine_of(t.orders, "o_orderdate"))


_DAYS = """
  x AS (SELECT min(CAST(o_orderdate AS DATE)) AS a, max(CAST(o_orderdate AS DATE)) AS b FROM orders),
  days AS (SELECT CAST(unnest(generate_series(a, b, INTERVAL 1 DAY)) AS DATE) AS d FROM x)
"""


def _sql(date: str) -> str:
    return f"CAST(CAST({date} AS DATE) AS VARCHAR)"


def _sunday(x: str) -> str:
    return f"({x} - CAST(dayofweek({x}) AS INTEGER))"


def _monday(x: str) -> str:
    return f"({x} - CAST(isodow({x}) - 1 AS INTEGER))"


def _last_of_quarter(x: str) -> str:
    return f"date_trunc('quarter', {x}) + INTERVAL 3 MONTH - INTERVAL 1 DAY"


_YEAR_AGO, _SAME = "(d - INTERVAL 1 YEAR)", "(d - 364)"

DIMENSION_SQL = f"""
WITH {_DAYS}
SELECT {_sql('d')} AS date_day, {_sql('d - 1')} AS prior_date_day, {_sql('d + 1')} AS next_date_day,
  {_sql(_YEAR_AGO)} AS prior_year_date_day, {_sql(_SAME)} AS prior_year_over_year_date_day,
  CAST(dayofweek(d) + 1 AS INTEGER) AS day_of_week, CAST(isodow(d) AS INTEGER) AS day_of_week_iso,
  dayname(d) AS day_of_week_name, left(dayname(d), 3) AS day_of_week_name_short,
  CAST(day(d) AS INTEGER) AS day_of_month, CAST(dayofyear(d) AS INTEGER) AS day_of_year,
  {_sql(_sunday('d'))} AS week_start_date, {_sql(_sunday('d') + ' + 6')} AS week_end_date,
  {_sql(_sunday(_SAME))} AS prior_year_week_start_date, {_sql(_sunday(_SAME) + ' + 6')} AS prior_year_week_end_date,
  CAST(ceil(dayofyear(d) / 7.0) AS INTEGER) AS week_of_year,
  {_sql(_monday('d'))} AS iso_week_start_date, {_sql(_monday('d') + ' + 6')} AS iso_week_end_date,
  {_sql(_monday(_SAME))} AS prior_year_iso_week_start_date, {_sql(_monday(_SAME) + ' + 6')} AS prior_year_iso_week_end_date,
  CAST(week(d) AS INTEGER) AS iso_week_of_year,
  CAST(ceil(dayofyear({_SAME}) / 7.0) AS INTEGER) AS prior_year_week_of_year,
  CAST(week({_SAME}) AS INTEGER) AS prior_year_iso_week_of_year,
  CAST(month(d) AS INTEGER) AS month_of_year, monthname(d) AS month_name, left(monthname(d), 3) AS month_name_short,
  {_sql("date_trunc('month', d)")} AS month_start_date, {_sql('last_day(d)')} AS month_end_date,
  {_sql(f"date_trunc('month', {_YEAR_AGO})")} AS prior_year_month_start_date, {_sql(f'last_day(CAST({_YEAR_AGO} AS DATE))')} AS prior_year_month_end_date,
  CAST(quarter(d) AS INTEGER) AS quarter_of_year, {_sql("date_trunc('quarter', d)")} AS quarter_start_date,
  {_sql(_last_of_quarter('d'))} AS quarter_end_date, CAST(year(d) AS INTEGER) AS year_number,
  {_sql("date_trunc('year', d)")} AS year_start_date, year(d) || '-12-31' AS year_end_date
FROM days
"""


@query("get_date_dimension", DIMENSION_SQL)
def date_dimension(t):
    return as_text(order_calendar(t))


_FISCAL = f"""
WITH {_DAYS},
  jan AS (SELECT year(d) - 1 AS fy, d, last_day(d) AS me FROM days WHERE month(d) = 1),
  ends AS (SELECT fy, max(me) AS me FROM jan GROUP BY 1),
  cand AS (SELECT fy, CAST(d + INTERVAL 6 DAY AS DATE) AS we FROM jan WHERE dayofweek(d) = 0),
  years AS (SELECT fy, we FROM cand JOIN ends USING (fy)
    QUALIFY rank() OVER (PARTITION BY fy ORDER BY abs(date_diff('day', we, me))) = 1),
  spans AS (SELECT fy, CAST(lag(we) OVER (ORDER BY we) + INTERVAL 1 DAY AS DATE) AS ys, we AS ye FROM years),
  weeks AS (SELECT d AS ws, CAST(d + INTERVAL 6 DAY AS DATE) AS we FROM days WHERE dayofweek(d) = 0),
  f AS (SELECT d, fy, ys, ye, ws, weeks.we AS we, dense_rank() OVER (PARTITION BY fy ORDER BY ws) AS wk
    FROM days JOIN spans ON d BETWEEN ys AND ye JOIN weeks ON d BETWEEN ws AND weeks.we)
"""


@query(
    "get_fiscal_year_dates",
    _FISCAL
    + f"SELECT {_sql('d')} AS date_day, CAST(fy AS INTEGER) AS fiscal_year_number, {_sql('ys')} AS fiscal_year_start_date, {_sql('ye')} AS fiscal_year_end_date,"
    f" {_sql('ws')} AS week_start_date, {_sql('we')} AS week_end_date, CAST(wk AS INTEGER) AS fiscal_week_of_year FROM f",
)
def fiscal_year_dates(t):
    return as_text(get_fiscal_year_dates(order_calendar(t), year_end_month=1))


@query(
    "get_fiscal_periods",
    _FISCAL
    + f""", p AS (SELECT *, least(floor((wk - 1) / 13.0), 3) AS q,
      CASE WHEN wk = 53 THEN 3 WHEN (wk - 1) % 13 <= 3 THEN 1 WHEN (wk - 1) % 13 <= 8 THEN 2 ELSE 3 END AS poq FROM f),
    n AS (SELECT *, CAST(q * 3 + poq AS INTEGER) AS period FROM p),
    o AS (SELECT CAST(o_orderdate AS DATE) AS d, count(*) AS n_orders FROM orders GROUP BY 1)
    SELECT {_sql('d')} AS date_day, CAST(fy AS INTEGER) AS fiscal_year_number, {_sql('ws')} AS week_start_date, {_sql('we')} AS week_end_date,
      CAST(wk AS INTEGER) AS fiscal_week_of_year, CAST(dense_rank() OVER (PARTITION BY period ORDER BY wk) AS INTEGER) AS fiscal_week_of_period,
      period AS fiscal_period_number, CAST(q + 1 AS INTEGER) AS fiscal_quarter_number, poq AS fiscal_period_of_quarter, coalesce(n_orders, 0) AS n_orders
    FROM n LEFT JOIN o USING (d)""",
)
def fiscal_periods(t):
    """The 4-5-4 calendar with the orders of each day."""
    per_day = t.orders.groupBy(F.to_date("o_orderdate").alias("date_day")).agg(F.count(F.lit(1)).alias("n"))
    periods = get_fiscal_periods(order_calendar(t), year_end_month=1, week_start_day=1)
    joined = periods.join(per_day, "date_day", "left").withColumn("n_orders", F.coalesce("n", F.lit(0)))
    return as_text(joined.drop("n"))


# --- calendar columns of a fact table ----------------------------------------


def _column_query(name, sql, table, key, date, /, **columns):
    """Calendar functions as columns of a fact table; each takes the table's date."""

    @query(name, f"SELECT {key}, {sql} FROM {table}")
    def run(t):
        day = date()
        return as_text(getattr(t, table).select(key, *[c(day).alias(n) for n, c in columns.items()]))


_D = "CAST(o_orderdate AS DATE)"


def _order_query(name, sql, /, **columns):
    _column_query(name, sql, "orders", "o_orderkey", lambda: F.to_date("o_orderdate"), **columns)


def _event_query(name, sql, /, **columns):
    _column_query(name, sql, "events", "event_id", lambda: F.col("ts"), **columns)


_event_query(
    "convert_timezone",
    "CAST(epoch_us(ts AT TIME ZONE 'UTC' AT TIME ZONE 'America/Los_Angeles') AS BIGINT) AS local_us",
    local_us=lambda x: F.unix_micros(d.convert_timezone("ts", "America/Los_Angeles")),
)
_event_query(
    "date_part",
    "CAST(hour(ts) AS INTEGER) AS hour, CAST(quarter(ts) AS INTEGER) AS quarter",
    hour=lambda x: d.date_part("hour", "ts"),
    quarter=lambda x: d.date_part("quarter", "ts"),
)
_order_query(
    "day_name", f"left(dayname({_D}), 3) AS short, dayname({_D}) AS long", short=lambda x: d.day_name(x), long=lambda x: d.day_name(x, short=False)
)
_order_query("day_of_month", f"CAST(day({_D}) AS INTEGER) AS day", day=lambda x: d.day_of_month(x))
_order_query(
    "day_of_week",
    f"CAST(isodow({_D}) AS INTEGER) AS iso, CAST(dayofweek({_D}) + 1 AS INTEGER) AS plain",
    iso=lambda x: d.day_of_week(x),
    plain=lambda x: d.day_of_week(x, isoweek=False),
)
_order_query("day_of_year", f"CAST(dayofyear({_D}) AS INTEGER) AS day", day=lambda x: d.day_of_year(x))
_event_query(
    "from_unixtimestamp",
    "CAST(to_timestamp(event_id * 100000) AT TIME ZONE 'UTC' AS VARCHAR) AS from_seconds,"
    " CAST(epoch_us(make_timestamp(event_id * 1234567)) AS BIGINT) AS micros",
    from_seconds=lambda x: d.from_unixtimestamp(F.col("event_id") * 100000).cast("string"),
    micros=lambda x: F.unix_micros(d.from_unixtimestamp(F.col("event_id") * 1234567, "microseconds")),
)
_event_query("to_unixtimestamp", "CAST(floor(epoch(ts)) AS BIGINT) AS seconds", seconds=lambda x: d.to_unixtimestamp("ts"))
_order_query("iso_week_start", f"{_sql(_monday(_D))} AS day", day=lambda x: d.iso_week_start(x))
_order_query("iso_week_end", f"{_sql(_monday(_D) + ' + 6')} AS day", day=lambda x: d.iso_week_end(x))
_order_query("iso_week_of_year", f"CAST(week({_D}) AS INTEGER) AS week", week=lambda x: d.iso_week_of_year(x))
_order_query("week_start", f"{_sql(_sunday(_D))} AS day", day=lambda x: d.week_start(x))
_order_query("week_end", f"{_sql(_sunday(_D) + ' + 6')} AS day", day=lambda x: d.week_end(x))
_order_query("week_of_year", f"CAST(ceil(dayofyear({_D}) / 7.0) AS INTEGER) AS week", week=lambda x: d.week_of_year(x))
_order_query(
    "month_name", f"left(monthname({_D}), 3) AS short, monthname({_D}) AS long", short=lambda x: d.month_name(x), long=lambda x: d.month_name(x, short=False)
)
_event_query(
    "round_timestamp",
    "CAST(CAST(date_trunc('day', ts + INTERVAL 12 HOUR) AS DATE) AS VARCHAR) AS day",
    day=lambda x: F.to_date(d.round_timestamp("ts")),
)



def _as_of():
    return F.lit("2002-03-31 18:30:00").cast("timestamp")


_T = "TIMESTAMP '2002-03-31 18:30:00'"
_order_query(
    "periods_since",
    f"date_diff('day', o_orderdate, {_T}) AS days, date_diff('month', o_orderdate, {_T}) AS months, date_diff('hour', o_orderdate, {_T}) AS hours",
    days=lambda x: d.periods_since("o_orderdate", _as_of()),
    months=lambda x: d.periods_since("o_orderdate", _as_of(), "month"),
    hours=lambda x: d.periods_since("o_orderdate", _as_of(), "hour"),
)
_event_query(
    "now",
    "CAST(floor(epoch(TIMESTAMP '2024-06-01 00:00:00')) - floor(epoch(ts AT TIME ZONE 'UTC' AT TIME ZONE 'Asia/Tokyo')) AS BIGINT) AS seconds_ahead",
    seconds_ahead=lambda x: F.unix_timestamp(F.lit("2024-06-01 00:00:00").cast("timestamp")) - F.unix_timestamp(d.now("ts", "Asia/Tokyo")),
)
_event_query(
    "today",
    "CAST(CAST(ts AT TIME ZONE 'UTC' AT TIME ZONE 'Asia/Tokyo' AS DATE) AS VARCHAR) AS day",
    day=lambda x: d.today("ts", "Asia/Tokyo"),
)
_order_query("yesterday", f"{_sql(_D + ' - 1')} AS day", day=lambda x: d.yesterday(x))
_order_query("tomorrow", f"{_sql(_D + ' + 1')} AS day", day=lambda x: d.tomorrow(x))
_order_query("n_days_ago", f"{_sql(_D + ' - 10')} AS day", day=lambda x: d.n_days_ago(10, x))
_order_query("n_days_away", f"{_sql(_D + ' + 10')} AS day", day=lambda x: d.n_days_away(10, x))


def _week(n: int) -> str:
    return _sql(f"date_trunc('week', {_D} + {7 * n})")


def _month(n: int) -> str:
    return f"date_trunc('month', {_D}) + INTERVAL ({n}) MONTH"


_order_query("n_weeks_ago", f"{_week(-3)} AS day", day=lambda x: d.n_weeks_ago(3, x))
_order_query("n_weeks_away", f"{_week(3)} AS day", day=lambda x: d.n_weeks_away(3, x))
_order_query("n_months_ago", f"{_sql(_month(-5))} AS day", day=lambda x: d.n_months_ago(5, x))
_order_query("n_months_away", f"{_sql(_month(5))} AS day", day=lambda x: d.n_months_away(5, x))
_order_query("last_week", f"{_week(-1)} AS day", day=lambda x: d.last_week(x))
_order_query("next_week", f"{_week(1)} AS day", day=lambda x: d.next_week(x))
_order_query("last_month", f"{_sql(_month(-1))} AS day", day=lambda x: d.last_month(x))
_order_query("next_month", f"{_sql(_month(1))} AS day", day=lambda x: d.next_month(x))
_order_query("last_month_name", f"left(monthname({_month(-1)}), 3) AS name", name=lambda x: d.last_month_name(x))
_order_query("next_month_name", f"monthname({_month(1)}) AS name", name=lambda x: d.next_month_name(x, short=False))
_order_query("last_month_number", f"CAST(month({_month(-1)}) AS INTEGER) AS month", month=lambda x: d.last_month_number(x))
_order_query("next_month_number", f"CAST(month({_month(1)}) AS INTEGER) AS month", month=lambda x: d.next_month_number(x))


@query(
    "orders_in_the_last_months",
    f"""
    SELECT CAST(date_trunc('month', o_orderdate) AS DATE)::VARCHAR AS month, monthname(any_value(o_orderdate)) AS name,
      count(*) AS n_orders, round(sum(o_totalprice), 2) AS total
    FROM orders WHERE o_orderdate >= DATE '2001-01-01' AND o_orderdate < DATE '2001-08-01' GROUP BY 1
    """,
)
def orders_in_the_last_months(t):
    """A relative-period filter: the seven whole months before a reference day."""
    day = F.lit("2001-08-15").cast("date")
    recent = t.orders.where(
        (F.col("o_orderdate") >= d.n_months_ago(7, day)) & (F.col("o_orderdate") < d.n_months_away(0, day))
    )
    per_day = recent.groupBy(F.to_date("o_orderdate").alias("day")).agg(
        F.count(F.lit(1)).alias("n"), F.sum("o_totalprice").alias("total")
    )
    month = F.trunc("day", "month")
    return per_day.groupBy(
        month.cast("string").alias("month"), d.month_name("day", short=False).alias("name")
    ).agg(F.sum("n").alias("n_orders"), F.round(F.sum("total"), 2).alias("total"))
