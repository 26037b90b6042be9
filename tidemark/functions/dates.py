"""Date column expressions. The clock is always an argument (``as_of``)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .scalars import ColumnLike, as_column

SECONDS = {"second": 1, "minute": 60, "hour": 3600}
DAYS = {"day": 1, "week": 7}
MONTHS = {"month": 1, "quarter": 3, "year": 12}


def check_part(part: str) -> str:
    part = part.lower()
    if part not in {**SECONDS, **DAYS, **MONTHS}:
        raise ValueError(f"unknown date part: {part!r}")
    return part


def interval(part: str, n: ColumnLike | int = 1) -> Column:
    """Interval of ``n`` date parts."""
    part = check_part(part)
    n = F.lit(n) if isinstance(n, int) else as_column(n)
    if part in MONTHS:
        return F.make_interval(months=(n * MONTHS[part]).cast("int"))
    if part in DAYS:
        return F.make_interval(days=(n * DAYS[part]).cast("int"))
    return F.make_interval(secs=(n * SECONDS[part]).cast("decimal(18,6)"))


def add_parts(value: ColumnLike, part: str, n: ColumnLike | int) -> Column:
    """Timestamp moved by ``n`` date parts."""
    return as_column(value).cast("timestamp") + interval(part, n)


def truncate(part: str, value: ColumnLike) -> Column:
    """Start of the period as a timestamp; weeks start on Monday."""
    return F.date_trunc(check_part(part), as_column(value))


def get_intervals_between(start: ColumnLike, end: ColumnLike, part: str) -> Column:
    """Number of date part boundaries between two times."""
    part = check_part(part)
    a, b = truncate(part, start), truncate(part, end)
    if part in MONTHS:
        months = (F.year(b) - F.year(a)) * 12 + (F.month(b) - F.month(a))
        return (months / MONTHS[part]).cast("bigint")
    if part in DAYS:
        return (F.datediff(b, a) / DAYS[part]).cast("bigint")
    seconds = F.unix_timestamp(b) - F.unix_timestamp(a)
    return (seconds / SECONDS[part]).cast("bigint")


# --- clock -------------------------------------------------------------------


def now(as_of: ColumnLike | None = None, tz: str = "UTC") -> Column:
    """The reference time, in ``tz`` wall clock."""
    moment = F.current_timestamp() if as_of is None else as_column(as_of)
    return convert_timezone(moment, tz)


def today(as_of: ColumnLike | None = None, tz: str = "UTC") -> Column:
    return F.to_date(now(as_of, tz))


def convert_timezone(value: ColumnLike, target_tz: str, source_tz: str = "UTC") -> Column:
    """Shift a wall clock from one zone to another."""
    value = as_column(value).cast("timestamp")
    if target_tz == source_tz:
        return value
    return F.from_utc_timestamp(F.to_utc_timestamp(value, source_tz), target_tz)


def round_timestamp(value: ColumnLike) -> Column:
    """Nearest day."""
    return truncate("day", add_parts(value, "hour", 12))


def from_unixtimestamp(epochs: ColumnLike, format: str = "seconds") -> Column:
    makers = {
        "seconds": F.timestamp_seconds,
        "milliseconds": F.timestamp_millis,
        "microseconds": F.timestamp_micros,
    }
    if format not in makers:
        raise ValueError(f"unknown epoch format: {format!r}")
    return makers[format](as_column(epochs))


def to_unixtimestamp(value: ColumnLike) -> Column:
    return F.unix_timestamp(as_column(value).cast("timestamp"))


# --- parts and names ---------------------------------------------------------


def date_part(part: str, value: ColumnLike) -> Column:
    return F.date_part(F.lit(part), as_column(value))


def day_of_month(value: ColumnLike) -> Column:
    return F.dayofmonth(as_column(value))


def day_of_year(value: ColumnLike) -> Column:
    return F.dayofyear(as_column(value))


def day_of_week(value: ColumnLike, isoweek: bool = True) -> Column:
    """Monday 1 to Sunday 7, or Sunday 1 to Saturday 7 without ``isoweek``."""
    value = as_column(value)
    return F.weekday(value) + 1 if isoweek else F.dayofweek(value)


def day_name(value: ColumnLike, short: bool = True) -> Column:
    return F.date_format(as_column(value), "E" if short else "EEEE")


def month_name(value: ColumnLike, short: bool = True) -> Column:
    return F.date_format(as_column(value), "MMM" if short else "MMMM")


# --- weeks -------------------------------------------------------------------


def week_start(value: ColumnLike) -> Column:
    """Sunday on or before the date."""
    value = as_column(value)
    return F.date_sub(value, F.dayofweek(value) - 1)


def week_end(value: ColumnLike) -> Column:
    """Saturday on or after the date."""
    return F.date_add(week_start(value), 6)


def week_of_year(value: ColumnLike) -> Column:
    """Seven-day blocks from the first of January."""
    return F.ceil(F.dayofyear(as_column(value)) / 7).cast("int")


def iso_week_start(value: ColumnLike) -> Column:
    """Monday on or before the date."""
    value = as_column(value)
    return F.date_sub(value, F.weekday(value))


def iso_week_end(value: ColumnLike) -> Column:
    """Sunday on or after the date."""
    return F.date_add(iso_week_start(value), 6)


def iso_week_of_year(value: ColumnLike) -> Column:
    return F.weekofyear(as_column(value))


# --- relative periods, all seen from ``day`` ---------------------------------


def yesterday(day: ColumnLike) -> Column:
    return n_days_ago(1, day)


def tomorrow(day: ColumnLike) -> Column:
    return n_days_away(1, day)


def n_days_ago(n: int, day: ColumnLike) -> Column:
    return n_days_away(-n, day)


def n_days_away(n: int, day: ColumnLike) -> Column:
    return F.date_add(F.to_date(as_column(day)), n)


def n_weeks_ago(n: int, day: ColumnLike) -> Column:
    return n_weeks_away(-n, day)


def n_weeks_away(n: int, day: ColumnLike) -> Column:
    """Monday of the week ``n`` weeks on."""
    return iso_week_start(n_days_away(7 * n, day))


def n_months_ago(n: int, day: ColumnLike) -> Column:
    return n_months_away(-n, day)


def n_months_away(n: int, day: ColumnLike) -> Column:
    """First day of the month ``n`` months on."""
    return F.trunc(F.add_months(as_column(day), n), "month")


def last_week(day: ColumnLike) -> Column:
    return n_weeks_ago(1, day)


def next_week(day: ColumnLike) -> Column:
    return n_weeks_away(1, day)


def last_month(day: ColumnLike) -> Column:
    return n_months_ago(1, day)


def next_month(day: ColumnLike) -> Column:
    return n_months_away(1, day)


def last_month_name(day: ColumnLike, short: bool = True) -> Column:
    return month_name(last_month(day), short)


def next_month_name(day: ColumnLike, short: bool = True) -> Column:
    return month_name(next_month(day), short)


def last_month_number(day: ColumnLike) -> Column:
    return F.month(last_month(day))


def next_month_number(day: ColumnLike) -> Column:
    return F.month(next_month(day))


def periods_since(value: ColumnLike, as_of: ColumnLike, period: str = "day") -> Column:
    """Period boundaries from the value to ``as_of``."""
    return get_intervals_between(value, as_of, period)
