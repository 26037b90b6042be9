"""Date dimension and the 4-5-4 fiscal calendar."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import dates as d

def _month_end(day: Column) -> Column:
    return F.last_day(day)


def get_date_dimension(days: DataFrame, column: str = "date_day") -> DataFrame:
    """36 calendar columns per day, ordered by day.

    ``days`` holds one row per day, for example a spine; its size is the number of
    days, whatever the facts weigh.
    """
    day = F.col("date_day")
    year_ago, same_weekday = F.add_months(day, -12), F.date_sub(day, 364)
    quarter, year = F.trunc(day, "quarter"), F.trunc(day, "year")
    columns = {
        "date_day": day,
        "prior_date_day": d.yesterday(day),
        "next_date_day": d.tomorrow(day),
        "prior_year_date_day": year_ago,
        "prior_year_over_year_date_day": same_weekday,
        "day_of_week": d.day_of_week(day, isoweek=False),
        "day_of_week_iso": d.day_of_week(day),
        "day_of_week_name": d.day_name(day, short=False),
        "day_of_week_name_short": d.day_name(day),
        "day_of_month": d.day_of_month(day),
        "day_of_year": d.day_of_year(day),
        "week_start_date": d.week_start(day),
        "week_end_date": d.week_end(day),
        "prior_year_week_start_date": d.week_start(same_weekday),
        "prior_year_week_end_date": d.week_end(same_weekday),
        "week_of_year": d.week_of_year(day),
        "iso_week_start_date": d.iso_week_start(day),
        "iso_week_end_date": d.iso_week_end(day),
        "prior_year_iso_week_start_date": d.iso_week_start(same_weekday),
        "prior_year_iso_week_end_date": d.iso_week_end(same_weekday),
        "iso_week_of_year": d.iso_week_of_year(day),
        "prior_year_week_of_year": d.week_of_year(same_weekday),
        "prior_year_iso_week_of_year": d.iso_week_of_year(same_weekday),
        "month_of_year": F.month(day),
        "month_name": d.month_name(day, short=False),
        "month_name_short": d.month_name(day),
        "month_start_date": F.trunc(day, "month"),
        "month_end_date": _month_end(day),
        "prior_year_month_start_date": F.trunc(year_ago, "month"),
        "prior_year_month_end_date": _month_end(year_ago),
        "quarter_of_year": F.quarter(day),
        "quarter_start_date": quarter,
        "quarter_end_date": _month_end(F.add_months(quarter, 2)),
        "year_number": F.year(day),
        "year_start_date": year,
        "year_end_date": _month_end(F.add_months(year, 11)),
    }
    table = days.select(F.to_date(column).alias("date_day"))
    return table.select(*[c.alias(n) for n, c in columns.items()]).orderBy("date_day")


def fiscal_year_ranges(
    dimension: DataFrame, year_end_month: int = 12, week_start_day: int = 1, shift_year: int = 1
) -> DataFrame:
    """First and last day per fiscal year.

    A year ends with the week end nearest to the end of its last month; it starts
    the day after the year before ends, so the first year has no range.
    """
    closing = dimension.where(F.col("month_of_year") == year_end_month).withColumn(
        "fiscal_year_number", F.col("year_number") - shift_year
    )
    ends = closing.groupBy("fiscal_year_number").agg(F.max("month_end_date").alias("month_end"))
    weeks = closing.where(F.col("day_of_week") == week_start_day).select(
        "fiscal_year_number", F.date_add("date_day", 6).alias("fiscal_year_end_date")
    )
    distance = F.abs(F.datediff("fiscal_year_end_date", "month_end"))
    nearest = Window.partitionBy("fiscal_year_number").orderBy(distance)
    # One row per year from here on.
    by_year = Window.orderBy("fiscal_year_end_date")
    return (
        weeks.join(ends, "fiscal_year_number")
        .withColumn("closest", F.rank().over(nearest))
        .where("closest = 1")
        .select(
            "fiscal_year_number",
            F.date_add(F.lag("fiscal_year_end_date").over(by_year), 1).alias(
                "fiscal_year_start_date"
            ),
            "fiscal_year_end_date",
        )
    )


def get_fiscal_year_dates(
    dimension: DataFrame, year_end_month: int = 12, week_start_day: int = 1, shift_year: int = 1
) -> DataFrame:
    """Fiscal year, week and week number of every day that lies in a whole fiscal year.

    Years and weeks are spread to days and meet the dimension by equality.
    """
    years = fiscal_year_ranges(dimension, year_end_month, week_start_day, shift_year)
    years = years.where("fiscal_year_start_date is not null").withColumn(
        "date_day",
        F.explode(F.sequence("fiscal_year_start_date", "fiscal_year_end_date")),
    )
    weeks = dimension.where(F.col("day_of_week") == week_start_day).select(
        F.col("date_day").alias("week_start_date"),
        F.date_add("date_day", 6).alias("week_end_date"),
        F.explode(F.sequence(F.col("date_day"), F.date_add("date_day", 6))).alias("date_day"),
    )
    in_year = Window.partitionBy("fiscal_year_number").orderBy("week_start_date")
    return (
        dimension.select("date_day")
        .join(years, "date_day")
        .join(weeks, "date_day")
        .select(
            "date_day",
            "fiscal_year_number",
            "fiscal_year_start_date",
            "fiscal_year_end_date",
            "week_start_date",
            "week_end_date",
            F.dense_rank().over(in_year).alias("fiscal_week_of_year"),
        )
        .orderBy("date_day")
    )


# Weeks before each period of a 13-week quarter (4-5-4).
WEEKS_BEFORE_PERIOD = (0, 4, 9)


def get_fiscal_periods(
    dimension: DataFrame, year_end_month: int, week_start_day: int, shift_year: int = 1
) -> DataFrame:
    """4-5-4 periods: quarters of 13 weeks, week 53 added to the last period."""
    days = get_fiscal_year_dates(dimension, year_end_month, week_start_day, shift_year)
    week = F.col("fiscal_week_of_year")
    quarter = F.least(F.floor((week - 1) / 13), F.lit(3)).cast("int")
    week_in_quarter = week - 1 - quarter * 13
    period = sum((week_in_quarter >= n).cast("int") for n in WEEKS_BEFORE_PERIOD)
    in_period = Window.partitionBy("fiscal_period_number").orderBy("fiscal_week_of_year")
    return (
        days.withColumn("_quarter", quarter)
        .withColumn("fiscal_period_of_quarter", period)
        .withColumn(
            "fiscal_period_number", F.col("_quarter") * 3 + F.col("fiscal_period_of_quarter")
        )
        .select(
            "date_day",
            "fiscal_year_number",
            "week_start_date",
            "week_end_date",
            "fiscal_week_of_year",
            F.dense_rank().over(in_period).alias("fiscal_week_of_period"),
            "fiscal_period_number",
            (F.col("_quarter") + 1).alias("fiscal_quarter_number"),
            "fiscal_period_of_quarter",
        )
        .orderBy("date_day")
    )
