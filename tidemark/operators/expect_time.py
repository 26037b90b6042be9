"""Expectations on distribution over time, gaps and recency.

Facts are aggregated to periods or groups first; the windows run on those.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import dates
from ..functions.rules import violates
from ..functions.scalars import metric_expression
from .core import Condition, aggregate, only
from .joins import compare_join
from .reshape import date_spine_of, spine_between


def _at(as_of) -> Column:
    return (as_of if isinstance(as_of, Column) else F.lit(as_of)).cast("timestamp")


def moving_sigma(
    df: DataFrame,
    column: str,
    date_column: str,
    group_by: Sequence[str] = (),
    period: str = "day",
    lookback_periods: int = 1,
    trend_periods: int = 7,
    take_diffs: bool = True,
    take_logs: bool = True,
) -> DataFrame:
    """Sum per period and its z-score against the periods just before it."""
    group = list(group_by)
    sums = df.groupBy(dates.truncate(period, date_column).alias("metric_period"), *group).agg(
        F.sum(column).alias("agg_metric_value")
    )
    in_time = Window.partitionBy(*group).orderBy("metric_period")
    trend = in_time.rowsBetween(-trend_periods, -1)
    tested = metric_expression("agg_metric_value", take_logs)
    if take_diffs:
        prior = F.lag("agg_metric_value", lookback_periods).over(in_time)
        sums = sums.withColumn("prior_agg_metric_value", prior)
        tested = tested - metric_expression("prior_agg_metric_value", take_logs)
    sums = sums.withColumn("metric_test_value", tested)
    sums = sums.withColumns(
        {
            "metric_test_rolling_average": F.avg("metric_test_value").over(trend),
            "metric_test_rolling_stddev": F.stddev_samp("metric_test_value").over(trend),
        }
    )
    delta = F.col("metric_test_value") - F.col("metric_test_rolling_average")
    return sums.withColumns(
        {
            "metric_test_delta": delta,
            "metric_test_sigma": F.try_divide(delta, F.col("metric_test_rolling_stddev")),
        }
    )


def expect_column_values_to_be_within_n_moving_stdevs(
    df: DataFrame,
    column: str,
    date_column: str,
    as_of,
    group_by: Sequence[str] = (),
    period: str = "day",
    lookback_periods: int = 1,
    trend_periods: int = 7,
    test_periods: int = 14,
    sigma_threshold: float = 3,
    sigma_threshold_upper: float | None = None,
    sigma_threshold_lower: float | None = None,
    take_diffs: bool = True,
    take_logs: bool = True,
) -> DataFrame:
    """Periods of the last ``test_periods`` whose z-score leaves the band."""
    upper = sigma_threshold_upper or sigma_threshold
    lower = sigma_threshold_lower or -sigma_threshold
    scores = moving_sigma(
        df, column, date_column, group_by, period,
        lookback_periods, trend_periods, take_diffs, take_logs,
    )
    end = dates.truncate(period, _at(as_of))
    sigma = F.col("metric_test_sigma")
    return scores.where(
        (F.col("metric_period") >= dates.add_parts(end, period, -test_periods))
        & (F.col("metric_period") < end)
        & violates((sigma >= lower) & (sigma <= upper))
    )


def expect_column_values_to_be_within_n_stdevs(
    df: DataFrame, column: str, group_by: Sequence[str] = (), sigma_threshold: float = 3
) -> DataFrame:
    """Groups whose sum is far from the mean of all groups' sums."""
    sums = aggregate(df, group_by, metric=F.sum(column))
    moments = sums.agg(
        F.avg("metric").alias("metric_average"), F.stddev_samp("metric").alias("metric_stddev")
    )
    scored = compare_join(sums, F.broadcast(moments), ()).withColumn(
        "metric_sigma",
        F.try_divide(F.col("metric") - F.col("metric_average"), F.col("metric_stddev")),
    )
    return scored.where(F.abs("metric_sigma") > sigma_threshold)


def expect_row_values_to_have_data_for_every_n_datepart(
    df: DataFrame,
    date_column: str,
    date_part: str = "day",
    interval: int | None = None,
    row_condition: Condition | None = None,
    exclusion_condition: Condition | None = None,
    test_start_date=None,
    test_end_date=None,
) -> DataFrame:
    """Periods of the spine that hold no row; the last period is not tested.

    The spine starts with the period of the first row, or of the start given, and periods
    of an interval are counted from there.
    """
    rows = only(df, row_condition)
    part = dates.check_part(date_part)
    day = F.to_date(date_column)
    if test_start_date is not None and test_end_date is not None:
        first = (test_start_date, test_end_date)
    else:
        # One row: the extremes of the column, or the given date.
        ends = rows.agg(
            F.coalesce(F.lit(test_start_date).cast("timestamp"), F.min(day).cast("timestamp")).alias("_start"),
            F.coalesce(F.lit(test_end_date).cast("timestamp"), F.max(day).cast("timestamp")).alias("_end"),
        )
        first = ends.first()
    start = dates.truncate(part, F.lit(first[0]).cast("timestamp"))
    bounds = df.sparkSession.range(1).select(start.alias("_start"), F.lit(first[1]).cast("timestamp").alias("_end"))
    spine = spine_between(bounds, part).withColumn("_start", start)

    name = f"date_{part}"
    period = dates.truncate(part, date_column)
    if interval:
        offset = dates.get_intervals_between("_start", name, part)
        spine = spine.where(offset % interval == 0)
        past = dates.get_intervals_between(start, period, part) % interval
        period = dates.add_parts(period, part, -past)
    counts = rows.groupBy(period.alias(name)).agg(F.count(F.lit(1)).alias("row_cnt"))
    missing = spine.drop("_start").join(counts, name, "left_anti")
    if exclusion_condition is not None:
        missing = only(missing, exclusion_condition)
    return missing.select(name, F.lit(True).alias("is_missing"), F.lit(0).alias("row_cnt"))


def _latest(df, timestamp_column, as_of, group_by, row_condition) -> DataFrame:
    """Latest time per group, times after ``as_of`` left out as erroneous."""
    moment = F.col(timestamp_column).cast("timestamp")
    rows = only(df, row_condition).where(moment <= _at(as_of))
    return aggregate(rows, group_by, latest=F.max(moment))


def expect_grouped_row_values_to_have_recent_data(
    df: DataFrame,
    group_by: Sequence[str],
    timestamp_column: str,
    datepart: str,
    interval: int,
    as_of,
    row_condition: Condition | None = None,
) -> DataFrame:
    """Groups whose latest row is older than the cutoff."""
    cutoff = dates.add_parts(_at(as_of), datepart, -interval)
    latest = _latest(df, timestamp_column, as_of, group_by, row_condition)
    return latest.where(F.col("latest") < cutoff)


def expect_row_values_to_have_recent_data(
    df: DataFrame,
    timestamp_column: str,
    datepart: str,
    interval: int,
    as_of,
    row_condition: Condition | None = None,
) -> DataFrame:
    """The table's latest time, if it is too old; no rows at all count as too old."""
    cutoff = dates.add_parts(_at(as_of), datepart, -interval)
    latest = _latest(df, timestamp_column, as_of, (), row_condition)
    epoch = F.lit("1970-01-01").cast("timestamp")
    return latest.where(F.coalesce("latest", epoch) < cutoff)


def recency(
    df: DataFrame,
    field: str,
    datepart: str,
    interval: int,
    as_of,
    ignore_time_component: bool = False,
    group_by: Sequence[str] = (),
) -> DataFrame:
    """Groups whose greatest value lies before the threshold; an empty table passes."""
    target = "date" if ignore_time_component else "timestamp"
    threshold = dates.add_parts(_at(as_of), datepart, -interval).cast(target)
    latest = aggregate(df, group_by, most_recent=F.max(field).cast(target))
    return latest.withColumn("threshold", threshold).where("most_recent < threshold")


def source_freshness(
    df: DataFrame, loaded_at_field: str, as_of, warn_after_hours: int = 12, error_after_hours: int = 24
) -> DataFrame:
    """Age of the latest load, graded pass, warn or error."""
    latest = df.agg(F.max(F.col(loaded_at_field).cast("timestamp")).alias("max_loaded_at"))
    age = (F.unix_timestamp(_at(as_of)) - F.unix_timestamp("max_loaded_at")).alias("age_seconds")
    aged = latest.select("max_loaded_at", age)
    status = (
        F.when(F.col("age_seconds").isNull() | (F.col("age_seconds") > error_after_hours * 3600), "error")
        .when(F.col("age_seconds") > warn_after_hours * 3600, "warn")
        .otherwise("pass")
    )
    return aged.withColumn("status", status)
