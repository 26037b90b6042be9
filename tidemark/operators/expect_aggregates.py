"""Expectations on a column's aggregates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.rules import bounds, violates
from .core import Condition, aggregate, equal_expression, expression_between, only
from .ordered import exact_quantile


def _between(metric):
    def expectation(
        df: DataFrame,
        column: str,
        min_value=None,
        max_value=None,
        group_by: Sequence[str] = (),
        row_condition: Condition | None = None,
        strictly: bool = False,
    ) -> DataFrame:
        return expression_between(
            df, metric(column), min_value, max_value, group_by, row_condition, strictly
        )

    return expectation


def unique_proportion(column: str) -> Column:
    """Distinct values per present value; nulls count on neither side."""
    return F.try_divide(F.count_distinct(column), F.count(column))


expect_column_max_to_be_between = _between(F.max)
expect_column_min_to_be_between = _between(F.min)
expect_column_mean_to_be_between = _between(F.avg)
expect_column_sum_to_be_between = _between(F.sum)
expect_column_stdev_to_be_between = _between(F.stddev_samp)
expect_column_unique_value_count_to_be_between = _between(F.count_distinct)
expect_column_proportion_of_unique_values_to_be_between = _between(unique_proportion)


def expect_column_quantile_values_to_be_between(
    df: DataFrame,
    column: str,
    quantile: float,
    min_value=None,
    max_value=None,
    group_by: Sequence[str] = (),
    row_condition: Condition | None = None,
    strictly: bool = False,
) -> DataFrame:
    """Groups whose exact interpolated quantile lies outside the bounds."""
    inside = bounds(F.col("value"), min_value, max_value, strictly)
    quantiles = exact_quantile(only(df, row_condition), column, quantile, group_by, into="value")
    return quantiles.where(violates(inside))


def expect_column_median_to_be_between(
    df: DataFrame,
    column: str,
    min_value=None,
    max_value=None,
    group_by: Sequence[str] = (),
    row_condition: Condition | None = None,
    strictly: bool = False,
) -> DataFrame:
    return expect_column_quantile_values_to_be_between(
        df, column, 0.5, min_value, max_value, group_by, row_condition, strictly
    )


def _distinct_count(compare):
    def expectation(
        df: DataFrame,
        column: str,
        value: int,
        group_by: Sequence[str] = (),
        row_condition: Condition | None = None,
    ) -> DataFrame:
        counts = aggregate(df, group_by, row_condition, value=F.count_distinct(column))
        return counts.where(violates(compare(F.col("value"), value)))

    return expectation


expect_column_distinct_count_to_equal = _distinct_count(lambda a, b: a == b)
expect_column_distinct_count_to_be_greater_than = _distinct_count(lambda a, b: a > b)
expect_column_distinct_count_to_be_less_than = _distinct_count(lambda a, b: a < b)


def expect_column_distinct_count_to_equal_other_table(
    df: DataFrame,
    column: str,
    compare_df: DataFrame | None = None,
    compare_column: str | None = None,
    row_condition: Condition | None = None,
    compare_row_condition: Condition | None = None,
) -> DataFrame:
    return equal_expression(
        df,
        F.count_distinct(column),
        compare_df,
        F.count_distinct(compare_column or column),
        row_condition=row_condition,
        compare_row_condition=compare_row_condition,
    )


def _value_set(df: DataFrame, column: str, values: Sequence) -> DataFrame:
    """The literal set as a table in the column's type."""
    dtype = df.schema[column].dataType
    items = F.array(*[F.lit(v).cast(dtype) for v in values])
    spark = df.sparkSession
    return spark.range(1).select(F.explode(items).alias("value_field")).distinct()


def _distinct_values(df: DataFrame, column: str, row_condition) -> DataFrame:
    return only(df, row_condition).select(F.col(column).alias("value_field")).distinct()


def expect_column_distinct_values_to_be_in_set(
    df: DataFrame, column: str, values: Sequence, row_condition: Condition | None = None
) -> DataFrame:
    """Distinct values outside the set; null fails."""
    found = _distinct_values(df, column, row_condition)
    return found.where(F.coalesce(~F.col("value_field").isin(list(values)), F.lit(True)))


def expect_column_distinct_values_to_contain_set(
    df: DataFrame, column: str, values: Sequence, row_condition: Condition | None = None
) -> DataFrame:
    """Set values the column lacks."""
    wanted = _value_set(df, column, values)
    rows = only(df, row_condition).where(F.col(column).isin(list(values)))
    return wanted.join(_distinct_values(rows, column, None), "value_field", "left_anti")


def expect_column_distinct_values_to_equal_set(
    df: DataFrame, column: str, values: Sequence, row_condition: Condition | None = None
) -> DataFrame:
    """Values of only one side, column or set; null fails."""
    found = _distinct_values(df, column, row_condition).withColumn("in_column", F.lit(True))
    wanted = _value_set(df, column, values).withColumn("in_set", F.lit(True))
    both = found.join(wanted, "value_field", "full")
    return both.where("in_column is null or in_set is null").select(
        "value_field",
        F.coalesce("in_column", F.lit(False)).alias("in_column"),
        F.coalesce("in_set", F.lit(False)).alias("in_set"),
    )


def nth_most_common(
    df: DataFrame, column: str, n: int, row_condition: Condition | None = None
) -> DataFrame:
    """The n-th most common value, equal counts ordered by value."""
    counts = only(df, row_condition).groupBy(F.col(column).alias("value_field")).count()
    top = counts.orderBy(F.desc("count"), F.asc("value_field")).limit(n)
    # n rows at most: the last of the first n is the n-th, if there are n.
    last = top.agg(
        F.count(F.lit(1)).alias("_found"),
        F.max_by("value_field", F.struct(-F.col("count"), "value_field")).alias("value_field"),
        F.min("count").alias("n_rows"),
    )
    return last.where(F.col("_found") == n).select("value_field", "n_rows")


def expect_column_most_common_value_to_be_in_set(
    df: DataFrame,
    column: str,
    values: Sequence,
    top_n: int = 1,
    row_condition: Condition | None = None,
) -> DataFrame:
    """The n-th most common value, if it is not in the set."""
    return nth_most_common(df, column, top_n, row_condition).where(
        ~F.col("value_field").isin(list(values))
    )
