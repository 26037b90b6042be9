"""Expectations on single columns, column tuples and strings."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import rules
from ..functions.scalars import as_column
from .core import Condition, aggregate, failing_rows, only
from .joins import repeated_keys
from .ordered import sort_keys, with_neighbour

# --- values ------------------------------------------------------------------


def expect_column_values_to_be_between(
    df, column, min_value=None, max_value=None, row_condition=None, strictly=False
) -> DataFrame:
    return failing_rows(df, rules.outside(column, min_value, max_value, strictly), row_condition)


def expect_column_values_to_be_in_set(
    df: DataFrame, column: str, values: Sequence, row_condition: Condition | None = None
) -> DataFrame:
    """Rows outside the set; null fails."""
    return failing_rows(df, rules.not_in_set(column, values, null_fails=True), row_condition)


def expect_column_values_to_not_be_in_set(
    df: DataFrame, column: str, values: Sequence, row_condition: Condition | None = None
) -> DataFrame:
    return failing_rows(df, rules.in_set(column, values), row_condition)


def expect_column_values_to_be_null(df, column, row_condition=None) -> DataFrame:
    return failing_rows(df, rules.is_present(column), row_condition)


def expect_column_values_to_not_be_null(df, column, row_condition=None) -> DataFrame:
    return failing_rows(df, rules.is_missing(column), row_condition)


def expect_column_values_to_be_unique(
    df: DataFrame, column: str, row_condition: Condition | None = None, wide: bool = False
) -> DataFrame:
    return expect_compound_columns_to_be_unique(df, [column], "all_values_are_missing", row_condition, wide)


def expect_column_values_to_have_consistent_casing(
    df: DataFrame, column: str, display_inconsistent_columns: bool = False
) -> DataFrame:
    """Values that differ in case only: their count, or a list of them.

    A null value counts on one side only, so the count form fails on it.
    """
    values = df.select(F.col(column).alias("value")).distinct()
    if display_inconsistent_columns:
        spellings = values.where("value is not null").groupBy(
            F.lower("value").alias("inconsistent_columns")
        )
        return spellings.agg(F.count("value").alias("set_count_case_insensitive")).where(
            "set_count_case_insensitive > 1"
        )
    counts = values.agg(
        F.count(F.lit(1)).alias("set_count"),
        F.count_distinct(F.lower("value")).alias("set_count_case_insensitive"),
    )
    return counts.where("set_count <> set_count_case_insensitive")


def _monotone(df, column, sort_column, strictly, row_condition, group_by, ordered, ranges):
    group, order = list(group_by), sort_keys([sort_column], [column])
    keys = sort_keys(group, order)
    tested = only(df, row_condition)
    rows = tested.groupBy(*keys).agg(F.count(F.lit(1)).alias("copies"))
    near = with_neighbour(rows, column, order, group, ranges=ranges)
    value, previous = F.col(column), F.col("previous")
    step = rules.violates(ordered(value, previous))
    if strictly:
        # A copy follows its equal, so every copy after the first fails too.
        repeats = F.when(value.isNotNull(), F.col("copies") - 1).otherwise(0)
    else:
        repeats = F.lit(0).cast("bigint")
    failing = step.cast("bigint") + repeats
    return near.withColumn("failing_rows", failing).where("failing_rows > 0").select(
        *keys, "previous", "failing_rows"
    )


def expect_column_values_to_be_increasing(
    df: DataFrame,
    column: str,
    sort_column: str | None = None,
    strictly: bool = True,
    row_condition: Condition | None = None,
    group_by: Sequence[str] = (),
    ranges: int | None = None,
) -> DataFrame:
    """Sorted rows whose value is not above (or at) the previous one.

    Rows are ordered by the sort column, then by the value, and equal rows are
    counted before the comparison: ``failing_rows`` tells how many a row stands for.
    """
    up = (lambda a, b: a > b) if strictly else (lambda a, b: a >= b)
    sort_column = sort_column or column
    return _monotone(df, column, sort_column, strictly, row_condition, group_by, up, ranges)


def expect_column_values_to_be_decreasing(
    df: DataFrame,
    column: str,
    sort_column: str | None = None,
    strictly: bool = True,
    row_condition: Condition | None = None,
    group_by: Sequence[str] = (),
    ranges: int | None = None,
) -> DataFrame:
    """As increasing, the other way round; the group columns are kept here too."""
    down = (lambda a, b: a < b) if strictly else (lambda a, b: a <= b)
    sort_column = sort_column or column
    return _monotone(df, column, sort_column, strictly, row_condition, group_by, down, ranges)


# --- several columns ---------------------------------------------------------


def expect_column_pair_values_A_to_be_greater_than_B(
    df, column_A, column_B, or_equal=False, row_condition=None
) -> DataFrame:
    a, b = as_column(column_A), as_column(column_B)
    return failing_rows(df, rules.violates(a >= b if or_equal else a > b), row_condition)


def expect_column_pair_values_to_be_equal(df, column_A, column_B, row_condition=None) -> DataFrame:
    return failing_rows(df, rules.violates(as_column(column_A) == as_column(column_B)), row_condition)


def pair_in_set(column_A: str, column_B: str, pairs: Sequence[Sequence]) -> Column:
    for pair in pairs:
        if len(pair) != 2:
            raise ValueError(f"not a pair: {pair!r}")
    a, b = as_column(column_A), as_column(column_B)
    return rules.any_of((a == x) & (b == y) for x, y in pairs)


def expect_column_pair_values_to_be_in_set(
    df, column_A, column_B, value_pairs_set, row_condition=None
) -> DataFrame:
    condition = pair_in_set(column_A, column_B, value_pairs_set)
    return failing_rows(df, rules.violates(condition), row_condition)


def expect_compound_columns_to_be_unique(
    df: DataFrame,
    column_list: Sequence[str],
    ignore_row_if: str = "all_values_are_missing",
    row_condition: Condition | None = None,
    wide: bool = False,
) -> DataFrame:
    """Column tuples held by more than one row."""
    rows = only(df, row_condition).where(rules.row_is_counted(column_list, ignore_row_if))
    return repeated_keys(rows, column_list, wide=wide)


def expect_multicolumn_sum_to_equal(
    df: DataFrame,
    column_list: Sequence[str],
    sum_total: float | str,
    group_by: Sequence[str] = (),
    row_condition: Condition | None = None,
    tolerance: float = 0.0,
) -> DataFrame:
    """Groups where the columns' sums do not add up to a number or a column's sum.

    A tolerance of 0 compares exactly; sums of doubles depend on their order.
    """
    total = F.sum(sum_total) if isinstance(sum_total, str) else F.lit(sum_total)
    found = sum((F.sum(c) for c in column_list[1:]), F.sum(column_list[0]))
    sums = aggregate(df, group_by, row_condition, expected=total, found=found)
    return sums.where(rules.violates(F.abs(F.col("found") - F.col("expected")) <= tolerance))


def expect_select_column_values_to_be_unique_within_record(
    df: DataFrame,
    column_list: Sequence[str],
    ignore_row_if: str = "all_values_are_missing",
    row_condition: Condition | None = None,
) -> DataFrame:
    rows = only(df, row_condition).where(rules.row_is_counted(column_list, ignore_row_if))
    return rows.where(rules.repeated_within_record(column_list))


# --- strings -----------------------------------------------------------------


def expect_column_value_lengths_to_be_between(
    df, column, min_value=None, max_value=None, row_condition=None, strictly=False
) -> DataFrame:
    length = F.length(as_column(column))
    return failing_rows(df, rules.outside(length, min_value, max_value, strictly), row_condition)


def expect_column_value_lengths_to_equal(df, column, value, row_condition=None) -> DataFrame:
    return failing_rows(df, rules.violates(F.length(as_column(column)) == value), row_condition)


def _pattern_lists(condition, positive: bool):
    def expectation(df, column, patterns, match_on="any", row_condition=None, **kw) -> DataFrame:
        test = condition(column, patterns, match_on, positive=positive, **kw)
        return failing_rows(df, rules.violates(test), row_condition)

    return expectation


def _single(expectation):
    def one(df, column, pattern, row_condition=None, **kw) -> DataFrame:
        return expectation(df, column, [pattern], "any", row_condition, **kw)

    return one


expect_column_values_to_match_like_pattern_list = _pattern_lists(rules.like_condition, True)
expect_column_values_to_not_match_like_pattern_list = _pattern_lists(rules.like_condition, False)
expect_column_values_to_match_regex_list = _pattern_lists(rules.regex_condition, True)
expect_column_values_to_not_match_regex_list = _pattern_lists(rules.regex_condition, False)
expect_column_values_to_match_like_pattern = _single(expect_column_values_to_match_like_pattern_list)
expect_column_values_to_not_match_like_pattern = _single(
    expect_column_values_to_not_match_like_pattern_list
)
expect_column_values_to_match_regex = _single(expect_column_values_to_match_regex_list)
expect_column_values_to_not_match_regex = _single(expect_column_values_to_not_match_regex_list)
