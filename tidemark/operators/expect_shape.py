"""Expectations on a table's columns, types and row counts.

Column checks read the schema only and return their findings as a list; row counts
are DataFrames.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.rules import violates
from .core import Condition, aggregate, equal_expression, expression_between

Transform = Callable[[str], str]


def _names(df: DataFrame, transform: Transform) -> list[str]:
    return [transform(c) for c in df.columns]


def expect_column_to_exist(
    df: DataFrame, column: str, column_index: int | None = None, transform: Transform = str.upper
) -> list[str]:
    """The column, if it is absent or not at its 1-based position."""
    names, wanted = _names(df, transform), transform(column)
    if wanted not in names or (column_index and names.index(wanted) + 1 != column_index):
        return [column]
    return []


def expect_table_column_count_to_be_between(
    df: DataFrame, min_value: int | None = None, max_value: int | None = None
) -> list[int]:
    """The column count, if outside the bounds; a bound of 0 reads as not given."""
    n = len(df.columns)
    bad = (min_value and n < min_value) or (max_value and n > max_value)
    return [n] if bad else []


def expect_table_column_count_to_equal(df: DataFrame, value: int) -> list[int]:
    return [] if len(df.columns) == value else [len(df.columns)]


def expect_table_column_count_to_equal_other_table(df: DataFrame, compare_df: DataFrame) -> list[int]:
    return expect_table_column_count_to_equal(df, len(compare_df.columns))


def expect_table_columns_to_contain_set(
    df: DataFrame, column_list: Sequence[str], transform: Transform = str.upper
) -> list[str]:
    """Listed columns the table lacks."""
    names = set(_names(df, transform))
    return [c for c in column_list if transform(c) not in names]


def expect_table_columns_to_not_contain_set(
    df: DataFrame, column_list: Sequence[str], transform: Transform = str.upper
) -> list[str]:
    """Listed columns the table has."""
    names = set(_names(df, transform))
    return [c for c in column_list if transform(c) in names]


def expect_table_columns_to_match_set(
    df: DataFrame, column_list: Sequence[str], transform: Transform = str.upper
) -> list[str]:
    """Columns of only one side, table or list."""
    return sorted(set(_names(df, transform)) ^ {transform(c) for c in column_list})


def expect_table_columns_to_match_ordered_list(
    df: DataFrame, column_list: Sequence[str], transform: Transform = str.upper
) -> list[str]:
    """Columns whose name and position do not both agree."""
    have = set(enumerate(_names(df, transform), start=1))
    want = {(i, transform(c)) for i, c in enumerate(column_list, start=1)}
    return [f"{i}:{name}" for i, name in sorted(have ^ want)]


def expect_column_values_to_be_in_type_list(
    df: DataFrame, column: str, column_type_list: Sequence[str]
) -> list[str]:
    """The column's type, if it is not in the list."""
    found = df.schema[column].dataType.simpleString().upper()
    return [] if found in {t.upper() for t in column_type_list} else [found]


def expect_column_values_to_be_of_type(df: DataFrame, column: str, column_type: str) -> list[str]:
    return expect_column_values_to_be_in_type_list(df, column, [column_type])


# --- row counts --------------------------------------------------------------


def expect_table_row_count_to_be_between(
    df: DataFrame,
    min_value: int | None = None,
    max_value: int | None = None,
    group_by: Sequence[str] = (),
    row_condition: Condition | None = None,
    strictly: bool = False,
) -> DataFrame:
    return expression_between(
        df, F.count(F.lit(1)), min_value, max_value, group_by, row_condition, strictly
    )


def expect_table_row_count_to_equal(
    df: DataFrame,
    value: int,
    group_by: Sequence[str] = (),
    row_condition: Condition | None = None,
) -> DataFrame:
    counts = aggregate(df, group_by, row_condition, value=F.count(F.lit(1)))
    return counts.where(violates(F.col("value") == value))


def expect_table_aggregation_to_equal_other_table(
    df: DataFrame, expression: Column, compare_df: DataFrame, **kw
) -> DataFrame:
    return equal_expression(df, expression, compare_df, **kw)


def expect_table_row_count_to_equal_other_table(
    df: DataFrame, compare_df: DataFrame, factor: float = 1, **kw
) -> DataFrame:
    """Groups whose row count is not the other table's times the factor."""
    rows = F.count(F.lit(1))
    return equal_expression(df, rows, compare_df, rows * F.lit(factor), **kw)


def expect_table_row_count_to_equal_other_table_times_factor(
    df: DataFrame, compare_df: DataFrame, factor: float, **kw
) -> DataFrame:
    return expect_table_row_count_to_equal_other_table(df, compare_df, factor, **kw)
