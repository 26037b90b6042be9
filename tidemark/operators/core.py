"""Core of the expectations: failing rows, failing groups, compared aggregates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.rules import bounds, truth, violates
from .joins import compare_join

Condition = Column | str


def only(df: DataFrame, row_condition: Condition | None) -> DataFrame:
    """Rows to be tested."""
    return df if row_condition is None else df.where(truth(row_condition))


def failing_rows(
    df: DataFrame, rule: Column, row_condition: Condition | None = None
) -> DataFrame:
    """Rows a rule marks as violating."""
    return only(df, row_condition).where(rule)


def aggregate(
    df: DataFrame,
    group_by: Sequence[str] = (),
    row_condition: Condition | None = None,
    **metrics: Column,
) -> DataFrame:
    """Named metrics per group, or one row without groups."""
    data = only(df, row_condition)
    named = [c.alias(n) for n, c in metrics.items()]
    return data.groupBy(*group_by).agg(*named) if group_by else data.agg(*named)


def expression_is_true(
    df: DataFrame,
    expression: Condition,
    group_by: Sequence[str] = (),
    row_condition: Condition | None = None,
    aggregated: bool = False,
) -> DataFrame:
    """Rows, or groups of an aggregate expression, where the expression is false."""
    if not (group_by or aggregated):
        return failing_rows(df, violates(expression), row_condition)
    result = aggregate(df, group_by, row_condition, expression=truth(expression))
    return result.where(violates("expression"))


def expression_between(
    df: DataFrame,
    expression: Column,
    min_value=None,
    max_value=None,
    group_by: Sequence[str] = (),
    row_condition: Condition | None = None,
    strictly: bool = False,
) -> DataFrame:
    """Groups whose aggregate lies outside the bounds, with the aggregate's value."""
    inside = bounds(F.col("value"), min_value, max_value, strictly)
    return aggregate(df, group_by, row_condition, value=expression).where(violates(inside))


def get_select(
    df: DataFrame,
    expression: Column,
    group_by: Sequence[str] = (),
    row_condition: Condition | None = None,
    into: str = "expression",
) -> DataFrame:
    """One side of a comparison, its group columns named by position."""
    side = aggregate(df, group_by, row_condition, **{into: expression})
    return side.select(
        *[F.col(c).alias(f"col_{i}") for i, c in enumerate(group_by, start=1)], into
    )


def equal_expression(
    df: DataFrame,
    expression: Column,
    compare_df: DataFrame | None = None,
    compare_expression: Column | None = None,
    group_by: Sequence[str] = (),
    compare_group_by: Sequence[str] | None = None,
    row_condition: Condition | None = None,
    compare_row_condition: Condition | None = None,
    tolerance: float = 0.0,
    tolerance_percent: float | None = None,
) -> DataFrame:
    """Groups whose aggregates differ by more than the tolerance.

    A group of one side only still appears, its missing value counting as 0. A
    relative tolerance has nothing to compare with where the first value is 0 or
    missing: those groups pass.
    """
    other = df if compare_df is None else compare_df
    a = get_select(df, expression, group_by, row_condition)
    b = get_select(
        other,
        expression if compare_expression is None else compare_expression,
        group_by if compare_group_by is None else compare_group_by,
        row_condition if compare_row_condition is None else compare_row_condition,
        into="compare_expression",
    )
    keys = [f"col_{i}" for i in range(1, len(group_by) + 1)]
    first, second = (F.coalesce(c, F.lit(0)) for c in ("expression", "compare_expression"))
    difference = F.abs(first - second)
    compared = compare_join(a, b, keys).select(
        *keys,
        "expression",
        "compare_expression",
        difference.alias("expression_difference"),
        F.try_divide(difference, F.col("expression")).alias("expression_difference_percent"),
    )
    if tolerance_percent:
        return compared.where(F.col("expression_difference_percent") > tolerance_percent)
    return compared.where(F.col("expression_difference") > tolerance)
