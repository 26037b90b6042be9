"""Generic table tests: each returns the failing rows, keys or groups."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import dates, rules
from .core import Condition, aggregate, expression_is_true, failing_rows, only
from .expect_time import recency  # noqa: F401  (one of the table tests)
from .joins import compare_join, key_counts, keys_without_match, repeated_keys
from .ordered import sort_keys, with_neighbour
from .reshape import except_both_ways


def unique(df: DataFrame, column: str, wide: bool = False) -> DataFrame:
    """Present values held by more than one row."""
    return repeated_keys(df.where(F.col(column).isNotNull()), [column], wide=wide)


def not_null(df: DataFrame, column: str) -> DataFrame:
    return failing_rows(df, rules.is_missing(column))


def accepted_values(df: DataFrame, column: str, values: Sequence) -> DataFrame:
    """Present values outside the list, with their row counts."""
    return key_counts(failing_rows(df, rules.not_in_set(column, values)), [column], "n_records")


def not_accepted_values(df: DataFrame, column: str, values: Sequence) -> DataFrame:
    """Distinct values of the forbidden list that occur."""
    return failing_rows(df, rules.in_set(column, values)).select(column).distinct()


def relationships(df: DataFrame, column: str, to: DataFrame, field: str) -> DataFrame:
    """Present keys with no parent, and how many rows hold each."""
    return keys_without_match(df, column, to, field)


def relationships_where(
    df: DataFrame,
    column: str,
    to: DataFrame,
    field: str,
    from_condition: Condition | None = None,
    to_condition: Condition | None = None,
) -> DataFrame:
    return keys_without_match(only(df, from_condition), column, only(to, to_condition), field)


def accepted_range(
    df: DataFrame, column: str, min_value=None, max_value=None, inclusive: bool = True
) -> DataFrame:
    return failing_rows(df, rules.outside(column, min_value, max_value, strictly=not inclusive))


def row_expression_is_true(
    df: DataFrame, expression: str, column: str | None = None
) -> DataFrame:
    """Rows where the expression, or the column followed by it, is false."""
    text = expression if column is None else f"{column} {expression}"
    return expression_is_true(df, text)


def at_least_one(df: DataFrame, column: str, group_by: Sequence[str] = ()) -> DataFrame:
    """Groups, or the table, without any present value."""
    return aggregate(df, group_by, n_present=F.count(column)).where("n_present = 0")


def not_constant(df: DataFrame, column: str, group_by: Sequence[str] = ()) -> DataFrame:
    """Groups with exactly one distinct value; all null passes."""
    return aggregate(df, group_by, n_distinct=F.count_distinct(column)).where("n_distinct = 1")


def not_empty_string(df: DataFrame, column: str, trim_whitespace: bool = True) -> DataFrame:
    return failing_rows(df, rules.is_blank(column, trim_whitespace))


def not_null_proportion(
    df: DataFrame,
    column: str,
    at_least: float,
    at_most: float = 1.0,
    group_by: Sequence[str] = (),
) -> DataFrame:
    share = F.try_divide(F.count(column), F.count(F.lit(1)))
    shares = aggregate(df, group_by, not_null_proportion=share)
    return shares.where(rules.outside("not_null_proportion", at_least, at_most))


def unique_combination_of_columns(df: DataFrame, combination: Sequence[str]) -> DataFrame:
    """Column tuples held by more than one row; null is a value like any other."""
    return repeated_keys(df, combination)


# --- two tables --------------------------------------------------------------


def cardinality_equality(df: DataFrame, column: str, to: DataFrame, field: str) -> DataFrame:
    """Pairs of value and row count found on one side only."""
    counts = [
        t.groupBy(F.col(c).alias("value_field")).agg(F.count(F.lit(1)).alias("n_records"))
        for t, c in ((df, column), (to, field))
    ]
    return except_both_ways(*counts)


def equality(
    df: DataFrame, compare_df: DataFrame, compare_columns: Sequence[str] | None = None
) -> DataFrame:
    """Distinct rows of only one table, over the given columns."""
    columns = list(compare_columns or df.columns)
    return except_both_ways(df.select(*columns), compare_df.select(*columns))


def equality_failures(differences: DataFrame) -> DataFrame:
    """Number of differing rows plus the imbalance between the two sides."""
    a = F.count_if(F.col("which_diff") == "a_minus_b")
    b = F.count_if(F.col("which_diff") == "b_minus_a")
    return differences.agg((a + b + F.abs(a - b)).alias("failures"))


def _row_counts(df: DataFrame, compare_df: DataFrame, group_by: Sequence[str]) -> DataFrame:
    a = aggregate(df, group_by, count_a=F.count(F.lit(1)))
    b = aggregate(compare_df, group_by, count_b=F.count(F.lit(1)))
    return compare_join(a, b, group_by)


def equal_rowcount(
    df: DataFrame, compare_df: DataFrame, group_by: Sequence[str] = ()
) -> DataFrame:
    """Groups of both tables with different row counts; failures are the sum of ``diff_count``."""
    counts = _row_counts(df, compare_df, group_by)
    counts = counts.withColumn("diff_count", F.abs(F.col("count_a") - F.col("count_b")))
    return counts.where("diff_count > 0")


def fewer_rows_than(
    df: DataFrame, compare_df: DataFrame, group_by: Sequence[str] = ()
) -> DataFrame:
    """Groups with no fewer rows than the other table; equal counts fail by 1."""
    excess = F.col("count_a") - F.col("count_b")
    delta = F.when(excess > 0, excess).when(excess == 0, F.lit(1))
    counts = _row_counts(df, compare_df, group_by).withColumn("row_count_delta", delta)
    return counts.where("row_count_delta > 0")


# --- neighbours --------------------------------------------------------------


def sequential_values(
    df: DataFrame,
    column: str,
    interval: int = 1,
    datepart: str | None = None,
    group_by: Sequence[str] = (),
    ranges: int | None = None,
) -> DataFrame:
    """Values that are not the previous value plus the interval.

    Copies of a value are counted first; each copy after the first fails, since it
    follows its equal.
    """
    keys = sort_keys(group_by, [column])
    rows = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("copies"))
    near = with_neighbour(rows, column, [column], group_by, ranges=ranges)

    def follows(previous):
        if datepart:
            value = F.col(column).cast("timestamp")
            return value == dates.add_parts(previous, datepart, interval)
        return F.col(column) == previous + interval

    failing = rules.violates(follows(F.col("previous"))).cast("bigint") + F.when(
        rules.violates(follows(F.col(column))), F.col("copies") - 1
    ).otherwise(0)
    return near.withColumn("failing_rows", failing).where("failing_rows > 0").select(
        *keys, "previous", "failing_rows"
    )


# How an upper bound relates to the next lower bound.
GAPS = {
    "allowed": lambda upper, lower: upper <= lower,
    "not_allowed": lambda upper, lower: upper == lower,
    "required": lambda upper, lower: upper < lower,
}


def mutually_exclusive_ranges(
    df: DataFrame,
    lower_bound_column: str,
    upper_bound_column: str,
    partition_by: str | None = None,
    gaps: str = "allowed",
    zero_length_range_allowed: bool = False,
    ranges: int | None = None,
) -> DataFrame:
    """Ranges that are empty, have a null bound or collide with the next one.

    Equal ranges are counted first: every copy but the last is followed by its equal.
    """
    if gaps not in GAPS:
        raise ValueError(f"gaps must be one of {', '.join(GAPS)}")
    group = [partition_by] if partition_by else []
    order = [lower_bound_column, upper_bound_column]
    keys = sort_keys(group, order)
    rows = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("copies"))
    near = with_neighbour(
        rows, lower_bound_column, order, group, "next_lower_bound",
        ahead=True, ranges=ranges,
    )
    lower, upper = F.col(lower_bound_column), F.col(upper_bound_column)
    fits = GAPS[gaps]
    proper = rules.holds(lower <= upper if zero_length_range_allowed else lower < upper)
    clear = F.coalesce(fits(upper, F.col("next_lower_bound")), ~F.col("next_lower_bound_exists"))
    clear_of_equal = rules.holds(fits(upper, lower))
    failing = F.when(proper & clear, 0).otherwise(1) + F.when(
        proper & clear_of_equal, 0
    ).otherwise(F.col("copies") - 1)
    return near.withColumn("failing_rows", failing.cast("bigint")).where(
        "failing_rows > 0"
    ).select(*keys, "next_lower_bound", "failing_rows")
