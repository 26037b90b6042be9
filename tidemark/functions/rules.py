"""Row rules: each returns a Column that is true for a violating row.

A rule never returns null, so rules can be combined, counted and negated freely.
Whether a null value violates a rule is stated per rule.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from .scalars import ColumnLike, as_column, with_flags


def truth(condition: ColumnLike) -> Column:
    """Condition as a Column: SQL text is parsed, a Column is taken as it is."""
    return F.expr(condition) if isinstance(condition, str) else condition


def holds(condition: ColumnLike) -> Column:
    """True only where the condition is true; null counts as false."""
    return F.coalesce(truth(condition), F.lit(False))


def violates(condition: ColumnLike) -> Column:
    """True only where the condition is false; null passes."""
    return F.coalesce(~truth(condition), F.lit(False))


def any_of(conditions: Iterable[Column]) -> Column:
    return reduce(lambda a, b: a | b, conditions, F.lit(False))


def all_of(conditions: Iterable[Column]) -> Column:
    return reduce(lambda a, b: a & b, conditions, F.lit(True))


def is_missing(value: ColumnLike) -> Column:
    return as_column(value).isNull()


def is_present(value: ColumnLike) -> Column:
    return as_column(value).isNotNull()


def bounds(value: ColumnLike, low=None, high=None, strictly: bool = False) -> Column:
    """Condition that the value lies between the given bounds; at least one is needed."""
    if low is None and high is None:
        raise ValueError("give a lower bound, an upper bound or both")
    value = as_column(value)
    parts = []
    if low is not None:
        parts.append(value > low if strictly else value >= low)
    if high is not None:
        parts.append(value < high if strictly else value <= high)
    return all_of(parts)


def outside(value: ColumnLike, low=None, high=None, strictly: bool = False) -> Column:
    """Outside the bounds; null passes."""
    return violates(bounds(value, low, high, strictly))


def not_in_set(value: ColumnLike, values: Sequence, null_fails: bool = False) -> Column:
    value = as_column(value)
    return F.coalesce(~value.isin(list(values)), F.lit(null_fails))


def in_set(value: ColumnLike, values: Sequence) -> Column:
    return holds(as_column(value).isin(list(values)))


def is_blank(value: ColumnLike, trim_whitespace: bool = True) -> Column:
    value = as_column(value)
    return holds((F.trim(value) if trim_whitespace else value) == "")


def bad_type(value: ColumnLike, spark_type: str) -> Column:
    """Present text that does not cast; null passes."""
    value = as_column(value)
    return value.isNotNull() & value.try_cast(spark_type).isNull()


def _quantified(tests: list[Column], match_on: str) -> Column:
    if match_on not in ("any", "all"):
        raise ValueError("match_on must be 'any' or 'all'")
    if not tests:
        raise ValueError("give at least one pattern")
    return reduce((lambda a, b: a | b) if match_on == "any" else (lambda a, b: a & b), tests)


def regex_condition(
    value: ColumnLike,
    patterns: Sequence[str],
    match_on: str = "any",
    flags: str = "",
    positive: bool = True,
) -> Column:
    """Partial regex match on any or all patterns, or the absence of a match."""
    tests = [as_column(value).rlike(with_flags(p, flags)) for p in patterns]
    return _quantified(tests if positive else [~t for t in tests], match_on)


def like_condition(
    value: ColumnLike, patterns: Sequence[str], match_on: str = "any", positive: bool = True
) -> Column:
    """LIKE on any or all patterns, or NOT LIKE."""
    tests = [as_column(value).like(p) for p in patterns]
    return _quantified(tests if positive else [~t for t in tests], match_on)


def row_is_counted(columns: Sequence[ColumnLike], ignore_row_if: str) -> Column:
    """Condition for rows to keep: not all, or not any, of the columns missing."""
    missing = [is_missing(c) for c in columns]
    if ignore_row_if == "all_values_are_missing":
        return ~all_of(missing)
    if ignore_row_if == "any_value_is_missing":
        return ~any_of(missing)
    raise ValueError(f"unknown ignore_row_if: {ignore_row_if!r}")


def repeated_within_record(columns: Sequence[ColumnLike]) -> Column:
    """Fewer distinct present values than columns: row-local, no shuffle."""
    values = F.array(*[as_column(c).cast("string") for c in columns])
    return F.size(F.array_distinct(F.array_compact(values))) < len(columns)
