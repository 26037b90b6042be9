"""Joins and key checks that hold up under hot keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def lookup_join(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Left join to a table that has one row per key.

    It reads each side once. The runtime re-plans it from the sizes it has seen: a right
    side below the broadcast threshold is broadcast, and a hot key's left rows, null keys
    among them, are split over tasks. Other columns must not share names.
    """
    keys = list(keys)
    extra = [c for c in right.columns if c not in keys]
    if shared := sorted({c.lower() for c in left.columns} & {c.lower() for c in extra}):
        raise ValueError(f"columns of both sides: {', '.join(shared)}")
    return left.join(right, keys, "left").select(*left.columns, *extra)


def key_counts(df: DataFrame, columns: Sequence[str], into: str = "failing_rows") -> DataFrame:
    """Present keys with their row counts: copies meet before the shuffle."""
    present = [F.col(c).isNotNull() for c in columns]
    data = df
    for p in present:
        data = data.where(p)
    return data.groupBy(*columns).agg(F.count(F.lit(1)).alias(into))


def repeated_keys(
    df: DataFrame, columns: Sequence[str], into: str = "n_records", wide: bool = False
) -> DataFrame:
    """Column tuples held by more than one row; null is a value like any other.

    For ``wide`` values, long texts say, their 64-bit hashes are counted first and
    only rows whose hash repeats take their values along. Equal values have equal
    hashes, so none is lost, and the values themselves decide.
    """
    rows = df.select(*columns)
    if wide:
        hashed = rows.withColumn("_h", F.xxhash64(*columns))
        counts = hashed.groupBy("_h").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1")
        rows = lookup_join(hashed, counts, ["_h"]).where("_n is not null").select(*columns)
    counts = rows.groupBy(*columns).agg(F.count(F.lit(1)).alias(into))
    return counts.where(F.col(into) > 1)


def keys_without_match(
    child: DataFrame, column: str, parent: DataFrame, field: str
) -> DataFrame:
    """Present child keys with no parent, and how many rows hold each."""
    parents = parent.select(F.col(field).alias(column)).where(F.col(column).isNotNull()).distinct()
    return key_counts(child, [column]).join(parents, column, "left_anti")


def keys_with_match(child: DataFrame, column: str, other: DataFrame, field: str) -> DataFrame:
    """Child keys found in the other table, and how many rows hold each."""
    others = other.select(F.col(field).alias(column)).distinct()
    return key_counts(child, [column]).join(others, column, "left_semi")


def compare_join(a: DataFrame, b: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Full join of two aggregates on their group keys; without keys both have one row.

    Group keys compare with ``=``: a null group of one side never meets the other's.
    """
    if keys:
        return a.join(b, list(keys), "full")
    return a.crossJoin(b)


def dates_in_ranges(
    ranges: DataFrame, start: str, end: str, into: str = "date_day"
) -> DataFrame:
    """One row per range and day it covers, so that facts meet ranges by equality."""
    return ranges.where(F.col(start) <= F.col(end)).withColumn(
        into, F.explode(F.sequence(F.col(start), F.col(end)))
    )
