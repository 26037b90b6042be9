"""Reshaping: column lists, unions, pivots, deduplication, set differences, series."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from fnmatch import fnmatchcase
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import dates
from ..functions.scalars import as_column, nullcheck as _nullcheck

# --- columns -----------------------------------------------------------------


def get_filtered_columns_in_relation(df: DataFrame, except_: Sequence[str] = ()) -> list[str]:
    """Column names without a case-insensitive list."""
    skip = {c.lower() for c in except_}
    return [c for c in df.columns if c.lower() not in skip]


def star(
    df: DataFrame,
    except_: Sequence[str] = (),
    prefix: str = "",
    suffix: str = "",
    relation_alias: str = "",
) -> list[Column]:
    """All columns but some, renamed with a prefix and suffix; for use in a select."""
    names = get_filtered_columns_in_relation(df, except_)
    owner = f"{relation_alias}." if relation_alias else ""
    return [F.col(f"{owner}`{c}`").alias(f"{prefix}{c}{suffix}") for c in names]


def rename_project(df: DataFrame, renames: Mapping[str, str]) -> DataFrame:
    """Select the keys of ``renames`` under their new names."""
    return df.select(*[F.col(old).alias(new) for old, new in renames.items()])


def nullcheck(df: DataFrame, columns: Sequence[str]) -> list[Column]:
    """The columns, empty strings turned to null where the type is string."""
    types = {f.name: f.dataType for f in df.schema.fields}
    return [
        (_nullcheck(c) if isinstance(types[c], T.StringType) else F.col(c)).alias(c)
        for c in columns
    ]


def nullcheck_table(df: DataFrame) -> DataFrame:
    return df.select(*nullcheck(df, df.columns))


# --- unions ------------------------------------------------------------------


def _loses_digits(given: T.DataType, wanted: T.DataType) -> bool:
    """Whether a numeric cast can change a value without notice; integers that do not fit are errors of their own."""
    if not (isinstance(given, T.NumericType) and isinstance(wanted, T.NumericType)) or given == wanted:
        return False
    digits = {T.ByteType: 3, T.ShortType: 5, T.IntegerType: 10, T.LongType: 19}.get(type(given))
    if isinstance(wanted, T.IntegralType):
        return not (isinstance(given, T.IntegralType) or (isinstance(given, T.DecimalType) and given.scale == 0))
    if isinstance(wanted, T.DecimalType):
        return digits is None and (not isinstance(given, T.DecimalType) or given.scale > wanted.scale)
    exact = 15 if isinstance(wanted, T.DoubleType) else 6
    return not isinstance(given, T.FloatType) and (digits is None or digits > exact)


def union_relations(
    relations: Mapping[str, DataFrame],
    include: Sequence[str] = (),
    exclude: Sequence[str] = (),
    column_override: Mapping[str, str] | None = None,
    source_column_name: str | None = "_source_relation",
    where: str | None = None,
) -> DataFrame:
    """UNION ALL over the superset of columns; absent ones are null.

    Columns come in first-seen order and take their first type, or the override. A later
    numeric type that the first can't hold without loss is refused unless it is overridden.
    """
    if include and exclude:
        raise ValueError("give include or exclude, not both")
    if not relations:
        raise ValueError("union_relations needs at least one relation")
    wanted, skipped = {c.lower() for c in include}, {c.lower() for c in exclude}
    types: dict[str, tuple[str, str]] = {}
    first: dict[str, T.DataType] = {}
    overridden = {c.lower() for c in column_override or {}}
    for label, df in relations.items():
        for field in df.schema.fields:
            key = field.name.lower()
            if key in skipped or (wanted and key not in wanted):
                continue
            types.setdefault(key, (field.name, field.dataType.simpleString()))
            wanted_type = first.setdefault(key, field.dataType)
            if key not in overridden and _loses_digits(field.dataType, wanted_type):
                raise ValueError(
                    f"{label}.{field.name} is {field.dataType.simpleString()}, which {wanted_type.simpleString()} can't hold without loss; give column_override"
                )
    for name, override in (column_override or {}).items():
        if name.lower() in types:
            types[name.lower()] = (types[name.lower()][0], override)

    parts = []
    for label, df in relations.items():
        if where:
            df = df.where(where)
        present = {c.lower(): c for c in df.columns}
        source = [] if source_column_name is None else [F.lit(label).alias(source_column_name)]
        parts.append(
            df.select(
                *source,
                *[
                    (F.col(f"`{present[k]}`") if k in present else F.lit(None)).cast(t).alias(n)
                    for k, (n, t) in types.items()
                ],
            )
        )
    return reduce(DataFrame.unionByName, parts)


def _like(text: str, pattern: str) -> bool:
    glob = pattern.lower().replace("[", "[[]").replace("*", "[*]").replace("?", "[?]")
    return fnmatchcase(text.lower(), glob.replace("%", "*").replace("_", "?"))


def get_relations_by_pattern(
    spark: SparkSession, schema_pattern: str, table_pattern: str, exclude: str = ""
) -> dict[str, DataFrame]:
    """Catalog tables and views whose schema and name are LIKE the patterns."""
    found = {}
    databases = [d.name for d in spark.catalog.listDatabases() if _like(d.name, schema_pattern)]
    for database in databases:
        for table in spark.catalog.listTables(database):
            full = table.name if table.isTemporary else f"{database}.{table.name}"
            if _like(table.name, table_pattern) and not (exclude and _like(table.name, exclude)):
                found[full] = spark.table(full)
    return dict(sorted(found.items()))


def get_relations_by_prefix(
    spark: SparkSession, schema: str, prefix: str, exclude: str = ""
) -> dict[str, DataFrame]:
    escaped = prefix.lower()
    tables = get_relations_by_pattern(spark, schema, "%", exclude)
    return {n: t for n, t in tables.items() if n.split(".")[-1].lower().startswith(escaped)}


# --- pivot and unpivot -------------------------------------------------------


def get_column_values(
    df: DataFrame,
    column: str,
    max_records: int | None = None,
    where: str | None = None,
    order_by: Column | None = None,
    descending: bool = True,
) -> DataFrame:
    """Distinct values, most frequent first, equal counts by value; all unless ``max_records``."""
    return column_value_counts(df, column, max_records, where, order_by, descending).select(column)


def listed_values(
    df: DataFrame | None,
    column: str,
    max_records: int,
    default: Sequence | None = None,
    where: str | None = None,
    order_by: Column | None = None,
    descending: bool = True,
) -> list:
    """The first ``max_records`` values as a list on the driver, for a pivot's columns."""
    if df is None:
        return list(default or [])
    return [r[0] for r in get_column_values(df, column, max_records, where, order_by, descending).collect()]


def column_value_counts(
    df: DataFrame,
    column: str,
    max_records: int | None = None,
    where: str | None = None,
    order_by: Column | None = None,
    descending: bool = True,
) -> DataFrame:
    """Distinct values with their counts, ordered by count or another aggregate."""
    if where:
        df = df.where(where)
    rows = F.count(F.lit(1))
    counts = df.groupBy(column).agg(
        rows.alias("n_rows"), (rows if order_by is None else order_by).alias("_order")
    )
    first = F.desc("_order") if descending else F.asc("_order")
    counts = counts.orderBy(first, F.asc(column)).drop("_order")
    return counts if max_records is None else counts.limit(max_records)


COMPARISONS = {
    "=": lambda a, b: a == b,
    "<>": lambda a, b: a != b,
    "!=": lambda a, b: a != b,
    "<": lambda a, b: a < b,
    "<=": lambda a, b: a <= b,
    ">": lambda a, b: a > b,
    ">=": lambda a, b: a >= b,
}
AGGREGATES = {"sum": F.sum, "count": F.count, "min": F.min, "max": F.max, "avg": F.avg}


def pivot(
    column: str,
    values: Sequence,
    alias: bool = True,
    agg: str = "sum",
    cmp: str = "=",
    prefix: str = "",
    suffix: str = "",
    then_value=1,
    else_value=0,
    distinct: bool = False,
) -> list[Column]:
    """One conditional aggregate per value; all go into a single ``agg``."""
    compare = COMPARISONS[cmp]
    columns = []
    for value in values:
        then = as_column(then_value) if isinstance(then_value, (str, Column)) else F.lit(then_value)
        case = F.when(compare(F.col(column), F.lit(value)), then)
        if else_value is not None:
            case = case.otherwise(F.lit(else_value))
        if distinct:
            out = {"count": F.count_distinct, "sum": F.sum_distinct}[agg](case)
        else:
            out = AGGREGATES[agg](case)
        columns.append(out.alias(f"{prefix}{value}{suffix}") if alias else out)
    return columns


def unpivot(
    df: DataFrame,
    cast_to: str = "string",
    exclude: Sequence[str] = (),
    remove: Sequence[str] = (),
    field_name: str = "field_name",
    value_name: str = "value",
) -> DataFrame:
    """One row per row and column; nulls are kept, ids are ``exclude``."""
    ids = {c.lower() for c in exclude}
    dropped = {c.lower() for c in remove}
    id_columns = [c for c in df.columns if c.lower() in ids]
    fields = [c for c in df.columns if c.lower() not in ids | dropped]
    cast = df.select(*id_columns, *[F.col(c).cast(cast_to).alias(c) for c in fields])
    return cast.unpivot(id_columns, fields, field_name, value_name)


# --- one row per key, set differences ----------------------------------------


def deduplicate(
    df: DataFrame, partition_by: Sequence[str], order_by: Sequence[Column | str]
) -> DataFrame:
    """First row per key in the given order, which should be total.

    The row number is limited to 1 before the shuffle (WindowGroupLimit), so a hot
    key sends one row per map task.
    """
    window = Window.partitionBy(*partition_by).orderBy(*order_by)
    return df.withColumn("_rn", F.row_number().over(window)).where("_rn = 1").drop("_rn")


def latest_per_key(
    df: DataFrame, keys: Sequence[str], order: str, tie_break: Sequence[str] = ()
) -> DataFrame:
    """Row with the greatest ``order`` per key; ties go to the greatest tie-break."""
    return deduplicate(df, keys, [F.col(c).desc() for c in [order, *tie_break]])


def except_both_ways(a: DataFrame, b: DataFrame) -> DataFrame:
    """Distinct rows of only one side, tagged ``a_minus_b`` or ``b_minus_a``.

    One aggregation of the tagged union: copies meet before the single shuffle,
    and nulls count as equal.
    """
    columns = a.columns
    tagged = a.select(*columns, F.lit(1).alias("_a"), F.lit(0).alias("_b")).union(
        b.select(*columns, F.lit(0).alias("_a"), F.lit(1).alias("_b"))
    )
    sides = tagged.groupBy(*columns).agg(F.max("_a").alias("_a"), F.max("_b").alias("_b"))
    side = F.when(F.col("_a") == 1, "a_minus_b").otherwise("b_minus_a")
    return sides.where("_a <> _b").select(side.alias("which_diff"), *columns)


# --- series and spines -------------------------------------------------------


def generate_series(spark: SparkSession, upper_bound: int) -> DataFrame:
    """Integers 1 to ``upper_bound``."""
    if upper_bound < 1:
        raise ValueError("upper bound must be positive")
    return spark.range(1, upper_bound + 1).select(F.col("id").alias("generated_number"))


def spine_between(bounds: DataFrame, part: str) -> DataFrame:
    """Expand one row with ``_start`` and ``_end`` (exclusive) to a row per date part.

    Parts below a day are laid out day by day, so no array outgrows a day's parts.
    """
    part = dates.check_part(part)
    name = f"date_{part}"

    def steps(start: str, end: str, by: str) -> Column:
        # The lesser start keeps a reversed pair legal until the filter drops it.
        return F.explode(F.sequence(F.least(start, end), F.col(end), dates.interval(by)))

    spine = bounds.where("_start < _end")
    if part in dates.SECONDS:
        spine = spine.select(steps("_start", "_end", "day").alias("_start"), "_end").where("_start < _end")
        next_day = dates.add_parts("_start", "day", 1)
        spine = spine.withColumn("_end", F.least("_end", next_day))
    return (
        spine.select(steps("_start", "_end", part).alias(name), "_end")
        .where(F.col(name) < F.col("_end"))
        .drop("_end")
    )


def date_spine(spark: SparkSession, datepart: str, start_date, end_date) -> DataFrame:
    """A row per date part from the start; the end is not included."""
    bounds = spark.range(1).select(
        F.lit(start_date).cast("timestamp").alias("_start"),
        F.lit(end_date).cast("timestamp").alias("_end"),
    )
    return spine_between(bounds, datepart)


def date_spine_of(
    df: DataFrame, column: str, datepart: str = "day", include_last: bool = True
) -> DataFrame:
    """Spine over the date parts a column covers, read from its extremes."""
    first, last = dates.truncate(datepart, F.min(column)), dates.truncate(datepart, F.max(column))
    bounds = df.agg(first.alias("_start"), last.alias("_end"))
    if include_last:
        bounds = bounds.withColumn("_end", dates.add_parts("_end", datepart, 1))
    return spine_between(bounds, datepart)


def get_base_dates(
    spark: SparkSession,
    start_date=None,
    end_date=None,
    n_dateparts: int | None = None,
    datepart: str = "day",
    as_of=None,
) -> DataFrame:
    """Spine between two dates, or over the last ``n_dateparts`` up to ``as_of``."""
    if start_date is not None and end_date is not None:
        return date_spine(spark, datepart, start_date, end_date)
    if n_dateparts is None or as_of is None:
        raise ValueError("give start and end dates, or n_dateparts and as_of")
    day = F.to_date(F.lit(as_of))
    bounds = spark.range(1).select(
        dates.add_parts(day, datepart, -n_dateparts).alias("_start"),
        dates.add_parts(day, "day", 1).alias("_end"),
    )
    return spine_between(bounds, datepart)
