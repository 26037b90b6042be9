"""Neighbours and exact quantiles in sorted data, without one task per group.

A plain window sends a whole group to one task, so one group with a third of all
rows decides the run time. Neighbours are looked up in ranges of the sorted rows instead:
Spark deals the rows by range of the group and order columns, and what they are dealt to is
stored once, so that every use sees the same ranges. Groups are contiguous in sort order, so
the only row outside a range that a row in it can need is the outermost one of the nearest
range with rows. The table that carries values over the limits therefore has one row per
range, and is broadcast.

Quantiles need no order of the rows at all: values are counted by the leading part of a code
that sorts like them, and then only where the wanted ranks lie by the next part.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.rules import all_of
from ..sources.folders import new_folder

# --- neighbours --------------------------------------------------------------


def sort_keys(partition_by: Sequence[str], order_by: Sequence[str]) -> list[str]:
    """Group columns, then order columns, each once."""
    return list(dict.fromkeys([*partition_by, *order_by]))


def ranged(df: DataFrame, names: Sequence[str], ranges: int | None = None, into: str = "_range") -> DataFrame:
    """Rows dealt to ranges of about equal size in the order of ``names``, with the range's number, stored.

    The rows are written to the shared folder here and now: ranges come from a sample, so a
    second look at them must not draw another one, also after an executor is lost.
    """
    spark = df.sparkSession
    if ranges is None:
        ranges = int(spark.conf.get("spark.sql.shuffle.partitions"))
    if ranges < 2:
        return df.withColumn(into, F.lit(0))
    dealt = df.repartitionByRange(ranges, *names).withColumn(into, F.spark_partition_id())
    path = new_folder(spark, "ranges")
    dealt.write.parquet(path)
    return spark.read.schema(dealt.schema).parquet(path)


def with_neighbour(
    df: DataFrame,
    value: str,
    order_by: Sequence[str],
    partition_by: Sequence[str] = (),
    into: str = "previous",
    ahead: bool = False,
    ranges: int | None = None,
) -> DataFrame:
    """Add the value of the previous (or next) row of the group in sort order.

    ``order_by`` should be a total order within the group, or equal keys are in
    arbitrary order. ``{into}_exists`` tells a missing neighbour from a null one.
    """
    group, order = list(partition_by), list(order_by)
    keys = sort_keys(group, order)
    cells = ranged(df, keys, ranges)
    of_value = F.struct(F.col(value).alias("v"))
    step = F.lead if ahead else F.lag
    inner = Window.partitionBy("_range", *group).orderBy(*order)
    near = cells.withColumn("_near", step(of_value).over(inner))

    # The outermost row of each range: one row per range, whatever the groups.
    pick = F.min_by if ahead else F.max_by
    key = F.struct(*[F.col(n) for n in keys])
    outermost = F.struct(*[F.col(c).alias(f"g{i}") for i, c in enumerate(group)], of_value.alias("value"))
    edges = cells.groupBy("_range").agg(pick(outermost, key).alias("_edge"))
    beside = step("_edge").over(Window.orderBy("_range"))
    edges = edges.select(F.col("_range").alias("_at"), beside.alias("_far"))
    near = near.join(F.broadcast(edges), near["_range"] == edges["_at"], "left")
    same_group = all_of(F.col(c).eqNullSafe(F.col("_far")[f"g{i}"]) for i, c in enumerate(group))
    near = near.withColumn("_near", F.coalesce("_near", F.when(same_group, F.col("_far")["value"])))
    return near.select(
        *df.columns,
        F.col("_near")["v"].alias(into),
        F.col("_near").isNotNull().alias(f"{into}_exists"),
    )


# --- quantiles ---------------------------------------------------------------

#: Bits of the mantissa that each step tells apart; the first one tells sign and exponent too.
STEPS = (10, 21, 21)


def with_codes(df: DataFrame, value: str, into: Sequence[str]) -> DataFrame:
    """Add whole numbers, one per step, that sort like a double, NaN last: together they tell it exactly.

    Sign and exponent with the mantissa's leading bits, then the mantissa's next bits. Zeros
    of either sign are equal. Every projection builds on the one before, so that nothing is
    computed twice.
    """
    size, power = F.col("_size"), lambda by: F.pow(F.lit(2.0), by)
    plain = (size > 0) & (size < F.lit(float("inf")))
    found = df.withColumn("_size", F.abs(value))
    found = found.withColumn("_exp", F.when(plain, F.floor(F.log2("_size"))).cast("int"))
    # The logarithm may be off by one next to a power of two.
    off = F.when(power(F.col("_exp")) > size, -1).when(power(F.col("_exp") + 1) <= size, 1).otherwise(0)
    found = found.withColumn("_exp", F.col("_exp") + off)
    # Below the normal numbers a power of two is as small as a number gets: divide in two steps.
    half = F.shiftright("_exp", 1)
    bits = ((size / power(half) / power(F.col("_exp") - half) - 1) * F.lit(2.0**52)).cast("bigint")
    found = found.withColumn("_bits", bits)
    left, codes = 52, []
    for i, width in enumerate(STEPS):
        left -= width
        part = F.shiftright("_bits", left).bitwiseAND((1 << width) - 1)
        if i == 0:
            beyond = F.when(F.isnan("_size"), 4000 << width).when(size > 0, 3000 << width).otherwise(0)
            part = F.coalesce((F.col("_exp") + 1100) * (1 << width) + part, beyond)
        codes.append((F.when(F.col(value) < 0, -1).otherwise(1) * F.coalesce(part, F.lit(0))).cast("bigint"))
    return found.withColumns(dict(zip(into, codes, strict=True))).drop("_size", "_exp", "_bits")


def exact_quantile(
    df: DataFrame,
    value: str,
    quantile: float,
    group_by: Sequence[str] = (),
    into: str = "quantile",
) -> DataFrame:
    """Exact interpolated quantile per group, nulls ignored.

    Each step counts the values by group and a part of their code, with partial counts before the
    shuffle, and keeps for the next one only the codes that hold the two ranks asked for: at most
    two per group. Rows are neither sorted nor shuffled to ranges; what is sorted are the codes of a
    group that occur, at most two million in a step. The input is read once per step, of its group
    and value columns.
    """
    if not 0 <= quantile <= 1:
        raise ValueError("quantile must lie between 0 and 1")
    group = [f"_g{i}" for i in range(len(group_by))]
    codes = [f"_c{i}" for i in range(len(STEPS))]
    rows = df.select(*[F.col(c).alias(g) for g, c in zip(group, group_by, strict=True)], F.col(value).cast("double").alias("_v"))
    rows = with_codes(rows.where("_v is not null"), "_v", codes)

    carried = ["_low", "_high", "_part"]
    wanted = None
    for i, code in enumerate(codes):
        here, near = [*group, *codes[:i]], rows
        if wanted is not None:
            # Without groups these are at most two rows; with them, as few per group as that.
            places = wanted.select(*[F.col(c).alias(f"{c}_") for c in here], *carried)
            places = places if group else F.broadcast(places)
            near = rows.join(places, all_of([rows[c].eqNullSafe(places[f"{c}_"]) for c in here]))
        counts = near.groupBy(*here, code).agg(
            F.count(F.lit(1)).alias("_n"), F.min("_v").alias("_least"), *([F.max(c).alias(c) for c in carried] if i else [])
        )
        inside = Window.partitionBy(*here).orderBy(code).rowsBetween(Window.unboundedPreceding, Window.currentRow)
        counts = counts.withColumn("_before", F.sum("_n").over(inside) - F.col("_n"))
        if wanted is None:
            rank = (F.sum("_n").over(Window.partitionBy(*group)) - 1) * F.lit(float(quantile))
            counts = counts.withColumn("_rank", rank).withColumns(
                {"_low": F.floor("_rank"), "_high": F.ceil("_rank"), "_part": F.col("_rank") - F.floor("_rank")}
            )
        # Ranks from the first of a code on; null for an end that lies elsewhere.
        inner = {c: F.col(c) - F.col("_before") for c in carried[:2]}
        counts = counts.withColumns({c: F.when((at >= 0) & (at < F.col("_n")), at) for c, at in inner.items()})
        wanted = counts.where("_low is not null or _high is not null").select(*here, code, *carried, "_least")

    low, high = (F.max(F.when(F.col(c).isNotNull(), F.col("_least"))) for c in carried[:2])
    ends = wanted.groupBy(*group).agg(low.alias("_lo"), high.alias("_hi"), F.max("_part").alias("_part"))
    # Equal ends are the value itself: infinite ones have no difference.
    between = F.when(F.col("_lo") == F.col("_hi"), F.col("_lo")).otherwise(F.col("_lo") + (F.col("_hi") - F.col("_lo")) * F.col("_part"))
    return ends.select(*[F.col(g).alias(c) for g, c in zip(group, group_by, strict=True)], between.alias(into))
