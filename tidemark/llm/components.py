"""Connected components of a stored edge list, by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .store import dropped, stored


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``(node, component)`` for every node of an edge; a component is its smallest node.

    Each round links every node's larger neighbours to its smallest one, then every
    node's smaller neighbours. Rounds grow with the logarithm of the longest path; each
    is stored, and the one before it deleted. Smallest neighbours are combined before the
    shuffle, so hubs are no hot keys.
    """
    pairs = edges.select(F.least(a, b).alias("low"), F.greatest(a, b).alias("high")).filter("low < high").distinct()
    pairs = stored(pairs, "edges")
    mark = digest(pairs)
    if not mark[0]:
        return pairs.select(F.col("low").alias("node"), F.col("high").alias("component"))
    while True:
        # Large star: larger neighbours of a node go to the smallest in its neighbourhood.
        both = pairs.select(F.col("low").alias("node"), F.col("high").alias("other")).unionByName(
            pairs.select(F.col("high").alias("node"), F.col("low").alias("other"))
        )
        least = both.groupBy("node").agg(F.least(F.min("other"), F.col("node")).alias("least"))
        up = pairs.select(F.col("low").alias("node"), F.col("high")).join(least, "node").select(F.col("least").alias("low"), "high")
        large = stored(up.filter("low < high").distinct(), "large")
        dropped(pairs)
        # Small star: a node and its smaller neighbours go to the smallest of these.
        least = large.groupBy("high").agg(F.min("low").alias("least"))
        met = large.join(least, "high")
        down = met.select(F.col("least").alias("low"), F.col("low").alias("high")).unionByName(met.select(F.col("least").alias("low"), "high"))
        pairs = stored(down.filter("low < high").distinct(), "small")
        dropped(large)
        before, mark = mark, digest(pairs)
        if mark == before:
            break
    nodes = pairs.select(F.col("high").alias("node"), F.col("low").alias("component"))
    roots = pairs.select(F.col("low").alias("node"), F.col("low").alias("component")).distinct()
    return nodes.unionByName(roots)


def digest(pairs: DataFrame) -> tuple:
    """Count and hashes of distinct pairs: equal for equal tables, whatever their order."""
    one, two = F.xxhash64("low", "high"), F.xxhash64("high", F.lit(1), "low")
    return tuple(pairs.agg(F.count(F.lit(1)), F.bit_xor(one), F.bit_xor(two)).first())
