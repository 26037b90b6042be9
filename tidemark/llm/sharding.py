"""Shards of near equal bytes for groups that must not be split, by Karmarkar-Karp differencing.

Differencing repeatedly takes the two partial partitions of largest spread and adds
them oppositely ordered, until one is left. To run it on any number of groups, these
form a tree of nodes by hash: the few largest groups are differenced at the root, the
next at its children, the many small ones at the leaves. A node hands its sums down in
equal parts, and each child differences its part of them together with its own groups:
small groups fill what large ones left uneven. Every node holds a bounded number of groups.
"""

from __future__ import annotations

import heapq
import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .store import closed, column, opened, stored, text_key

#: Groups a leaf holds on average.
LEAF = 2_000
#: Children of a node at most; a node above the leaves holds fewer than this times the shards.
CHILDREN = 256


def difference(sums: np.ndarray) -> np.ndarray:
    """Place of each row's entries in one combined partition.

    ``sums`` has a partial partition per row, one column per shard. Returns, for row r
    and column c, the shard of the combination that entry goes to. Ties go by row.
    """
    rows, shards = sums.shape
    if rows == 0:
        return np.zeros((0, shards), np.int64)
    order = np.argsort(-sums, axis=1, kind="stable")
    current = [np.take(sums[r], order[r]) for r in range(rows)]
    # A tree: node n >= rows adds parts[n - rows] = (left, right), with right reversed, then sorted anew.
    heap = [(-(int(c[0]) - int(c[-1])), r) for r, c in enumerate(current)]
    heapq.heapify(heap)
    parts: list[tuple[int, int, np.ndarray]] = []
    while len(heap) > 1:
        left = heapq.heappop(heap)[1]
        right = heapq.heappop(heap)[1]
        added = current[left] + current[right][::-1]
        again = np.argsort(-added, kind="stable")
        parts.append((left, right, again))
        current[left] = current[right] = None
        current.append(added[again])
        node = len(current) - 1
        heapq.heappush(heap, (-(int(current[node][0]) - int(current[node][-1])), node))
    # From the root down: where the entries of each node ended.
    places: dict[int, np.ndarray] = {heap[0][1]: np.arange(shards)}
    for node in range(len(current) - 1, rows - 1, -1):
        left, right, again = parts[node - rows]
        at = np.empty(shards, np.int64)
        at[again] = places.pop(node)
        places[left] = at
        places[right] = at[::-1]
    out = np.empty((rows, shards), np.int64)
    for r in range(rows):
        out[r, order[r]] = places[r]
    return out


def balance_groups(groups: DataFrame, shards: int, *, leaf: int = LEAF) -> DataFrame:
    """``(key, size)`` rows, a key each, to ``(key, shard)`` with near equal sizes per shard."""
    groups = stored(groups.select("key", F.col("size").cast("long").alias("size")), "groups")
    total = groups.agg(F.count("*"), F.coalesce(F.sum("size"), F.lit(0))).first()
    leaves = max(1, -(-total[0] // leaf))
    depth = max(1, math.ceil(math.log(leaves, CHILDREN)))
    children = max(1, math.ceil(leaves ** (1 / depth)))

    # A group belongs to the first level at which it outweighs a shard's fair part of a child.
    level = F.lit(depth)
    for d in reversed(range(depth)):
        level = F.when(F.col("size").cast("double") * shards * children ** (d + 1) > total[1], d).otherwise(level)
    dealt = groups.withColumn("level", level).withColumn("hash", F.xxhash64("key"))

    def place(node: pd.DataFrame, part: pd.DataFrame) -> pd.DataFrame:
        node = node.sort_values(["size", "key"], ascending=[False, True], kind="stable")
        sums = np.zeros((len(node) + 1, shards), np.int64)
        sums[0] = part["sums"].iloc[0]
        sums[1:, 0] = node["size"]
        places = difference(sums)
        shard_at = np.argsort(places[0])  # what came down keeps its shards
        return pd.DataFrame({"node": node["node"].to_numpy(), "key": node["key"].to_numpy(), "size": node["size"].to_numpy(), "shard": shard_at[places[1:, 0]].astype(np.int32)})

    spark = groups.sparkSession
    parts = spark.range(1).select(F.col("id").alias("node"), F.array_repeat(F.lit(0).cast("long"), shards).alias("sums"))
    every = F.sequence(F.lit(0), F.lit(shards - 1))
    found = None
    for d in range(depth + 1):
        here = dealt.filter(F.col("level") == d).select(F.pmod("hash", F.lit(children**d)).alias("node"), "key", "size")
        filled = here.groupBy("node").cogroup(parts.groupBy("node")).applyInPandas(
            lambda node, part: place(node, part) if len(node) else node.assign(shard=np.int32(0))[["node", "key", "size", "shard"]],
            "node long, key binary, size long, shard int",
        )
        filled = stored(filled, "placed")
        one = filled.select("key", "shard")
        found = one if found is None else found.unionByName(one)
        if d < depth:
            own = filled.groupBy("node", "shard").agg(F.sum("size").alias("size")).groupBy("node").agg(
                F.map_from_entries(F.collect_list(F.struct("shard", "size"))).alias("own")
            )
            added = F.transform(every, lambda s: F.element_at("sums", s + 1) + F.coalesce(F.element_at("own", s), F.lit(0)))
            child = F.explode(F.sequence(F.lit(0), F.lit(children - 1)))
            parts = parts.join(own, "node", "left").withColumn("sums", added).withColumn("child", child).select(
                (F.col("node") + F.col("child") * children**d).alias("node"),
                F.expr(f"transform(sums, s -> (s + child) div {children})").alias("sums"),
            )
            parts = stored(parts, "parts")
    return found


def balanced_shards(
    docs: DataFrame, shards: int = 40, *, doc_id: str = "doc_id", text: str = "text", overhead: int = 16, bucket: int = 5_000
) -> DataFrame:
    """Documents with their shard and their slot in it; equal texts share a shard.

    A row's size is the UTF-8 bytes of its text plus ``overhead``. Returns the input's
    columns and ``size``, ``text_crc32``, ``shard`` (0 to ``shards - 1``) and ``slot``
    (gapless from 0 per shard), replacing columns of these names.

    Empty table: empty. Null text: no bytes, in one group with the empty texts. Null and
    repeated ids: rows are placed by text and numbered one by one. A group larger than a
    shard's part is still whole. Slots are numbered in buckets of about ``bucket`` rows, by a
    hash of id and text: rows equal in both (null ids as well) are in one bucket, however many,
    and one task numbers them. Copies under different ids are spread.
    """
    given = F.coalesce(column(text), F.lit(""))
    rows = opened(docs, id=column(doc_id), key=text_key(column(text)), size=(F.octet_length(given) + overhead).cast("long"), crc=F.crc32(given.cast("binary")))
    groups = rows.groupBy("key").agg(F.sum("size").alias("size"), F.count(F.lit(1)).alias("rows"))
    groups = stored(groups, "groups")
    n = groups.agg(F.sum("rows")).first()[0] or 0
    shard_of = balance_groups(groups, shards).withColumnRenamed("key", "group")
    buckets = max(1, -(-n // bucket))
    placed = rows.join(shard_of, rows["key"] == shard_of["group"]).withColumn("bucket", F.pmod(F.xxhash64("id", "size", "crc"), F.lit(buckets)))
    counts = placed.groupBy("shard", "bucket").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("shard").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(F.col("shard").alias("s"), F.col("bucket").alias("b"), F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    inside = Window.partitionBy("shard", "bucket").orderBy("id", "key")
    numbered = placed.withColumn("at", F.row_number().over(inside) - 1)
    numbered = numbered.join(offsets, (F.col("shard") == F.col("s")) & (F.col("bucket") == F.col("b")))
    return closed(
        numbered, docs.columns, size=F.col("size"), text_crc32=F.col("crc"), shard=F.col("shard"), slot=(F.col("before") + F.col("at")).cast("long")
    )
