"""Tables of one row per key, upserted by the partitions that hold the keys.

A run writes the partitions it touches anew, below a folder of its own, and publishes a
manifest that names the folder of every partition's rows. Partitions it does not touch keep
their files, unread. Readers take the manifest of the last committed run, so that a run which
fails, or is repeated, changes nothing until it is published.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .layers import _delete, commit_batch, committed_batches

MANIFEST = "partition string, folder string"
#: How Spark names the partition of nulls.
NULL_PARTITION = "__HIVE_DEFAULT_PARTITION__"
#: Their text is the same in a path and in a column.
PARTITION_TYPES = (T.DateType, T.IntegerType, T.LongType)


def manifest_path(path: str, run: int) -> str:
    return f"{path}.manifest/run={run}"


def manifest(spark: SparkSession, path: str, before: int | None = None) -> dict[str, str]:
    """Folder of each partition's rows after the last committed run, or the last one ``before`` a run."""
    runs = [run for _, run in committed_batches(spark, path) if before is None or run < before]
    if not runs:
        return {}
    rows = spark.read.schema(MANIFEST).json(manifest_path(path, max(runs))).collect()  # a row per partition
    return {r["partition"]: r["folder"] for r in rows}


def partition_rows(
    spark: SparkSession, path: str, parts: dict[str, str], partition: str, schema: T.StructType
) -> DataFrame:
    """The rows of some partitions; only their files are listed."""
    if not parts:
        return spark.createDataFrame([], schema)
    paths = [f"{folder}/{partition}={value}" for value, folder in parts.items()]
    return spark.read.schema(schema).option("basePath", path).parquet(*paths).select(*schema.names)


@dataclass(frozen=True)
class Upsert:
    """A run's partitions, not yet published."""

    spark: SparkSession
    path: str
    partition: str
    run: int
    schema: T.StructType
    parts: dict[str, str]
    touched: list[str]

    def rows(self) -> DataFrame:
        return partition_rows(self.spark, self.path, self.parts, self.partition, self.schema)

    def publish(self) -> None:
        listed = self.spark.createDataFrame(list(self.parts.items()), MANIFEST).coalesce(1)
        listed.write.mode("overwrite").json(manifest_path(self.path, self.run))
        commit_batch(self.spark, self.path, self.run)


def _values(df: DataFrame, partition: str) -> set[str]:
    text = F.coalesce(F.col(partition).cast("string"), F.lit(NULL_PARTITION))
    return {r[0] for r in df.select(text).distinct().collect()}  # a row per partition


def upsert_partitions(updates: DataFrame, path: str, key: str, partition: str, run: int) -> Upsert:
    """Rows of ``updates`` replace the table's rows of their keys, or join them.

    ``updates`` has one row per key; rows without a key replace none and are all kept. ``partition``
    is a date or whole number. A key may move to another partition: to find where the updated keys
    are now, the key column alone is read, of row groups whose range of keys meets the updates'.
    Full rows are read of the touched partitions only.
    """
    if not isinstance(updates.schema[partition].dataType, PARTITION_TYPES):
        raise ValueError(f"{partition} must be a date or a whole number")
    spark, schema = updates.sparkSession, T.StructType([T.StructField(f.name, f.dataType) for f in updates.schema.fields])
    attempt = f"{run}-{uuid.uuid4().hex[:8]}"
    staging = f"{path}.staging/run={attempt}"
    updates.write.parquet(staging)
    staged = spark.read.schema(schema).parquet(staging)
    before = manifest(spark, path, run)
    touched = _values(staged, partition)
    span = staged.agg(F.min(key).alias("least"), F.max(key).alias("most")).first()
    if before and span["least"] is not None:
        now = partition_rows(spark, path, before, partition, schema).select(key, partition)
        near = now.where(F.col(key).between(F.lit(span["least"]), F.lit(span["most"])))
        touched |= _values(near.join(staged.select(key), key, "left_semi"), partition)
    changed = {value: folder for value, folder in before.items() if value in touched}
    kept = partition_rows(spark, path, changed, partition, schema).join(staged.select(key), key, "left_anti")
    folder = f"{path}/run={attempt}"
    # Sorted by key within files, so that row groups can be told apart by their range of keys.
    merged = kept.select(*schema.names).unionByName(staged).hint("rebalance", partition)
    merged.sortWithinPartitions(partition, key).write.partitionBy(partition).parquet(folder)
    _delete(spark, staging)
    # A partition whose rows have all moved has no folder any more.
    written = _values(spark.read.schema(schema).parquet(folder), partition) if touched else set()
    parts = {value: f for value, f in before.items() if value not in touched} | {value: folder for value in written}
    return Upsert(spark, path, partition, run, schema, parts, sorted(touched))


def vacuum_partitions(spark: SparkSession, path: str, partition: str, keep: int = 2) -> int:
    """Delete partition folders that only runs before the ``keep`` latest read; returns how many."""
    if keep < 1:
        raise ValueError("at least one run must be kept")
    runs = sorted({run for _, run in committed_batches(spark, path)})
    if len(runs) <= keep:
        return 0
    listed = spark.read.schema(f"{MANIFEST}, run long").json(f"{path}.manifest")
    rows = listed.where(F.col("run").isin(runs)).collect()  # a row per partition and run left
    kept = {(r["folder"], r["partition"]) for r in rows if r["run"] in runs[-keep:]}
    gone = {(r["folder"], r["partition"]) for r in rows} - kept
    for folder, value in sorted(gone):
        _delete(spark, f"{folder}/{partition}={value}")
    for run in sorted({r["run"] for r in rows} - set(runs[-keep:])):
        _delete(spark, manifest_path(path, run))
    return len(gone)
