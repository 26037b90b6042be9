"""Layer tables on plain Parquet: a log of batches, read as its latest rows.

Every micro-batch is written to its own folder and replaces it when it is retried,
so a lost executor or a repeated batch never duplicates rows. An upsert is an
append to the log; readers take the latest row per key. ``generation`` counts up
when a checkpoint is thrown away and batch ids start again.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.rules import any_of, is_missing
from ..operators.reshape import latest_per_key

POSITION = ["generation", "batch_id"]
#: Generation and number of a batch.
Place = tuple[int, int]
#: A commit of a batch has no snapshot; a published snapshot names the last batch it holds.
COMMIT = "generation int, batch_id long, snapshot string"


def batch_path(path: str, batch_id: int, generation: int = 0) -> str:
    return f"{path}/generation={generation}/batch_id={batch_id}"


def write_batch(
    df: DataFrame,
    path: str,
    batch_id: int,
    generation: int = 0,
    partition_by: Sequence[str] = (),
) -> None:
    """Write one batch to its folder and commit it; a retry replaces it and commits again."""
    add_batch(df, path, batch_id, generation, partition_by)
    commit_batch(df.sparkSession, path, batch_id, generation)


def add_batch(
    df: DataFrame,
    path: str,
    batch_id: int,
    generation: int = 0,
    partition_by: Sequence[str] = (),
) -> None:
    """Write one batch to its folder, to be committed later."""
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(batch_path(path, batch_id, generation))


def commit_batch(spark: SparkSession, path: str, batch_id: int, generation: int = 0) -> None:
    _commit(spark, path, (generation, batch_id), None)


def _commit(spark: SparkSession, path: str, at: Place, snapshot: str | None) -> None:
    commit = spark.createDataFrame([(*at, snapshot)], COMMIT).coalesce(1)
    commit.write.mode("append").json(commits_path(path))


def commits(spark: SparkSession, path: str) -> DataFrame | None:
    """The commit log of a table, None if nothing is committed yet."""
    try:
        return spark.read.schema(COMMIT).json(commits_path(path))
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def committed_batches(spark: SparkSession, path: str, after: Place | None = None) -> list[Place]:
    """Generation and number of every committed batch, in order; of those after a place, if one is given.

    ``compact_log`` and ``vacuum_log`` keep the log short: then it holds the batches of a few snapshots.
    """
    found = commits(spark, path)
    if found is None:
        return []
    found = found.where("snapshot is null").select(*POSITION)
    if after is not None:
        found = found.where(_after(after))
    return sorted((r[0], r[1]) for r in found.distinct().collect())  # a row per batch


def published_snapshots(spark: SparkSession, path: str) -> list[tuple[Place, str]]:
    """Place and folder of every published snapshot, the latest first."""
    found = commits(spark, path)
    if found is None:
        return []
    rows = found.where("snapshot is not null").distinct().collect()  # a row per snapshot kept
    return sorted((((r[0], r[1]), r[2]) for r in rows), reverse=True)


def read_batches(
    spark: SparkSession, path: str, batches: Sequence[int], schema: T.StructType, generation: int = 0
) -> DataFrame:
    """The rows of some batches with their place in the log."""
    place = T.StructType([*schema.fields, T.StructField("generation", T.IntegerType()), T.StructField("batch_id", T.LongType())])
    paths = [batch_path(path, b, generation) for b in batches]
    return spark.read.schema(place).option("basePath", path).parquet(*paths)


def commits_path(path: str) -> str:
    """Beside the table: a small file per written batch, added after its rows."""
    return f"{path}.commits"


def commit_stream(
    spark: SparkSession, path: str, max_files_per_batch: int | None = None
) -> DataFrame | None:
    """Stream of a log's committed batches; None if nothing is committed yet."""
    if commits(spark, path) is None:
        return None
    reader = spark.readStream.schema(COMMIT)
    if max_files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", max_files_per_batch)
    return reader.json(commits_path(path)).where("snapshot is null").select(*POSITION)


def read_batch(spark: SparkSession, path: str, batch_id: int, generation: int = 0) -> DataFrame:
    """The rows of one batch as they are now."""
    return spark.read.parquet(batch_path(path, batch_id, generation))


def read_log(spark: SparkSession, path: str, merge_schema: bool = False) -> DataFrame:
    """All batches of a layer table.

    ``merge_schema`` reads every file's footer to join columns over schema changes,
    which only a table that may change its columns needs (the quarantine).
    """
    return spark.read.option("mergeSchema", merge_schema).parquet(path)


def latest_rows(log: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Latest row per key. A key occurs once per batch, so a key's rows are few.

    A null key matches none, as in a merge: rows with one are all kept.
    """
    keyless = any_of(is_missing(k) for k in keys)
    numbered = log.where(~keyless).withColumn("_at", F.struct(*POSITION))
    latest = latest_per_key(numbered, keys, "_at").drop("_at")
    return latest.unionByName(log.where(keyless)).drop(*POSITION)


def _after(at: tuple[int, int]):
    generation, batch_id = F.col("generation"), F.col("batch_id")
    return (generation > at[0]) | ((generation == at[0]) & (batch_id > at[1]))


def compact(
    spark: SparkSession,
    path: str,
    keys: Sequence[str],
    snapshot_path: str,
    upto: tuple[int, int],
    previous: tuple[int, int] | None = None,
) -> None:
    """Write the latest rows up to a batch as a snapshot, on top of an older one."""
    rows = _log_since(spark, path, snapshot_path, previous).where(~_after(upto))
    latest = latest_rows(rows, keys)
    latest.write.mode("overwrite").parquet(batch_path(snapshot_path, upto[1], upto[0]))


def _log_since(spark, path, snapshot_path, snapshot) -> DataFrame:
    log = read_log(spark, path)
    if snapshot is None:
        return log
    generation, batch_id = snapshot
    base = _with_place(spark.read.parquet(batch_path(snapshot_path, batch_id, generation)), snapshot)
    return log.where(_after(snapshot)).unionByName(base, allowMissingColumns=True)


def _with_place(rows: DataFrame, at: Place) -> DataFrame:
    return rows.withColumns({"generation": F.lit(at[0]), "batch_id": F.lit(at[1])})


def _committed_log(spark: SparkSession, path: str, upto: Place | None = None) -> DataFrame | None:
    """The latest published snapshot and the batches committed after it; no other file is listed or read."""
    snapshots = [s for s in published_snapshots(spark, path) if upto is None or s[0] <= upto]
    at, folder = snapshots[0] if snapshots else (None, None)
    batches = [b for b in committed_batches(spark, path, at) if upto is None or b <= upto]
    parts = [_with_place(spark.read.parquet(folder), at)] if folder else []
    if batches:
        paths = [batch_path(path, batch_id, generation) for generation, batch_id in batches]
        parts.append(spark.read.option("basePath", path).parquet(*paths))
    return reduce(lambda x, y: x.unionByName(y, allowMissingColumns=True), parts) if parts else None


def current_rows(
    spark: SparkSession,
    path: str,
    keys: Sequence[str],
    snapshot_path: str | None = None,
    snapshot: Place | None = None,
) -> DataFrame:
    """Latest row per key, from the latest published snapshot and the batches committed after it.

    A snapshot of one's own, written by ``compact``, can be named instead.
    """
    log = _committed_log(spark, path) if snapshot is None else None
    return latest_rows(_log_since(spark, path, snapshot_path, snapshot) if log is None else log, keys)


def log_rows(spark: SparkSession, path: str, after: Place | None = None) -> DataFrame:
    """Rows of the batches committed after a place; without one, or where some are gone, from the latest snapshot on.

    Rows come without their place; a key has a row per batch that brought it.
    """
    snapshots = published_snapshots(spark, path)
    if after is None or (snapshots and snapshots[0][0] > after and not _still_there(spark, path, after)):
        return _committed_log(spark, path).drop(*POSITION)
    batches = committed_batches(spark, path, after)
    if not batches:
        return _committed_log(spark, path).drop(*POSITION).limit(0)
    paths = [batch_path(path, batch_id, generation) for generation, batch_id in batches]
    return spark.read.option("basePath", path).parquet(*paths).drop(*POSITION)


def _still_there(spark: SparkSession, path: str, after: Place) -> bool:
    """Whether all batches after a place are still in the log: the place's own commit has not been deleted."""
    return after in committed_batches(spark, path)


def compact_log(spark: SparkSession, path: str, keys: Sequence[str], upto: Place | None = None) -> Place | None:
    """Write the latest rows up to a batch (the last one committed) as a snapshot and publish it.

    Reads the snapshot before and the batches after it. Files are sized by the rows they turn out to
    hold. The snapshot is found by readers from its commit on, which is one small file: a run that
    fails before leaves the table as it was. Returns the place of the snapshot that holds from then
    on, None if the log is empty. A batch must not be changed any more once a snapshot holds it.
    """
    snapshots = published_snapshots(spark, path)
    last = snapshots[0][0] if snapshots else None
    batches = [b for b in committed_batches(spark, path, last) if upto is None or b <= upto]
    if not batches:
        return last
    rows = latest_rows(_committed_log(spark, path, batches[-1]), keys)
    generation, batch_id = batches[-1]
    folder = f"{path}.snapshots/{generation}-{batch_id}-{uuid.uuid4().hex[:8]}"
    rows.hint("rebalance").write.parquet(folder)
    _commit(spark, path, batches[-1], folder)
    return batches[-1]


def vacuum_log(spark: SparkSession, path: str, keep: int = 2) -> Place | None:
    """Delete what no reader of the ``keep`` latest snapshots needs: older snapshots, the batches they hold, their commits.

    A reader that began before the oldest of these may miss its files, and so may a downstream hop that
    has not yet taken a deleted batch: keep as many snapshots as the slowest of them is behind.
    Returns the place up to which batches are gone, None if there are too few snapshots.
    """
    if keep < 1:
        raise ValueError("at least one snapshot must be kept")
    snapshots = published_snapshots(spark, path)
    if len(snapshots) < keep:
        return None
    at, _ = snapshots[keep - 1]
    named = commits(spark, path).select("*", F.col("_metadata.file_path").alias("file"))
    here = (F.col("generation") == at[0]) & (F.col("batch_id") == at[1])
    old = named.where(~_after(at) & (F.col("snapshot").isNull() | ~here))
    found = old.collect()  # what earlier runs have left: the batches of one snapshot or a few
    gone = {folder for place, folder in snapshots[keep:]} | {batch_path(path, r["batch_id"], r["generation"]) for r in found if not r["snapshot"]}
    # Commits last: a run that fails between can be repeated.
    for target in [*sorted(gone), *sorted({r["file"] for r in found})]:
        _delete(spark, target)
    return at


def _delete(spark: SparkSession, target: str) -> None:
    file = spark._jvm.org.apache.hadoop.fs.Path(target)
    file.getFileSystem(spark._jsc.hadoopConfiguration()).delete(file, True)


def incremental_upsert(target: DataFrame, updates: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Target rows replaced or joined by the updates; both have one row per key."""
    kept = target.join(updates.select(*keys), list(keys), "left_anti")
    return kept.unionByName(updates)


def clustered_write(df: DataFrame, path: str, cluster_by: Sequence[str]) -> None:
    """Full rebuild, rows ranged and sorted by the clustering columns.

    A range split never divides equal keys, so every column follows as a tie-break
    and a hot key fills as many files as it needs.
    """
    rest = [c for c in df.columns if c not in cluster_by]
    ranged = df.repartitionByRange(*cluster_by, *rest)
    ranged.sortWithinPartitions(*cluster_by).write.mode("overwrite").parquet(path)
