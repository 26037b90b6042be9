"""Small shared pieces: stored tables, renamed columns, sized lookups."""

from __future__ import annotations

import tempfile
import uuid

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A lookup table of at most this many rows is broadcast.
BROADCAST_ROWS = 50_000
#: Copies of a larger lookup table's rows, so that a hot key meets many tasks.
SALTS = 16

#: Spark's setting to delete a finished query's shuffle files instead of waiting for the driver's garbage collector.
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

_LOCAL: dict[str, str] = {}


def shared(spark: SparkSession) -> str:
    """The folder named in ``spark.checkpoint.dir``; in local mode a folder of our own if unset."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    return _LOCAL.setdefault(spark.sparkContext.applicationId, tempfile.mkdtemp(prefix="tidemark-llm-"))


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write a table to the shared folder and read it back, which cuts its lineage.

    The files outlive lost executors and go when the session ends, or by ``dropped``. What
    the query shuffled is deleted once it is written.
    """
    spark = df.sparkSession
    path = f"{shared(spark)}/llm-{label}-{uuid.uuid4().hex[:12]}"
    before = spark.conf.get(SHUFFLE_CLEANUP, None)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        if before is None:
            spark.conf.unset(SHUFFLE_CLEANUP)
        else:
            spark.conf.set(SHUFFLE_CLEANUP, before)
    folder, files = opened_folder(spark, path)
    files.deleteOnExit(folder)
    table = spark.read.schema(df.schema).parquet(path)
    table.stored_at = path
    return table


def opened_folder(spark: SparkSession, path: str) -> tuple:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder, folder.getFileSystem(spark._jsc.hadoopConfiguration())


def dropped(*tables: DataFrame) -> None:
    """Delete stored tables that nothing reads any more: all made of them has been stored."""
    for table in tables:
        folder, files = opened_folder(table.sparkSession, table.stored_at)
        files.delete(folder, True)


def column(name: str) -> Column:
    """A column by its exact name, dots and spaces included."""
    return F.col(f"`{name}`")


def opened(docs: DataFrame, **parts: Column) -> DataFrame:
    """The columns renamed by position beside the parts needed, so that names cannot clash."""
    kept = [column(c).alias(f"in{i}") for i, c in enumerate(docs.columns)]
    return docs.select(*kept, *[c.alias(n) for n, c in parts.items()])


def closed(df: DataFrame, names: list[str], **added: Column) -> DataFrame:
    """Back to the names; an added column takes the place of one of the same name."""
    taken = {n.lower() for n in added}
    kept = [F.col(f"in{i}").alias(c) for i, c in enumerate(names) if c.lower() not in taken]
    return df.select(*kept, *[c.alias(n) for n, c in added.items()])


def looked_up(rows: DataFrame, table: DataFrame, key: str, spread: Column) -> DataFrame:
    """Left join on one key (null matches null); the table has a row per key.

    A small table is broadcast after its rows are counted. Of a larger one each row
    is copied ``SALTS`` times, and ``spread`` deals the rows of a hot key over the copies.
    """
    table = stored(table, "lookup")
    if table.count() <= BROADCAST_ROWS:
        match = table.withColumnRenamed(key, "__key")
        return rows.join(F.broadcast(match), rows[key].eqNullSafe(match["__key"]), "left").drop("__key")
    match = table.withColumnRenamed(key, "__key").withColumn("__copy", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    salted = rows.withColumn("__salt", F.pmod(F.xxhash64(spread), F.lit(SALTS)).cast("int"))
    on = salted[key].eqNullSafe(match["__key"]) & (salted["__salt"] == match["__copy"])
    return salted.join(match, on, "left").drop("__key", "__copy", "__salt")


def text_key(text: Column) -> Column:
    """128 bits that stand for a text; null and empty texts are equal."""
    return F.unhex(F.md5(F.coalesce(text, F.lit(""))))


def by_text(docs: DataFrame, marks: DataFrame, text: str, **added: Column) -> DataFrame:
    """Rows of documents with the marks of their text's ``key``, a row each, as new columns.

    The marks are stored first: then the join is between two plain scans, and Spark can
    split the rows of a hot text.
    """
    marks = stored(marks.withColumnRenamed("key", "marked_text"), "marks")
    rows = opened(docs, text_of_row=text_key(column(text)))
    return closed(rows.join(marks, rows["text_of_row"] == marks["marked_text"], "left"), docs.columns, **added)


class BitMap:
    """A broadcast set of 64-bit numbers, of fixed size; some others seem to be in it too."""

    BITS = 26

    def __init__(self, bits):
        self.bits = bits  # a broadcast

    def has(self, number: int) -> bool:
        spot = (number & (2**64 - 1)) >> (64 - self.BITS)
        return bool(self.bits.value[spot >> 3] >> (spot & 7) & 1)

    def have(self, numbers: np.ndarray) -> np.ndarray:
        spot = numbers.view(np.uint64) >> np.uint64(64 - self.BITS)
        return (self.bits.value[spot >> np.uint64(3)] >> (spot & np.uint64(7)).astype(np.uint8)) & 1 == 1


def shared_map(numbers: DataFrame) -> BitMap:
    """A bit map of the ``bits`` column; what it collects is bounded by the map's 8 MB."""
    spot = F.shiftrightunsigned("bits", 64 - BitMap.BITS)
    maps = numbers.select(F.floor(spot / 32768).cast("long").alias("bucket"), F.pmod(spot, F.lit(32768)).alias("spot"))
    maps = maps.groupBy("bucket").agg(F.bitmap_construct_agg("spot").alias("bits"))
    found = np.zeros(2**BitMap.BITS // 8, np.uint8)
    for bucket, part in maps.collect():  # at most 2**BITS / 32768 rows of 4 kB
        found[bucket * 4096 : (bucket + 1) * 4096] = np.frombuffer(part, np.uint8)
    return BitMap(numbers.sparkSession.sparkContext.broadcast(found))
