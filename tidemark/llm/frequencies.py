"""Values of distinct words summed over whole texts, without a row per word and text.

The most frequent words, a bounded number, meet their values in a broadcast table while
the text is read. The others, of which a text keeps its frequencies, meet them by a join.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .batches import buffers, byte_sums, pick, slices, spans
from .store import stored

#: Words in the broadcast table at most.
HEAD = 1 << 18
#: Bytes of a word in it at most; a longer one goes through the join, however frequent.
HEAD_BYTES = 256


def hashes_of(split) -> np.ndarray:
    return spans(*byte_sums(split.raw), split.starts, split.ends)


def distinct_words(named: DataFrame, split: Callable) -> DataFrame:
    """``(word, n, chosen)`` over ``(text, chosen)`` rows: how often in all texts and in chosen ones."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text"):
            words = split(part.column("text"))
            _, first, which, times = np.unique(hashes_of(words), return_index=True, return_inverse=True, return_counts=True)
            chosen = np.repeat(part.column("chosen").to_numpy(zero_copy_only=False), np.diff(words.bounds))
            of_chosen = np.bincount(which, weights=chosen, minlength=len(first)).astype(np.int64)
            yield pa.RecordBatch.from_arrays(
                [pick(words.raw, words.starts[first], words.ends[first]), pa.array(times), pa.array(of_chosen)], names=["word", "n", "chosen"]
            )

    counted = named.select("text", "chosen").mapInArrow(count, "word string, n long, chosen long")
    return counted.groupBy("word").agg(F.sum("n").alias("n"), F.sum("chosen").alias("chosen"))


def frequent(words: DataFrame, limit: int) -> DataFrame:
    """Rows of the highest ``n``, at most ``limit``, cut at a power of two, of words up to ``HEAD_BYTES``."""
    words = words.filter(F.octet_length("word") <= HEAD_BYTES)
    power = F.floor(F.log2(F.col("n").cast("double"))).cast("int")
    sizes = dict(words.groupBy(power.alias("power")).count().collect())  # a row per power of two
    cut, total = 62, 0
    for at in sorted(sizes, reverse=True):
        total += sizes[at]
        if total > limit:
            break
        cut = at
    return words.filter(F.col("n") >= F.lit(2**cut).cast("long"))


def summed(named: DataFrame, split: Callable, words: DataFrame, values: list[str], head: int = HEAD) -> DataFrame:
    """``(key, n_words, *values)``: each value of ``words`` summed over the text of ``(key, text)``.

    ``words`` is a stored table with a row for every word of the texts, ``n`` its frequency.
    """
    spark = named.sparkSession
    table = frequent(words, head).select("word", *[F.col(v).cast("double") for v in values]).toArrow()
    offsets, raw = buffers(table.column("word"))
    known = spans(*byte_sums(raw), offsets[:-1], offsets[1:])
    order = np.argsort(known)
    common = spark.sparkContext.broadcast((known[order], [table.column(v).to_numpy()[order] for v in values]))

    def per_text(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, columns = common.value
        row = TaskContext.get().partitionId() << 40
        for part in slices(batches, "text"):
            of = split(part.column("text"))
            found = hashes_of(of)
            counts = np.diff(of.bounds)
            rows = np.repeat(np.arange(of.rows), counts)
            if len(hashes):
                spot = np.minimum(np.searchsorted(hashes, found), len(hashes) - 1)
                in_head = hashes[spot] == found
            else:
                spot, in_head = np.zeros(len(found), np.int64), np.zeros(len(found), bool)
            sums = [np.bincount(rows[in_head], weights=c[spot[in_head]], minlength=of.rows).astype(np.float64) for c in columns]
            rest = np.flatnonzero(~in_head)
            order = np.lexsort((found[rest], rows[rest]))
            rest, of_row = rest[order], rows[rest[order]]
            new = np.ones(len(rest), bool)
            new[1:] = (found[rest[1:]] != found[rest[:-1]]) | (of_row[1:] != of_row[:-1])
            first = np.flatnonzero(new)
            times = np.diff(np.append(first, len(rest)))
            lists = np.searchsorted(of_row[first], np.arange(of.rows + 1)).astype(np.int32)
            rare = pa.StructArray.from_arrays([pick(of.raw, of.starts[rest[first]], of.ends[rest[first]]), pa.array(times, pa.int64())], names=["word", "times"])
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(row, row + of.rows)), part.column("key"), pa.array(counts.astype(np.int64)), *map(pa.array, sums), pa.ListArray.from_arrays(pa.array(lists), rare)],
                names=["row", "key", "n_words", *values, "rare"],
            )
            row += of.rows

    schema = ", ".join(["row long, key binary, n_words long", *[f"`{v}` double" for v in values], "rare array<struct<word: string, times: long>>"])
    found = stored(named.select("key", "text").mapInArrow(per_text, schema), "frequencies")
    valued = words.select("word", *[F.col(v).alias(f"of_{v}") for v in values])
    rare = found.select("row", F.explode("rare").alias("r")).select("row", "r.*").join(valued, "word")
    rare = rare.groupBy("row").agg(*[F.sum(F.col("times") * F.col(f"of_{v}")).alias(f"rest_{v}") for v in values])
    both = found.select("row", "key", "n_words", *values).join(rare, "row", "left")
    # Rows of one text agree; any of them tells its sums.
    return both.groupBy("key").agg(F.max("n_words").alias("n_words"), *[F.max(F.col(v) + F.coalesce(f"rest_{v}", F.lit(0.0))).alias(v) for v in values])
