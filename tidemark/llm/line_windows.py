"""Remove lines that repeat elsewhere, found by overlapping windows of three lines."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .store import closed, column, opened, text_key


def line_windows(named: DataFrame, length: int) -> DataFrame:
    """``(id, key, pos, a, b)``: place and two 64-bit hashes of every window of consecutive lines."""
    hashed = F.transform("lines", lambda x: F.struct(F.xxhash64(x).alias("a"), F.xxhash64(F.lit("line"), x).alias("b")))
    hashed = named.select("id", "key", hashed.alias("hashes")).filter(F.size("hashes") >= length)
    # The lines beside themselves, shifted: each window is one element.
    shifted = [F.slice("hashes", i + 1, F.size("hashes") - (length - 1)).alias(f"line{i}") for i in range(length)]
    exploded = hashed.select("id", "key", *shifted).select("id", "key", F.posexplode(F.arrays_zip(*[f"line{i}" for i in range(length)])).alias("pos", "w"))
    both = [F.xxhash64(*[F.col(f"w.line{i}.{part}") for i in range(length)]).alias(part) for part in ("a", "b")]
    return exploded.select("id", "key", "pos", *both)


def remove_repeated_windows(
    docs: DataFrame, *, length: int = 3, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Documents without the later occurrences of repeated line windows.

    A window is ``length`` consecutive lines (split at ``\\n``, compared as they are).
    Its first occurrence, by id, text key and position, stays; the lines that any
    later one covers go. Returns the input's columns, the text cut, and
    ``n_lines`` and ``n_removed`` (which replace columns of these names).

    Empty table: empty. Null text: stays null with no lines. Empty text: one empty line.
    Fewer lines than ``length``: no window, unchanged. Null ids come first. Rows with
    equal id and text count as one document and are cut alike; copies under other ids
    lose their lines. Long texts and hot windows: one row per window, pre-aggregated,
    joined by window and summed up per document.
    """
    named = docs.select(column(doc_id).alias("id"), text_key(column(text)).alias("key"), F.split(column(text), "\n", -1).alias("lines"))
    windows = line_windows(named, length)
    place = F.struct("id", "key", "pos")
    repeated = (
        windows.groupBy("a", "b")
        .agg(F.min(place).alias("first"), F.max(place).alias("last"))
        .filter(~F.col("first").eqNullSafe(F.col("last")))
        .select("a", "b", "first")
    )
    later = windows.join(repeated, ["a", "b"]).filter(~place.eqNullSafe(F.col("first"))).select("id", "key", "pos").distinct()

    # Runs of windows that touch or overlap become one covered stretch of lines.
    by_place = Window.partitionBy("id", "key").orderBy("pos")
    opens = F.col("pos") > F.coalesce(F.lag("pos").over(by_place) + length, F.lit(-1))
    runs = later.withColumn("run", F.sum(opens.cast("int")).over(by_place)).groupBy("id", "key", "run").agg(
        F.min("pos").alias("start"), (F.max("pos") + length).alias("end")
    )
    covered = runs.groupBy("id", "key").agg(F.sort_array(F.collect_list(F.struct("start", "end"))).alias("covered")).select(
        F.col("id").alias("covered_id"), F.col("key").alias("covered_key"), "covered"
    )

    rows = opened(docs, id=column(doc_id), key=text_key(column(text)), text=column(text))
    rows = rows.join(covered, rows["id"].eqNullSafe(covered["covered_id"]) & (rows["key"] == covered["covered_key"]), "left")
    rows = rows.withColumn("lines", F.split("text", "\n", -1))
    n = F.coalesce(F.when(F.col("text").isNotNull(), F.size("lines")), F.lit(0))
    # What is kept lies between one stretch's end and the next one's start.
    starts = F.concat(F.array(F.lit(0)), F.transform("covered", lambda s: s["end"]))
    ends = F.concat(F.transform("covered", lambda s: s["start"]), F.array(n))
    parts = F.zip_with(starts, ends, lambda a, b: F.slice(F.col("lines"), a + 1, b - a))
    kept = F.when(F.col("covered").isNull(), F.col("text")).otherwise(F.array_join(F.flatten(parts), "\n"))
    removed = F.coalesce(F.aggregate("covered", F.lit(0), lambda a, s: a + s["end"] - s["start"]), F.lit(0))
    places_of = {c.lower(): i for i, c in enumerate(docs.columns)}
    rows = rows.withColumn(f"in{places_of[text.lower()]}", kept)
    return closed(rows, docs.columns, n_lines=n, n_removed=removed)
