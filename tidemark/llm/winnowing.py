"""Find benchmark passages in documents by winnowing.

Of every window of consecutive words the smallest k-gram hash is kept as a
fingerprint, so two texts that share a whole window share one. Documents pass a bit
map of the benchmark's fingerprints; the whole windows around those that pass are
joined with the benchmark's, and those that agree are merged to passages.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .batches import ALPHANUMERIC, Words, mix, sequences, slices
from .store import BitMap, by_text, column, looked_up, shared_map, stored, text_key

FINGERPRINTS = pa.list_(pa.struct([("print", pa.int64()), ("at", pa.int32()), ("around", pa.list_(pa.int64()))]))
FOUND = "key binary, n_words long, prints array<struct<print: long, at: int, around: array<long>>>"


def gram(window: int) -> int:
    """Words of a fingerprint's k-gram for windows of so many words."""
    return (window + 1) // 2


def winnow(hashes: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash and place of the smallest k-gram of every window, the leftmost of equals."""
    k = gram(window)
    grams = mix(sequences(hashes, k), window)
    n = max(0, len(hashes) - window + 1)
    least, place = grams[:n].copy(), np.arange(n)
    for i in range(1, window - k + 1):
        other = grams[i : i + n]
        less = other < least
        least[less] = other[less]
        place[less] = np.flatnonzero(less) + i
    return least, place


def surroundings(hashes: np.ndarray, places: np.ndarray, low: np.ndarray, high: np.ndarray, window: int) -> np.ndarray:
    """Word hashes from ``window - k`` before each place to as many after its k-gram; 0 beyond the text."""
    k = gram(window)
    at = places[:, None] + np.arange(k - window, window)[None, :]
    inside = (at >= low[:, None]) & (at < high[:, None])
    return np.where(inside, hashes[np.clip(at, 0, max(0, len(hashes) - 1))], np.uint64(0))


def fingerprints(windows: list[int], bits: BitMap | None, whole_below: int | None):
    """Per row its words and fingerprints; ``whole_below`` makes a shorter text one window."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text"):
            words = Words(part.column("text"), ALPHANUMERIC, lower=True)
            hashes, row = words.hashes(), words.row
            rows, prints, places, around = [], [], [], []
            for window in windows:
                least, place = winnow(hashes, window)
                whole = row[: len(place)] == row[window - 1 : window - 1 + len(place)]
                if whole_below is not None and window < whole_below:
                    whole &= words.counts[row[: len(place)]] == window
                if bits is not None:
                    whole &= bits.have(least)
                chosen, first = np.unique(place[whole], return_index=True)
                if not len(chosen):
                    continue
                at = row[chosen]
                rows.append(at)
                prints.append(least[whole][first])
                places.append(chosen - words.bounds[at])
                around += list(surroundings(hashes, chosen, words.bounds[at], words.bounds[at + 1], window).view(np.int64))
            counts = np.zeros(words.rows + 1, np.int32)
            if rows:
                at = np.concatenate(rows)
                order = np.argsort(at, kind="stable")
                np.cumsum(np.bincount(at, minlength=words.rows), out=counts[1:])
                values = pa.StructArray.from_arrays(
                    [
                        pa.array(np.concatenate(prints)[order].view(np.int64)),
                        pa.array(np.concatenate(places)[order].astype(np.int32)),
                        pa.array([around[i] for i in order], pa.list_(pa.int64())),
                    ],
                    fields=list(FINGERPRINTS.value_type),
                )
            else:
                values = pa.array([], FINGERPRINTS.value_type)
            yield pa.RecordBatch.from_arrays(
                [part.column("key"), pa.array(words.counts.astype(np.int64)), pa.ListArray.from_arrays(pa.array(counts), values)],
                names=["key", "n_words", "prints"],
            )

    return run


def windows_around(around: Column, lengths: list[int]) -> Column:
    """The whole windows with a fingerprint's k-gram in them, as ``(shift, n, window)``: its place less the window's, its words, 128 bits for these."""

    def of(n: int) -> Column:
        def one(shift: Column) -> Column:
            words = F.slice(around, F.lit(n - gram(n) + 1) - shift, n)
            hashed = F.struct(F.xxhash64(words).alias("h0"), F.xxhash64(F.lit("window"), words).alias("h1"))
            return F.struct(shift.alias("shift"), F.lit(n).alias("n"), F.when(~F.array_contains(words, F.lit(0).cast("long")), hashed).alias("window"))

        return F.transform(F.sequence(F.lit(0), F.lit(n - gram(n))), one)

    found = F.lit(None)
    for n in lengths:
        found = F.when(F.size(around) == 2 * n - gram(n), of(n)).otherwise(found)
    return F.filter(found, lambda w: w["window"].isNotNull())


def find_passages(
    docs: DataFrame,
    benchmark: DataFrame,
    *,
    window: int = 10,
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
) -> DataFrame:
    """Documents with the benchmark passages in them.

    Words are runs of ASCII letters (A-Z as a-z) and digits and of characters beyond
    ASCII. A passage is ``window`` consecutive words of an item, or all words of a
    shorter one. Returns the input's columns and ``n_words``, ``n_hit`` (words inside
    any occurrence), ``hits`` (their merged ``[start, end)`` word spans), ``items``
    (sorted ids, as text, of items with an occurrence) and ``contaminated``, replacing
    columns of these names.

    Empty documents: empty; empty benchmark: no hits. Null and empty texts: no words, no
    hits; such items are nothing to find. Null item ids: found and counted as hits, not
    listed. Repeated items or rows: each row gets the marks of its text. Long texts are
    searched whole, an Arrow slice at a time.
    """
    items = benchmark.select(column(item_id).cast("string").alias("item"), text_key(column(item_text)).alias("key"), column(item_text).cast("string").alias("text"))
    lengths = list(range(1, window + 1))
    prints = items.select("key", "text").dropDuplicates(["key"]).mapInArrow(fingerprints(lengths, None, window), FOUND)
    prints = stored(prints.select("key", F.explode("prints").alias("p")).select("key", "p.*"), "benchmark")
    # An item's windows are all of one length, told by the surroundings' length 2 * window - k.
    known = {2 * n - gram(n): n for n in lengths}
    present = sorted(known[r[0]] for r in prints.select(F.size("around")).distinct().collect())
    # The map only saves joins: fingerprints that pass it are compared in full.
    search = fingerprints(present, shared_map(prints.select(F.col("print").alias("bits"))), None)
    named = docs.select(text_key(column(text)).alias("key"), column(text).cast("string").alias("text"))
    found = stored(named.mapInArrow(search, FOUND), "fingerprints")
    # Whole windows meet, not pairs of fingerprints: a document's window makes one row, however many items have it.
    if present:
        theirs = prints.select(F.col("key").alias("item_key"), F.explode(windows_around(F.col("around"), present)).alias("w"))
        theirs = stored(theirs.select("w.window", "item_key").distinct(), "windows")
        # Windows of the same items are named alike, by hashes that add up in any order.
        alike = F.struct(F.bit_xor(F.xxhash64("item_key")).alias("h0"), F.bit_xor(F.xxhash64(F.lit("items"), "item_key")).alias("h1"))
        named_windows = stored(theirs.groupBy("window").agg(alike.alias("item_set")), "sets")
        members = stored(theirs.join(named_windows, "window").select("item_set", "item_key").distinct(), "members")
        ours = found.select("key", F.explode("prints").alias("p")).select("key", "p.at", F.explode(windows_around(F.col("p.around"), present)).alias("w"))
        ours = ours.select("key", (F.col("at") - F.col("w.shift")).alias("start"), F.col("w.n").alias("n"), F.col("w.window").alias("window"))
        met = looked_up(ours, named_windows, "window", F.struct("key", "start")).filter(F.col("item_set").isNotNull())
        hits = met.select("key", "item_set", "start", (F.col("start") + F.col("n")).alias("end"))
    else:
        members = items.limit(0).select(F.lit("").alias("item_set"), F.col("key").alias("item_key"))
        hits = found.limit(0).select("key", F.lit("").alias("item_set"), F.lit(0).alias("start"), F.lit(0).alias("end"))
    hits = stored(hits.distinct(), "hits")

    def merge(spans: Column, span: Column) -> Column:
        last = F.element_at(spans, -1)
        wider = F.struct(last["start"].alias("start"), F.greatest(last["end"], span["end"]).alias("end"))
        return F.when((F.size(spans) > 0) & (span["start"] <= F.get(spans, F.size(spans) - 1)["end"]), F.concat(F.slice(spans, 1, F.greatest(F.size(spans) - 1, F.lit(0))), F.array(wider))).otherwise(
            F.concat(spans, F.array(span))
        )

    no_span = F.expr("CAST(array() AS array<struct<start: int, end: int>>)")
    spans = hits.groupBy("key").agg(F.sort_array(F.collect_set(F.struct("start", "end"))).alias("spans")).select(
        "key", F.aggregate("spans", no_span, merge).alias("hits")
    )
    listed = items.select(F.col("key").alias("item_key"), "item").filter("item IS NOT NULL").distinct()
    named_items = hits.select("key", "item_set").distinct().join(members, "item_set").select("key", "item_key").distinct().join(listed, "item_key").groupBy("key").agg(F.sort_array(F.collect_set("item")).alias("items"))
    marks = found.groupBy("key").agg(F.max("n_words").alias("n_words")).join(spans, "key", "left").join(named_items, "key", "left")
    n_hit = F.coalesce(F.aggregate("hits", F.lit(0), lambda n, s: n + s["end"] - s["start"]), F.lit(0)).cast("long")
    return by_text(
        docs,
        marks,
        text,
        n_words=F.col("n_words"),
        n_hit=n_hit,
        hits=F.coalesce("hits", no_span),
        items=F.coalesce("items", F.array().cast("array<string>")),
        contaminated=n_hit > 0,
    )
