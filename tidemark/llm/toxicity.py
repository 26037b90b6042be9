"""Toxicity by subword bags: averaged n-gram vectors into a linear softmax.

A word is a bag of its character n-grams (by UTF-8 bytes, with word limits) and itself,
hashed into buckets. A text's vector is the average over its distinct words' bags.
Vectors and softmax are trained together, in numpy, on a bounded sample of labelled
rows, in one task. A misspelt word shares n-grams with the word as trained.

As the softmax is linear, the average of vectors times weights is the average of one
number per bucket; that table, of fixed size, is what scoring broadcasts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .batches import NOT_SPACE, Words, byte_sums, slices, spans
from .store import by_text, column, stored, text_key

#: Buckets of n-grams, as a power of two.
BUCKET_BITS = 17
GRAMS = (3, 4, 5)
#: N-grams with a vector of nought that every text has besides, so that a few words alone decide little.
NEUTRAL = 400
#: Factor on a text's averaged vector.
SCALE = np.float32(100.0)
#: Length of a vector.
WIDTH = 8
#: Labelled rows to learn from, at most, a third of them toxic.
SAMPLE_ROWS = 6_000
#: Spread of untrained vectors: an n-gram never seen hardly moves a text.
START = 1e-4


class Bags:
    """N-gram buckets of a slice's distinct words, and which word stands where."""

    def __init__(self, texts: pa.Array):
        words = Words(texts, NOT_SPACE, lower=True)
        hashes, self.first, self.which, _ = np.unique(words.hashes(), return_index=True, return_inverse=True, return_counts=True)
        self.rows, self.bounds = words.rows, words.bounds
        starts, ends = words.starts[self.first], words.ends[self.first]
        sizes = ends - starts + 2
        offsets = np.concatenate([[0], np.cumsum(sizes)])
        body = np.empty(offsets[-1], np.uint8)
        body[offsets[:-1]], body[offsets[1:] - 1] = ord(" "), ord("\n")
        inner = np.ones(len(body), bool)
        inner[offsets[:-1]] = inner[offsets[1:] - 1] = False
        body[inner] = words.raw[np.repeat(starts - np.cumsum(sizes - 2) + sizes - 2, sizes - 2) + np.arange(offsets[-1] - 2 * len(starts))]
        sums, back = byte_sums(body)
        owner, bucket = [np.arange(len(starts))], [hashes]
        of = np.repeat(np.arange(len(starts)), sizes)
        for n in GRAMS:
            at = np.flatnonzero(np.arange(len(body)) + n <= offsets[1:][of]) if len(of) else np.zeros(0, np.int64)
            owner.append(of[at])
            bucket.append(spans(sums, back, at, at + n))
        self.owner = np.concatenate(owner)
        self.bucket = (np.concatenate(bucket) >> np.uint64(64 - BUCKET_BITS)).astype(np.int64)
        self.grams = np.bincount(self.owner, minlength=len(starts))

        # Each distinct word of a text once: a text that repeats a word is no stronger case.
        row = np.repeat(np.arange(self.rows), np.diff(self.bounds))
        pairs = np.unique(row * max(1, len(self.first)) + self.which)
        self.row, self.word = np.divmod(pairs, max(1, len(self.first)))

    def averages(self, table: np.ndarray) -> np.ndarray:
        """Average over each text's n-grams and the neutral ones of the table's numbers."""
        of_word = np.bincount(self.owner, weights=table[self.bucket], minlength=len(self.first))
        total = np.bincount(self.row, weights=of_word[self.word], minlength=self.rows)
        grams = np.bincount(self.row, weights=self.grams[self.word], minlength=self.rows)
        return total / (grams + NEUTRAL)

    def frequencies(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Distinct buckets of each text and their shares."""
        order = np.argsort(self.owner, kind="stable")
        bucket = self.bucket[order]
        limits = np.concatenate([[0], np.cumsum(self.grams)])
        bounds = np.searchsorted(self.row, np.arange(self.rows + 1))
        for r in range(self.rows):
            words = self.word[bounds[r] : bounds[r + 1]]
            sizes = self.grams[words]
            at = np.repeat(limits[words] - np.cumsum(sizes) + sizes, sizes) + np.arange(sizes.sum())
            used, times = np.unique(bucket[at], return_counts=True)
            yield used, times / (sizes.sum() + NEUTRAL)


def train(
    bags: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, *, steps: int = 2_000, batch: int = 32, rate: float = 8.0, seed: int = 5
) -> tuple[np.ndarray, float]:
    """Fit n-gram vectors and softmax by stochastic gradient descent; returns a number per bucket and the bias, as log odds."""
    rng = np.random.default_rng(seed)
    size = 1 << BUCKET_BITS
    vectors = rng.normal(0, START, (size, WIDTH)).astype(np.float32)
    softmax = rng.normal(0, 1, (WIDTH, 2)).astype(np.float32)
    bias = np.zeros(2, np.float32)
    order = rng.permutation(len(bags))
    for step in range(steps):
        pace = rate * (1 - step / steps)
        if len(order) < batch:
            order = np.concatenate([order, rng.permutation(len(bags))])
        chosen, order = order[:batch], order[batch:]
        bucket = np.concatenate([bags[i][0] for i in chosen])
        share = np.concatenate([bags[i][1] for i in chosen]).astype(np.float32)
        row = np.repeat(np.arange(len(chosen)), [len(bags[i][0]) for i in chosen])
        used, spot = np.unique(bucket, return_inverse=True)
        mean = np.stack([np.bincount(row, weights=share * vectors[bucket, d], minlength=len(chosen)) for d in range(WIDTH)], axis=1).astype(np.float32)
        # Averages of many n-grams are small; a fixed factor brings them to unit scale.
        scores = SCALE * mean @ softmax + bias
        odds = np.exp(scores - scores.max(axis=1, keepdims=True))
        odds /= odds.sum(axis=1, keepdims=True)
        odds[np.arange(len(chosen)), labels[chosen]] -= 1
        odds /= len(chosen)
        back = SCALE * odds @ softmax.T
        of_vectors = np.stack([np.bincount(spot, weights=share * back[row, d], minlength=len(used)) for d in range(WIDTH)], axis=1).astype(np.float32)
        # Plain steps: an n-gram moves by its share of the text, so rare ones stay near nothing.
        vectors[used] -= pace * of_vectors
        softmax -= 0.01 * pace * SCALE * mean.T @ odds
        bias -= 0.01 * pace * odds.sum(axis=0)
    return SCALE * (vectors @ (softmax[:, 1] - softmax[:, 0])).astype(np.float64), float(bias[1] - bias[0])


def fit(docs: DataFrame, labels: DataFrame, training: Column, *, doc_id: str, text: str, label: str, sample_rows: int, steps: int) -> tuple[np.ndarray, float]:
    """Train on at most ``sample_rows`` labelled ids of ``training``, chosen by a hash of the id, a text each.

    An id with several rows gives its smallest text that is not empty, whose copies meet before the shuffle.
    """
    known = labels.select(column(doc_id).alias("id"), column(label).cast("int").alias("label")).filter("id IS NOT NULL AND label IN (0, 1)")
    known = known.groupBy("id").agg(F.max("label").alias("label"))
    learn = docs.filter(F.coalesce(training, F.lit(False))).select(column(doc_id).alias("doc"), column(text).cast("string").alias("text"))
    known = known.join(learn.select(F.col("doc").alias("id")).distinct(), "id", "left_semi")
    by_hash = [F.xxhash64(F.lit("sample"), "id"), F.col("id")]
    toxic = known.filter("label = 1").orderBy(*by_hash).limit(sample_rows // 3)
    clean = known.filter("label = 0").orderBy(*by_hash).limit(sample_rows - sample_rows // 3)
    chosen = stored(toxic.unionByName(clean), "sample")
    rows = learn.join(F.broadcast(chosen), learn["doc"] == chosen["id"])
    rows = rows.groupBy("id", "label").agg(F.min(F.nullif("text", F.lit(""))).alias("text"))

    def bags(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text"):
            buckets, shares = zip(*Bags(part.column("text")).frequencies(), strict=True)
            yield pa.RecordBatch.from_arrays(
                [part.column("id"), part.column("label"), pa.array(list(buckets), pa.list_(pa.int32())), pa.array([s.astype(np.float32) for s in shares], pa.list_(pa.float32()))],
                names=["id", "label", "buckets", "shares"],
            )

    kind = rows.schema["id"].dataType.simpleString()
    bagged = rows.mapInArrow(bags, f"id {kind}, label int, buckets array<int>, shares array<float>")

    def learned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = []
        for batch in batches:
            for i, label, buckets, shares in zip(*[batch.column(c) for c in ("id", "label", "buckets", "shares")], strict=True):
                found.append((str(i.as_py()), label.as_py(), buckets.values.to_numpy(zero_copy_only=False), shares.values.to_numpy(zero_copy_only=False)))
        found.sort(key=lambda x: x[:2])
        known = np.array([x[1] for x in found], np.int64)
        table, bias = np.zeros(1 << BUCKET_BITS), 0.0
        if len(set(known.tolist())) == 2:
            table, bias = train([x[2:] for x in found], known, steps=steps)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(np.arange(len(table)), -1)), pa.array(np.append(table, bias))], names=["bucket", "value"])

    model = bagged.repartition(1).mapInArrow(learned, "bucket long, value double").toPandas().drop_duplicates("bucket").sort_values("bucket")
    values = model["value"].to_numpy()
    return values[1:], float(values[0])


def toxicity_scores(
    docs: DataFrame,
    labels: DataFrame,
    training: Column,
    *,
    doc_id: str = "doc_id",
    text: str = "text",
    label: str = "toxic",
    sample_rows: int = SAMPLE_ROWS,
    steps: int = 2_000,
) -> DataFrame:
    """Documents with ``toxic_score`` (0 to 1) and ``toxic`` (1 from 0.5 up).

    Learns from labelled rows that ``training``, a column of ``docs``, chooses: at most
    ``sample_rows``, a third of them toxic, and one per id, the smallest text that is not
    empty. Only the text is an input of a score. Returns the input's columns and the two,
    which replace columns of these names.

    Empty table: empty. Null and empty texts: the bias alone, toxic only if it says so.
    No labelled rows, or rows of one label only: every score is 0.5 less a hair, not toxic.
    Null and conflicting labels: no label; the higher one. Null ids are never learned from.
    Repeated rows and long texts: whole, each by its text; learned from once per id.
    """
    spark = docs.sparkSession
    table, bias = fit(docs, labels, training, doc_id=doc_id, text=text, label=label, sample_rows=sample_rows, steps=steps)
    if not table.any():
        bias = -1e-9
    model = spark.sparkContext.broadcast(table)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text"):
            odds = Bags(part.column("text")).averages(model.value) + bias
            kept = [part.column(i) for i in range(part.num_columns - 1)]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(1 / (1 + np.exp(-np.clip(odds, -500, 500))))], names=[*part.schema.names[:-1], "score"])

    texts = docs.select(text_key(column(text)).alias("key"), column(text).cast("string").alias("text"))
    scores = texts.mapInArrow(score, "key binary, score double").groupBy("key").agg(F.first("score").alias("score"))
    return by_text(docs, scores, text, toxic_score=F.col("score"), toxic=(F.col("score") >= 0.5).cast("int"))
