"""Quality by subword embeddings: hashed word and character n-gram vectors, averaged, softmax.

A text is the average of the vectors of its words, word pairs and the words' character
n-grams (by UTF-8 bytes, with word limits), each as often as it occurs. All are hashed into
buckets. Two equal words in a row are one pair, whatever the word, so that repetition is
learned once. Vectors and softmax are learned together by stochastic gradient descent in
numpy, in one task, on a bounded sample of labelled rows.

The softmax is linear, so a text's log odds are an average of one number per bucket; that
table, of fixed size, is what scoring broadcasts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .batches import NOT_SPACE, byte_sums, mix, spans
from .store import by_text, column, stored, text_key
from .stretches import Slice, sliced

#: Buckets of features, as a power of two.
BUCKET_BITS = 17
BUCKETS = 1 << BUCKET_BITS
GRAMS = (3, 4, 5)
#: Length of a vector.
WIDTH = 10
#: Passes over the sample.
EPOCHS = 5
#: Labelled rows to learn from, at most; of each label at most half.
SAMPLE_ROWS = 6_000
#: Buckets of a sampled text to learn from, at most: those of the highest counts.
SAMPLE_BUCKETS = 4_096
_PAIR = np.uint64(0x9E3779B97F4A7C15)


def _bucket(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> np.uint64(64 - BUCKET_BITS)).astype(np.int64)


class Features:
    """Buckets of a slice's distinct words with their n-grams, and where words and pairs stand."""

    def __init__(self, part: Slice):
        raw, edges = part.raw, part.bounds
        inside = np.zeros(len(raw) + 2, bool)
        inside[1:-1] = NOT_SPACE[raw]
        first = np.zeros(len(raw) + 1, bool)
        first[edges] = True
        starts = np.flatnonzero(inside[1:-1] & (~inside[:-2] | first[:-1]))
        ends = np.flatnonzero(inside[1:-1] & (~inside[2:] | first[1:])) + 1
        self.rows = len(edges) - 1
        self.row = np.searchsorted(edges, starts, "right") - 1
        hashes = spans(*byte_sums(raw), starts, ends)
        words, at, self.which = np.unique(hashes, return_index=True, return_inverse=True)
        self.owner, self.bucket = self._grams(raw, starts[at], ends[at], words)
        self.per_word = np.bincount(self.owner, minlength=len(words))
        same_row = self.row[1:] == self.row[:-1]
        self.pair_row = self.row[1:][same_row]
        left, right = hashes[:-1][same_row], hashes[1:][same_row]
        with np.errstate(over="ignore"):
            pair = np.where(left == right, np.uint64(1), left * _PAIR + right)
        self.pair = _bucket(mix(pair, 2))

    @staticmethod
    def _grams(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Words, by number, and their buckets: the whole word and its n-grams between limits."""
        sizes = ends - starts + 2
        limits = np.concatenate([[0], np.cumsum(sizes)])
        body = np.full(limits[-1], ord(" "), np.uint8)
        body[limits[1:] - 1] = ord("\n")
        body[np.repeat(limits[:-1] + 1 - np.cumsum(sizes - 2) + sizes - 2, sizes - 2) + np.arange(limits[-1] - 2 * len(starts))] = raw[
            np.repeat(starts - np.cumsum(sizes - 2) + sizes - 2, sizes - 2) + np.arange(limits[-1] - 2 * len(starts))
        ]
        sums, back = byte_sums(body)
        of = np.repeat(np.arange(len(starts)), sizes)
        stop = limits[1:][of]
        owner, bucket = [np.arange(len(starts))], [_bucket(mix(words, 1))]
        for n in GRAMS:
            at = np.flatnonzero(np.arange(len(body)) + n <= stop)
            owner.append(of[at])
            bucket.append(_bucket(spans(sums, back, at, at + n)))
        return np.concatenate(owner), np.concatenate(bucket)

    def sums(self, table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Per stretch the sum of the table's numbers over its features, and how many they are."""
        of_word = np.bincount(self.owner, weights=table[self.bucket], minlength=len(self.per_word))
        total = np.bincount(self.row, weights=of_word[self.which], minlength=self.rows)
        total += np.bincount(self.pair_row, weights=table[self.pair], minlength=self.rows)
        count = np.bincount(self.row, weights=self.per_word[self.which], minlength=self.rows)
        return total, count + np.bincount(self.pair_row, minlength=self.rows)

    def counts(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Distinct buckets of each stretch and how often each occurs."""
        order = np.argsort(self.owner, kind="stable")
        bucket, limits = self.bucket[order], np.concatenate([[0], np.cumsum(self.per_word)])
        words, pairs = np.searchsorted(self.row, np.arange(self.rows + 1)), np.searchsorted(self.pair_row, np.arange(self.rows + 1))
        for r in range(self.rows):
            word, times = np.unique(self.which[words[r] : words[r + 1]], return_counts=True)
            sizes = self.per_word[word]
            at = np.repeat(limits[word] - np.cumsum(sizes) + sizes, sizes) + np.arange(sizes.sum())
            all_ = np.concatenate([bucket[at], self.pair[pairs[r] : pairs[r + 1]]])
            weights = np.concatenate([np.repeat(times, sizes), np.ones(pairs[r + 1] - pairs[r], np.int64)])
            found, spot = np.unique(all_, return_inverse=True)
            yield found, np.bincount(spot, weights=weights, minlength=len(found))


def forward(vectors: np.ndarray, softmax: np.ndarray, bias: np.ndarray, bags: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Averages of the bags' vectors (a bag: buckets and shares) and the labels' probabilities."""
    mean = np.stack([share @ vectors[bucket] for bucket, share in bags])
    scores = mean @ softmax + bias
    odds = np.exp(scores - scores.max(axis=1, keepdims=True))
    return mean, odds / odds.sum(axis=1, keepdims=True)


def gradients(
    vectors: np.ndarray, softmax: np.ndarray, bias: np.ndarray, bags: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of the mean log loss: by buckets used (those first), softmax and bias."""
    mean, error = forward(vectors, softmax, bias, bags)
    error[np.arange(len(bags)), labels] -= 1
    error /= len(bags)
    back = error @ softmax.T
    used, spot = np.unique(np.concatenate([bucket for bucket, _ in bags]), return_inverse=True)
    share = np.concatenate([s for _, s in bags])
    row = np.repeat(np.arange(len(bags)), [len(b) for b, _ in bags])
    of_vectors = np.stack([np.bincount(spot, weights=share * back[row, d], minlength=len(used)) for d in range(vectors.shape[1])], axis=1)
    return used, of_vectors, mean.T @ error, error.sum(axis=0)


def train(
    bags: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, *, epochs: int = EPOCHS, batch: int = 16, rate: float = 1.0, seed: int = 12
) -> tuple[np.ndarray, float]:
    """Fit vectors and softmax; returns a number per bucket and the bias, as log odds of label 1.

    Each bucket's step is divided by the root of its squared gradients so far (AdaGrad), so
    that what occurs in few texts is learned as well as what occurs in all.
    """
    rng = np.random.default_rng(seed)
    vectors = rng.normal(0, 0.01, (BUCKETS, WIDTH)).astype(np.float32)
    softmax = rng.normal(0, 1, (WIDTH, 2)).astype(np.float32)
    bias = np.zeros(2, np.float32)
    seen = [np.full(BUCKETS, 1e-8, np.float32), np.full(softmax.shape, 1e-8, np.float32), np.full(2, 1e-8, np.float32)]
    total = epochs * (-(-len(bags) // batch))
    step = 0
    for _ in range(epochs):
        order = rng.permutation(len(bags))
        for at in range(0, len(order), batch):
            chosen = order[at : at + batch]
            pace = np.float32(rate * (1 - step / total))
            step += 1
            used, of_vectors, of_softmax, of_bias = gradients(vectors, softmax, bias, [bags[i] for i in chosen], labels[chosen])
            seen[0][used] += (of_vectors**2).mean(axis=1)
            vectors[used] -= pace * of_vectors / np.sqrt(seen[0][used])[:, None]
            for i, (weights, change) in enumerate(((softmax, of_softmax), (bias, of_bias)), 1):
                seen[i] += change**2
                weights -= np.float32(0.1) * pace * change / np.sqrt(seen[i])
    return (vectors @ (softmax[:, 1] - softmax[:, 0])).astype(np.float64), float(bias[1] - bias[0])


def _blank(raw: np.ndarray) -> np.ndarray:
    return ~NOT_SPACE[raw]


def _sample(docs: DataFrame, labels: DataFrame, training: Column, *, doc_id: str, text: str, label: str, rows: int) -> DataFrame:
    """``(id, label, text)`` of at most ``rows`` labelled ids, half of each label, by a hash of the id, a text each."""
    known = labels.select(column(doc_id).alias("id"), column(label).cast("int").alias("label"))
    known = known.filter("id IS NOT NULL AND label IN (0, 1)").groupBy("id").agg(F.min("label").alias("label"))
    learn = docs.filter(F.coalesce(training, F.lit(False))).select(column(doc_id).alias("doc"), column(text).cast("string").alias("text"))
    known = known.join(learn.select(F.col("doc").alias("id")).distinct(), "id", "left_semi")
    by_hash = [F.xxhash64(F.lit("quality"), "id"), F.col("id")]
    parts = [known.filter(F.col("label") == value).orderBy(*by_hash).limit(rows // 2) for value in (0, 1)]
    chosen = stored(parts[0].unionByName(parts[1]), "quality-sample")
    # Copies of an id meet before the shuffle; at most ``rows`` ids are broadcast.
    texts = learn.join(F.broadcast(chosen), learn["doc"] == chosen["id"])
    return texts.groupBy("id", "label").agg(F.min(F.nullif("text", F.lit(""))).alias("text"))


def _largest(parts: list[tuple[np.ndarray, np.ndarray]], limit: int) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of a text's stretches with the highest counts, and their shares of all."""
    bucket, spot = np.unique(np.concatenate([b for b, _ in parts]), return_inverse=True)
    counts = np.bincount(spot, weights=np.concatenate([n for _, n in parts]), minlength=len(bucket))
    kept = np.sort(np.argsort(-counts, kind="stable")[:limit])
    return bucket[kept].astype(np.int32), (counts[kept] / max(1.0, counts.sum())).astype(np.float32)


def fit(docs: DataFrame, labels: DataFrame, training: Column, *, doc_id: str, text: str, label: str, sample_rows: int, epochs: int) -> tuple[np.ndarray, float]:
    rows = _sample(docs, labels, training, doc_id=doc_id, text=text, label=label, rows=sample_rows)

    def bags(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts, found = [], []
            for piece in sliced(batch.column("text"), _blank):
                for last, counts in zip(piece.last.tolist(), Features(piece).counts(), strict=True):
                    parts.append(counts)
                    if last:
                        found.append(_largest(parts, SAMPLE_BUCKETS))
                        parts = []
                    elif len(parts) > 64:
                        bucket, spot = np.unique(np.concatenate([b for b, _ in parts]), return_inverse=True)
                        parts = [(bucket, np.bincount(spot, weights=np.concatenate([n for _, n in parts])))]
            yield pa.RecordBatch.from_arrays(
                [pa.array([str(i) for i in batch.column("id").to_pylist()]), batch.column("label"),
                 pa.array([b for b, _ in found], pa.list_(pa.int32())), pa.array([s for _, s in found], pa.list_(pa.float32()))],
                names=["id", "label", "buckets", "shares"],
            )

    def learned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = []
        for batch in batches:
            for i, label_, bucket, share in zip(*[batch.column(c) for c in ("id", "label", "buckets", "shares")], strict=True):
                found.append((i.as_py(), label_.as_py(), bucket.values.to_numpy(), share.values.to_numpy()))
        found.sort(key=lambda x: x[:2])
        known = np.array([x[1] for x in found], np.int64)
        ones = int(known.sum())
        table, bias = np.zeros(BUCKETS), float(np.log((ones + 1) / (len(known) - ones + 1)))
        if 0 < ones < len(known):
            table, bias = train([x[2:] for x in found], known, epochs=epochs)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(np.arange(BUCKETS), -1)), pa.array(np.append(table, bias))], names=["bucket", "value"])

    bagged = rows.mapInArrow(bags, "id string, label int, buckets array<int>, shares array<float>")
    model = bagged.repartition(1).mapInArrow(learned, "bucket long, value double").toPandas().drop_duplicates("bucket").sort_values("bucket")
    values = model["value"].to_numpy()
    return (values[1:], float(values[0])) if len(values) else (np.zeros(BUCKETS), 0.0)


def quality_scores(
    docs: DataFrame,
    labels: DataFrame,
    training: Column,
    *,
    doc_id: str = "doc_id",
    text: str = "text",
    label: str = "quality",
    threshold: float = 0.7,
    sample_rows: int = SAMPLE_ROWS,
    epochs: int = EPOCHS,
) -> DataFrame:
    """Documents with ``quality_score`` (0 to 1, the probability of label 1) and ``good`` (1 from ``threshold`` up).

    Learns from labelled rows that ``training``, a column of ``docs``, chooses: at most
    ``sample_rows`` ids, half of each label, each by its smallest text that is not empty and the
    ``SAMPLE_BUCKETS`` most frequent features of it. All texts are scored by all their features;
    only the text is an input of a score. Returns the input's columns and the two, which replace
    columns of these names.

    Empty table: empty. Null and empty texts, and texts of white space: by the bias alone. No
    labelled rows, or of one label only: the share of label 1 with one row of each label added.
    Null labels: none; of conflicting ones the lower holds. Null ids are never learned from.
    Repeated rows: each by its text, learned from once per id. Long texts: whole, in stretches cut
    at white space; the pair of words at a cut is not counted.
    """
    table, bias = fit(docs, labels, training, doc_id=doc_id, text=text, label=label, sample_rows=sample_rows, epochs=epochs)
    model = docs.sparkSession.sparkContext.broadcast(table)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            total, count = np.zeros(batch.num_rows), np.zeros(batch.num_rows)
            for piece in sliced(batch.column("text"), _blank):
                for into, values in zip((total, count), Features(piece).sums(model.value), strict=True):
                    into += np.bincount(piece.rows, weights=values, minlength=batch.num_rows)
            odds = np.clip(total / np.maximum(count, 1) + bias, -500, 500)
            yield pa.RecordBatch.from_arrays([batch.column("key"), pa.array(1 / (1 + np.exp(-odds)))], names=["key", "score"])

    texts = docs.select(text_key(column(text)).alias("key"), column(text).cast("string").alias("text"))
    scores = texts.mapInArrow(score, "key binary, score double").groupBy("key").agg(F.max("score").alias("score"))
    return by_text(docs, scores, text, quality_score=F.col("score"), good=(F.col("score") >= threshold).cast("int"))
