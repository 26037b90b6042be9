"""Content and boilerplate lines by a linear-chain conditional random field.

Each line with a word has a few features. The field scores a text's label sequence by
feature weights per label and weights of neighbouring labels; it is fitted in numpy,
in one task, to a bounded sample of labelled texts. Their lines' labels are found by
expectation maximisation: a text's label holds for most of its words, not for each line.
Viterbi decoding marks the lines of every text, and the share of words that stand in
content lines decides whether it is kept, after fixed rules on words and repetitions.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .batches import NOT_SPACE, Words, byte_sums, mix, per_row, sequences, slices, spans
from .store import by_text, column, stored, text_key

CONTENT, BOILERPLATE = 0, 1
#: Labelled rows to learn from, at most, half of each label.
SAMPLE_ROWS = 2_000
#: Words of a window whose repetition counts.
REPEAT = 8
FEATURES = 11
#: The feature that holds the logarithm of a line's words.
LINE_WORDS = 1
MARKS = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, content_words long, labels array<tinyint>"

_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True
_UPPER = np.zeros(256, bool)
_UPPER[0x41:0x5B] = True
_LETTER = _UPPER.copy()
_LETTER[0x61:0x7B] = True
_DIGIT = np.zeros(256, bool)
_DIGIT[0x30:0x3A] = True
_SIGN = np.zeros(256, bool)
_SIGN[0x21:0x7F] = True
_SIGN &= ~(_LETTER | _DIGIT)
_SIGN[list(b".,;:?'\"()-")] = False


def repeated(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which keys occur twice or more, and which are not the first of their kind."""
    order = np.argsort(keys, kind="stable")
    same = np.zeros(len(keys), bool)
    same[1:] = keys[order[1:]] == keys[order[:-1]]
    either = same.copy()
    either[:-1] |= same[1:]
    often, later = np.zeros(len(keys), bool), np.zeros(len(keys), bool)
    often[order], later[order] = either, same
    return often, later


class Lines:
    """Words, lines with a word, and what the rules and the field need of them, per slice."""

    def __init__(self, texts: pa.Array):
        words = Words(texts, NOT_SPACE)
        raw, self.rows, self.n_words = words.raw, words.rows, words.counts
        hashes, row = words.hashes(), words.row

        def counted(kind: np.ndarray) -> np.ndarray:
            sums = np.zeros(len(raw) + 1, np.int64)
            np.cumsum(kind, out=sums[1:])
            return sums

        breaks = np.flatnonzero(raw == 0x0A)
        starts = np.unique(np.concatenate([words.offsets[:-1], breaks + 1]))
        line_of_word = np.searchsorted(starts, words.starts, "right") - 1
        used, first_word, line = np.unique(line_of_word, return_index=True, return_inverse=True)
        self.line_words = np.bincount(line, minlength=len(used))
        self.line_row = row[first_word]
        begin = starts[used]
        stop = np.append(breaks, len(raw))[np.searchsorted(breaks, begin)]
        stop = np.minimum(stop, words.offsets[1:][self.line_row])
        sums, back = byte_sums(raw)
        with np.errstate(over="ignore"):
            line_keys = spans(sums, back, begin, stop) + mix(self.line_row.astype(np.uint64), 7)
            grams = sequences(hashes, REPEAT)
            inside = np.flatnonzero(row[: len(grams)] == row[REPEAT - 1 :][: len(grams)])
            gram_keys = grams[inside] + mix(row[inside].astype(np.uint64), 11)
        dup_line = repeated(line_keys)[1]
        at = inside[repeated(gram_keys)[0]]
        cover = np.bincount(at, minlength=len(row) + 1) - np.bincount(at + REPEAT, minlength=len(row) + 1)[: len(row) + 1]
        repeat_word = np.cumsum(cover)[: len(row)] > 0

        chars = counted((raw & 0xC0) != 0x80)
        self.word_chars = per_row(chars[words.ends] - chars[words.starts], words.bounds)
        symbols = counted(_SYMBOL[raw])
        self.n_symbols = symbols[words.offsets[1:]] - symbols[words.offsets[:-1]]
        self.n_dup_lines = np.bincount(self.line_row[dup_line], minlength=self.rows)
        self.n_repeat_words = np.bincount(row[repeat_word], minlength=self.rows)

        def share(kind: np.ndarray, of: np.ndarray) -> np.ndarray:
            sums = counted(kind)
            return (sums[stop] - sums[begin]) / np.maximum(of, 1)

        letters = share(_LETTER[raw], np.ones(len(used)))
        size = np.maximum(stop - begin, 1)
        echo = np.zeros(len(row), bool)
        echo[1:] = (hashes[1:] == hashes[:-1]) & (line[1:] == line[:-1])
        last = raw[words.ends[np.append(first_word[1:], len(row))[: len(used)] - 1] - 1] if len(used) else raw[:0]
        n = np.maximum(self.line_words, 1)
        self.features = np.stack(
            [
                np.ones(len(used)),
                np.log1p(self.line_words) / 4,
                share(_UPPER[raw], letters),
                np.minimum(1, share(_SIGN[raw], n)),
                np.minimum(1, share(raw == 0x7C, n)),
                np.bincount(line[echo], minlength=len(used)) / n,
                dup_line,
                np.bincount(line[repeat_word], minlength=len(used)) / n,
                share(_DIGIT[raw], size),
                np.isin(last, list(b".!?")),
                self.line_words < 4,
            ],
            axis=1,
        ).astype(np.float64)
        self.line_bounds = np.searchsorted(self.line_row, np.arange(self.rows + 1))


def viterbi(scores: np.ndarray, bounds: np.ndarray, first: np.ndarray, between: np.ndarray) -> np.ndarray:
    """Best label of every line; all texts advance by a line at a time. Ties go to content."""
    sizes = np.diff(bounds)
    order = np.argsort(-sizes, kind="stable")
    order = order[sizes[order] > 0]
    labels = np.zeros(len(scores), np.int8)
    if not len(order):
        return labels
    starts, sizes = bounds[:-1][order], sizes[order]
    came = np.zeros((len(scores), 2), np.int8)
    state = scores[starts] + first
    best = np.zeros((len(order), 2))
    best[:] = state
    for t in range(1, int(sizes[0])):
        active = int(np.searchsorted(-sizes, -t, "left"))
        through = best[:active, :, None] + between[None]
        take = through[:, 1, :] > through[:, 0, :]
        at = starts[:active] + t
        came[at] = take
        best[:active] = np.where(take, through[:, 1, :], through[:, 0, :]) + scores[at]
    current = (best[:, 1] > best[:, 0]).astype(np.int8)
    labels[starts + sizes - 1] = current
    for t in range(int(sizes[0]) - 1, 0, -1):
        active = int(np.searchsorted(-sizes, -t, "left"))
        at = starts[:active] + t
        current[:active] = came[at, current[:active]]
        labels[at - 1] = current[:active]
    return labels


def likelihood(theta: np.ndarray, x: np.ndarray, y: np.ndarray, sizes: np.ndarray, decay: float) -> tuple[float, np.ndarray]:
    """Mean log likelihood of the texts' label sequences less the decay's penalty, and its gradient.

    Lines stand text by text, longest text first. A text counts alike whatever its length.
    """
    width = x.shape[1]
    starts = np.concatenate([[0], np.cumsum(sizes)])[:-1]
    text = np.repeat(np.arange(len(sizes)), sizes)
    weight = 1.0 / sizes
    of, first, between = theta[: 2 * width].reshape(2, width), theta[2 * width : 2 * width + 2], theta[2 * width + 2 :].reshape(2, 2)
    scores = x @ of.T
    alpha, beta = np.zeros_like(scores), np.zeros_like(scores)
    alpha[starts] = scores[starts] + first
    slope = np.zeros_like(theta)
    longest = int(sizes[0])
    for t in range(1, longest):
        at = starts[: int(np.searchsorted(-sizes, -t, "left"))] + t
        through = alpha[at - 1][:, :, None] + between[None]
        alpha[at] = np.logaddexp(through[:, 0], through[:, 1]) + scores[at]
    norm = np.logaddexp(alpha[starts + sizes - 1, 0], alpha[starts + sizes - 1, 1])
    for t in range(longest - 1, 0, -1):
        active = int(np.searchsorted(-sizes, -t, "left"))
        at = starts[:active] + t
        through = between[None] + (scores[at] + beta[at])[:, None, :]
        beta[at - 1] = np.logaddexp(through[:, :, 0], through[:, :, 1])
        pair = np.exp(alpha[at - 1][:, :, None] + through - norm[:active, None, None])
        slope[2 * width + 2 :] -= (pair * weight[:active, None, None]).sum(axis=0).reshape(-1)
    # What the given labels have, less what the field expects.
    surplus = np.eye(2)[y] - np.exp(alpha + beta - norm[text][:, None])
    slope[: 2 * width] = ((surplus * weight[text][:, None]).T @ x).reshape(-1)
    slope[2 * width : 2 * width + 2] = (surplus[starts] * weight[:, None]).sum(axis=0)
    later = np.flatnonzero(text[1:] == text[:-1]) + 1
    np.add.at(slope, 2 * width + 2 + 2 * y[later - 1] + y[later], weight[text[later]])
    path = np.bincount(text, weights=scores[np.arange(len(y)), y], minlength=len(sizes)) + first[y[starts]]
    path += np.bincount(text[later], weights=between[y[later - 1], y[later]], minlength=len(sizes))
    value = float(((path - norm) * weight).mean() - decay / 2 * theta @ theta)
    return value, slope / len(sizes) - decay * theta


def fit(features: list[np.ndarray], labels: list[np.ndarray], *, steps: int = 150, rate: float = 0.15, decay: float = 1e-3) -> np.ndarray:
    """Weights of features, first label and neighbours by gradient ascent, from a label per line."""
    order = np.argsort([-len(f) for f in features], kind="stable")
    sizes = np.array([len(features[i]) for i in order])
    x = np.concatenate([features[i] for i in order])
    y = np.concatenate([labels[i] for i in order])
    theta = np.zeros(2 * x.shape[1] + 2 + 4)
    moment, square = np.zeros_like(theta), np.zeros_like(theta)
    for step in range(1, steps + 1):
        slope = likelihood(theta, x, y, sizes, decay)[1]
        moment = 0.9 * moment + 0.1 * slope
        square = 0.99 * square + 0.01 * slope * slope
        theta += rate * (moment / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.99**step)) + 1e-8)
    return theta


def line_targets(features: list[np.ndarray], words: list[np.ndarray], of_text: np.ndarray, *, rounds: int = 4) -> list[np.ndarray]:
    """A label per line, by hard expectation maximisation under the texts' labels.

    Lines begin with their text's label. Each round fits a logistic model of single lines to
    the present labels; then in every text the lines that the model puts on the other side
    change over, the surest first, while less than half of the text's words do. So a good
    text may hold boilerplate lines, and a bad one content.
    """
    sizes = np.array([len(f) for f in features])
    x, n = np.concatenate(features), np.concatenate(words).astype(np.float64)
    text = np.repeat(np.arange(len(sizes)), sizes)
    own = of_text[text]
    half = np.bincount(text, weights=n, minlength=len(sizes)) / 2
    weight = 1.0 / sizes[text]
    weight = weight * np.where(own == CONTENT, 0.5 / max(weight[own == CONTENT].sum(), 1e-9), 0.5 / max(weight[own == BOILERPLATE].sum(), 1e-9))
    y = own.copy()
    for _ in range(rounds):
        away = np.where(own == CONTENT, 1.0, -1.0) * (x @ logistic(x, y, weight))
        order = np.lexsort((-away, text))
        moved = np.where(away > 0, n, 0.0)[order]
        total = np.cumsum(moved)
        before = np.concatenate([[0.0], total])[np.concatenate([[0], np.cumsum(sizes)])[:-1]]
        change = np.zeros(len(y), bool)
        change[order] = (away[order] > 0) & (total - before[text[order]] < half[text[order]])
        new = np.where(change, 1 - own, own)
        if (new == y).all():
            break
        y = new
    return np.split(y, np.cumsum(sizes)[:-1])


def logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, *, decay: float = 1e-3, steps: int = 12) -> np.ndarray:
    """Weights for label 1 by Newton's steps; ``weight`` of all lines adds up to one."""
    theta = np.zeros(x.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ theta, -30, 30)))
        slope = x.T @ (weight * (y - p)) - decay * theta
        theta += np.linalg.solve((x * (weight * p * (1 - p))[:, None]).T @ x + decay * np.eye(x.shape[1]), slope)
    return theta


def learned(docs: DataFrame, labels: DataFrame, *, doc_id: str, text: str, label: str, sample_rows: int) -> np.ndarray:
    """Fit the field to at most ``sample_rows`` labelled ids, chosen by a hash of the id, a text each.

    An id with several rows gives its smallest text that is not empty, whose copies meet before the shuffle.
    """
    known = labels.select(column(doc_id).alias("id"), column(label).cast("int").alias("label")).filter("id IS NOT NULL AND label IN (0, 1)")
    known = known.groupBy("id").agg(F.max("label").alias("label"))
    by_hash = [F.xxhash64(F.lit("sample"), "id"), F.col("id")]
    halves = [known.filter(F.col("label") == v).orderBy(*by_hash).limit(sample_rows // 2) for v in (0, 1)]
    chosen = stored(halves[0].unionByName(halves[1]), "sample")
    texts = docs.select(column(doc_id).alias("doc"), column(text).cast("string").alias("text"))
    rows = texts.join(F.broadcast(chosen), texts["doc"] == chosen["id"])
    rows = rows.groupBy("id", "label").agg(F.min(F.nullif("text", F.lit(""))).alias("text")).withColumn("id", F.col("id").cast("string"))

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text"):
            lines = Lines(part.column("text"))
            found = [lines.features[a:b].reshape(-1) for a, b in zip(lines.line_bounds[:-1], lines.line_bounds[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([part.column("id"), part.column("label"), pa.array(found, pa.list_(pa.float64()))], names=["id", "label", "features"])

    def train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = []
        for batch in batches:
            for name, good, values in zip(*[batch.column(c) for c in ("id", "label", "features")], strict=True):
                if len(values.values):
                    found.append((name.as_py(), good.as_py(), values.values.to_numpy().reshape(-1, FEATURES)))
        found.sort(key=lambda f: f[:2])
        # A low quality text's words are boilerplate for the most part.
        of_text = np.array([BOILERPLATE if f[1] == 0 else CONTENT for f in found], np.int64)
        theta = np.zeros(2 * FEATURES + 6)
        if len(set(of_text.tolist())) == 2:
            features = [f[2] for f in found]
            words = [np.expm1(4 * f[:, LINE_WORDS]) for f in features]
            theta = fit(features, line_targets(features, words, of_text))
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(theta))), pa.array(theta)], names=["at", "value"])

    described = rows.mapInArrow(describe, "id string, label int, features array<double>")
    theta = described.repartition(1).mapInArrow(train, "at long, value double").toPandas().drop_duplicates("at").sort_values("at")
    return theta["value"].to_numpy()


def label_lines(
    docs: DataFrame,
    labels: DataFrame,
    *,
    doc_id: str = "doc_id",
    text: str = "text",
    label: str = "quality",
    min_words: int = 20,
    max_repeat_percent: int = 30,
    min_content: float = 0.5,
    sample_rows: int = SAMPLE_ROWS,
) -> DataFrame:
    """Documents with their line labels and whether they are kept.

    Adds ``n_words``, ``word_chars`` (code points in words), ``n_symbols``,
    ``n_dup_lines`` (lines with a word, equal to an earlier one), ``n_repeat_words``
    (words in eight-word windows found twice), ``line_labels`` (0 content, 1
    boilerplate, per line with a word), ``content_share`` (of words), ``base_failed``
    (too few words or too much repetition) and ``kept`` (not failed, and the content
    share is at least ``min_content``). Columns of these names are replaced.

    Empty table: empty. Null and empty texts: no words, failed. Without rows of both
    labels every line is content. Ties go to content. Null ids are never learned from;
    conflicting labels: the higher one. Repeated rows and long texts: whole, by the text;
    learned from once per id, by its smallest text that is not empty.
    """
    spark = docs.sparkSession
    theta = spark.sparkContext.broadcast(learned(docs, labels, doc_id=doc_id, text=text, label=label, sample_rows=sample_rows))

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = theta.value[: 2 * FEATURES].reshape(2, FEATURES)
        first, between = theta.value[2 * FEATURES : 2 * FEATURES + 2], theta.value[2 * FEATURES + 2 :].reshape(2, 2)
        for part in slices(batches, "text"):
            lines = Lines(part.column("text"))
            found = viterbi(lines.features @ of.T, lines.line_bounds, first, between)
            content = np.bincount(lines.line_row, weights=lines.line_words * (found == CONTENT), minlength=lines.rows).astype(np.int64)
            columns = [lines.n_words, lines.word_chars, lines.n_symbols, lines.n_dup_lines, lines.n_repeat_words, content]
            yield pa.RecordBatch.from_arrays(
                [part.column("key"), *[pa.array(c.astype(np.int64)) for c in columns], pa.ListArray.from_arrays(pa.array(lines.line_bounds.astype(np.int32)), pa.array(found))],
                names=["key", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "content_words", "labels"],
            )

    texts = docs.select(text_key(column(text)).alias("key"), column(text).cast("string").alias("text"))
    marks = texts.mapInArrow(mark, f"key binary, {MARKS}")
    marks = marks.groupBy("key").agg(*[F.max(c).alias(c) for c in marks.columns[1:]])
    failed = (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > max_repeat_percent * F.col("n_words"))
    share = F.when(F.col("n_words") > 0, F.col("content_words") / F.col("n_words")).otherwise(0.0)
    counts = {c: F.col(c) for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")}
    return by_text(docs, marks, text, **counts, line_labels=F.col("labels"), content_share=share, base_failed=failed, kept=~failed & (share >= min_content))
