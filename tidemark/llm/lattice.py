"""Document likelihood under a subword vocabulary, summed over all segmentations.

A text is words and one end. A word, with the vocabulary's word mark before it, is
any sequence of pieces whose bytes are the word's; every sequence counts with the
product of its pieces' probabilities. The forward recursion adds them up in log space,
once per distinct word, for words are separated by white space and no piece spans it.

Scores of the vocabulary that are log probabilities are taken as they are. Where they
only rank the pieces, as a byte-pair vocabulary's do, probabilities start from that order
and are fitted to the training documents by expected counts, from a forward and a
backward recursion. The pieces stay as they are.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .batches import NOT_SPACE, Words, buffers, byte_sums, spans
from .frequencies import HEAD, distinct_words, summed
from .store import by_text, column, stored, text_key

#: The word mark of the vocabulary, in UTF-8.
MARK = "▁".encode()
#: Words whose lattices are worked on at once, times their length in bytes.
LATTICE_CELLS = 200_000
#: Words of more bytes have a lattice each, of the pieces that match.
LONG_WORD = 256
#: Edges of a long word's lattice that are Python numbers at a time.
EDGES = 1 << 16
#: Log probabilities of a vocabulary may add up to so much more than one, for rounding.
SLACK = 1e-3
#: How far below the lowest score a byte lies that no piece holds alone.
UNKNOWN = 10.0
#: Words gathered from Arrow batches before their lattices are made, for long arrays.
GATHERED = 100_000
#: Leading bits of a hash that tell most stretches which are no piece.
SEEN_BITS = 20
#: Expected counts are added up as integers of this part, so that sums don't depend on order.
UNIT = 2.0**-20


class Vocabulary:
    """Pieces as bytes, sorted by hash, with their log probabilities."""

    def __init__(self, pieces: list[bytes], log_p: np.ndarray):
        self.log_p = log_p
        raw = np.frombuffer(b"".join(pieces), np.uint8)
        ends = np.cumsum([len(p) for p in pieces])
        starts = np.concatenate([[0], ends[:-1]])
        hashes = spans(*byte_sums(raw), starts, ends)
        self.order = np.argsort(hashes)
        self.hashes = hashes[self.order]
        self.seen = np.zeros(1 << SEEN_BITS, bool)
        self.seen[(hashes >> np.uint64(64 - SEEN_BITS)).astype(np.int64)] = True
        lengths = ends - starts
        self.lengths = sorted(set(lengths.tolist()))

    def edges(self, sums: np.ndarray, back: np.ndarray, starts: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
        """Which of the stretches are pieces, and which pieces."""
        found = spans(sums, back, starts, starts + length)
        maybe = np.flatnonzero(self.seen[(found >> np.uint64(64 - SEEN_BITS)).astype(np.int64)])
        found = found[maybe]
        spot = np.minimum(np.searchsorted(self.hashes, found), len(self.hashes) - 1)
        same = self.hashes[spot] == found
        return maybe[same], self.order[spot[same]]


def pieces_of(model: bytes) -> tuple[list[bytes], np.ndarray]:
    """Pieces of a ``sentencepiece`` model as bytes, by falling score, and their scores.

    Byte pieces stand for their byte and come last, without a score (NaN); control pieces are left out.
    """
    from sentencepiece import SentencePieceProcessor

    processor = SentencePieceProcessor(model_proto=model)
    scored, single = [], []
    for i in range(processor.get_piece_size()):
        if processor.is_control(i) or processor.is_unknown(i) or processor.is_unused(i):
            continue
        name = processor.id_to_piece(i)
        if processor.is_byte(i):
            single.append(bytes([int(name[3:5], 16)]))
        else:
            scored.append((-processor.get_score(i), name.encode()))
    scored.sort()
    best: dict[bytes, float] = {}
    for down, piece in scored:
        best.setdefault(piece, -down)
    # A byte piece beside a piece of the same byte would be the same edge twice.
    single = [b for b in single if b not in best]
    return [*best, *single], np.array([*best.values(), *[np.nan] * len(single)])


def as_scored(pieces: list[bytes], scores: np.ndarray) -> tuple[list[bytes], np.ndarray]:
    """Pieces with the log probabilities that their scores are, and every byte.

    A byte that no piece with a score holds alone gets the lowest score less ``UNKNOWN``,
    so that every word has a probability. Scores that are whole numbers, as ranks of merges
    are, or that add up to more than one as probabilities are refused.
    """
    scored = np.isfinite(scores)
    if (scores[scored] == np.round(scores[scored])).all() or np.exp(scores[scored]).sum() > 1 + SLACK:
        raise ValueError("the vocabulary's scores are no log probabilities; fit them to the training rows instead")
    known = [p for p, s in zip(pieces, scored, strict=True) if s]
    rest = sorted({bytes([b]) for b in range(256)} - set(known))
    lowest = scores[scored].min() - UNKNOWN
    return known + rest, np.concatenate([scores[scored], np.full(len(rest), lowest)])


def long_lattice(word: np.ndarray, vocabulary: Vocabulary) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Begins, ends and pieces of one word's lattice edges, by end, then by falling begin."""
    body = np.concatenate([np.frombuffer(MARK, np.uint8), word])
    sums, back = byte_sums(body)
    begins, ends, pieces = [], [], []
    for span in vocabulary.lengths:
        at = np.arange(max(0, len(body) - span + 1))
        if span > 1:
            at = at[(at == 0) | (at >= len(MARK))]  # no piece but a byte begins inside the mark
        hit, piece = vocabulary.edges(sums, back, at, span)
        begins.append(at[hit])
        ends.append(at[hit] + span)
        pieces.append(piece)
    begin, end, piece = np.concatenate(begins), np.concatenate(ends), np.concatenate(pieces)
    order = np.lexsort((-begin, end))
    return begin[order], end[order], piece[order]


def along(source: np.ndarray, target: np.ndarray, weight: np.ndarray, length: int, start: int) -> np.ndarray:
    """Log sums over all ways from ``start``, of edges of which each comes after all that end at its source."""
    total = [-math.inf] * (length + 1)
    total[start] = 0.0
    for at in range(0, len(source), EDGES):
        some = slice(at, at + EDGES)
        for a, b, w in zip(source[some].tolist(), target[some].tolist(), weight[some].tolist(), strict=True):
            more, had = total[a] + w, total[b]
            if more > had:
                more, had = had, more
            if had > -math.inf:
                total[b] = had + math.log1p(math.exp(more - had))
    return np.array(total)


def long_words(words: pa.Array) -> Iterator[tuple[int, np.ndarray]]:
    """Places and bytes of the words that have a lattice each."""
    offsets, raw = buffers(words)
    for i in np.flatnonzero(np.diff(offsets) > LONG_WORD).tolist():
        yield i, raw[offsets[i] : offsets[i + 1]]


def lattices(words: pa.Array, vocabulary: Vocabulary):
    """Per group of words of one length, long ones left out: their places, lattice edges and forward sums.

    Yields ``(which, length, edges, alpha)``; ``edges`` has for each end, in order, lists
    of ``(begin, words, pieces)``. ``alpha[:, -1]`` is the log likelihood.
    """
    offsets, raw = buffers(words)
    sizes = np.diff(offsets)
    for size in np.unique(sizes[sizes <= LONG_WORD]):
        chosen = np.flatnonzero(sizes == size)
        length = len(MARK) + int(size)
        step = max(1, LATTICE_CELLS // length)
        for at in range(0, len(chosen), step):
            which = chosen[at : at + step]
            n = len(which)
            body = np.empty((n, length), np.uint8)
            body[:, : len(MARK)] = np.frombuffer(MARK, np.uint8)
            body[:, len(MARK) :] = raw[offsets[which][:, None] + np.arange(size)[None, :]]
            sums, back = byte_sums(body.reshape(-1))
            base = np.arange(n) * length
            alpha = np.full((n, length + 1), -np.inf)
            alpha[:, 0] = 0.0
            edges = []
            for end in range(1, length + 1):
                for span in vocabulary.lengths:
                    if span > end:
                        break
                    if span > 1 and 0 < end - span < len(MARK):
                        continue  # no piece but a byte begins inside the mark
                    hit, piece = vocabulary.edges(sums, back, base + end - span, span)
                    if len(hit):
                        alpha[hit, end] = np.logaddexp(alpha[hit, end], alpha[hit, end - span] + vocabulary.log_p[piece])
                        edges.append((end, end - span, hit, piece))
            yield which, length, edges, alpha


def gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The batches put together to about ``GATHERED`` rows each."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        held.append(batch)
        if sum(b.num_rows for b in held) >= GATHERED:
            yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            held = []
    if sum(b.num_rows for b in held):
        yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]


def likelihoods(words: pa.Array, vocabulary: Vocabulary) -> np.ndarray:
    """Natural log of each word's probability."""
    out = np.zeros(len(words))
    for which, _, _, alpha in lattices(words, vocabulary):
        out[which] = alpha[:, -1]
    for i, word in long_words(words):
        begin, end, piece = long_lattice(word, vocabulary)
        length = len(MARK) + len(word)
        out[i] = along(begin, end, vocabulary.log_p[piece], length, 0)[length]
    return out


def expected_counts(words: pa.Array, times: np.ndarray, vocabulary: Vocabulary) -> np.ndarray:
    """How often each piece is used in the words, expected over all segmentations."""
    total = np.zeros(len(vocabulary.log_p))
    for which, length, edges, alpha in lattices(words, vocabulary):
        beta = np.full(alpha.shape, -np.inf)
        beta[:, length] = 0.0
        whole = alpha[:, length]
        weight = times[which]
        for end, begin, hit, piece in reversed(edges):
            tail = vocabulary.log_p[piece] + beta[hit, end]
            share = np.exp(alpha[hit, begin] + tail - whole[hit])
            total += np.bincount(piece, weights=share * weight[hit], minlength=len(total))
            beta[hit, begin] = np.logaddexp(beta[hit, begin], tail)
    for i, word in long_words(words):
        begin, end, piece = long_lattice(word, vocabulary)
        length, weight = len(MARK) + len(word), vocabulary.log_p[piece]
        alpha = along(begin, end, weight, length, 0)
        beta = along(end[::-1], begin[::-1], weight[::-1], length, length)
        share = np.exp(alpha[begin] + weight + beta[end] - alpha[length])
        total += np.bincount(piece, weights=share * times[i], minlength=len(total))
    return total


def fitted(spark: SparkSession, words: DataFrame, pieces: list[bytes], ends: int, rounds: int, prior: float) -> np.ndarray:
    """Log probabilities of the pieces and, last, of the end, fitted to ``(word, chosen)``.

    Each round collects one number per piece of the vocabulary.
    """
    # The vocabulary's order as a first guess: Zipf's law over it.
    guess = 1.0 / (np.arange(len(pieces)) + 10.0)
    guess /= guess.sum()
    p, p_end = guess, 0.1
    for _ in range(rounds):
        log_p = spark.sparkContext.broadcast(np.log(p * (1 - p_end)))

        def expect(batches: Iterator[pa.RecordBatch], log_p=log_p) -> Iterator[pa.RecordBatch]:
            vocabulary, total = Vocabulary(pieces, log_p.value), np.zeros(len(pieces))
            for batch in gathered(batches):
                total += np.round(expected_counts(batch.column("word"), batch.column("chosen").to_numpy().astype(np.float64), vocabulary) / UNIT)
            used = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used].astype(np.int64))], names=["piece", "times"])

        counted = words.filter("chosen > 0").select("word", "chosen").mapInArrow(expect, "piece long, times long")
        counted = counted.groupBy("piece").agg(F.sum(F.col("times").cast("decimal(38,0)")).alias("times")).toPandas()
        expected = np.zeros(len(pieces))
        expected[counted["piece"].to_numpy(np.int64)] = counted["times"].astype(float).to_numpy() * UNIT
        used = expected.sum()
        p = (expected + prior * guess) / (used + prior)
        p_end = (ends + 1.0) / (used + ends + 2.0)
    return np.append(np.log(p * (1 - p_end)), np.log(p_end))


def lattice_scores(
    docs: DataFrame,
    model: str,
    training: Column,
    *,
    text: str = "text",
    weights: str = "fitted",
    rounds: int = 3,
    prior: float = 1000.0,
    head: int = HEAD,
) -> DataFrame:
    """Documents with their log10 probability under the subword lattice, and a word baseline.

    Words are runs of bytes other than ASCII white space, A-Z as a-z; an end follows.
    ``model`` is a ``sentencepiece`` file, ``training`` tells the rows to learn from.
    ``weights`` is ``scores`` for a vocabulary whose scores are log probabilities: they are
    taken as they are, a byte that no piece holds alone lies below the lowest one, the end
    has no score of its own, and ``training`` decides the baseline only. It is ``fitted``
    for one whose scores are ranks; with ``scores`` such a vocabulary is refused.
    Returns the input's columns and ``n_tokens`` (with the end), ``n_known`` (seen in
    training), ``train_tokens``, ``base_score`` (add-one word unigrams) and ``score``,
    replacing columns of these names. All counts cover all training rows.

    Empty table: empty. Null and empty texts: the end alone. No training rows: the end is
    unknown, pieces keep their first guess. Repeated rows count as often as they come.
    A null ``training`` is no training row. Long texts are read whole, and words of any length.
    """
    spark = docs.sparkSession
    with open(model, "rb") as file:
        pieces, scores = pieces_of(file.read())
    if weights not in ("scores", "fitted"):
        raise ValueError(f"weights must be scores or fitted, not {weights}")
    if weights == "scores":
        pieces, scores = as_scored(pieces, scores)
    chosen = F.coalesce(training, F.lit(False))
    named = docs.select(text_key(column(text)).alias("key"), column(text).cast("string").alias("text"), chosen.alias("chosen"))

    def split(texts: pa.Array) -> Words:
        return Words(texts, NOT_SPACE, lower=True)

    words = stored(distinct_words(named, split), "words")
    ends = docs.filter(chosen).count()
    totals = words.agg(F.coalesce(F.sum("chosen"), F.lit(0)), F.count_if(F.col("chosen") > 0)).first()
    n, distinct = totals[0] + ends, totals[1] + (1 if ends else 0)
    log_p = np.append(scores, 0.0) if weights == "scores" else fitted(spark, words, pieces, ends, rounds, prior)
    log_p = spark.sparkContext.broadcast(log_p)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = Vocabulary(pieces, log_p.value[:-1])
        for batch in gathered(batches):
            found = likelihoods(batch.column("word"), vocabulary) / np.log(10)
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in ("word", "n", "chosen")], pa.array(found)], names=["word", "n", "chosen", "lattice"])

    valued = words.mapInArrow(score, "word string, n long, chosen long, lattice double").select(
        "word", "n", (F.col("chosen") > 0).cast("double").alias("known"), F.log10(F.col("chosen") + 1.0).alias("base"), "lattice"
    )
    sums = summed(named, split, stored(valued, "likelihoods"), ["known", "base", "lattice"], head)
    n_tokens = F.col("n_words") + 1
    end = float(np.log10(ends + 1.0))
    base = F.col("base") + F.lit(end) - n_tokens * F.lit(float(np.log10(float(n + distinct + 1))))
    last = fitted_end(log_p.value)
    return by_text(
        docs,
        sums,
        text,
        n_tokens=n_tokens,
        n_known=(F.col("known") + F.lit(1 if ends else 0)).cast("long"),
        train_tokens=F.lit(n).cast("long"),
        base_score=base,
        score=F.col("lattice") + F.lit(last),
    )


def fitted_end(log_p: np.ndarray) -> float:
    """log10 probability of the end."""
    return float(log_p[-1] / np.log(10))
