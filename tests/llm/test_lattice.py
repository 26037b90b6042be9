"""Lattices of given log probabilities and of long words, against all segmentations."""

import math
import struct
import time

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tidemark.llm import lattice

MARK = "▁"
PIECES = {MARK: 0.2, "a": 0.1, "b": 0.1, "ab": 0.2, "ba": 0.1, MARK + "a": 0.1, "aba": 0.2}


def field(number, value):
    """A field of a serialised message: text or bytes, a float, or a small number."""
    if isinstance(value, float):
        return bytes([number << 3 | 5]) + struct.pack("<f", value)
    if isinstance(value, int):
        return bytes([number << 3, value])
    value = value.encode() if isinstance(value, str) else value
    return bytes([number << 3 | 2, len(value)]) + value


@pytest.fixture(scope="module")
def unigram_model(tmp_path_factory):
    """A model file of the unigram kind (1) with the pieces above and an unknown piece (kind 2)."""
    pieces = [field(1, "<unk>") + field(2, 0.0) + field(3, 2)]
    pieces += [field(1, p) + field(2, math.log(x)) + field(3, 1) for p, x in PIECES.items()]
    model = b"".join(field(1, p) for p in pieces) + field(2, field(3, 1)) + field(3, field(1, "identity"))
    path = tmp_path_factory.mktemp("model") / "unigram.model"
    path.write_bytes(model)
    return str(path)


def probability(word, p):
    """Sum over all segmentations of the word's bytes, one by one."""
    if not word:
        return 1.0
    return sum(x * probability(word[len(piece) :], p) for piece, x in p.items() if word.startswith(piece))


def test_scores_that_are_log_probabilities_are_taken_as_they_are(spark, unigram_model):
    p = {piece.encode(): x for piece, x in PIECES.items()}
    below = math.exp(math.log(min(PIECES.values())) - lattice.UNKNOWN)
    p |= {bytes([b]): below for b in range(256) if bytes([b]) not in p}
    texts = ["ab", "aba baab", "", None, "abc", "é ab", "ABAB"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = lattice.lattice_scores(docs, unigram_model, F.lit(True), weights="scores").collect()
    for row in found:
        words = (texts[row.doc_id] or "").lower().split()
        want = sum(math.log10(probability((MARK + w).encode(), p)) for w in words)
        assert row.score == pytest.approx(want, rel=1e-5, abs=1e-9)
    # What is learned from decides nothing but the baseline.
    other = lattice.lattice_scores(docs, unigram_model, F.col("doc_id") == 0, weights="scores").collect()
    assert {(r.doc_id, r.score) for r in other} == {(r.doc_id, r.score) for r in found}


def test_ranks_are_refused_as_scores(spark):
    docs = spark.createDataFrame([(1, "a")], "doc_id long, text string")
    with pytest.raises(ValueError, match="no log probabilities"):
        lattice.lattice_scores(docs, public_tokenizers.path("piece_bpe_32k.model"), F.lit(True), weights="scores")
    with pytest.raises(ValueError, match="weights"):
        lattice.lattice_scores(docs, public_tokenizers.path("piece_bpe_32k.model"), F.lit(True), weights="other")


def test_long_words_as_short_ones(monkeypatch):
    pieces = [p.encode() for p in PIECES] + [bytes([x]) for x in MARK.encode()]
    vocabulary = lattice.Vocabulary(pieces, np.log(np.arange(1.0, len(pieces) + 1) / 100))
    words = pa.array(["a", "", "abab", "baabab" * 20, "c", "ab" * 100, "aba"])
    times = np.arange(1.0, 8.0)
    known = pa.array([w for w in words.to_pylist() if w != "c"])
    short = lattice.likelihoods(words, vocabulary), lattice.expected_counts(known, times[:6], vocabulary)
    monkeypatch.setattr(lattice, "LONG_WORD", -1)
    monkeypatch.setattr(lattice, "EDGES", 7)
    assert lattice.likelihoods(words, vocabulary) == pytest.approx(short[0])
    assert lattice.likelihoods(words, vocabulary)[4] == -math.inf
    assert lattice.expected_counts(known, times[:6], vocabulary) == pytest.approx(short[1])


def test_a_word_of_100_kilobytes_takes_seconds():
    with open(public_tokenizers.path("piece_bpe_32k.model"), "rb") as file:
        pieces, _ = lattice.pieces_of(file.read())
    vocabulary = lattice.Vocabulary(pieces, np.log(np.full(len(pieces), 1 / len(pieces))))
    letters = np.random.default_rng(1).choice(list("etaoinshrdlu"), 100_000)
    word = pa.array(["".join(letters)])
    began = time.monotonic()
    found = lattice.likelihoods(word, vocabulary)
    counts = lattice.expected_counts(word, np.ones(1), vocabulary)
    assert time.monotonic() - began < 20
    assert -1e7 < found[0] < 0
    sizes = np.array([len(p) for p in pieces])
    # The expected pieces hold the word's bytes, its mark included.
    assert (counts * sizes).sum() == pytest.approx(100_000 + len(MARK.encode()))
