"""Toxicity: bags, averages and scores against plain Python, a training step against slopes of the loss."""

import functools
import math
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from tidemark.llm import toxicity as t
from tidemark.llm.batches import byte_sums, spans

FOLDER = "/root/testdata/sf0.001"


@functools.cache
def bucket(gram):
    (hashed,) = spans(*byte_sums(np.frombuffer(gram, np.uint8)), np.array([0]), np.array([len(gram)]))
    return int(hashed) >> (64 - t.BUCKET_BITS)


def plain_bag(text):
    """Buckets of the distinct words and of their n-grams."""
    out = []
    lowered = re.sub(rb"[A-Z]", lambda m: m.group().lower(), (text or "").encode())
    for word in sorted(set(re.findall(rb"[^\x20\x09-\x0D]+", lowered))):
        limited = b" " + word + b"\n"
        out.append(bucket(word))
        out += [bucket(limited[i : i + n]) for n in t.GRAMS for i in range(len(limited) - n + 1)]
    return out


def test_bags_and_averages_are_those_of_plain_python():
    texts = ["the the cat SAT on", "", "  ", "a", "Été été x\ny\tthe", None, "Ärger cat"]
    bags = t.Bags(pa.array(texts))
    table = np.random.default_rng(1).normal(size=1 << t.BUCKET_BITS)
    averages = bags.averages(table)
    for text, average, (used, shares) in zip(texts, averages, bags.frequencies(), strict=True):
        want = plain_bag(text)
        assert math.isclose(average, sum(table[b] for b in want) / (len(want) + t.NEUTRAL), abs_tol=1e-12)
        assert used.tolist() == sorted(set(want))
        assert np.allclose(shares, [want.count(b) / (len(want) + t.NEUTRAL) for b in used.tolist()])


def test_every_document_is_scored_as_plain_python_does(spark):
    docs, labels = (spark.read.parquet(f"{FOLDER}/{x}.parquet") for x in ("documents", "labels"))
    training = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(5)) != 0
    table, bias = t.fit(docs, labels, training, doc_id="doc_id", text="text", label="toxic", sample_rows=t.SAMPLE_ROWS, steps=100)
    found = {r.doc_id: r for r in t.toxicity_scores(docs, labels, training, steps=100).collect()}
    rows = docs.select("doc_id", "text").collect()
    assert {r.doc_id for r in rows} == set(found)
    for doc_id, text in rows:
        want = plain_bag(text)
        odds = sum(table[b] for b in want) / (len(want) + t.NEUTRAL) + bias
        assert math.isclose(found[doc_id].toxic_score, 1 / (1 + math.exp(-odds)), abs_tol=1e-9)
        assert found[doc_id].toxic == int(found[doc_id].toxic_score >= 0.5)


def test_a_training_step_follows_the_slope_of_the_loss():
    rng = np.random.default_rng(3)
    bags = [(np.sort(rng.choice(30, 6, False)), rng.dirichlet(np.ones(6))) for _ in range(5)]
    labels = np.array([0, 1, 1, 0, 1])
    seed, rate, scale = 7, 0.5, float(t.SCALE)
    # The weights that training starts from.
    start = np.random.default_rng(seed)
    vectors = start.normal(0, t.START, (1 << t.BUCKET_BITS, t.WIDTH))[:30].astype(np.float32).astype(float)

    # The table's whole draw comes first, so the softmax is drawn after it.
    softmax = start.normal(0, 1, (t.WIDTH, 2)).astype(np.float32).astype(float)
    bias = np.zeros(2)

    def loss():
        total = 0.0
        for (used, shares), label in zip(bags, labels, strict=True):
            scores = scale * sum(s * vectors[b] for b, s in zip(used, shares, strict=True)) @ softmax + bias
            total += math.log(sum(math.exp(x) for x in scores)) - scores[label]
        return total / len(bags)

    def slope(weights):
        out = np.zeros(weights.shape)
        for at in np.ndindex(weights.shape):
            kept = weights[at]
            weights[at] = kept + 1e-6
            up = loss()
            weights[at] = kept - 1e-6
            out[at] = (up - loss()) / 2e-6
            weights[at] = kept
        return out

    slopes = [slope(w) for w in (vectors, softmax, bias)]
    vectors -= rate * slopes[0]
    softmax -= 0.01 * rate * slopes[1]
    bias -= 0.01 * rate * slopes[2]
    table, log_odds = t.train(bags, labels, steps=1, batch=len(bags), rate=rate, seed=seed)
    assert np.allclose(table[:30], scale * vectors @ (softmax[:, 1] - softmax[:, 0]), rtol=1e-3, atol=1e-2)
    assert math.isclose(log_odds, bias[1] - bias[0], rel_tol=1e-3, abs_tol=1e-6)
