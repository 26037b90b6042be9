"""Quality scores: features against plain Python, gradients, held-out accuracy and odd rows."""

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from tidemark.llm import quality as q
from tidemark.llm.queries import QUERIES
from tidemark.llm.stretches import sliced


def plain_counts(text):
    """Features by name: words, their n-grams, and pairs."""
    words = [w for w in text.encode().split(b" ") if w]
    out = []
    for w in words:
        limited = b" " + w + b"\n"
        out += [("word", w)] + [(n, limited[i : i + n]) for n in q.GRAMS for i in range(len(limited) - n + 1)]
    return out + [("same",) if a == b else ("pair", a, b) for a, b in zip(words, words[1:], strict=False)]


def test_features_are_those_of_plain_python():
    texts = ["the the cat sat on the mat", "", "a", "été été été x", "cat mat"]
    (part,) = sliced(pa.array(texts), q._blank)
    features = q.Features(part)
    found = list(features.counts())
    number = {}
    table = np.random.default_rng(1).normal(size=q.BUCKETS)
    total, count = features.sums(table)
    for i, text in enumerate(texts):
        want = plain_counts(text)
        bucket, times = found[i]
        assert times.sum() == len(want) == count[i]
        assert abs((table[bucket] * times).sum() - total[i]) < 1e-9
        for name in set(want):  # equal features share a bucket in every text
            number.setdefault(name, None)
        assert len(bucket) == len(set(want))
    assert len(np.unique(np.concatenate([b for b, _ in found]))) == len(number)


def test_gradients_are_slopes_of_the_loss():
    rng = np.random.default_rng(3)
    vectors, softmax, bias = rng.normal(size=(40, 4)), rng.normal(size=(4, 2)), rng.normal(size=2)
    bags = [(np.sort(rng.choice(40, 6, False)), rng.dirichlet(np.ones(6))) for _ in range(5)]
    labels = np.array([0, 1, 1, 0, 1])

    def loss():
        return -np.log(q.forward(vectors, softmax, bias, bags)[1][np.arange(5), labels]).mean()

    used, *slopes = q.gradients(vectors, softmax, bias, bags, labels)
    for weights, slope, rows in ((vectors, slopes[0], used), (softmax, slopes[1], range(4)), (bias, slopes[2], range(2))):
        for i, row in enumerate(rows):
            for d in np.ndindex(weights[row].shape):
                at = (row, *d)
                kept = weights[at]
                weights[at] = kept + 1e-5
                up = loss()
                weights[at] = kept - 1e-5
                down = loss()
                weights[at] = kept
                assert abs((up - down) / 2e-5 - slope[(i, *d)]) < 1e-6


def test_held_out_rows_are_told_apart(spark):
    folder = "/root/testdata/sf0.1"
    scored = QUERIES["op12_subword_quality"](spark, folder).join(spark.read.parquet(f"{folder}/labels.parquet"), "doc_id")
    rows = scored.filter("held_out AND quality IS NOT NULL").select("quality", "score", "predicted").collect()
    good, bad = [r for r in rows if r["quality"] == 1], [r for r in rows if r["quality"] == 0]
    assert sum(r["predicted"] for r in good) >= 0.99 * len(good)
    assert sum(r["predicted"] for r in bad) <= 0.1 * len(bad)
    assert all(r["predicted"] == (r["score"] >= 0.7) for r in rows)


def test_odd_rows(spark):
    schema = "doc_id long, text string, key string, score int, Good int, `a.b` int"
    long = "good words here and there " * 200_000
    texts = [(1, "fine prose here"), (1, "fine prose here"), (2, None), (3, ""), (4, " \n\t"), (None, "fine prose here"), (5, "junk junk junk"), (6, long)]
    docs = spark.createDataFrame([(i, t, "k", 1, 2, 3) for i, t in texts], schema)
    labels = spark.createDataFrame([(1, 1), (5, 0), (5, 1), (None, 0), (2, None), (99, 0), (6, 1)], "doc_id long, quality int")
    out = q.quality_scores(docs, labels, F.lit(True))
    assert out.columns == ["doc_id", "text", "key", "score", "a.b", "quality_score", "good"]
    rows = out.collect()
    assert len(rows) == len(texts) and all(0 <= r["quality_score"] <= 1 for r in rows)
    by_text = {}
    for r in rows:
        by_text.setdefault(r["text"] or "", set()).add((r["quality_score"], r["good"]))
    assert all(len(v) == 1 for v in by_text.values())
    assert len({v for t in ("", " \n\t") for v in by_text[t]}) == 1
    score = {r["text"]: r["quality_score"] for r in rows}
    assert score["fine prose here"] > 0.7 > score["junk junk junk"]  # the lower of two labels holds
    assert q.quality_scores(docs.limit(0), labels, F.lit(True)).collect() == []
    none = q.quality_scores(docs, labels.limit(0), F.lit(True)).collect()
    assert {r["quality_score"] for r in none} == {0.5}
    one = q.quality_scores(docs, labels.filter("quality = 1 AND doc_id = 1"), F.col("doc_id") == 1).collect()
    assert {round(r["quality_score"], 6) for r in one} == {round(2 / 3, 6)}


def test_stretches_add_up():
    text = "some words, and more of them. " * 40
    table = np.random.default_rng(1).normal(size=q.BUCKETS)
    whole, parts = [sum(q.Features(p).sums(table)[1].sum() for p in sliced(pa.array([text]), q._blank, size)) for size in (1 << 20, 100)]
    cuts = sum(len(p.rows) for p in sliced(pa.array([text]), q._blank, 100)) - 1
    assert cuts > 5 and parts == whole - cuts  # a pair of words per cut
