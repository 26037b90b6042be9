"""Inputs with one row, word or phrase repeated very often."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import frequencies, line_labels, toxicity, winnowing
from tidemark.llm.batches import NOT_SPACE, Words
from tidemark.llm.store import stored, text_key

DOCS = "doc_id long, text string"
WORDS = "calm river stone garden window paper letter morning kitchen bottle".split()


def texts(n):
    return [(i, "\n".join(" ".join(WORDS[(i * 7 + j * k) % 10] for k in range(1, 9)) for j in range(1, 4)) + f" end{i}") for i in range(n)]


@pytest.fixture(scope="module")
def learning(spark):
    rows = texts(40)
    labels = spark.createDataFrame([(i, i % 2, i % 2) for i, _ in rows], "doc_id long, quality int, toxic int")
    # One id in a third of all rows, also with other texts and empty ones.
    again = [rows[3]] * 20 + [(3, "~ " + rows[3][1])] * 5 + [(3, ""), (3, None)]
    return spark.createDataFrame(rows, DOCS), spark.createDataFrame(rows + again, DOCS), labels


def test_repeated_ids_are_learned_from_once_by_the_toxicity_model(learning):
    once, often, labels = learning
    names = {"doc_id": "doc_id", "text": "text", "label": "toxic", "sample_rows": 30, "steps": 30}
    (table, bias), (table_often, bias_often) = [toxicity.fit(d, labels, F.lit(True), **names) for d in (once, often)]
    assert table.any() and np.array_equal(table, table_often) and bias == bias_often


def test_repeated_ids_are_learned_from_once_by_the_line_labels(learning):
    once, often, labels = learning
    names = {"doc_id": "doc_id", "text": "text", "label": "quality", "sample_rows": 40}
    theta, theta_often = [line_labels.learned(d, labels, **names) for d in (once, often)]
    assert theta.any() and np.array_equal(theta, theta_often)


def test_long_words_are_counted_but_not_collected(spark):
    long = "x" * 257
    given = [(f"{long} a {long} y{i}",) for i in range(30)] + [("a a b",)]
    named = spark.createDataFrame(given, "text string").select(text_key(F.col("text")).alias("key"), "text", F.lit(True).alias("chosen"))
    split = lambda texts: Words(texts, NOT_SPACE)
    words = stored(frequencies.distinct_words(named, split).withColumn("size", F.octet_length("word")), "words")
    head = {r["word"] for r in frequencies.frequent(words, 5).collect()}
    assert head == {"a"}  # 32 times; 60 times is too long, once too many
    sums = frequencies.summed(named, split, words, ["size"], head=5).select("n_words", "size").collect()
    assert sorted((r["n_words"], r["size"]) for r in sums) == sorted([(3, 3)] + [(4, 2 * 257 + 1 + len(f"y{i}")) for i in range(30)])


def test_a_common_phrase_makes_no_pairs(spark, monkeypatch):
    # A phrase of six words in all items and documents; a few share a whole window, and a short item too.
    phrase = "and so on and so forth"
    item = lambda i: f"i{i}a i{i}b i{i}c i{i}d {phrase} i{i}e i{i}f i{i}g i{i}h"
    items = [(i, item(i)) for i in range(40)] + [(40, item(3)), (41, "so on")]
    docs = [(i, f"d{i} d{i} {phrase} d{i} d{i} d{i} d{i} d{i}") for i in range(40)] + [(40, f"start {item(3)} end"), (41, f"{item(5)} {item(6)}")]
    met = []

    def recorded(rows, table, key, spread, looked_up=winnowing.looked_up):
        met.append((table, rows.count()))
        return looked_up(rows, table, key, spread)

    monkeypatch.setattr(winnowing, "looked_up", recorded)
    out = {r["doc_id"]: r for r in winnowing.find_passages(spark.createDataFrame(docs, DOCS), spark.createDataFrame(items, "item_id long, text string")).collect()}

    listed = {str(i): t.split() for i, t in items}
    for i, text in docs:
        words = text.split()
        inside, named = set(), set()
        for name, of in listed.items():
            n = min(10, len(of))
            for a in range(len(of) - n + 1):
                for b in range(len(words) - n + 1):
                    if words[b : b + n] == of[a : a + n]:
                        inside |= set(range(b, b + n))
                        named.add(name)
        assert (out[i]["n_hit"], out[i]["items"]) == (len(inside), sorted(named))
        assert {w for a, b in out[i]["hits"] for w in range(a, b)} == inside
    ((table, rows),) = met
    # A row of the lookup table adds none to what it meets and holds no list that grows with the items.
    assert "array" not in table.schema.simpleString() and table.count() == table.select("window").distinct().count()
    assert rows < 40 * 40
