"""Every corpus operator on nulls, empty and long texts, ties, repeated rows, empty tables and clashing names."""

from collections import Counter

import public_tokenizers
import pytest
from pyspark.sql import functions as F

from tidemark.llm.chat import format_conversations
from tidemark.llm.lattice import lattice_scores
from tidemark.llm.line_labels import label_lines
from tidemark.llm.line_windows import remove_repeated_windows
from tidemark.llm.mixing import poisson_mix
from tidemark.llm.sharding import balanced_shards
from tidemark.llm.similar import one_of_each, similar_documents
from tidemark.llm.token_counts import count_tokens
from tidemark.llm.toxicity import toxicity_scores
from tidemark.llm.winnowing import find_passages

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, key string, node int, `SIZE` string, in0 int, `a.b` int, n_words string"
LONG = " ".join(f"w{i % 700}x{i}" for i in range(20_000))


def row(doc_id, text, source="s"):
    return (doc_id, text, None, source, None, "k", 1, "clash", 2, 3, "clash")


ROWS = [
    row(1, "one two three four five six seven eight nine ten eleven twelve"),
    row(1, "one two three four five six seven eight nine ten eleven twelve"),  # a repeated row
    row(2, "one two three four five six seven eight nine ten eleven twelve"),  # a copy
    row(3, None),
    row(4, ""),
    row(5, " \n\t \n"),
    row(6, "short"),
    row(7, LONG, None),
    row(None, "a row without an id\nand two lines\nand a third\nand a fourth", None),
    row(8, "a row without an id\nand two lines\nand a third\nand a fourth", "t"),
    row(9, "\x00 nul, ünïcode 中文 🎉 and <|endoftext|> </s>", "t"),
]
BENCHMARK = "item_id long, text string"
ITEMS = [(1, "ONE two, three four five six seven eight nine ten"), (2, None), (3, ""), (None, "short"), (4, "short"), (4, "short")]
LABELS = "doc_id long, quality int, toxic int, extra string"
MARKS = [(1, 1, 0, "x"), (2, None, None, "x"), (6, 0, 1, "x"), (6, 0, 0, "x"), (None, 1, 1, "x"), (99, 1, 1, "x"), (7, 1, 0, "x")]


def operators(spark, labels, items):
    return {
        "lattice": (lambda d: lattice_scores(d, public_tokenizers.path("piece_bpe_32k.model"), F.col("doc_id") < 7, rounds=1), {"n_tokens", "n_known", "train_tokens", "base_score", "score"}),
        "lines": (remove_repeated_windows, {"n_lines", "n_removed"}),
        "similar": (similar_documents, {"n_shingles", "component_id"}),
        "shards": (lambda d: balanced_shards(d, 4), {"size", "text_crc32", "shard", "slot"}),
        "passages": (lambda d: find_passages(d, items), {"n_words", "n_hit", "hits", "items", "contaminated"}),
        "toxicity": (lambda d: toxicity_scores(d, labels, F.lit(True), steps=20), {"toxic_score", "toxic"}),
        "labels": (lambda d: label_lines(d, labels), {"n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "line_labels", "content_share", "base_failed", "kept"}),
        "tokens": (lambda d: count_tokens(d, public_tokenizers.path("byte_bpe_50k.json")), {"n_bytes", "n_tokens", "over_limit"}),
    }


NAMES = ["lattice", "lines", "similar", "shards", "passages", "toxicity", "labels", "tokens"]


@pytest.fixture(scope="module")
def tables(spark):
    return spark.createDataFrame(ROWS, SCHEMA), spark.createDataFrame(MARKS, LABELS), spark.createDataFrame(ITEMS, BENCHMARK)


@pytest.mark.parametrize("name", NAMES)
def test_messy_rows_keep_their_columns_and_equal_rows_agree(spark, tables, name):
    docs, labels, items = tables
    run, added = operators(spark, labels, items)[name]
    out = run(docs)
    kept = [c for c in docs.columns if c.lower() not in {a.lower() for a in added}]
    assert out.columns == kept + [c for c in out.columns if c in added] and added <= set(out.columns)
    rows = out.collect()
    assert len(rows) == len(ROWS)
    assert sorted(str(r["doc_id"]) for r in rows) == sorted(str(r[0]) for r in ROWS)
    for value in added - {"slot"}:
        if name not in ("lines", "similar"):
            assert len({str(r[value]) for r in rows if r["doc_id"] in (1, 2)}) == 1


@pytest.mark.parametrize("name", NAMES)
def test_empty_tables(spark, tables, name):
    docs, labels, items = tables
    run, added = operators(spark, labels.limit(0), items.limit(0))[name]
    assert run(docs.limit(0)).collect() == []
    assert added <= set(run(docs.limit(0)).columns)


@pytest.mark.parametrize("name", ["passages", "toxicity", "labels"])
def test_empty_second_tables(spark, tables, name):
    docs, labels, items = tables
    rows = operators(spark, labels.limit(0), items.limit(0))[name][0](docs).collect()
    assert len(rows) == len(ROWS)
    if name == "passages":
        assert not any(r["contaminated"] or r["n_hit"] for r in rows)
    if name == "toxicity":
        assert {r["toxic"] for r in rows} == {0} and all(0.49 < r["toxic_score"] < 0.5 for r in rows)
    if name == "labels":
        assert all(set(r["line_labels"]) <= {0} for r in rows)


def test_values_of_messy_rows(spark, tables):
    docs, labels, items = tables
    marked = {r["doc_id"]: r for r in find_passages(docs, items).collect()}
    assert (marked[1]["n_words"], marked[1]["n_hit"], marked[1]["items"]) == (12, 10, ["1"])
    assert (marked[6]["n_hit"], marked[6]["items"]) == (1, ["4"])  # the item without an id hits, unnamed
    assert marked[3]["n_words"] == marked[4]["n_words"] == marked[5]["n_words"] == 0
    groups = [(r["doc_id"], r["component_id"], r["n_shingles"]) for r in similar_documents(docs).collect()]
    assert {g[1] for g in groups if g[0] in (1, 2)} == {1} and {g[1] for g in groups if g[0] in (None, 8)} == {8}
    assert {g for g in groups if g[0] in (3, 4, 5)} == {(3, 3, 0), (4, 4, 0), (5, 5, 0)}
    left = [r["doc_id"] for r in one_of_each(docs).collect()]
    assert sorted(left) == [1, 3, 4, 5, 6, 7, 8, 9]
    cut = {r["doc_id"]: r for r in remove_repeated_windows(docs).collect()}
    assert cut[8]["text"] == "" and cut[8]["n_removed"] == 4 and cut[None]["n_removed"] == 0  # null ids come first
    assert cut[3]["text"] is None and cut[3]["n_lines"] == 0 and cut[4]["n_lines"] == 1
    tokens = {r["doc_id"]: r for r in count_tokens(docs, public_tokenizers.path("byte_bpe_50k.json")).collect()}
    assert (tokens[3]["n_tokens"], tokens[3]["n_bytes"], tokens[4]["n_tokens"]) == (0, 0, 0) and tokens[7]["over_limit"]
    assert one_of_each(docs).columns == docs.columns


def test_mixing_edges(spark, tables):
    docs, _, _ = tables
    mixed = poisson_mix(docs, seed=3)
    assert mixed.columns == [*docs.columns, "mix_copy", "mix_rate", "mix_order"]
    assert poisson_mix(docs.limit(0)).collect() == []
    weights = spark.createDataFrame([("s", 1.0), (None, 0.0), ("s", 1.0), ("absent", 5.0)], "source string, weight double")
    rows = poisson_mix(docs, weights, seed=3).collect()
    assert {r["source"] for r in rows} == {"s"}  # the null source has weight 0, "t" none
    again = poisson_mix(docs.repartition(5), weights, seed=3).collect()
    key = lambda r: (str(r["doc_id"]), r["mix_copy"], r["mix_order"])
    assert sorted(map(key, rows)) == sorted(map(key, again))


def test_texts_of_one_id_are_drawn_and_dealt_apart(spark):
    hot = F.when(F.col("n") % 3 == 0, F.lit(7)).otherwise(F.col("n"))
    docs = spark.range(9_000).select(F.col("id").alias("n")).select(
        hot.alias("doc_id"), F.concat(F.lit("words "), F.col("n").cast("string")).alias("text"), F.when(F.col("n") % 5 == 0, "a").otherwise("b").alias("source")
    )
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        mixed = poisson_mix(docs, exponent=0.5, seed=3).withColumn("part", F.spark_partition_id()).collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert len({r["mix_order"] for r in mixed}) == len(mixed)
    one_id = [r for r in mixed if r["doc_id"] == 7]
    assert len({r["text"] for r in one_id if r["mix_copy"] == 2}) not in (0, len({r["text"] for r in one_id}))
    parts = sorted(Counter(r["part"] for r in mixed).values())
    assert parts[-1] <= 2 * parts[len(parts) // 2]


def test_conversation_edges(spark):
    schema = "conv_id long, turn long, role string, text string, formatted string"
    rows = [
        (1, 1, "assistant", None, "x"), (1, 0, "user", "</s>[INST]\\ \\\\", "x"), (1, 0, "user", "</s>[INST]\\ \\\\", "x"),
        (1, None, None, "first", "x"), (None, 0, "tool [TEXT]", "[/TEXT]", "x"), (2, 5, "assistant", "", "x"), (2, 5, "assistant", "b", "x"),
    ]
    from tidemark.llm.chat import read_back

    turns = spark.createDataFrame(rows, schema)
    back = {r["conv_id"]: r for r in read_back(format_conversations(turns)).collect()}
    assert [tuple(t) for t in back[1]["turns"]] == [("", "first"), ("user", "</s>[INST]\\ \\\\"), ("user", "</s>[INST]\\ \\\\"), ("assistant", "")]
    assert [tuple(t) for t in back[None]["turns"]] == [("tool [TEXT]", "[/TEXT]")]
    assert back[2]["loss_text"] == "b" and back[1]["loss_text"] == ""
    assert read_back(format_conversations(turns.limit(0))).collect() == []
