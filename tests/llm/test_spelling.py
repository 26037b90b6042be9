"""Spelling variants against plain Python: all words, near words, forms and roots."""

import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from tidemark.llm.queries import QUERIES
from tidemark.llm.spelling import continued_crc, spelling_variants

ASCII = str.maketrans({chr(c): chr(c + 32) for c in range(ord("A"), ord("Z") + 1)})


def counted(rows, drop_every):
    found = Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(ASCII)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if drop_every and h % drop_every == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            found[run] += 1
    return found


def grouped(found, min_length=5, min_count=3, ratio=2):
    words = {w: n for w, n in found.items() if len(w) >= min_length and n >= min_count}
    replaced, near = defaultdict(set), {w: set() for w in words}
    for w in words:
        for i in range(len(w)):
            replaced[w[:i], w[i + 1 :]].add(w)
            shorter = w[:i] + w[i + 1 :]
            if shorter in words:
                near[w].add(shorter)
                near[shorter].add(w)
    for alike in replaced.values():
        for w in alike:
            near[w] |= alike - {w}
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda x: (-words[x], x), default=None)
        if best is not None and words[best] >= ratio * words[w]:
            form[w] = best

    def root(w):
        while w in form:
            w = form[w]
        return w

    return sorted((w, n, len(near[w]), form.get(w), words.get(form.get(w)), root(w)) for w, n in words.items())


def test_query_against_plain_python(spark):
    folder = "/root/testdata/sf0.001"
    rows = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()
    want = grouped(counted(rows, 97))
    assert sorted(map(tuple, QUERIES["op11_spelling_variants"](spark, folder).collect())) == want
    assert any(w[5] != (w[3] or w[0]) for w in want)  # roots beyond the form


@pytest.mark.parametrize("limit", [3, 20_000])
def test_edits_at_every_place_and_divided_lists(spark, limit):
    rng = np.random.default_rng(4)
    words = {"".join(rng.choice(list("abé"), int(rng.integers(1, 9)))) for _ in range(700)}
    words |= {"x" * k + "y" for k in range(1, 40)} | {"stem" + c + "rest" for c in "abcdefghijklmnop"} | {"stemrest", "q" * 3000, "q" * 2999}
    rows = [(i, f"{w} " * int(rng.integers(1, 40))) for i, w in enumerate(sorted(words))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    want = grouped(counted(rows, None), min_length=1, min_count=2)
    got = spelling_variants(docs, min_length=1, min_count=2, limit=limit)
    assert sorted(map(tuple, got.collect())) == want


def test_edges(spark):
    schema = "doc_id long, text string, word string, n int, size int"
    rows = [(None, "Maple maple MAPLE maples"), (1, None), (2, ""), (3, " 12 \n"), (4, "Étoile étoile"), (4, "Étoile étoile"), (5, "Maples maples, " + "a" * 2_000)]
    docs = spark.createDataFrame([(*r, "x", 1, 1) for r in rows], schema)
    got = sorted(map(tuple, spelling_variants(docs, min_count=1).collect()))
    assert got == grouped(counted(rows, None), min_count=1)
    assert ("Étoile", 2, 1, None, None, "Étoile") in got  # only A-Z are lower-cased
    planted = sorted(map(tuple, spelling_variants(docs, min_count=1, drop_every=2).collect()))
    assert planted == grouped(counted(rows, 2), min_count=1)
    assert spelling_variants(docs.limit(0)).collect() == []
    with pytest.raises(ValueError):
        spelling_variants(docs, ratio=1)


def test_crc_of_stretches():
    rng = np.random.default_rng(2)
    raw = rng.integers(0, 256, 3000).astype(np.uint8)
    starts = rng.integers(0, 2900, 300)
    ends = starts + np.append(rng.integers(0, 9, 290), rng.integers(60, 100, 10))
    seen = rng.integers(0, 2**32, 300, dtype=np.uint32)
    want = [zlib.crc32(raw[a:b].tobytes(), int(s)) for a, b, s in zip(starts, ends, seen, strict=True)]
    assert continued_crc(seen, raw, starts, ends).tolist() == want


def test_a_word_of_200_000_characters(spark):
    long = "a" * 100_000 + "b" * 100_000
    docs = spark.createDataFrame([(1, f"{long} {long} {long[:-1]}")], "doc_id long, text string")
    got = {len(r["word"]): r for r in spelling_variants(docs, min_count=1).collect()}
    assert got[199_999]["form"] == long and got[200_000]["n_near"] == 1 and got[200_000]["form"] is None
