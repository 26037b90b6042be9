"""Queries of the corpus operators against their SQL, and against plain Python where SQL can't express them."""

import collections
import hashlib
import math
import re
import zlib

import public_tokenizers
import pytest

import corpus_pipeline
from tests import compare
from tidemark.llm import partenum
from tidemark.llm.queries import ORACLES, QUERIES

FOLDER = "/root/testdata/sf0.001"
SPACED = re.compile(r"[^\x20\x09-\x0D]+")


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


@pytest.fixture(scope="module")
def documents(spark):
    return {r.doc_id: r.text or "" for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()}


def by_id(spark, name):
    return {r.doc_id: r for r in QUERIES[name](spark, FOLDER).collect()}


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_its_sql(spark, name, monkeypatch):
    monkeypatch.setattr(compare, "hazards", lambda df: None)  # these may use Arrow
    assert compare.check(spark, compare.database(FOLDER), FOLDER, name, QUERIES[name], ORACLES[name]) is None


@pytest.mark.parametrize("name", ["op2_poisson_mix", "op3_line_windows"])
def test_native_queries_stay_in_the_engine(spark, name):
    assert compare.hazards(QUERIES[name](spark, FOLDER)) is None


def test_every_operator_has_one_query():
    numbers = [int(re.match(r"op(\d+)_", name)[1]) for name in QUERIES]
    assert sorted(numbers) == list(range(1, 11))


def test_word_baseline_and_lattice(spark, documents):
    found = by_id(spark, "op1_subword_lattice")
    words = {i: SPACED.findall(lower(t)) for i, t in documents.items()}
    held_out = {i: zlib.crc32(str(i).encode()) % 7 == 2 for i in documents}
    counts = collections.Counter()
    for i, w in words.items():
        if not held_out[i]:
            counts.update([*w, None])
    n, v = sum(counts.values()), len(counts)
    for i, w in words.items():
        r, tokens = found[i], [*w, None]
        assert (r.held_out, r.n_tokens, r.train_tokens) == (held_out[i], len(tokens), n)
        assert r.n_known == sum(counts[x] > 0 for x in tokens)
        assert r.base_score == pytest.approx(sum(math.log10((counts[x] + 1) / (n + v + 1)) for x in tokens), rel=1e-9)
        assert r.score < 0
    # A text's score is the sum over its words: equal texts agree, a longer one scores less.
    texts = collections.defaultdict(set)
    for i, t in documents.items():
        texts[t].add(found[i].score)
    assert all(len(s) == 1 for s in texts.values())


def test_lattice_sums_all_segmentations():
    import numpy as np
    import pyarrow as pa

    from tidemark.llm.lattice import MARK, Vocabulary, expected_counts, likelihoods

    pieces = [MARK, b"a", b"b", b"ab", b"ba", MARK + b"a", b"aba", *[bytes([x]) for x in MARK]]
    p = np.arange(1.0, len(pieces) + 1)
    p /= p.sum()
    vocabulary = Vocabulary(pieces, np.log(p))

    def ways(rest):
        if not rest:
            yield ()
        for i, piece in enumerate(pieces):
            if rest.startswith(piece):
                for more in ways(rest[len(piece) :]):
                    yield (i, *more)

    words = ["a", "b", "ab", "aba", "abab", "baab", ""]
    wanted, used = [], np.zeros(len(pieces))
    for word in words:
        all_ways = list(ways(MARK + word.encode()))
        weights = np.array([np.prod(p[list(w)]) for w in all_ways])
        wanted.append(math.log(weights.sum()))
        for way, weight in zip(all_ways, weights / weights.sum(), strict=True):
            for i in way:
                used[i] += weight
    assert likelihoods(pa.array(words), vocabulary) == pytest.approx(wanted)
    assert expected_counts(pa.array(words), np.ones(len(words)), vocabulary) == pytest.approx(used)


def groups(documents, length, percent):
    sets = {}
    for i, t in documents.items():
        w = SPACED.findall(lower(t))
        sets[i] = {tuple(w[j : j + length]) for j in range(len(w) - length + 1)} if len(w) >= length else ({tuple(w)} if w else set())
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    shared = collections.Counter()
    holders = collections.defaultdict(list)
    for i, s in sets.items():
        for x in s:
            shared.update((j, i) for j in holders[x])
            holders[x].append(i)
    for (a, b), n in shared.items():
        if 100 * n >= percent * (len(sets[a]) + len(sets[b]) - n):
            a, b = sorted((find(a), find(b)))
            root[b] = a
    return {i: (len(sets[i]), find(i)) for i in sets}


def test_components_of_similar_documents(spark, documents):
    found = by_id(spark, "op4_partenum")
    assert {i: (r.n_shingles, r.component_id) for i, r in found.items()} == groups(documents, 4, 85)


def test_chains_and_large_groups_lose_no_link(spark):
    from tidemark.llm.similar import similar_documents

    words = [f"w{i}" for i in range(120)]
    rows, at = [], 0
    for i in range(60):  # a chain: each differs a little from the one before, the ends not at all alike
        rows.append((i, " ".join(words)))
        words = [*words[:at], f"x{i}", f"y{i}", *words[at + 2 :]]
        at = (at + 2) % 118
    base = [f"v{i}" for i in range(200)]
    for i in range(100, 160):  # many copies that differ from one text, hardly from each other
        rows.append((i, " ".join([*base[: i - 100], f"z{i}", *base[i - 99 :]])))
    documents = dict(rows)
    found = similar_documents(spark.createDataFrame(rows, "doc_id long, text string"), shingle=4, percent=85)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in found.collect()} == groups(documents, 4, 85)


@pytest.mark.parametrize("percent", [80, 85])
@pytest.mark.parametrize("size", [2, 6, 9, 14, 33, 100, 250, 900])
def test_similar_sets_share_a_signature(percent, size):
    import numpy as np

    rng = np.random.default_rng(size)
    for _ in range(60):
        whole = np.unique(rng.integers(0, 2**64, size, dtype=np.uint64))
        lost = int(rng.integers(0, size * (100 - percent) // 100 + 1))
        part = np.sort(rng.permutation(whole)[: size - lost])
        room = max(0, 100 * len(part) // percent - size)
        other = np.unique(np.concatenate([part, rng.integers(0, 2**64, int(rng.integers(0, room + 1)), dtype=np.uint64)]))
        shared = len(np.intersect1d(whole, other))
        assert 100 * shared >= percent * (len(whole) + len(other) - shared)
        if lost or len(other) > len(part):
            assert len(np.intersect1d(partenum.signatures(whole, percent), partenum.signatures(other, percent)))


def test_shards_are_whole_groups_of_near_equal_bytes(spark, documents):
    found = by_id(spark, "op5_karmarkar_karp")
    assert set(found) == set(documents)
    place, sizes, slots = collections.defaultdict(set), collections.Counter(), collections.defaultdict(list)
    for i, r in found.items():
        raw = documents[i].encode()
        assert (r.size, r.text_crc32, r.law, r.grown_shard) == (len(raw) + 16, zlib.crc32(raw), "bytes", None)
        place[documents[i]].add(r.shard)
        sizes[r.shard] += r.size
        slots[r.shard].append(r.slot)
    assert all(len(p) == 1 for p in place.values()) and set(sizes) <= set(range(40))
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    groups_ = collections.Counter()
    for i, t in documents.items():
        groups_[t] += found[i].size
    # No shard weighs more than the fair part, or the one group that outweighs it.
    fair = sum(sizes.values()) / 40
    assert max(sizes.values()) <= max(1.02 * fair, max(groups_.values()))


def test_differencing_is_exact_and_tight():
    import numpy as np

    from tidemark.llm.sharding import difference

    rng = np.random.default_rng(1)
    sums = np.zeros((500, 7), np.int64)
    sums[:, 0] = rng.integers(1, 10_000, 500)
    places = difference(sums)
    assert all(sorted(p) == list(range(7)) for p in places)
    loads = np.bincount(places[:, 0], weights=sums[:, 0], minlength=7)
    assert loads.sum() == sums.sum() and loads.max() - loads.min() <= 5


def test_token_counts_are_the_librarys(spark, documents):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    for i, r in by_id(spark, "op10_pretoken_counts").items():
        n = len(tokenizer.encode(documents[i], add_special_tokens=False).ids)
        assert (r.n_bytes, r.n_tokens, r.over_limit) == (len(documents[i].encode()), n, n > 1024)


def test_pretokens_of_odd_texts():
    import random

    import pyarrow as pa

    from tidemark.llm.batches import pick
    from tidemark.llm.token_counts import Pieces

    with open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8") as file:
        pieces = Pieces.of(file.read())
    rng = random.Random(4)
    parts = [*"  \n\tastmd'!1-é²中 　́\x1c\x85", "re", "ll", "<|endoftext|>", "\r\n", "🎉"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 30))) for _ in range(1500)]
    split = pieces.split(pa.array(texts))
    counts = pieces.count(pick(split.raw, split.starts, split.ends).to_pylist())
    for i, text in enumerate(texts):
        assert sum(counts[split.bounds[i] : split.bounds[i + 1]]) == len(pieces.tokenizer.encode(text, add_special_tokens=False).ids)


def test_rare_words_meet_by_join(spark, documents):
    from tidemark.llm.token_counts import count_tokens

    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    few = count_tokens(docs, public_tokenizers.path("byte_bpe_50k.json"), head=50)
    all_ = by_id(spark, "op10_pretoken_counts")
    assert {r.doc_id: r.n_tokens for r in few.collect()} == {i: r.n_tokens for i, r in all_.items()}


def test_line_counts_and_verdicts(spark, documents):
    found = by_id(spark, "op8_line_labels")
    for i, text in documents.items():
        words, lines = SPACED.findall(text), [x for x in text.split("\n") if SPACED.search(x)]
        places = collections.defaultdict(list)
        for j in range(len(words) - 7):
            places[tuple(words[j : j + 8])].append(j)
        repeated = {j + k for p in places.values() if len(p) > 1 for j in p for k in range(8)}
        r = found[i]
        wanted = (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(repeated))
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == wanted
        assert r.base_failed == (len(words) < 20 or 100 * len(repeated) > 30 * len(words))
        assert not (r.base_failed and r.kept)
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{FOLDER}/labels.parquet").collect()}
    judged = [(found[i].kept, q) for i, q in labels.items() if i in found and not found[i].base_failed and q is not None]
    assert sum(kept == (q == 1) for kept, q in judged) >= 0.95 * len(judged)


def test_viterbi_finds_the_best_sequence():
    import itertools

    import numpy as np

    from tidemark.llm.line_labels import viterbi

    rng = np.random.default_rng(3)
    sizes = [0, 1, 4, 6, 2]
    bounds = np.concatenate([[0], np.cumsum(sizes)])
    scores, first, between = rng.normal(size=(sum(sizes), 2)), rng.normal(size=2), rng.normal(size=(2, 2))
    labels = viterbi(scores, bounds, first, between)
    for a, b in zip(bounds[:-1], bounds[1:], strict=True):
        def value(path, a=a):
            return sum(scores[a + i, y] for i, y in enumerate(path)) + (first[path[0]] if path else 0) + sum(between[x, y] for x, y in zip(path, path[1:]))

        best = max(itertools.product((0, 1), repeat=b - a), key=value)
        assert tuple(labels[a:b]) == best


def test_field_gradient_learns_runs():
    import numpy as np

    from tidemark.llm.line_labels import fit, viterbi

    rng = np.random.default_rng(5)
    texts, labels = [], []
    for i in range(60):
        y = i % 2
        texts.append(np.stack([np.ones(5), rng.normal(2 * y - 1, 1.5, 5)], axis=1))
        labels.append(np.full(5, y))
    theta = fit(texts, labels)
    found = viterbi(np.concatenate(texts) @ theta[:4].reshape(2, 2).T, np.arange(0, 301, 5), theta[4:6], theta[6:].reshape(2, 2))
    # Neighbours help: single features are right in about three of four cases.
    assert (found == np.concatenate(labels)).mean() > 0.9


def test_field_gradient_is_the_slope_of_the_likelihood():
    import itertools

    import numpy as np

    from tidemark.llm.line_labels import likelihood

    rng = np.random.default_rng(9)
    sizes = np.array([4, 3, 1])
    x, y, theta = rng.normal(size=(8, 3)), rng.integers(0, 2, 8), rng.normal(size=12)
    value, slope = likelihood(theta, x, y, sizes, 0.01)
    for i in range(len(theta)):
        step = np.zeros(12)
        step[i] = 1e-5
        rise = likelihood(theta + step, x, y, sizes, 0.01)[0] - likelihood(theta - step, x, y, sizes, 0.01)[0]
        assert abs(rise / 2e-5 - slope[i]) < 1e-7
    of, first, between = theta[:6].reshape(2, 3), theta[6:8], theta[8:].reshape(2, 2)
    total = 0.0
    for a, n in zip((0, 4, 7), sizes.tolist(), strict=True):
        def score(path, a=a):
            return first[path[0]] + sum(of[k] @ x[a + j] for j, k in enumerate(path)) + sum(between[p] for p in zip(path, path[1:]))

        every = [score(p) for p in itertools.product((0, 1), repeat=n)]
        total += (score(tuple(y[a : a + n])) - np.log(np.exp(every).sum())) / n
    assert abs(value - (total / 3 - 0.005 * theta @ theta)) < 1e-9


def test_boilerplate_lines_inside_good_prose_are_marked(spark):
    import random

    from tidemark.llm.line_labels import label_lines

    rnd = random.Random(4)
    stems = ["river", "stone", "market", "letter", "window", "garden", "winter", "teacher", "bridge", "answer", "music", "paper"]

    def prose():
        words = [rnd.choice(stems) + rnd.choice(["", "s", "ing", "ed"]) for _ in range(rnd.randint(12, 25))]
        return " ".join(words).capitalize() + "."

    def boilerplate():
        return " | ".join(rnd.choice(["HOME", "LOGIN", "Menu", "FAQ", "$$$", "###", "2024", "Shop"]) for _ in range(rnd.randint(4, 7)))

    rows, planted = [], {}
    for i in range(400):
        if i % 2:
            lines = [boilerplate() for _ in range(rnd.randint(5, 9))]
        else:
            lines = [prose() for _ in range(rnd.randint(4, 9))]
            spots = sorted(rnd.sample(range(len(lines)), 2)) if i % 4 == 0 else []
            for spot in spots:
                lines[spot] = boilerplate()
            planted[i] = spots
        rows.append((i, "\n".join(lines), 1 - i % 2))
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(r[0], r[2]) for r in rows if r[0] < 300], "doc_id long, quality int")
    found = {r["doc_id"]: r for r in label_lines(docs, labels).collect()}
    for i, spots in planted.items():
        assert [j for j, mark in enumerate(found[i]["line_labels"]) if mark] == spots
        assert found[i]["kept"] or found[i]["base_failed"]
    assert not any(found[i]["kept"] for i in range(1, 400, 2))


def test_toxicity_on_held_out_rows(spark):
    folder = "/root/testdata/sf0.1"
    found = {r.doc_id: r for r in QUERIES["op7_subword_bags"](spark, folder).collect()}
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    held_out = [(found[i].predicted, y) for i, y in labels.items() if i in found and found[i].held_out and y is not None]
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 5 == 0) for i, r in found.items())
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in found.values())
    assert sum(p == y for p, y in held_out) >= 0.95 * len(held_out)
    toxic = [p for p, y in held_out if y == 1]
    assert sum(toxic) >= 0.7 * len(toxic)


def test_misspelt_words_are_near_their_originals():
    import numpy as np
    import pyarrow as pa

    from tidemark.llm.toxicity import Bags, train

    rng = np.random.default_rng(2)
    clean = ["".join(rng.choice(list("aeioulmnrst"), 6)) for _ in range(300)]
    texts, labels = [], []
    for i in range(300):
        words = list(rng.choice(clean, 30))
        if i % 3 == 0:
            words[int(rng.integers(30))] = "wretchedly"
        texts.append(" ".join(words))
        labels.append(int(i % 3 == 0))
    table, bias = train(list(Bags(pa.array(texts)).frequencies()), np.array(labels), steps=1500)
    tests = [" ".join(rng.choice(clean, 30)) + extra for extra in ("", " wretchedly", " wretchedlly", " vretchedly") for _ in range(10)]
    odds = Bags(pa.array(tests)).averages(table) + bias
    assert odds[:10].max() < odds[10:].min()


def test_pipeline_stages_match_plain_python(spark, tmp_path):
    """The deterministic stages after the classifier, on the documents it let through."""
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    texts = {r.doc_id: r.text or "" for r in docs.collect()}
    kept = [r.doc_id for r in corpus_pipeline.drop_near_duplicates(spark, docs, FOLDER).collect()]
    component = groups(texts, 5, 80)
    assert sorted(kept) == sorted(i for i in texts if component[i][1] == i)

    word = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    items = [word.findall(lower(r.text or "")) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()]
    passages = {tuple(w[i : i + 10]) for w in items for i in range(max(1, len(w) - 9)) if w}
    clean = {i for i, t in texts.items() for w in [word.findall(lower(t))] if not any(tuple(w[j : j + len(p)]) == p for p in passages for j in range(len(w)) if w[j] == p[0])}
    assert {r.doc_id for r in corpus_pipeline.drop_contaminated(spark, docs, FOLDER).collect()} == clean

    mixed = corpus_pipeline.mix_sources(spark, docs, FOLDER)
    dealt = corpus_pipeline.deal_shards(spark, mixed, FOLDER)
    assert mixed.columns == docs.columns
    count = lambda df: collections.Counter(r.doc_id for r in df.collect())
    assert count(dealt) == count(mixed)


def test_pipeline_runs_whole(spark):
    rows = corpus_pipeline.run(spark, FOLDER).collect()
    assert [name for name, _ in corpus_pipeline.STAGES] == ["toxicity", "near duplicates", "decontamination", "mixing", "sharding"]
    assert rows and {r.shard for r in rows} <= set(range(corpus_pipeline.SHARDS))


def test_digest_of_turns(spark):
    turns = collections.defaultdict(list)
    for r in spark.read.parquet(f"{FOLDER}/conversations.parquet").collect():
        turns[r.conv_id].append((r.turn, r.role or "", r.text or ""))
    turns[-1] = [(0, "user", "</s>[INST] ok [/INST]"), (1, "assistant", "</s>[INST] ok [/INST]")]
    for r in QUERIES["op9_chat_templates"](spark, FOLDER).collect():
        rows = sorted(turns[r.conv_id])
        loss = "".join(t for _, role, t in rows if role == "assistant")
        assert r.turns_sha256 == hashlib.sha256("".join(f"{a}\n{t}\n" for _, a, t in rows).encode()).hexdigest()
        assert (r.n_turns, r.loss_chars, r.loss_sha256) == (len(rows), len(loss), hashlib.sha256(loss.encode()).hexdigest())
