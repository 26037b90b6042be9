"""Token alignment against a walk over both token lists in plain Python."""

import hashlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tidemark.llm.alignment import align_tokens, successors, terminals
from tidemark.llm.queries import QUERIES

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
VALUES = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


class Plain:
    def __init__(self):
        from tidemark.llm.alignment import byte_of_character

        self.a, self.b = Tokenizer.from_file(A), sentencepiece.SentencePieceProcessor(model_file=B)
        self.a.encode_special_tokens = True
        known = byte_of_character()
        self.of_a = {i: bytes(known[c] for c in name) for name, i in self.a.get_vocab().items() if all(c in known for c in name)}

    def of_b(self, i):
        piece = self.b.id_to_piece(i)
        return bytes([int(piece[3:5], 16)]) if self.b.is_byte(i) else piece.replace("▁", " ").encode()

    def walk(self, text):
        """Groups and links; None without tokens."""
        if not text:
            return None
        a, b = self.a.encode(f" {text}", add_special_tokens=False).ids, self.b.encode(text)
        a_bytes, b_bytes = [self.of_a[i] for i in a], [self.of_b(i) for i in b]
        if b"".join(a_bytes) != f" {text}".encode() or b"".join(b_bytes) != f" {text}".encode():
            return None
        links, groups, i, j, a_end, b_end, left, right = [], [], 0, 0, len(a_bytes[0]), len(b_bytes[0]), [a[0]], [b[0]]
        while True:
            links.append((a[i], b[j]))
            step_a, step_b = a_end <= b_end, b_end <= a_end
            if step_a and step_b:
                groups.append(f"{','.join(map(str, left))}|{','.join(map(str, right))}")
                left, right = [], []
            if step_a:
                i += 1
                if i == len(a):
                    return len(a), len(b), groups, links
                left.append(a[i])
                a_end += len(a_bytes[i])
            if step_b:
                j += 1
                right.append(b[j])
                b_end += len(b_bytes[j])

    def rows(self, docs):
        walked = [(i, self.walk(text)) for i, text in docs]
        counts = Counter(link for _, w in walked if w for link in w[3])
        best = Counter()
        for (_, b), n in counts.items():
            best[b] = max(best[b], n)
        for i, w in walked:
            if w is None:
                yield i, 0, 0, 0, 0, 0, 0, ""
            else:
                sums = sum(counts[x] == best[x[1]] for x in w[3]), sum(counts[x] for x in w[3])
                yield i, w[0], w[1], len(w[2]), len(w[3]), *sums, hashlib.sha256(";".join(w[2]).encode()).hexdigest()


def test_query_against_plain_python(spark):
    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()
    got = sorted(map(tuple, QUERIES["op13_token_alignment"](spark, folder).collect()))
    assert got == sorted(Plain().rows(docs)) and sum(r[1] > 0 for r in got) > 150


ODD = [
    None, "", " ", "  a  b \n c", "one ▁ two", "▁", "ｆｕｌｌ é <s> </s> <|endoftext|> x", "\x00 nul 中文 \U0001f389",
    "end with blanks  ", " begins with one", "x" * 4000 + " " + "word, Wörd! " * 900, "a b 　 c", "tab\tand\r\nlines", "it's they'll 'tis", "same text", "same text",
]


@pytest.mark.parametrize("size, head", [(1 << 22, 1 << 18), (64, 3)])
def test_odd_and_long_texts_in_stretches(spark, size, head):
    schema = "doc_id long, text string, n_a string, row int, pair int, `a.b` int"
    docs = spark.createDataFrame([(i, t, "clash", 1, 2, 3) for i, t in enumerate(ODD)], schema)
    out = align_tokens(docs, A, B, size=size, head=head)
    assert out.columns == ["doc_id", "text", "row", "pair", "a.b", *VALUES]
    got = sorted(map(tuple, out.select("doc_id", *VALUES).collect()))
    assert got == sorted(Plain().rows(list(enumerate(ODD))))
    assert got[0][1:] == (0, 0, 0, 0, 0, 0, "") and got[4][1] == 0 and got[10][1] > 5000


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert align_tokens(docs, A, B).collect() == []
    nulls = spark.createDataFrame([(None, None), (None, None)], docs.schema)
    assert align_tokens(nulls, A, B).agg(F.sum("n_links")).first()[0] == 0


def test_pointers_end_at_common_ends():
    rng = np.random.default_rng(9)
    for _ in range(50):
        total = int(rng.integers(1, 60))
        ends = [np.append(np.flatnonzero(rng.random(total) < 0.3)[:-1] + 1, total) for _ in range(2)]
        ends = [np.unique(e[e > 0]) for e in ends]
        label = terminals(successors(*ends))
        every = np.concatenate(ends)
        common = np.intersect1d(*ends)
        assert every[label].tolist() == common[np.searchsorted(common, every)].tolist()
        assert (label < len(ends[0])).all()  # of two equal ends A's
