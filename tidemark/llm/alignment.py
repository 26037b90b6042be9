"""Two tokenizers' tokens of the same text, aligned into groups and counted as pairs.

A text's tokens of both kinds stand over the same bytes. Every token points to the token
that reaches farthest right among those it overlaps, itself included; pointers are doubled,
a whole slice of texts at once, until nothing moves: then each token points to the last
token of its group, which labels it. Links are the overlapping pairs of an A and a B token.

Links are counted over the corpus per pair of ids. The counts meet the texts' pairs in two
ways: the most frequent pairs, a bounded number, through a broadcast table, all others by a join.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import chain, pairwise
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .batches import byte_sums, pick, spans
from .frequencies import HEAD
from .store import by_text, column, stored, text_key
from .stretches import Slice, sliced

#: Bytes of text that are encoded and aligned at once.
ENCODED = 3 << 20

#: Bytes of neighbouring units that are encoded in one piece.
TOGETHER = 16 << 10


def _graphic(raw: np.ndarray) -> np.ndarray:
    """Bytes of printable ASCII characters and of U+00C0 to U+00FF, none of which is a blank to either tokenizer."""
    lead = np.zeros(len(raw), bool)
    lead[:-1] = (raw[:-1] == 0xC3) & ((raw[1:] & 0xC0) == 0x80)
    out = ((raw > 0x20) & (raw < 0x7F)) | lead
    out[1:] |= lead[:-1]
    return out


def byte_of_character() -> dict[str, int]:
    """The byte-level vocabulary's characters: printable bytes stand for themselves, others count up from U+0100."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(0x100 + i): b for i, b in enumerate(others)}


class Vocabulary:
    """Bytes of each id's token, one after the other."""

    def __init__(self, tokens: list[bytes]):
        self.sizes = np.array([len(t) for t in tokens], np.int64)
        self.starts = np.concatenate([[0], np.cumsum(self.sizes)])
        self.raw = np.frombuffer(b"".join(tokens), np.uint8)

    def joined(self, ids: np.ndarray) -> np.ndarray:
        sizes = self.sizes[ids]
        ends = np.cumsum(sizes)
        return self.raw[np.repeat(self.starts[ids] - ends + sizes, sizes) + np.arange(ends[-1] if len(ends) else 0)]


class Tokenizers:
    """Both tokenizers of a process: A byte-level, B of pieces."""

    made: dict[int, Tokenizers] = {}

    def __init__(self, a_spec: str, b_model: bytes):
        import os

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_str(a_spec)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_proto=b_model)
        known, names = byte_of_character(), self.a.get_vocab()
        tokens = [b""] * (max(names.values()) + 1)
        for name, i in names.items():
            tokens[i] = bytes(known.get(c, 0x3F) for c in name)
        self.a_bytes = Vocabulary(tokens)
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        as_byte = [re.fullmatch(r"<0x([0-9A-F]{2})>", p) for p in pieces]
        self.b_bytes = Vocabulary([bytes([int(m[1], 16)]) if m else p.replace("▁", " ").encode() for p, m in zip(pieces, as_byte, strict=True)])
        # No piece goes on over a blank after something else: then both cut a text before " x".
        self.divides = not any("▁" in p.lstrip("▁") for p in pieces)

    @classmethod
    def of(cls, a_spec: str, b_model: bytes) -> Tokenizers:
        key = hash((a_spec, b_model))
        if key not in cls.made:
            cls.made[key] = cls(a_spec, b_model)
        return cls.made[key]

    def places(self, raw: np.ndarray) -> np.ndarray:
        """Single blanks between printable characters."""
        found = np.zeros(len(raw), bool)
        if self.divides:
            plain = _graphic(raw)
            found[1:-1] = (raw[1:-1] == 0x20) & plain[:-2] & plain[2:]
        return found

    def encoded(self, texts: list[str]) -> tuple[list[list[int]], list[list[int]]]:
        a = [e.ids for e in self.a.encode_batch([f" {t}" for t in texts], add_special_tokens=False)]
        return a, self.b.encode(texts, num_threads=1)


def successors(a_ends: np.ndarray, b_ends: np.ndarray) -> np.ndarray:
    """The token each of both kinds' tokens (A's, then B's) points to; of two equal ends A's."""

    def farthest(ends: np.ndarray, others: np.ndarray, first: int, own: int, ahead: bool) -> np.ndarray:
        # The last overlapping token of the other kind holds the byte before this one's end.
        near = np.minimum(np.searchsorted(others, ends, "left"), len(others) - 1)
        beyond = others[near] >= ends if ahead else others[near] > ends
        return np.where(beyond, near + first, np.arange(len(ends)) + own)

    n = len(a_ends)
    return np.concatenate([farthest(a_ends, b_ends, n, 0, False), farthest(b_ends, a_ends, 0, n, True)])


def terminals(following: np.ndarray) -> np.ndarray:
    """Each token's last successor, by doubling how far the pointers reach."""
    while True:
        further = following[following]
        if np.array_equal(further, following):
            return following
        following = further


@dataclass
class Aligned:
    """What is known of a text after some of its stretches."""

    valid: bool = True
    counts: np.ndarray = field(default_factory=lambda: np.zeros(4, np.int64))
    digest: object = None
    pairs: list[tuple[np.ndarray, np.ndarray]] = field(default_factory=list)

    def add(self, counts: np.ndarray, groups: bytes, pairs: tuple[np.ndarray, np.ndarray]) -> None:
        self.digest = self.digest or hashlib.sha256()
        self.digest.update(b";" + groups if self.counts[0] else groups)
        self.counts = self.counts + counts
        self.pairs.append(pairs)
        if len(self.pairs) > 64:
            self.pairs = [self.merged()]

    def merged(self) -> tuple[np.ndarray, np.ndarray]:
        if len(self.pairs) == 1:
            return self.pairs[0]
        pair, which = np.unique(np.concatenate([p for p, _ in self.pairs]), return_inverse=True)
        return pair, np.bincount(which, weights=np.concatenate([t for _, t in self.pairs])).astype(np.int64)


def _decimals(limit: int) -> tuple[np.ndarray, np.ndarray]:
    """Digits of the numbers below ``limit``, padded, and which of them count."""
    width = len(str(max(1, limit - 1)))
    padded = np.array([str(i).rjust(width) for i in range(limit)], f"S{width}").view(np.uint8).reshape(limit, width)
    return padded, padded != 0x20


class Aligner:
    def __init__(self, tokenizers: Tokenizers):
        self.of = tokenizers
        self.digits, self.counted = _decimals(max(len(tokenizers.a_bytes.sizes), len(tokenizers.b_bytes.sizes)))

    def stretches(self, part: Slice) -> Iterator[tuple[int, bool, tuple | None]]:
        """Per stretch: row, whether it is the text's last, and its counts, groups and pairs (None: no tokens).

        Where both kinds' tokens end a group ends, so stretches fall apart into units at the places
        where neither kind goes on. Each distinct unit of the slice is encoded and aligned once.
        """
        first = part.bounds[:-1]
        inner = np.flatnonzero(self.of.places(part.raw)) if len(part.raw) > 2 else np.zeros(0, np.int64)
        limits = np.zeros(len(part.raw) + 2, bool)
        limits[part.bounds] = True
        inner = inner[~limits[inner] & ~limits[inner + 1]]
        begins = np.sort(np.concatenate([first[np.diff(part.bounds) > 0], inner]))
        ends = np.append(begins[1:], len(part.raw))
        owner = np.searchsorted(part.bounds, begins, "right") - 1
        # A unit's own blank stands for the one that both tokenizers are given before it.
        fresh = np.append(True, part.rows[1:] != part.rows[:-1]) & ~self.continues(part)
        blank = ~(limits[begins] & fresh[owner])
        begins = begins + blank
        _, at, which = np.unique(spans(*byte_sums(part.raw), begins, ends), return_index=True, return_inverse=True)
        plain = _graphic(part.raw)
        plain = plain[np.minimum(begins[at], len(plain) - 1)] & plain[ends[at] - 1] if len(at) else np.zeros(0, bool)
        order = np.argsort(~plain, kind="stable")
        which, at = np.argsort(order)[which], at[order]
        sound, counts, lines, link_unit, link_pair = self.units(part.raw, begins[at], ends[at], int(plain.sum()))

        n = len(first)
        valid = np.bincount(owner, weights=~sound[which], minlength=n) == 0
        valid &= np.diff(part.bounds) > 0
        totals = np.stack([np.bincount(owner, weights=counts[which, i], minlength=n) for i in range(4)], axis=1).astype(np.int64)
        units = np.searchsorted(owner, np.arange(n + 1))
        pairs, pair_limits = self.pairs_of(owner, which, link_unit, link_pair, n)
        for i in range(n):
            found = None
            if valid[i]:
                of = slice(pair_limits[i], pair_limits[i + 1])
                line = b";".join([lines[u] for u in which[units[i] : units[i + 1]].tolist()])
                found = totals[i], line, (pairs[0][of], pairs[1][of])
            yield int(part.rows[i]), bool(part.last[i]), found

    @staticmethod
    def pairs_of(owner: np.ndarray, which: np.ndarray, link_unit: np.ndarray, link_pair: np.ndarray, n: int) -> tuple[tuple[np.ndarray, np.ndarray], np.ndarray]:
        """Distinct pairs of each stretch with how often they are linked in it, and where a stretch's begin."""
        distinct, number = np.unique(link_pair, return_inverse=True)
        places = np.searchsorted(link_unit, np.arange((which.max() if len(which) else 0) + 2))
        both, times = np.unique(owner * np.int64(len(places)) + which, return_counts=True)
        stretch, unit = np.divmod(both, len(places))
        sizes = places[unit + 1] - places[unit]
        links = np.repeat(places[unit] - np.cumsum(sizes) + sizes, sizes) + np.arange(sizes.sum())
        keys, spot = np.unique(np.repeat(stretch, sizes) * max(1, len(distinct)) + number[links], return_inverse=True)
        of, pair = np.divmod(keys, max(1, len(distinct)))
        total = np.bincount(spot, weights=np.repeat(times, sizes), minlength=len(keys)).astype(np.int64)
        return (distinct[pair], total), np.searchsorted(of, np.arange(n + 1))

    def continues(self, part: Slice) -> np.ndarray:
        """Whether the first stretch goes on with the text of the slice before."""
        out = np.zeros(len(part.rows), bool)
        out[0] = bool(self.open_row == part.rows[0])
        self.open_row = int(part.rows[-1]) if not part.last[-1] else -1
        return out

    open_row = -1

    def units(self, raw: np.ndarray, begins: np.ndarray, ends: np.ndarray, plain: int) -> tuple[np.ndarray, np.ndarray, list[bytes], np.ndarray, np.ndarray]:
        """Of distinct units: whether both kinds give them back, counts, group lines, and links by unit.

        The first ``plain`` units begin and end with printable characters: they can stand in one text.
        """
        written = pick(raw, begins, ends, pa.binary()).to_pylist()
        many = np.cumsum(ends - begins + 1)[:plain] // TOGETHER if self.of.divides else np.arange(plain)
        limits = [0, *(np.flatnonzero(np.diff(many)) + 1).tolist(), *([plain] if plain else []), *range(plain + 1, len(written) + 1)]
        found = self.tokens(written, limits)
        apart = [i for (low, high), f in zip(pairwise(limits), found, strict=True) if f is None and high - low > 1 for i in range(low, high)]
        alone = dict(zip(apart, self.tokens([written[i] for i in apart], list(range(len(apart) + 1))), strict=True))
        parts: list[tuple[np.ndarray, ...]] = []
        sound = np.ones(len(written), bool)
        for (low, high), f in zip(pairwise(limits), found, strict=True):
            for i, own in ((low, f),) if f is not None else ((i, alone.get(i)) for i in range(low, high)):
                if own is None:
                    sound[i] = False
                else:
                    parts.append(own)
        good = np.flatnonzero(sound)
        counts, lines = np.zeros((len(written), 4), np.int64), [b""] * len(written)
        link_unit = link_pair = np.zeros(0, np.int64)
        if len(good):
            counts[good], groups, link, link_pair = self.aligned(*[np.concatenate(x) for x in zip(*parts, strict=True)])
            for i, line in zip(good.tolist(), groups, strict=True):
                lines[i] = line
            link_unit = good[link]
        return sound, counts, lines, link_unit, link_pair

    def encoded(self, written: list[bytes], limits: list[int]) -> Iterator[tuple[tuple[int, int], bytes, tuple[list[int], list[int]]]]:
        """Units from limit to limit as one text, with the ids of both kinds; few texts at a time, as ids come as objects."""
        waiting: list[tuple[tuple[int, int], bytes]] = []
        size = 0
        for span in chain(pairwise(limits), [None]):
            if waiting and (span is None or size > 8 * TOGETHER):
                a, b = self.of.encoded([text.decode("utf-8", "replace") for _, text in waiting])
                yield from ((at, text, ids) for (at, text), ids in zip(waiting, zip(a, b, strict=True), strict=True))
                waiting, size = [], 0
            if span is not None:
                waiting.append((span, b" ".join(written[span[0] : span[1]])))
                size += len(waiting[-1][1])

    def tokens(self, written: list[bytes], limits: list[int]) -> list[tuple[np.ndarray, ...] | None]:
        """Ids of both kinds and how many of each a unit has, per text of units from limit to limit.

        None for a text that either vocabulary does not give back, or whose tokens reach over a unit's end.
        """
        out: list[tuple[np.ndarray, ...] | None] = []
        for (low, high), text, ids in self.encoded(written, limits):
            unit_ends = np.cumsum([len(w) + 1 for w in written[low:high]])
            arrays = [np.array(x, np.int64) for x in ids]
            sizes, fits = [], bool(text)
            for vocabulary, x in zip((self.of.a_bytes, self.of.b_bytes), arrays, strict=True):
                token_ends = np.cumsum(vocabulary.sizes[x])
                upto = np.searchsorted(token_ends, unit_ends, "right")
                fits = fits and vocabulary.joined(x).tobytes() == b" " + text and bool((token_ends[upto - 1] == unit_ends).all())
                sizes.append(np.diff(upto, prepend=0))
            out.append((*arrays, *sizes) if fits else None)
        return out

    def aligned(self, a: np.ndarray, b: np.ndarray, a_sizes: np.ndarray, b_sizes: np.ndarray) -> tuple[np.ndarray, list[bytes], np.ndarray, np.ndarray]:
        """Counts, group lines and links (unit, pair) of units whose tokens of both kinds cover the same bytes."""
        a_ends, b_ends = np.cumsum(self.of.a_bytes.sizes[a]), np.cumsum(self.of.b_bytes.sizes[b])
        units = len(a_sizes)
        a_unit, b_unit = np.repeat(np.arange(units), a_sizes), np.repeat(np.arange(units), b_sizes)
        label = terminals(successors(a_ends, b_ends))
        ends = np.concatenate([a_ends, b_ends])

        # Tokens in the order of their groups, A's before B's.
        order = np.lexsort((np.arange(len(label)) >= len(a), ends[label]))
        ids, kind = np.concatenate([a, b])[order], (order >= len(a)).astype(np.int8)
        unit, group = np.concatenate([a_unit, b_unit])[order], label[order]
        after_unit = np.append(unit[1:] != unit[:-1], True)
        after_group = np.append(group[1:] != group[:-1], True)
        sign = np.where(after_group, ord(";"), np.where(np.append(kind[1:], 0) != kind, ord("|"), ord(","))).astype(np.uint8)
        written = np.column_stack([self.digits[ids], sign])
        shown = np.column_stack([self.counted[ids], ~after_unit])
        line = written[shown].tobytes()
        places = np.concatenate([[0], np.cumsum(np.bincount(unit, weights=shown.sum(axis=1), minlength=units).astype(np.int64))]).tolist()

        # Between two neighbouring ends of either kind lies the overlap of one pair.
        at = np.unique(ends)
        of_a, of_b = np.searchsorted(a_ends, at), np.searchsorted(b_ends, at)
        link = a_unit[of_a]
        counts = np.stack([a_sizes, b_sizes, np.bincount(unit[after_group], minlength=units), np.bincount(link, minlength=units)], axis=1)
        return counts, [line[x:y] for x, y in pairwise(places)], link, (a[of_a] << 32) | b[of_b]

    def texts(self, column: pa.Array, size: int) -> Iterator[Aligned]:
        """Each text of the column, in order."""
        self.open_row, now = -1, Aligned()
        for part in sliced(column, self.of.places, size):
            for _, last, found in self.stretches(part):
                if found is None:
                    now.valid = False
                elif now.valid:
                    now.add(*found)
                if last:
                    yield now if now.valid and now.pairs else Aligned(valid=False)
                    now = Aligned()


def pair_counts(pairs: DataFrame) -> DataFrame:
    """``(pair, n, best)``: links of each pair of ids over the corpus, and whether no pair of its B id has more."""
    counts = stored(pairs.groupBy("pair").agg(F.sum("times").alias("n")), "pairs")
    b = F.col("pair").bitwiseAND(0xFFFFFFFF)
    highest = counts.groupBy(b.alias("b")).agg(F.max("n").alias("highest"))  # a row per id of B's vocabulary
    return counts.join(highest, b == highest["b"]).select("pair", "n", (F.col("n") == F.col("highest")).alias("best"))


def frequent_pairs(counts: DataFrame, limit: int) -> DataFrame:
    """Pairs of the highest ``n``, at most ``limit``, cut at a power of two."""
    power = F.floor(F.log2(F.col("n").cast("double"))).cast("int")
    sizes = dict(counts.groupBy(power.alias("power")).count().collect())  # a row per power of two
    cut, total = 62, 0
    for at in sorted(sizes, reverse=True):
        total += sizes[at]
        if total > limit:
            break
        cut = at
    return counts.filter(F.col("n") >= F.lit(2**cut).cast("long"))


def align_tokens(docs: DataFrame, a: str, b: str, *, text: str = "text", head: int = HEAD, size: int = ENCODED) -> DataFrame:
    """Documents with ``n_a, n_b, n_groups, n_links, n_best, count_sum`` and ``groups_sha256``.

    ``a`` is a byte-level file of the ``tokenizers`` library, ``b`` a ``sentencepiece`` model that
    puts a blank before the text; A is given the text with that blank. No special tokens: their
    strings are plain text. Groups end where tokens of both kinds end; links are the pairs of an
    A and a B token over some byte in common. A pair of ids counts as often as it is linked in the
    corpus: ``count_sum`` adds these counts over a text's links, ``n_best`` are the links whose count
    is the highest that their B id has. ``groups_sha256`` is of ``a1,a2|b1;a3|b2,b3``, the ids in order.

    Returns the input's columns and these, which replace columns of the same name. Empty table:
    empty. Null and empty texts, and texts that either vocabulary does not give back byte by byte:
    zeros and an empty string. Repeated rows: each counts, and has its text's values. Long texts:
    whole, in stretches cut at single blanks between printable characters of Latin-1, where neither kind
    of token goes on; a stretch without such a place is encoded in one piece, in about 500 bytes of memory per byte.
    """
    spark = docs.sparkSession
    files = spark.sparkContext.broadcast((Path(a).read_text(encoding="utf-8"), Path(b).read_bytes()))
    named = docs.select(text_key(column(text)).alias("key"), column(text).cast("string").alias("text"))

    def per_text(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = Aligner(Tokenizers.of(*files.value))
        row = TaskContext.get().partitionId() << 40
        for batch in batches:
            keys, found, at, weight = batch.column("key"), [], 0, 0
            for one in aligner.texts(batch.column("text"), size):
                found.append(one)
                weight += 200 + sum(len(p) for p, _ in one.pairs) * 16
                if weight > 16 * size:
                    yield _rows(found, keys.slice(at, len(found)), row)
                    row, at, found, weight = row + len(found), at + len(found), [], 0
            if found:
                yield _rows(found, keys.slice(at, len(found)), row)
                row += len(found)

    schema = "row long, key binary, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, pairs array<struct<pair: long, times: long>>"
    aligned = stored(named.mapInArrow(per_text, schema), "aligned")
    pairs = aligned.select("row", F.explode("pairs").alias("p")).select("row", "p.*")
    counts = stored(pair_counts(pairs), "pair-counts")
    common = frequent_pairs(counts, head).select(F.col("pair").alias("of"), "n", "best")
    met = pairs.join(F.broadcast(common), pairs["pair"] == common["of"], "left")
    sums = [F.sum(F.col("times") * F.col("n")).alias("count_sum"), F.sum(F.when(F.col("best"), F.col("times"))).alias("n_best")]
    # What the head does not have occurs less often than any pair in it, so no key of this join is hot.
    rare = met.filter("of IS NULL").select("row", "pair", "times").join(counts, "pair").groupBy("row").agg(*sums)
    often = met.filter("of IS NOT NULL").groupBy("row").agg(*sums)
    summed = often.unionByName(rare).groupBy("row").agg(F.sum("count_sum").alias("count_sum"), F.sum("n_best").alias("n_best"))
    own = ["n_a", "n_b", "n_groups", "n_links", "groups_sha256"]
    both = aligned.select("row", "key", *own).join(summed, "row", "left").na.fill(0, ["count_sum", "n_best"])
    # Rows of one text agree; any of them tells its values.
    names = [*own[:4], "n_best", "count_sum", "groups_sha256"]
    marks = both.groupBy("key").agg(*[F.max(c).alias(c) for c in names])
    return by_text(docs, marks.select("key", *[F.col(c).alias(f"of_{c}") for c in names]), text, **{c: F.col(f"of_{c}") for c in names})


def _rows(found: list[Aligned], keys: pa.Array, row: int) -> pa.RecordBatch:
    merged = [one.merged() if one.pairs else (np.zeros(0, np.int64), np.zeros(0, np.int64)) for one in found]
    limits = np.concatenate([[0], np.cumsum([len(p) for p, _ in merged])]).astype(np.int32)
    both = [pa.array(np.concatenate([m[i] for m in merged]), pa.int64()) for i in (0, 1)]
    counts = np.stack([one.counts for one in found])
    digests = [one.digest.hexdigest() if one.digest else "" for one in found]
    lists = pa.ListArray.from_arrays(pa.array(limits), pa.StructArray.from_arrays(both, names=["pair", "times"]))
    return pa.RecordBatch.from_arrays(
        [pa.array(np.arange(row, row + len(found))), keys, *[pa.array(counts[:, i]) for i in range(4)], pa.array(digests, pa.string()), lists],
        names=["row", "key", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "pairs"],
    )
