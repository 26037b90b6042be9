"""Spelling variants: words one edit apart, grouped under the most frequent.

Near words are found by dynamic programming over sorted lists. Of two words one edit apart
the bytes before and behind the edit agree, so each word goes to the lists of those that
share its first half, and of those that share its second. A list is sorted, the common
prefixes of neighbours (LCP) cut it into ranges, and a range has one row of the edit matrix
per query word, reduced to the band of three cells that one edit can reach. The words of a
range begin with that row and only compute what follows; a range whose row exceeds one edit
is left out whole. All queries of all lists advance by one character at a time, in numpy.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .batches import LOWER, byte_sums, pick, spans
from .store import column, stored
from .stretches import sliced

#: A list of more words is divided by a second part that its words share.
LIST = 20_000
#: Rows of lists in a task's group, about.
BUCKET = 16_384
#: Pairs of a range and a query word that advance at once, about.
PAIRS = 1 << 19

# --- words -------------------------------------------------------------------

_LETTER = np.zeros(256, bool)
_LETTER[0x41:0x5B] = _LETTER[0x61:0x7B] = True
_LEAD = 0xC3  # in UTF-8 the first byte of U+00C0 to U+00FF, and of no other


def _table() -> np.ndarray:
    row = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        row = np.where(row & 1, (row >> 1) ^ np.uint32(0xEDB88320), row >> 1)
    return row


_CRC = _table()


def in_run(raw: np.ndarray) -> np.ndarray:
    """Bytes of A-Z, a-z and U+00C0 to U+00FF."""
    lead = np.zeros(len(raw), bool)
    lead[:-1] = (raw[:-1] == _LEAD) & ((raw[1:] & 0xC0) == 0x80)
    letter = _LETTER[raw] | lead
    letter[1:] |= lead[:-1]
    return letter


def continued_crc(states: np.ndarray, raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """CRC-32 of each stretch of bytes behind what each given CRC-32 has seen."""
    sizes = ends - starts
    order = np.argsort(-sizes, kind="stable")
    state, begin, size = ~states[order], starts[order], sizes[order]
    # All stretches by one byte at a time; the few long ones by themselves.
    long = int(np.searchsorted(-size, -64, "left"))
    for i in range(long):
        state[i] = ~np.uint32(zlib.crc32(raw[begin[i] : begin[i] + size[i]].tobytes(), int(~state[i])))
    upto = len(size)
    for k in range(int(size[long]) if long < upto else 0):
        upto = int(np.searchsorted(-size, -k, "left"))
        now = state[long:upto]
        state[long:upto] = _CRC[(now ^ raw[begin[long:upto] + k]) & 0xFF] ^ (now >> 8)
    out = np.empty_like(state)
    out[order] = ~state
    return out


def word_counts(docs: DataFrame, *, doc_id: str, text: str, min_length: int, min_count: int, drop_every: int | None) -> DataFrame:
    """``(word, length, n)`` of all documents' words, lower-cased from A-Z."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("id")
            for part in sliced(batch.column("text"), lambda raw: ~in_run(raw)):
                yield counted(ids, part)

    def counted(ids: pa.Array, part) -> pa.RecordBatch:
        raw, edges = LOWER[part.raw], part.bounds
        inside = np.zeros(len(raw) + 2, bool)
        inside[1:-1] = in_run(part.raw)
        first = np.zeros(len(raw) + 1, bool)
        first[edges] = True
        starts = np.flatnonzero(inside[1:-1] & (~inside[:-2] | first[:-1]))
        ends = np.flatnonzero(inside[1:-1] & (~inside[2:] | first[1:])) + 1
        leads = np.concatenate([[0], np.cumsum(raw == _LEAD)])
        lengths = ends - starts - (leads[ends] - leads[starts])
        changed: Counter[str] = Counter()
        if drop_every:
            names = [f"{'' if i is None else i}:".encode() for i in ids.take(pa.array(part.rows)).to_pylist()]
            seen = np.array([zlib.crc32(name) for name in names], np.uint32)
            of = np.searchsorted(edges, starts, "right") - 1
            crc = continued_crc(seen[of], raw, starts, ends)
            hit = crc % np.uint32(drop_every) == 0
            for i in np.flatnonzero(hit).tolist():
                run, at = raw[starts[i] : ends[i]].tobytes().decode(), int(crc[i]) % int(lengths[i])
                changed[run[:at] + run[at + 1 :]] += 1
            starts, ends, lengths = starts[~hit], ends[~hit], lengths[~hit]
        enough = lengths >= min_length
        starts, ends = starts[enough], ends[enough]
        _, at, times = np.unique(spans(*byte_sums(raw), starts, ends), return_index=True, return_counts=True)
        more = [(w, n) for w, n in changed.items() if len(w) >= min_length]
        words = pa.concat_arrays([pick(raw, starts[at], ends[at]), pa.array([w for w, _ in more], pa.string())])
        return pa.RecordBatch.from_arrays([words, pa.array([*times.tolist(), *(n for _, n in more)], pa.int64())], names=["word", "n"])

    named = docs.select(column(doc_id).cast("string").alias("id"), column(text).cast("string").alias("text"))
    found = named.mapInArrow(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return found.filter(F.col("n") >= min_count).select("word", F.length("word").alias("length"), "n")


# --- near words --------------------------------------------------------------


def _list_key(size: Column, start: Column, end: Column) -> Column:
    """What the words of a list share: all of a word of ``size`` but its characters from ``start`` to ``end``."""
    parts = [size.cast("string"), start.cast("string"), F.left("word", start), F.expr("right(word, size - end)")]
    return F.concat_ws("\x00", *parts)


def _listed(rows: DataFrame) -> DataFrame:
    return rows.withColumn("list", _list_key(F.col("size"), F.col("start"), F.col("end")))


def in_lists(words: DataFrame, limit: int = LIST) -> DataFrame:
    """A row per word and list that it belongs to: ``word, n, size, start, end, list``.

    Words of ``size`` and one less that differ in one character from ``start`` to ``end`` share a list.
    A list above ``limit`` words is divided in two by halving that span, down to two characters,
    where it has at most as many words as the alphabet has pairs and single characters.
    """
    sizes = F.explode(F.array(F.col("length"), F.col("length") + 1))
    halves = F.explode(F.array(F.struct(F.lit(0).alias("start"), F.floor(F.col("size") / 2).cast("int").alias("end")),
                               F.struct(F.floor(F.col("size") / 2).cast("int").alias("start"), F.col("size").alias("end"))))
    rows = words.select("word", "n", sizes.alias("size")).select("word", "n", "size", halves.alias("h")).select("word", "n", "size", "h.*")
    rows, done = _listed(rows), None
    while True:
        wide = rows.filter(F.col("end") - F.col("start") > 2)
        large = stored(wide.groupBy("list").count().filter(F.col("count") > limit).select("list"), "large-lists")
        if large.isEmpty():
            return rows if done is None else done.unionByName(rows)
        small = rows.join(large, "list", "left_anti")
        done = small if done is None else done.unionByName(small)
        middle = F.floor((F.col("start") + F.col("end")) / 2).cast("int")
        halves = F.array(F.struct("start", middle.alias("end")), F.struct(middle.alias("start"), "end"))
        cut = rows.join(large, "list", "left_semi").select("word", "n", "size", F.explode(halves).alias("h"))
        rows = _listed(cut.select("word", "n", "size", "h.*"))


def neighbours(letters: np.ndarray, sizes: np.ndarray, lists: np.ndarray, shared: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Positions of words of one list that are one edit apart, each pair both ways.

    ``letters`` has a word per row, padded with 0; rows are sorted by list and word, words
    of a list differ, and share their first ``shared`` characters.
    """
    n, width = letters.shape
    equal = (letters[1:] == letters[:-1]) & (lists[1:] == lists[:-1])[:, None]
    lcp = np.concatenate([[-1], np.where(lists[1:] != lists[:-1], -1, np.argmin(np.column_stack([equal, np.zeros(n - 1, bool)]), axis=1)), [-1]])
    padded = np.zeros((n, width + 2), np.uint8)
    padded[:, :width] = letters
    # A range of the first depth is a list; every word of it is a query.
    opens = np.flatnonzero(lcp[:-1] < shared)
    closes = np.append(opens[1:], n)
    per_list = closes - opens
    blocks, at = [], 0
    cost = np.cumsum(per_list * np.minimum(per_list, 64))
    while at < len(opens):
        upto = max(at + 1, int(np.searchsorted(cost, (cost[at - 1] if at else 0) + PAIRS, "right")))
        blocks.append((at, upto))
        at = upto
    for a, b in blocks:
        query = np.arange(opens[a], closes[b - 1])
        start, end = np.repeat(opens[a:b], per_list[a:b]), np.repeat(closes[a:b], per_list[a:b])
        # Cells of the band: the query's prefix one shorter, as long and one longer than the range's.
        less, same, more = np.ones(len(query), np.uint8), np.zeros(len(query), np.uint8), np.ones(len(query), np.uint8)
        for depth in range(shared, width + 1):
            # The first word of a range may end here, in the cell of the query's whole length.
            stops = np.flatnonzero(sizes[start] == depth)
            ahead = sizes[query[stops]].astype(int) - depth
            cell = np.where(ahead == -1, less[stops], np.where(ahead == 0, same[stops], more[stops]))
            near = stops[(np.abs(ahead) <= 1) & (cell == 1)]
            yield start[near], query[near]
            if depth == width or not len(query):
                break
            # Ranges of one character more: they begin at the words that share less with the one before.
            begins = np.flatnonzero(lcp[:-1] <= depth)
            begins = begins[sizes[begins] > depth]
            low, high = np.searchsorted(begins, start), np.searchsorted(begins, end)
            times = high - low
            which = np.repeat(np.arange(len(start)), times)
            child = begins[np.repeat(low - np.cumsum(times) + times, times) + np.arange(len(which))]
            limits = np.flatnonzero(lcp <= depth)
            until = limits[np.searchsorted(limits, child, "right")]
            char, query = padded[child, depth], query[which]
            before = padded[query, depth - 1] if depth else np.zeros(len(query), np.uint8)
            old_less, old_same, old_more = less[which], same[which], more[which]
            less = np.minimum(old_less + (char != before), old_same + 1)
            same = np.minimum(np.minimum(old_same + (char != padded[query, depth]), old_more + 1), less + 1)
            more = np.minimum(old_more + (char != padded[query, depth + 1]), same + 1)
            alive = np.minimum(np.minimum(less, same), more) <= 1
            start, end, query = child[alive], until[alive], query[alive]
            less, same, more = (np.minimum(cells[alive], 2).astype(np.uint8) for cells in (less, same, more))


def _near_in(table: pa.Table) -> pa.Table:
    """Per word of some whole lists: how many near words, and the most frequent of them."""
    words = np.array([w.encode("latin-1") for w in table.column("word").to_pylist()], object)
    numbers = table.column("n").to_numpy()
    size, start, end = (table.column(c).to_numpy() for c in ("size", "start", "end"))
    _, lists, members = np.unique(pc.dictionary_encode(table.column("list").combine_chunks()).indices.to_numpy(), return_inverse=True, return_counts=True)
    found = []
    kinds, kind = np.unique(np.stack([size, start, end]), axis=1, return_inverse=True)
    kind = np.where(members[lists] > 1, kind.ravel(), -1)  # a list of one word has no pair
    for k, (m, a, b) in enumerate(kinds.T.tolist()):
        rows = np.flatnonzero(kind == k)
        if not len(rows):
            continue
        # Words whose last part agrees are read from the end.
        flip = a == 0
        mine = np.array([w[::-1] for w in words[rows]] if flip else list(words[rows]), f"S{m}")
        order = np.lexsort((mine, lists[rows]))
        rows, mine = rows[order], mine[order]
        letters = mine.view(np.uint8).reshape(len(rows), m)
        sizes = np.char.str_len(mine)
        for word, near in neighbours(letters, sizes, lists[rows], m - b if flip else a):
            # A pair counts in the lists of its longer word's size, at the first place where the two differ.
            fits = np.maximum(sizes[word], sizes[near]) == m
            word, near = word[fits], near[fits]
            differ = letters[word] != letters[near]
            if flip:
                spare = np.minimum(sizes[word], sizes[near])
                at = _first_difference(letters, word, near, sizes, spare)
            else:
                at = np.argmax(differ, axis=1)
            keep = (at >= a) & (at < b)
            found.append((rows[word[keep]], rows[near[keep]]))
    if found:
        of, near = np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found])
    else:
        of = near = np.zeros(0, np.int64)
    names = words[near] if len(near) else np.zeros(0, object)
    order = np.lexsort((names.astype(bytes) if len(near) else names, -numbers[near], words[of].astype(bytes) if len(near) else names))
    of, near = of[order], near[order]
    begin = np.ones(len(of), bool)
    begin[1:] = words[of[1:]] != words[of[:-1]]
    first = np.flatnonzero(begin)
    times = np.diff(np.append(first, len(of)))
    text = table.column("word").combine_chunks()
    return pa.table({
        "word": text.take(pa.array(of[first])), "n_near": pa.array(times, pa.int64()),
        "form_n": pa.array(numbers[near[first]], pa.int64()), "form": text.take(pa.array(near[first])),
    })


def _first_difference(letters: np.ndarray, word: np.ndarray, near: np.ndarray, sizes: np.ndarray, spare: np.ndarray) -> np.ndarray:
    """Length of the common prefix of words that are stored from their end."""
    m = letters.shape[1]
    at = np.zeros(len(word), np.int64)
    open_ = np.arange(len(word))
    for i in range(m):
        open_ = open_[i < spare[open_]]
        w, v = word[open_], near[open_]
        open_ = open_[letters[w, sizes[w] - 1 - i] == letters[v, sizes[v] - 1 - i]]
        if not len(open_):
            break
        at[open_] += 1
    return at


def near_words(words: DataFrame, limit: int = LIST) -> DataFrame:
    """``(word, n_near, form_n, form)``: near words of each that has any, and the most frequent of them."""
    rows = stored(in_lists(words, limit), "lists")
    buckets = max(rows.count() // BUCKET, int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    dealt = rows.groupBy(F.pmod(F.xxhash64("list"), F.lit(buckets)).alias("bucket"))
    found = dealt.applyInArrow(_near_in, "word string, n_near long, form_n long, form string")
    best = F.min(F.struct((-F.col("form_n")).alias("less"), "form")).alias("best")
    found = found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best)
    return found.select("word", "n_near", (-F.col("best.less")).alias("form_n"), "best.form")


def with_roots(forms: DataFrame) -> DataFrame:
    """``(word, form, root)`` of words with a form: forms followed to the last, twice as far each round."""
    rows = stored(forms.select("word", "form", F.col("form").alias("root")), "forms")
    while True:
        further = rows.select(F.col("word").alias("root"), F.col("root").alias("next"))
        rows = stored(rows.join(further, "root", "left").select("word", "form", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "forms")
        moved = not rows.filter("moved").isEmpty()
        rows = rows.select("word", "form", "root")
        if not moved:
            return rows


def spelling_variants(
    docs: DataFrame,
    *,
    doc_id: str = "doc_id",
    text: str = "text",
    min_length: int = 5,
    min_count: int = 3,
    ratio: int = 2,
    drop_every: int | None = None,
    limit: int = LIST,
) -> DataFrame:
    """``(word, n, n_near, form, form_n, root)`` for each word of the documents' texts.

    Words are maximal runs of A-Z, a-z and U+00C0 to U+00FF, lower-cased from A-Z, of at least
    ``min_length`` characters and ``min_count`` occurrences (``n``). Near words differ by one
    character inserted, deleted or replaced; ``n_near`` tells how many there are. The form is the
    most frequent near word (of equal ones the smallest) if it occurs ``ratio`` times as often or
    more, else null; ``ratio`` must be above 1. The root is the last form reached from a word.

    ``drop_every`` plants misspellings: a run loses a character where it divides the CRC-32 of
    ``<doc_id>:<run>``, the one at that CRC-32 modulo the run's length.

    Empty table, null and empty texts: no words. Null ids: as an empty id. Repeated rows:
    each occurrence counts. Long texts: whole, in stretches cut between runs; a run itself is never
    cut. Other columns are not looked at.
    """
    if ratio <= 1:
        raise ValueError("ratio must be above 1, or forms may lead in a circle")
    words = stored(word_counts(docs, doc_id=doc_id, text=text, min_length=max(1, min_length), min_count=min_count, drop_every=drop_every), "words")
    near = words.join(near_words(words, limit), "word", "left")
    fits = F.col("form_n") >= F.col("n") * F.lit(ratio)
    near = near.select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(fits, F.col("form")).alias("form"), F.when(fits, F.col("form_n")).alias("form_n"))
    near = stored(near, "near-words")
    roots = with_roots(near.filter("form IS NOT NULL")).select("word", "root")
    return near.join(roots, "word", "left").select("word", "n", "n_near", "form", "form_n", F.coalesce("root", "word").alias("root"))
