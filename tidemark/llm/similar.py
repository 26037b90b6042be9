"""Documents whose word shingles are similar, joined by partition signatures.

Equal sets are one node. A node's signatures are dealt out by signature; inside one the
nodes form a star around the smallest, and inside a task before that, so a signature of
very many nodes is never gathered. Star edges are verified by the exact similarity and
linked nodes contracted to components. Where a star leaves several components, the nodes
outside the largest are compared with all others, in blocks, so no link is lost.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .batches import NOT_SPACE, Words, mix, sequences, slices
from .components import components
from .partenum import signatures
from .store import by_text, closed, column, dropped, opened, shared_map, stored, text_key

#: Signatures that a task gathers before it links those of one kind.
GATHERED = 1 << 21
#: Nodes of a block that a task holds, and that pass by it, about.
OUTSIDERS, MEMBERS = 256, 4096


def shingle_sets(texts: pa.Array, length: int) -> Iterator[np.ndarray]:
    """Each text's sorted distinct 64-bit shingles; a shorter text is one, without words none."""
    words = Words(texts, NOT_SPACE, lower=True)
    hashes = words.hashes()
    runs = sequences(hashes, length)
    for a, b in zip(words.bounds[:-1].tolist(), words.bounds[1:].tolist(), strict=True):
        if b - a >= length:
            yield np.unique(runs[a : b - length + 1])
        elif b > a:
            yield sequences(hashes[a:b], b - a)
        else:
            yield hashes[:0]


def node_of(features: np.ndarray) -> int:
    """64 bits that stand for a set."""
    with np.errstate(over="ignore"):
        both = np.array([mix(features, 3).sum(), mix(features, 5).sum() ^ np.uint64(len(features))], np.uint64)
        return int((mix(both[:1], 9) + mix(both[1:], 13)).view(np.int64)[0])


def starred(sigs: np.ndarray, nodes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Signatures with their smallest node, and for its other nodes that one as their centre."""
    order = np.lexsort((nodes, sigs))
    sigs, nodes = sigs[order], nodes[order]
    first = np.ones(len(sigs), bool)
    first[1:] = sigs[1:] != sigs[:-1]
    centre = nodes[np.maximum.accumulate(np.where(first, np.arange(len(sigs)), 0))]
    return sigs, nodes, np.where(first | (centre == nodes), nodes, centre)


def similar_pairs(docs: DataFrame, *, shingle: int, percent: int, text: str) -> tuple[DataFrame, DataFrame]:
    """``(text_key, n_shingles, node)`` per distinct text, and the verified pairs ``(a, b)`` of nodes.

    The pairs connect what is connected: two similar sets are in one component of them.
    """
    named = docs.select(text_key(column(text)).alias("key"), column(text).cast("string").alias("text"))

    def profile(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text"):
            sets = list(shingle_sets(part.column("text"), shingle))
            yield pa.RecordBatch.from_arrays(
                [part.column("key"), pa.array([len(s) for s in sets], pa.int64()), pa.array([node_of(s) if len(s) else None for s in sets], pa.int64())],
                names=["key", "n_shingles", "node"],
            )

    profiles = named.mapInArrow(profile, "key binary, n_shingles long, node long")
    profiles = stored(profiles.groupBy("key").agg(F.max("n_shingles").alias("n_shingles"), F.max("node").alias("node")), "profiles")

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        held: list[tuple[np.ndarray, int]] = []
        count = 0

        def flush() -> pa.RecordBatch:
            sigs = np.concatenate([s for s, _ in held])
            nodes = np.repeat(np.array([n for _, n in held], np.int64), [len(s) for s, _ in held])
            sigs, nodes, centre = starred(sigs, nodes)
            local = centre != nodes
            # What is linked here already is dealt out by itself, with its signature beside it.
            place = np.where(local, mix(sigs ^ nodes.view(np.uint64), 17), sigs).view(np.int64)
            # Rows of a node side by side compress better in the shuffle.
            order = np.argsort(nodes, kind="stable")
            sigs, nodes, centre, local, place = sigs[order], nodes[order], centre[order], local[order], place[order]
            return pa.RecordBatch.from_arrays(
                [pa.array(place), pa.array(nodes), pa.array(np.where(local, centre, 0)), pa.array(np.where(local, sigs.view(np.int64), 0)), pa.array(local)],
                names=["place", "node", "centre", "signature", "linked"],
            )

        for part in slices(batches, "text"):
            for features in shingle_sets(part.column("text"), shingle):
                if len(features) and (node := node_of(features)) not in seen:
                    seen.add(node)
                    sigs = signatures(features, percent)
                    if len(sigs):
                        held.append((sigs, node))
                        count += len(sigs)
            if count >= GATHERED:
                yield flush()
                held, count = [], 0
        if held:
            yield flush()

    signed = named.select("text").mapInArrow(sign, "place long, node long, centre long, signature long, linked boolean")
    least = F.first("node").over(Window.partitionBy("place").orderBy("linked", "node"))
    stars = signed.withColumn("least", least).select(
        F.when(F.col("linked"), F.col("signature")).otherwise(F.col("place")).alias("signature"),
        F.when(F.col("linked"), F.col("centre")).otherwise(F.col("least")).alias("a"),
        F.col("node").alias("b"),
    )
    stars = stored(stars.filter("a != b"), "stars")
    sets = stored(sets_of(named, stars.select(F.explode(F.array("a", "b")).alias("node")).distinct(), shingle), "sets")
    links = verified(stars.select("a", "b"), sets, percent)

    # Signatures whose nodes did not all end in one component: what lies across is left.
    labels = stored(components(links), "labels")
    of_a = labels.select(F.col("node").alias("a"), F.col("component").alias("label_a"))
    of_b = labels.select(F.col("node").alias("b"), F.col("component").alias("label_b"))
    labelled = stars.join(of_a, "a", "left").join(of_b, "b", "left").select(
        "signature", "a", "b", F.coalesce("label_a", "a").alias("label_a"), F.coalesce("label_b", "b").alias("label_b")
    )
    labelled = stored(labelled, "labelled")
    dropped(stars, labels)
    # A star of one centre has tested all its pairs with it; only what is between the others is left.
    kinds = labelled.groupBy("signature").agg(
        F.min("a").alias("a"), F.max("a").alias("z"), F.min("label_b").alias("b0"), F.max("label_b").alias("b1"),
        F.min(F.least("label_a", "label_b")).alias("l0"), F.max(F.greatest("label_a", "label_b")).alias("l1"),
    )
    mixed = kinds.filter("(a = z AND b0 != b1) OR (a != z AND l0 != l1)").select("signature")
    unsettled = stored(labelled.join(mixed, "signature"), "open")
    dropped(labelled)
    ends = F.array(*[F.struct(F.col(x).alias("node"), F.col(f"label_{x}").alias("label")) for x in ("a", "b")])
    members = stored(unsettled.select("signature", F.explode(ends).alias("m")).select("signature", "m.*").distinct(), "members")
    families = components(unsettled.select("a", "b")).select("node", F.col("component").alias("family"))
    dropped(unsettled)
    crossing = across(in_units(members, families), sets, percent)
    dropped(members, sets)
    return profiles, links.unionByName(crossing)


def in_units(members: DataFrame, families: DataFrame) -> DataFrame:
    """``(unit, node, label)``: nodes to be compared with one another, from those of a signature each.

    Nodes that share many signatures would be compared in each of them. Of signatures with
    the same nodes, told by count and 128 bits, one is a unit. A family, which is
    what signatures connect, is one unit where that makes fewer rows than its signatures do.
    """
    bits = [F.bit_xor(F.xxhash64(F.lit(i), "node")).alias(f"bits{i}") for i in (1, 2)]
    alike = members.groupBy("signature").agg(F.count(F.lit(1)).alias("n"), *bits)
    once = alike.groupBy("n", "bits1", "bits2").agg(F.min("signature").alias("signature")).select("signature")
    members = stored(members.join(once, "signature", "left_semi").join(families, "node"), "families")
    nodes = members.select("family", "node", "label").distinct()
    by_label = nodes.groupBy("family", "label").agg(F.count(F.lit(1)).alias("n"))
    size = by_label.groupBy("family").agg(F.sum("n").alias("all"), F.max("n").alias("main"))
    rows = members.groupBy("family").agg(F.count(F.lit(1)).alias("rows"))
    whole = F.col("all") * F.ceil((F.col("all") - F.col("main")) / F.lit(float(OUTSIDERS))) <= F.col("rows")
    chosen = stored(size.join(rows, "family").select("family", whole.alias("whole")), "chosen")
    met = members.join(chosen, "family")
    unit = F.when(F.col("whole"), F.xxhash64(F.lit("family"), "family")).otherwise(F.xxhash64(F.lit("signature"), "signature"))
    return met.select(unit.alias("unit"), "node", "label").distinct()


def sets_of(named: DataFrame, nodes: DataFrame, shingle: int) -> DataFrame:
    """``(node, features)`` of the wanted nodes, from the texts."""
    wanted = shared_map(nodes.select(F.col("node").alias("bits")))

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for part in slices(batches, "text"):
            found, sets, sketches = [], [], []
            for features in shingle_sets(part.column("text"), shingle):
                if len(features) and (node := node_of(features)) not in seen and wanted.has(node):
                    seen.add(node)
                    found.append(node)
                    sets.append(features.view(np.int64))
                    sketches.append(sketch(features).tobytes())
            if found:
                columns = [pa.array(found, pa.int64()), pa.array(sets, pa.list_(pa.int64())), pa.array(sketches, pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, names=["node", "features", "sketch"])

    sets = named.select("text").mapInArrow(gather, "node long, features array<long>, sketch binary")
    sets = sets.groupBy("node").agg(F.first("features").alias("features"), F.first("sketch").alias("sketch")).join(nodes, "node", "left_semi")
    return sets.select("node", F.size("features").alias("size"), "features", "sketch")


def is_close(shared: np.ndarray | int, left: np.ndarray | int, right: int, percent: int) -> np.ndarray | bool:
    return 100 * shared >= percent * (left + right - shared)


def verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The distinct pairs of nodes whose sets are similar, by their whole sets."""
    pairs = pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    # Pairs that sizes or sketches rule out never meet the sets.
    for end in ("a", "b"):
        pairs = pairs.join(sets.select(F.col("node").alias(end), F.col("size").alias(f"size_{end}"), F.col("sketch").alias(f"sketch_{end}")), end)
    near = 100 * F.least("size_a", "size_b") >= percent * F.greatest("size_a", "size_b")

    def sift(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = batch.column("size_a").to_numpy().astype(np.int64) + batch.column("size_b").to_numpy()
            apart = [cells_apart(*(np.frombuffer(v.as_buffer(), np.uint64) for v in two)) for two in zip(batch.column("sketch_a"), batch.column("sketch_b"), strict=True)]
            kept = np.array(apart, np.int64) * (100 + percent) <= sizes * (100 - percent)
            yield batch.select(["a", "b"]).filter(pa.array(kept, pa.bool_()))

    pairs = stored(pairs.filter(near).mapInArrow(sift, "a long, b long"), "pairs")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept = []
            for i in range(batch.num_rows):
                left = batch.column("left")[i].values.to_numpy()
                right = batch.column("right")[i].values.to_numpy()
                shared = len(np.intersect1d(left, right, assume_unique=True))
                kept.append(is_close(shared, len(left), len(right), percent))
            yield batch.select(["a", "b"]).filter(pa.array(kept, pa.bool_()))

    # The spokes' sets go to the centre of their star, which is the smaller node.
    met = pairs.join(sets.select(F.col("node").alias("b"), F.col("features").alias("right")), "b")
    met = met.join(sets.select(F.col("node").alias("a"), F.col("features").alias("left")), "a")
    links = stored(met.select("a", "b", "left", "right").mapInArrow(compare, "a long, b long"), "links")
    dropped(pairs)
    return links


def across(members: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Similar pairs of nodes of one unit and different labels.

    Of ``(unit, node, label)`` rows, those outside the unit's largest component are its
    outsiders. They are compared with all members, block by block: a task holds a
    bounded number of outsiders, and members pass by one at a time. No pair becomes a row.
    Members whose size is similar to no outsider's are left out first, then, by the same
    blocks, those whose sketch differs too much from all they meet.
    """
    members = stored(members.join(sets.select("node", "size"), "node"), "sized")
    sizes = members.groupBy("unit", "label").agg(F.count(F.lit(1)).alias("n"))
    main = sizes.groupBy("unit").agg(F.max(F.struct("n", "label")).alias("main")).select("unit", F.col("main.label").alias("main"))
    outside = F.when(F.col("label") != F.col("main"), F.col("size"))
    span = members.join(main, "unit").groupBy("unit", "main").agg(
        F.min(outside).alias("least"), F.max(outside).alias("most"), F.count(outside).alias("outside")
    )
    span = stored(span.filter("outside > 0"), "span")
    meets = (100 * F.col("size") >= percent * F.col("least")) & (100 * F.col("most") >= percent * F.col("size"))
    met = meeting = stored(members.join(span, "unit").filter(meets).select("unit", "node", "label", "main"), "meeting")
    left = stored(in_blocks(met, sets, "sketch").mapInArrow(near_sketches(percent), "unit long, node long").distinct(), "left")
    met = met.join(left, ["unit", "node"], "left_semi")
    rows = in_blocks(met, sets, "features")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for pairs in met_in_blocks(batches, "features", Index, percent):
            low, high = [min(p) for p in pairs], [max(p) for p in pairs]
            yield pa.RecordBatch.from_arrays([pa.array(low, pa.int64()), pa.array(high, pa.int64())], names=["a", "b"])

    crossing = stored(rows.mapInArrow(compare, "a long, b long").distinct(), "across")
    dropped(members, span, meeting, left)
    return crossing


def in_blocks(met: DataFrame, sets: DataFrame, what: str) -> DataFrame:
    """Members ``(unit, node, label, main)`` with a column of their sets, dealt by blocks, the held ones first."""
    plan = met.groupBy("unit").agg(F.count(F.lit(1)).alias("all"), F.count_if(F.col("label") != F.col("main")).alias("out"))
    blocks = [F.ceil(c / F.lit(float(size))).cast("long").alias(name) for c, size, name in (
        (F.col("all"), MEMBERS, "m_blocks"), (F.col("out"), OUTSIDERS, "o_blocks"))]
    plan = plan.filter("all > 1 AND out > 0").select("unit", *blocks)
    placed = met.join(stored(plan, "plan"), "unit").join(sets.select("node", "size", what), "node")
    placed = placed.withColumn("m", F.pmod(F.xxhash64("node"), F.col("m_blocks"))).withColumn("o", F.pmod(F.xxhash64("node"), F.col("o_blocks")))
    others = F.explode(F.sequence(F.lit(0).cast("long"), F.col("o_blocks") - 1))
    passing = placed.withColumn("o", others).withColumn("held", F.lit(False))
    others = F.explode(F.sequence(F.lit(0).cast("long"), F.col("m_blocks") - 1))
    outsiders = placed.filter("label != main").withColumn("m", others).withColumn("held", F.lit(True))
    rows = outsiders.unionByName(passing).select(F.xxhash64("unit", "m", "o").alias("block"), "held", "unit", "node", "label", "size", what)
    return rows.repartition("block").sortWithinPartitions("block", F.desc("held"))


def met_in_blocks(batches: Iterator[pa.RecordBatch], what: str, index_of: type, percent: int, *, unit: bool = False) -> Iterator[list[tuple]]:
    """Pairs of a held and a passing node that an index of the held ones lets through, per batch."""
    block, held, index = None, [], None
    for batch in batches:
        pairs = []
        columns = [batch.column(c).to_pylist() for c in ("block", "held", "unit", "node", "label", "size")]
        for i, (at, is_held, of, node, label, size) in enumerate(zip(*columns, strict=True)):
            value = batch.column(what)[i]
            value = np.frombuffer(value.as_buffer(), np.uint64) if what == "sketch" else value.values.to_numpy()
            if at != block:
                block, held, index = at, [], None
            if is_held:
                held.append((node, label, size, value))
                continue
            if index is None:
                index = index_of(held)
            found = index.close_to(node, label, size, value, percent)
            pairs += [(of, node, *found)] if unit and found else [] if unit else [(node, x) for x in found]
        if pairs:
            yield pairs


def near_sketches(percent: int):
    """What keeps of the members of each unit those whose sketch allows a similar one among the others."""

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for found in met_in_blocks(batches, "sketch", Sketches, percent, unit=True):
            nodes = sorted({(unit, node) for unit, *both in found for node in both})
            yield pa.RecordBatch.from_arrays([pa.array([n[0] for n in nodes], pa.int64()), pa.array([n[1] for n in nodes], pa.int64())], names=["unit", "node"])

    return keep


def sketch(features: np.ndarray) -> np.ndarray:
    """Parities of the features in a power of two of cells, two to four for each feature, as 64-bit words.

    Two sketches differ in at most as many cells as their sets do in features, and half of
    a sketch laid over the other half is the sketch of half as many cells.
    """
    cells = max(64, 1 << (2 * len(features) - 1).bit_length())
    at = (mix(features, 41) & np.uint64(cells - 1)).astype(np.int64)
    return np.packbits((np.bincount(at, minlength=cells) & 1).astype(np.uint8), bitorder="little").view(np.uint64)


def folded(words: np.ndarray) -> np.ndarray:
    half = words.shape[-1] // 2
    return words[..., :half] ^ words[..., half:]


def cells_apart(left: np.ndarray, right: np.ndarray) -> int:
    """In how many cells two sketches differ, at the width of the smaller one."""
    while len(left) != len(right):
        left, right = (folded(left), right) if len(left) > len(right) else (left, folded(right))
    return int(np.bitwise_count(left ^ right).sum(dtype=np.int64))


class Sketches:
    """Sketches of a block of sets, to rule out those that differ too much from another."""

    def __init__(self, held: list[tuple[int, int, int, np.ndarray]]):
        self.kinds = {}
        for width in {len(h[3]) for h in held}:
            same = [h for h in held if len(h[3]) == width]
            nodes, labels, sizes = (np.array([h[i] for h in same], np.int64) for i in range(3))
            words = np.stack([h[3] for h in same])
            self.kinds[width] = nodes, labels, sizes, words, folded(words) if width > 1 else None

    def close_to(self, node: int, label: int, size: int, words: np.ndarray, percent: int) -> list[int]:
        found = []
        # Sets of which one is more than twice the other are never similar enough for a link of 50 in a hundred.
        for width, (nodes, labels, sizes, whole, half) in self.kinds.items():
            if width == len(words):
                differ = whole ^ words
            elif width == 2 * len(words):
                differ = half ^ words
            elif 2 * width == len(words):
                differ = whole ^ folded(words)
            else:
                differ = whole[:, :0]
                if percent > 50:
                    continue
            apart = np.bitwise_count(differ).sum(axis=1, dtype=np.int64)
            fits = (apart * (100 + percent) <= (sizes + size) * (100 - percent)) & (labels != label) & (nodes != node)
            found += nodes[fits].tolist()
        return found


class Index:
    """Features of a block of sets, to count what another set shares with each."""

    def __init__(self, held: list[tuple[int, int, int, np.ndarray]]):
        self.nodes = np.array([h[0] for h in held], np.int64)
        self.labels = np.array([h[1] for h in held], np.int64)
        self.sizes = np.array([h[2] for h in held], np.int64)
        features = np.concatenate([h[3] for h in held]) if held else np.zeros(0, np.int64)
        order = np.argsort(features, kind="stable")
        self.features = features[order]
        self.owners = np.repeat(np.arange(len(held)), self.sizes)[order]

    def close_to(self, node: int, label: int, size: int, features: np.ndarray, percent: int) -> list[int]:
        first = np.searchsorted(self.features, features, "left")
        count = np.searchsorted(self.features, features, "right") - first
        at = np.repeat(first - np.cumsum(count) + count, count) + np.arange(count.sum())
        shared = np.bincount(self.owners[at], minlength=len(self.nodes))
        found = is_close(shared, self.sizes, size, percent) & (self.labels != label) & (self.nodes != node)
        return self.nodes[found].tolist()


def similar_documents(
    docs: DataFrame, *, shingle: int = 5, percent: int = 80, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Documents with ``n_shingles`` and ``component_id``, the smallest id reachable by links.

    Words are runs of other than ASCII white space, A-Z as a-z. A document's set is its
    distinct shingles of ``shingle`` words, the whole sequence where it has fewer. Two
    documents link when their sets share at least ``percent`` in a hundred of their union.
    Columns of the two names are replaced.

    Empty table: empty. Null, empty and wordless texts: no shingles, linked with nothing,
    not even each other. Null ids: reachable, but never the smallest unless alone, when
    the component is null. Repeated rows are in one component. Long texts: whole.
    """
    profiles = grouped(docs, shingle=shingle, percent=percent, text=text)
    named = docs.select(column(doc_id).alias("id"), text_key(column(text)).alias("key"))
    least = named.join(profiles.filter("component IS NOT NULL"), "key").groupBy("component").agg(F.min("id").alias("component_id"))
    marks = profiles.join(least, "component", "left").select("key", "n_shingles", "component_id", F.col("component").isNull().alias("alone"))
    own = F.col(f"in{docs.columns.index(doc_id)}")
    return by_text(docs, marks, text, n_shingles=F.col("n_shingles"), component_id=F.when(F.col("alone"), own).otherwise(F.col("component_id")))


def grouped(docs: DataFrame, *, shingle: int, percent: int, text: str) -> DataFrame:
    """``(key, n_shingles, component)`` per distinct text; without words it has no component."""
    profiles, links = similar_pairs(docs, shingle=shingle, percent=percent, text=text)
    labels = components(links).select(F.col("node").alias("linked"), "component")
    joined = profiles.join(labels, profiles["node"] == labels["linked"], "left")
    return stored(joined.select("key", "n_shingles", F.coalesce("component", "node").alias("component")), "profiles")


def one_of_each(docs: DataFrame, *, shingle: int = 5, percent: int = 80, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents without near duplicates: of each group of linked ones the one of smallest id.

    Links are those of ``similar_documents``. Texts without words all stay. A null id is
    taken only where a group has no other; of repeated rows and equal ids one stays.
    """
    profiles = grouped(docs, shingle=shingle, percent=percent, text=text)
    named = docs.select(column(doc_id).alias("id"), text_key(column(text)).alias("key"))
    order = F.struct(F.col("id").isNull().alias("late"), "id", "key")
    first = named.join(profiles.filter("component IS NOT NULL"), "key").groupBy("component").agg(F.min(order).alias("first"))
    chosen = stored(first.select(F.col("first.id").alias("chosen_id"), F.col("first.key").alias("chosen_key")), "chosen")
    wordless = profiles.filter("component IS NULL").select(F.col("key").alias("wordless_key"))
    rows = opened(docs, id=column(doc_id), key=text_key(column(text)))
    kept = rows.join(chosen, (rows["key"] == chosen["chosen_key"]) & rows["id"].eqNullSafe(chosen["chosen_id"]), "left_semi")
    once = kept.dropDuplicates(["key", "id"]).unionByName(rows.join(wordless, rows["key"] == wordless["wordless_key"], "left_semi"))
    return closed(once, docs.columns)
