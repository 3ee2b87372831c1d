"""Similarity join of texts on word shingles with signature trees.

Leaves of a tree are texts, each with its number of shingles and a bitmap of its shingle hashes. An inner node holds
the range of sizes and the combined (OR) bitmap of its texts. Two nodes are compared only if the overlap that they can
reach at most, by sizes and bitmaps, is enough for the wanted similarity; those that pass are opened and their
children compared in turn, down to exact counts on shingle sets.

A forest instead of one tree keeps this from being all against all: the roots are the values of ``BANDS`` keys, each
made of ``BAND_ROWS`` minimum hashes, and two texts are compared if they share a root. A pair at exactly 0.8 shares
none with a probability of (1 - 0.8**5)**40 = 1.3e-7.

1. Texts with equal word sequences are one class; its smallest doc_id stands for it.
2. Each text joins the node of the text that leads most of its roots. Nodes beyond ``NODE_TEXTS`` texts or
   ``NODE_SHINGLES`` shingles are split by hash, with the leader in each part. Inside a part all pairs that are not
   yet connected are compared, which gives first components.
3. Roots that still hold several components remain. The texts of a root are its tree; beyond the size of a node it is cut
   by size band and hash, a large component apart from the rest. Pairs of nodes of a root in the same or the next band,
   others being too different in size, are traversed together, unless they hold one and the same component.

Pairs that are already connected are skipped: links between them cannot change a component.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.llm.common import components, map_batches, mix, rows_in, shingles, word_hashes, words_of
from tickloom.session import stored

BANDS, BAND_ROWS = 40, 5
NODE_TEXTS, NODE_SHINGLES = 48, 400_000
#: Texts of a node of a large root: fewer nodes meet fewer others, so each text is sent less often.
ROOT_TEXTS = 384
#: Links need 100 * intersection >= PERCENT * union.
PERCENT = 80
#: Children of a node, and texts of a node without children.
FANOUT = 8
CHUNK = 4096

_random = np.random.default_rng(20240611)
_TIMES = _random.integers(1, 2**31, (BANDS * BAND_ROWS, 1), dtype=np.uint32) * np.uint32(2) + np.uint32(1)
_PLUS = _random.integers(0, 2**32, (BANDS * BAND_ROWS, 1), dtype=np.uint32)
_FOLD = _random.integers(1, 2**63, (BAND_ROWS,), dtype=np.uint64) | np.uint64(1)
_BAND = mix(np.arange(1, BANDS + 1, dtype=np.uint64))


def band_keys(hashes: np.ndarray) -> np.ndarray:
    low = (hashes >> np.uint64(32)).astype(np.uint32)
    least = np.full(BANDS * BAND_ROWS, 2**32 - 1, np.uint32)
    for at in range(0, len(low), CHUNK):
        np.minimum(least, (low[at:at + CHUNK] * _TIMES + _PLUS).min(axis=1), out=least)
    rows = least.reshape(BANDS, BAND_ROWS).astype(np.uint64)
    return mix((rows * _FOLD).sum(axis=1, dtype=np.uint64) ^ _BAND).view(np.int64)


def bitmap(hashes: np.ndarray) -> np.ndarray:
    """One bit per shingle, among two to four times as many bits as there are shingles."""
    bits = max(64, 2 << int(len(hashes) - 1).bit_length())
    flags = np.zeros(bits, np.uint8)
    flags[(hashes & np.uint64(bits - 1)).astype(np.int64)] = 1
    return np.packbits(flags, bitorder="little").view(np.uint64)


def folded(bits: np.ndarray, length: int) -> np.ndarray:
    """The bitmap as it would be with fewer bits."""
    return bits if len(bits) <= length else np.bitwise_or.reduce(bits.reshape(-1, length), axis=0)


def combined(bitmaps: list[np.ndarray]) -> np.ndarray:
    length = min(map(len, bitmaps))
    return np.bitwise_or.reduce([folded(b, length) for b in bitmaps])


def may_link(size: tuple[int, int], bits: np.ndarray, slack: int, other_size: tuple[int, int], other: np.ndarray, other_slack: int) -> bool:
    """Whether a text of one node can be similar enough to one of the other node.

    Their common shingles set common bits, and at one length of bitmap are at most as many more than those as a text has more
    shingles than bits. ``slack`` is the most of that at the own length, so it bounds nothing after folding to a shorter one.
    """
    low, high = max(size[0], other_size[0]), min(size[1], other_size[1])
    if 100 * high < PERCENT * low:
        return False
    length = min(len(bits), len(other))
    extra = min(s for s, b in ((slack, bits), (other_slack, other)) if len(b) == length)
    most = int(np.bitwise_count(folded(bits, length) & folded(other, length)).sum()) + extra
    # |x and y| * (100 + PERCENT) >= PERCENT * (|x| + |y|)
    return most * (100 + PERCENT) >= PERCENT * (size[0] + other_size[0])


def linked(x: np.ndarray, y: np.ndarray) -> bool:
    if 100 * min(len(x), len(y)) < PERCENT * max(len(x), len(y)):
        return False
    if len(x) > len(y):
        x, y = y, x
    at = np.searchsorted(y, x)
    at[at == len(y)] = 0
    both = int((y[at] == x).sum())
    return 100 * both >= PERCENT * (len(x) + len(y) - both)


class Node:
    """Texts next to each other in size: their range of sizes, combined bitmap and the most shingles that share bits.

    A node of more than ``FANOUT`` texts has children, else ``members``.
    """

    def __init__(self, members: list[int], sets: list[np.ndarray], maps: dict[int, np.ndarray]):
        self.members = members
        share = -(-len(members) // FANOUT)
        self.children = [
            Node(members[at:at + share], sets, maps) for at in range(0, len(members), share)
        ] if share > 1 else []
        self.size = (len(sets[members[0]]), len(sets[members[-1]]))
        self.bits = combined([maps[i] for i in members])
        length = len(self.bits)
        self.slack = max(len(sets[i]) - int(np.bitwise_count(folded(maps[i], length)).sum()) for i in members)

    def may_link(self, other: Node) -> bool:
        return may_link(self.size, self.bits, self.slack, other.size, other.bits, other.slack)


class Forest:
    """Who is connected to whom among the texts of one task."""

    def __init__(self, count: int):
        self.up = list(range(count))

    def root(self, i: int) -> int:
        while self.up[i] != i:
            self.up[i] = i = self.up[self.up[i]]
        return i

    def join(self, i: int, j: int) -> None:
        a, b = self.root(i), self.root(j)
        self.up[max(a, b)] = min(a, b)


def tree(members: list[int], sets: list[np.ndarray]) -> Node:
    order = sorted(members, key=lambda i: len(sets[i]))
    return Node(order, sets, {i: bitmap(sets[i]) for i in order})


def traverse(one: Node, other: Node, sets: list[np.ndarray], forest: Forest) -> None:
    """Dual traversal: join in ``forest`` what links between two trees, or inside one if both are the same."""
    if one is not other and not one.may_link(other):
        return
    if one.children or other.children:
        left, right = one.children or [one], other.children or [other]
        for at, x in enumerate(left):
            for y in right[at:] if one is other else right:
                traverse(x, y, sets, forest)
        return
    for at, i in enumerate(one.members):
        for j in one.members[at + 1:] if one is other else other.members:
            if forest.root(i) != forest.root(j) and linked(sets[i], sets[j]):
                forest.join(i, j)


def signatures(docs: DataFrame) -> DataFrame:
    """Per row ``doc_id, n_shingles, class, roots``; ``class`` is null for a text without words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = word_hashes()
        for batch in batches:
            ids, sizes, classes, roots = [], [], [], []
            for doc, text in rows_in(batch, "doc_id", "text"):
                words = words_of(text)
                found = shingles(words, hashes)
                ids.append(doc)
                sizes.append(len(found))
                classes.append(hashlib.md5(b" ".join(words)).digest() if words else None)
                roots.append(band_keys(found) if words else None)
            yield pa.record_batch([
                pa.array(ids, pa.int64()), pa.array(sizes, pa.int64()), pa.array(classes, pa.binary()),
                pa.array(roots, pa.list_(pa.int64())),
            ], names=["doc_id", "n_shingles", "class", "roots"])

    rows = docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string"))
    return map_batches(rows, run, "doc_id bigint, n_shingles bigint, class binary, roots array<bigint>")


def shingle_sets(docs: DataFrame) -> DataFrame:
    """Per row ``id`` and the sorted shingle hashes as bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = word_hashes()
        for batch in batches:
            ids, sets = [], []
            for doc, text in rows_in(batch, "doc_id", "text"):
                ids.append(doc)
                sets.append(shingles(words_of(text), hashes).tobytes())
            yield pa.record_batch([pa.array(ids, pa.int64()), pa.array(sets, pa.binary())], names=["id", "hashes"])

    rows = docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string"))
    return map_batches(rows, run, "id bigint, hashes binary")


def _groups(batches: Iterator[pa.RecordBatch], keys: list[str], *names: str) -> Iterator[tuple[tuple, list[tuple]]]:
    """Runs of rows with equal keys; rows come sorted by them."""
    held, rows = None, []
    for batch in batches:
        for key, row in zip(rows_in(batch, *keys), rows_in(batch, *names), strict=True):
            if key != held:
                if rows:
                    yield held, rows
                held, rows = key, []
            rows.append(row)
    if rows:
        yield held, rows


def _edges(ids: list[int], forest: Forest) -> list[tuple[int, int]]:
    return list({(ids[i], ids[forest.root(i)]) for i in range(len(ids)) if ids[i] != ids[forest.root(i)]})


def _edge_batch(edges: list[tuple[int, int]]) -> pa.RecordBatch:
    return pa.record_batch(
        [pa.array([e[k] for e in edges], pa.int64()) for k in (0, 1)], names=["a", "b"])


def _inside(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for _, rows in _groups(batches, ["home", "part"], "id", "hashes"):
        ids = [r[0] for r in rows]
        sets = [np.frombuffer(r[1], np.uint64) for r in rows]
        forest = Forest(len(ids))
        root = tree(list(range(len(ids))), sets)
        traverse(root, root, sets, forest)
        yield _edge_batch(_edges(ids, forest))


def _between(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for _, rows in _groups(batches, PAIR, "side", "component", "id", "hashes"):
        ids = [r[2] for r in rows]
        sets = [np.frombuffer(r[3], np.uint64) for r in rows]
        forest = Forest(len(ids))
        of: dict[int, int] = {}
        for i, r in enumerate(rows):  # components are connected already
            forest.join(of.setdefault(r[1], i), i)
        if len(of) > 1:
            trees = [tree(x, sets) for side in (0, 1) if (x := [i for i, r in enumerate(rows) if r[0] == side])]
            traverse(trees[0], trees[-1], sets, forest)
        name = {forest.root(i): component for component, i in of.items()}
        yield _edge_batch([(c, name[forest.root(i)]) for c, i in of.items() if name[forest.root(i)] != c])


def _parts(members: DataFrame, key: str) -> DataFrame:
    """``members`` (key, id, n) with a part number, and the number of parts that each key has.

    The counts are stored, so that the join back has two plain sides and Spark can split a hot key there.
    """
    count = F.ceil(F.greatest(F.count(F.lit(1)) / NODE_TEXTS, F.sum("n") / NODE_SHINGLES)).cast("int").alias("parts")
    parts = stored(members.groupBy(key).agg(count), "parts")
    return members.join(parts, key).withColumn("part", F.pmod(F.xxhash64("id"), F.col("parts")).cast("int"))


#: What names a node of a root, and a pair of them.
NODE = ["band", "own", "part"]
PAIR = ["root", *[f"first_{c}" for c in NODE], *[f"second_{c}" for c in NODE]]
MIXED = -(2**63)


def _root_nodes(texts: DataFrame) -> DataFrame:
    """``texts`` (root, id, n, component) with ``band``, ``own`` and ``part``, which name their node in the root.

    A root of the size of a node is one node. In larger ones a band holds sizes up to a factor of 100 / PERCENT, so texts that
    link are in the same or the next band. In a band a component of more than half a node has nodes of its own, named by it;
    the rest is ``MIXED``. Either is dealt into parts by hash.
    """
    parts = F.ceil(F.greatest(F.count(F.lit(1)) / ROOT_TEXTS, F.sum("n") / NODE_SHINGLES)).cast("int")
    whole = stored(texts.groupBy("root").agg(parts.alias("whole")), "roots")
    band = F.when(F.col("whole") == 1, 0).otherwise(F.floor(F.log("n") / math.log(100 / PERCENT) + 1e-9)).cast("int")
    banded = stored(texts.join(whole, "root").select(*texts.columns, "whole", band.alias("band")), "bands")
    alike = stored(banded.groupBy("root", "band", "component").agg(F.count(F.lit(1)).alias("alike")), "alike")
    own = F.when((F.col("whole") > 1) & (2 * F.col("alike") > ROOT_TEXTS), F.col("component")).otherwise(F.lit(MIXED))
    owned = stored(banded.join(alike, ["root", "band", "component"]).select(*texts.columns, "band", own.alias("own")), "owned")
    count = stored(owned.groupBy("root", "band", "own").agg(parts.alias("parts")), "parts")
    return stored(
        owned.join(count, ["root", "band", "own"])
        .withColumn("part", F.pmod(F.xxhash64("id"), F.col("parts")).cast("int")),
        "nodes")


def _node_pairs(nodes: DataFrame) -> DataFrame:
    """Rows of ``PAIR``: the pairs of nodes of a root, and each node with itself, that may hold an unknown link. Sizes have
    to allow it, and nodes of one component hold none."""
    named = nodes.select("root", *NODE).distinct()
    one = named.toDF("root", *[f"first_{c}" for c in NODE])
    two = named.toDF("root", *[f"second_{c}" for c in NODE])
    return one.join(two, "root").filter(
        "second_band - first_band between 0 and 1 and (second_band > first_band or second_own > first_own "
        "or second_own = first_own and second_part >= first_part)"
    ).filter(f"first_own <> second_own or first_own = {MIXED}")


def similar_components(docs: DataFrame) -> DataFrame:
    """Per row of ``docs`` (``doc_id, text``; other columns are ignored): ``doc_id, n_shingles, component_id``.

    Two texts link at a Jaccard similarity of 0.8 or more on their distinct shingles of five words. ``component_id`` is
    the smallest doc_id that can be reached over links. A text that is null or without words links with nothing. Rows
    with one doc_id count as one document: what links with one of them links with all. A row without doc_id is
    connected by its text like the others and gets the component's smallest doc_id, or null if there is none.
    An empty table gives no rows.
    """
    signed = stored(signatures(docs), "signatures")
    worded = signed.filter("class is not null and doc_id is not null")
    classes = stored(worded.groupBy("class").agg(F.min("doc_id").alias("id"), F.first("n_shingles").alias("n"), F.first("roots").alias("roots")), "classes")

    rooted = classes.select("id", "n", F.explode("roots").alias("root"))
    leaders = stored(rooted.groupBy("root").agg(F.min("id").alias("leader"), F.count(F.lit(1)).alias("texts")).filter("texts > 1").select("root", "leader"), "leaders")
    shared = stored(rooted.join(leaders, "root"), "shared")
    homes = (
        shared.groupBy("id", "n", "leader").agg(F.count(F.lit(1)).alias("votes"))
        .groupBy("id", "n").agg(F.min_by("leader", F.struct(-F.col("votes"), F.col("leader"))).alias("home"))
    )
    members = stored(homes, "homes")
    parted = stored(_parts(members, "home").select("home", "part", "id", "parts"), "parted")
    leading = parted.select("home", "parts").distinct().select(
        "home", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), F.col("home").alias("id"))
    ids = members.select(F.col("id").alias("doc_id")).distinct()
    sets = stored(shingle_sets(docs.select("doc_id", "text").join(ids, "doc_id", "left_semi")), "sets")

    placed = parted.select("home", "part", "id").union(leading).distinct()
    inside = placed.join(sets, "id").repartition("home", "part").sortWithinPartitions("home", "part")
    edges = stored(map_batches(inside.select("home", "part", "id", "hashes"), _inside, "a bigint, b bigint"), "edges")

    labels = components(edges)
    labelled = stored(
        members.join(labels, "id", "left").select("id", "n", F.coalesce("component", "id").alias("component")), "labelled")
    at_root = stored(shared.select("root", "id").join(labelled, "id"), "rooted")
    mixed = stored(
        at_root.groupBy("root").agg(F.min("component").alias("x"), F.max("component").alias("y"))
        .filter("x < y").select("root"), "mixed")
    nodes = _root_nodes(at_root.join(mixed, "root").select("root", "id", "n", "component"))
    pairs = stored(_node_pairs(nodes), "pairs")

    def side(number: int, name: str) -> DataFrame:
        itself = " and ".join(f"first_{c} = second_{c}" for c in NODE)
        chosen = pairs if number == 0 else pairs.filter(f"not ({itself})")
        return (
            chosen.withColumns({c: F.col(f"{name}_{c}") for c in NODE})
            .join(nodes.select("root", *NODE, "id", "component"), ["root", *NODE])
            .select(*PAIR, F.lit(number).alias("side"), "component", "id")
        )

    opened = (
        side(0, "first").union(side(1, "second")).join(sets, "id").repartition(*PAIR).sortWithinPartitions(*PAIR)
    )
    between = map_batches(opened.select(*PAIR, "side", "component", "id", "hashes"), _between, "a bigint, b bigint")
    merged = components(between).select(F.col("id").alias("component"), F.col("component").alias("merged"))
    final = labelled.join(merged, "component", "left").select("id", F.coalesce("merged", "component").alias("component"))

    of_class = stored(
        classes.select("class", "id").join(final, "id", "left").select("class", F.coalesce("component", "id").alias("component")),
        "of_class",
    )
    return signed.select("doc_id", "n_shingles", "class").join(of_class, "class", "left").select(
        "doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id"))
