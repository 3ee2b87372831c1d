"""Hard negatives for anchors: anchor-clustered shared lists.

Anchors are grouped by label and nearest of a few leading anchors. A cluster has a centre and a radius, the widest angle
between a member and the centre; a row at angle ``t`` from the centre has an inner product of at most
``|anchor| * |row| * cos(max(0, t - radius))`` with any member. The rows of a block are sorted by that bound once per cluster,
and every member walks this one list until the bound of the next row is below what can still enter its result.

A walk pays where a cluster is narrow. Of each block a few rows are bounded first; clusters whose bounds would leave out little
share plain matrix products, a tile of anchors of one label with all rows that count for it.

The first pass finds each anchor's positives over rows of its label, the second, over the others, the rows in the window that
each positive's score opens.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickloom.llm.vectors import (
    Best, Rows, blocks, chunk_rows, exact_type, lower, matrix, norms_of, products, seeds, sizes, usable)
from tickloom.session import stored

SCALE = 256.0
POSITIVES, NEGATIVES = 5, 3
#: A negative's score is between these percentages of the positive's.
LEAST, MOST = 50, 95
#: Anchors per leader, at least, and leaders at most.
LEADER_ANCHORS, LEADERS = 256, 256
#: Rows of a list that are scored at a time.
STEP = 512
#: Anchors whose products with a block are taken at a time.
TILE = 256
#: Rows of a block whose bounds say whether a cluster is walked, and how many of its members that has to spare a row on average.
PROBE_ROWS, SPARED = 128, 32
#: Labels of fewer anchors share tiles when rows of other labels are scored.
LABEL_ANCHORS = 64
#: Scores that are taken in at a time; many where rows are copies of one another.
HITS = 1 << 17
#: Tasks of a pass over the rows, at least. Each task returns its best rows of every list.
TASKS = 32


class Cluster:
    """Anchors of one label around one leader: their places among the anchors, their centre and radius."""

    def __init__(self, label: int, members: np.ndarray, vectors: np.ndarray):
        self.label, self.members = label, members
        self.norms = norms_of(vectors)
        directions = vectors[self.norms > 0] / self.norms[self.norms > 0, None]
        centre = directions.sum(axis=0)
        length = np.sqrt((centre ** 2).sum())
        self.centre = centre / length if length > 1e-9 else np.zeros(vectors.shape[1])
        self.radius = np.arccos(np.clip(directions @ self.centre, -1, 1)).max(initial=0) if length > 1e-9 else np.pi

    def bounds(self, vectors: np.ndarray, norms: np.ndarray) -> np.ndarray:
        """Most that a row's inner product with a member can be, over the member's norm."""
        cosine = np.clip(vectors @ self.centre / np.where(norms > 0, norms, 1), -1, 1)
        widest = np.cos(self.radius)
        nearer = cosine * widest + np.sqrt(1 - cosine * cosine) * np.sin(self.radius)
        return norms * (np.where(cosine >= widest, 1, nearer) + 1e-6)

    def cut(self, least: np.ndarray) -> float:
        """What a row's bound must reach to matter to a member whose score has to reach ``least``."""
        needed = lower(least)
        return np.where(self.norms > 0, needed / np.maximum(self.norms, 1e-9), np.where(needed > 0, np.inf, -np.inf)).min()


def clusters(vectors: np.ndarray, labels: np.ndarray, leaders: np.ndarray, least: int = 1) -> list[Cluster]:
    """The clusters of at least ``least`` anchors."""
    order = np.lexsort((leaders, labels))
    if not len(order):
        return []
    borders = np.flatnonzero((np.diff(labels[order]) != 0) | (np.diff(leaders[order]) != 0)) + 1
    return [Cluster(int(labels[m[0]]), m, vectors[m]) for m in np.split(order, borders) if len(m) >= least]


def walk(cluster: Cluster, anchors: np.ndarray, block: Rows, among: np.ndarray, lists) -> int:
    """Walk the rows ``among`` of a block by falling bound. ``lists.least()`` is what the members' scores must reach to matter,
    ``lists.take()`` takes scores in. Returns how many scores were computed."""
    bounds = cluster.bounds(block.vector, block.norms)[among]
    matter = bounds >= cluster.cut(lists.least(cluster.members))
    among, bounds = among[matter], bounds[matter]
    order = np.argsort(-bounds, kind="stable")
    scored = 0
    for start in range(0, len(order), STEP):
        part = order[start:start + STEP]
        walking = np.flatnonzero(cluster.norms * bounds[part[0]] >= lower(lists.least(cluster.members)))
        if not len(walking):
            break
        members = cluster.members[walking]
        scores = products(anchors[members], block.vector[among[part]])
        scored += scores.size
        lists.take(members, scores, block, among[part])
    return scored


def spared(groups: list[Cluster], block: Rows, lists) -> np.ndarray:
    """How many members of each cluster a row's bound spares on average, judged by some rows of the block."""
    every = -(-len(block.row) // PROBE_ROWS)
    vectors, norms = block.vector[::every], block.norms[::every]
    return np.array([
        (cluster.bounds(vectors, norms) < cluster.cut(lists.least(cluster.members))).mean() * len(cluster.members)
        for cluster in groups])


def meet(lists, anchors: Rows, members: np.ndarray, block: Rows) -> None:
    """Score ``members``, anchors in order of their labels, with the rows of a block, in that order too, tile by tile."""
    for group, parts in lists.meetings(anchors.label[members], block.label):
        for start, (first, end) in product(range(group.start, group.stop, TILE), parts):
            tile = members[start:min(start + TILE, group.stop)]
            kind = exact_type(anchors.norms[tile].max(), block.norms[first:end].max(), single=True)
            one, other = (x.single if kind is np.float32 else x.vector for x in (anchors, block))
            scores = one[tile].astype(kind, copy=False) @ other[first:end].astype(kind, copy=False).T
            lists.take(tile, scores, block, np.arange(first, end))


def search(lists, anchors: Rows, by_label: np.ndarray, groups: list[Cluster], block: Rows) -> None:
    """Take the rows of a block into the lists. ``by_label``: all anchors in order of their labels."""
    block = block.by_label()
    walked = [c for c, n in zip(groups, spared(groups, block, lists), strict=True) if n >= SPARED]
    for cluster in walked:
        lists.scan(cluster, anchors.vector, block)
    others = np.ones(len(by_label), bool)
    for cluster in walked:
        others[cluster.members] = False
    meet(lists, anchors, by_label[others[by_label]], block)


def reaching(scores: np.ndarray, least: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places of the scores that reach what their line needs, ``HITS`` at most at a time."""
    if scores.dtype == np.float32:  # whole numbers below 2^24
        least = np.clip(np.ceil(least), -2.0**25, 2.0**25).astype(np.float32)
    places = np.flatnonzero(scores >= least[:, None])
    for at in range(0, len(places), HITS):
        yield np.divmod(places[at:at + HITS], scores.shape[1])


def runs(labels: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """Label, first place and end of each run of sorted labels."""
    borders = np.flatnonzero(np.diff(labels)) + 1
    for first, end in zip([0, *borders], [*borders, len(labels)], strict=True):
        if first < end:
            yield int(labels[first]), int(first), int(end)


def kth(scores: np.ndarray, fits: np.ndarray, k: int) -> np.ndarray:
    """The ``k``-th largest of the scores that fit, line by line, -inf where fewer do."""
    if scores.shape[1] < k:
        return np.full(len(scores), -np.inf)
    return np.partition(np.where(fits, scores, -np.inf), -k, axis=1)[:, -k]


def windows(scores: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least and largest whole score that ``LEAST * positive <= 100 * score <= MOST * positive`` allows."""
    whole, rest = scores // 100, scores % 100
    return LEAST * whole + -(-LEAST * rest // 100), MOST * whole + MOST * rest // 100


class Positives:
    """The best rows of each anchor among those of its label."""

    def __init__(self, chunk: pa.Table):
        self.ids, least = chunk["row"].to_numpy(), chunk["least"].to_numpy()
        self.found = Best(len(self.ids), POSITIVES, least)

    def least(self, members: np.ndarray) -> np.ndarray:
        return self.found.least[members]

    def take(self, members: np.ndarray, scores: np.ndarray, block: Rows, rows: np.ndarray) -> None:
        for one, other in reaching(scores, lower(self.least(members))):
            kept = self.ids[members[one]] != block.row[rows[other]]
            one, other = one[kept], other[kept]
            self.found.add(members[one], scores[one, other], block, rows[other])

    def scan(self, cluster: Cluster, anchors: np.ndarray, block: Rows) -> int:
        return walk(cluster, anchors, block, np.flatnonzero(block.label == cluster.label), self)

    @staticmethod
    def meetings(anchors: np.ndarray, rows: np.ndarray) -> Iterator[tuple[range, list[tuple[int, int]]]]:
        """Ranges of anchors and of the rows to score with them, by their sorted labels."""
        places = {label: [(first, end)] for label, first, end in runs(rows)}
        for label, first, end in runs(anchors):
            if label in places:
                yield range(first, end), places[label]


class Negatives:
    """The best rows of each anchor and positive among those of other labels in the window of the positive's score."""

    def __init__(self, chunk: pa.Table):
        self.ids, self.label = np.repeat(chunk["row"].to_numpy(), POSITIVES), chunk["label"].to_numpy()
        self.low, self.high, third = (
            chunk[x].combine_chunks().flatten().to_numpy().reshape(-1, POSITIVES) for x in ("low", "high", "third"))
        self.found = Best(len(self.ids), NEGATIVES, third.ravel())

    def slots(self, members: np.ndarray) -> np.ndarray:
        return self.found.least.reshape(-1, POSITIVES)[members]

    def least(self, members: np.ndarray) -> np.ndarray:
        return self.slots(members).min(axis=1)

    def take(self, members: np.ndarray, scores: np.ndarray, block: Rows, rows: np.ndarray) -> None:
        for one, other in reaching(scores, lower(self.least(members))):
            kept = self.label[members[one]] != block.label[rows[other]]
            one, other = one[kept], other[kept]
            found, of = scores[one, other].astype(np.int64), members[one]
            least = lower(self.slots(members))
            fits = (found[:, None] >= least[one]) & (found[:, None] >= self.low[of]) & (found[:, None] <= self.high[of])
            at, slot = np.nonzero(fits)
            self.found.add(of[at] * POSITIVES + slot, found[at], block, rows[other[at]])

    def scan(self, cluster: Cluster, anchors: np.ndarray, block: Rows) -> int:
        return walk(cluster, anchors, block, np.flatnonzero(block.label != cluster.label), self)

    @staticmethod
    def meetings(anchors: np.ndarray, rows: np.ndarray) -> Iterator[tuple[range, list[tuple[int, int]]]]:
        """As of ``Positives``. Runs of rare labels go together, with all rows."""
        places, rare = {label: (first, end) for label, first, end in runs(rows)}, None
        for label, first, end in runs(anchors):
            if end - first < LABEL_ANCHORS:
                rare = range(first if rare is None else rare.start, end)
                continue
            if rare is not None:
                yield rare, [(0, len(rows))]
                rare = None
            start, stop = places.get(label, (0, 0))
            yield range(first, end), [x for x in ((0, start), (stop, len(rows))) if x[0] < x[1]]
        if rare is not None:
            yield rare, [(0, len(rows))]


def mine(df: DataFrame, is_anchor: Column, label: Column, scale: float = SCALE) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``: for each anchor row and each of its
    ``POSITIVES`` best other rows of its label, the ``NEGATIVES`` best rows of other labels whose score is between ``LEAST``
    and ``MOST`` percent of the positive's; scores are inner products over ``floor(scale * x)``.

    Equal scores go by smaller vec_id, null last. Rows that share a vec_id are rows of their own; an anchor's own row is none
    of its positives. Rows without label, with a null vector or with a null or non-finite component take no part; a row
    without vec_id can be positive or negative. Fewer rows than asked for are returned as they are; a positive with a negative
    score opens no window. An empty table gives no rows. Columns of ``df`` other than ``vec_id``, ``embedding`` and those that
    ``is_anchor`` and ``label`` name are ignored.
    """
    spark = df.sparkSession
    named = df.select("vec_id", "embedding", label.cast("bigint").alias("label"), is_anchor.alias("is_anchor"))
    rows = usable(named.filter("label is not null"), F.col("label"), F.col("is_anchor"))
    _, width = sizes(rows)
    kind = rows.schema["vector"].dataType.simpleString()
    chosen = rows.filter("is_anchor").drop("is_anchor")
    leading = seeds(chosen, min(LEADERS, max(1, chosen.count() // LEADER_ANCHORS)))
    sample = seeds(rows.drop("is_anchor"))

    def start(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Each anchor's leader, and its last positive among the sample as the least that can be one."""
        known, heads = Rows(sample, width, scale), matrix(leading["vector"], width, scale)
        heads /= np.maximum(np.sqrt((heads ** 2).sum(axis=1)), 1e-9)[:, None]
        for batch in tiles(batches):
            anchors, ids = matrix(batch["vector"], width, scale), batch["row"].to_numpy()
            fits = (batch["label"].to_numpy()[:, None] == known.label) & (ids[:, None] != known.row)
            least = kth(products(anchors, known.vector).astype(np.float64, copy=False), fits, POSITIVES)
            yield pa.record_batch(
                [*batch.columns, pa.array((anchors @ heads.T).argmax(axis=1).astype(np.int32)), pa.array(least)],
                names=[*batch.schema.names, "leader", "least"])

    columns = f"row bigint, vec_id bigint, vector {kind}, label bigint"
    anchors = stored(_chunked(stored(
        chosen.mapInArrow(start, f"{columns}, leader int, least double"), "anchors"), chunk_rows(width)), "chunked")
    numbers = [r["chunk"] for r in anchors.select("chunk").distinct().orderBy("chunk").collect()]

    def scanned(table: DataFrame, of: type, name: str) -> DataFrame:
        parts = [stored(_scan(rows.drop("is_anchor"), table.filter(F.col("chunk") == c).toArrow(), of, width, scale), name)
                 for c in numbers]
        return reduce(DataFrame.union, parts, spark.createDataFrame(
            [], "anchor_row bigint, slot int, row bigint, vec_id bigint, score bigint"))

    def best(each: DataFrame, keys: list[str], k: int) -> DataFrame:
        ranks = Window.partitionBy(*keys).orderBy(F.desc("score"), F.asc_nulls_last("vec_id"), "row")
        return each.withColumn("rank", F.row_number().over(ranks)).filter(F.col("rank") <= k)

    positives = stored(best(scanned(anchors, Positives, "positives"), ["anchor_row"], POSITIVES).select(
        "anchor_row", F.col("rank").alias("slot"), F.col("vec_id").alias("positive_id"),
        F.col("score").alias("positive_score")), "positives")
    scores = positives.groupBy(F.col("anchor_row").alias("row")).agg(
        F.transform(F.sort_array(F.collect_list(F.struct("slot", "positive_score"))), lambda x: x["positive_score"]).alias("scores"))

    def open_windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Each anchor's windows, and in each the last of the best rows among the sample."""
        known = Rows(sample, width, scale)
        for batch in tiles(batches):
            found_scores = products(matrix(batch["vector"], width, scale), known.vector)
            other = batch["label"].to_numpy()[:, None] != known.label[None, :]
            size, each = np.full((batch.num_rows, POSITIVES), 0, np.int64), batch["scores"].to_pylist()
            low, high, third = size + 2**62, size - 2**62, np.full(size.shape, np.inf)
            for slot in range(POSITIVES):
                has = np.array([len(x) > slot for x in each])
                low[has, slot], high[has, slot] = windows(np.array([x[slot] for x in each if len(x) > slot], np.int64))
                fits = other & (found_scores >= low[:, slot, None]) & (found_scores <= high[:, slot, None])
                third[has, slot] = np.maximum(low[has, slot], kth(found_scores, fits, NEGATIVES)[has])
            as_lists = [pa.array(list(x)) for x in (low, high, third)]
            yield pa.record_batch([*batch.columns, *as_lists], names=[*batch.schema.names, "low", "high", "third"])

    opened = stored(anchors.drop("least").join(scores, "row").mapInArrow(
        open_windows,
        f"{columns}, leader int, chunk int, scores array<bigint>, low array<bigint>, high array<bigint>, third array<double>"),
        "windows")
    negatives = best(scanned(opened, Negatives, "negatives"), ["anchor_row", "slot"], NEGATIVES)
    ids = anchors.select(F.col("row").alias("anchor_row"), F.col("vec_id").alias("anchor_id"))
    return negatives.join(positives, ["anchor_row", "slot"]).join(ids, "anchor_row").select(
        "anchor_id", "positive_id", "rank", F.col("vec_id").alias("negative_id"), "positive_score",
        F.col("score").alias("negative_score"))


def tiles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of few rows, as each is scored with the whole sample."""
    for batch in batches:
        for at in range(0, batch.num_rows, TILE):
            yield batch.slice(at, TILE)


def _chunked(anchors: DataFrame, size: int) -> DataFrame:
    """Anchors with the ``chunk`` they go in: leaders stay together, and one with more than ``size`` anchors is dealt out."""
    counts = anchors.groupBy("leader").agg(F.count(F.lit(1)).alias("n")).orderBy("leader").collect()  # LEADERS rows at most
    places, chunk, held = [], 0, 0
    for r in counts:
        parts = -(-r["n"] // size)
        if held and held + r["n"] > size:
            chunk, held = chunk + 1, 0
        places.append((r["leader"], chunk, parts))
        chunk, held = (chunk + parts, 0) if parts > 1 else (chunk, held + r["n"])
    table = anchors.sparkSession.createDataFrame(places, "leader int, first int, parts int")
    return anchors.join(F.broadcast(table), "leader").select(
        "row", "vec_id", "vector", "label", "leader", "least",
        (F.col("first") + F.pmod(F.xxhash64("row"), F.col("parts"))).cast("int").alias("chunk"))


def _scan(rows: DataFrame, chunk: pa.Table, of: type, width: int, scale: float) -> DataFrame:
    """The best rows of each task for each list of a chunk of anchors. No more tasks than can run at once in a few rounds, as
    what they return grows with their number."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        anchors, lists = Rows(chunk, width, scale), of(chunk)
        groups = clusters(anchors.vector, anchors.label, chunk["leader"].to_numpy(), SPARED)
        by_label = np.argsort(anchors.label, kind="stable")
        for block in blocks(batches, width, scale):
            search(lists, anchors, by_label, groups, block)
        found, per = lists.found, len(lists.ids) // max(1, len(anchors.row))
        yield pa.record_batch(
            [pa.array(lists.ids[found.of]), pa.array((found.of % max(1, per) + 1).astype(np.int32)), pa.array(found.row),
             pa.array(found.vec_id, mask=found.no_id), pa.array(found.score)],
            names=["anchor_row", "slot", "row", "vec_id", "score"])

    few = rows.coalesce(max(TASKS, 2 * rows.sparkSession.sparkContext.defaultParallelism))
    return few.mapInArrow(run, "anchor_row bigint, slot int, row bigint, vec_id bigint, score bigint")
