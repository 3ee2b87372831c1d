"""Search for benchmark items inside documents: containment of shingle sets with MinHash sketches per size class.

Items are partitioned by the number of their shingles, in powers of two. The sketch of an item with q shingles is its
q - ceil(0.8 q) + 1 smallest shingle hashes. A document that contains 0.8 of the item lacks at most q - ceil(0.8 q) of its
shingles, so it holds one of the sketch: no item is missed. Where several rows share a doc_id the sketch may be in one and
the rest in another, so their shingles are sent on without it. Documents test their shingles against one bit filter per
class, of fixed size, and only against classes small enough to fit into them. Those with a hit send on their shingles that
may be of an item; an equi-join on the hash and a count then give the exact containment.

An item of fewer than five words is one shingle of its own length. Documents cut their words into runs of such a length too,
for the lengths that items have; the length is part of the hash, so runs of different lengths never meet.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.llm.common import SHINGLE_WORDS, WordHashes, map_batches, rows_in, runs, shingles, word_hashes, words_of
from tickloom.session import stored

#: An item is in a document if 100 * common shingles >= PERCENT * shingles of the item.
PERCENT = 80
#: Bits of a class's filter, and of a part of it: the filters of all classes are at most 32 * 2 MB.
FILTER_BITS = 1 << 22
PART_BITS = 1 << 15


def least_common(count: int) -> int:
    return -(-PERCENT * count // 100)


def runs_of_document(words: list[bytes], hashes: WordHashes, short: Sequence[int]) -> np.ndarray:
    """Hashes of the distinct shingles and of the runs of ``short`` lengths, in order."""
    found = [shingles(words, hashes), *(runs(words, width, hashes) for width in short if width < len(words))]
    return np.unique(np.concatenate(found)) if len(found) > 1 else found[0]


def item_shingles(items: DataFrame) -> DataFrame:
    """``item_id, n_words, n_item, size_class, hash, in_sketch``; an item without words has no rows. ``n_words`` is five for
    items of more words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = word_hashes()
        for batch in batches:
            for item, text in rows_in(batch, "item_id", "text"):
                words = words_of(text)
                found = shingles(words, hashes)
                count = len(found)
                sketch = np.arange(count) <= count - least_common(count)
                yield pa.record_batch([
                    pa.array([item] * count, pa.int64()),
                    pa.array([min(len(words), SHINGLE_WORDS)] * count, pa.int32()), pa.array([count] * count, pa.int64()),
                    pa.array([count.bit_length()] * count, pa.int32()), pa.array(found.view(np.int64)), pa.array(sketch),
                ], names=["item_id", "n_words", "n_item", "size_class", "hash", "in_sketch"])

    rows = items.select(F.col("item_id").cast("bigint"), F.col("text").cast("string"))
    return map_batches(rows, run, "item_id bigint, n_words int, n_item bigint, size_class int, hash bigint, in_sketch boolean")


def bit_filters(hashes: DataFrame) -> dict[int, np.ndarray]:
    """Per size class, which values the low bits of ``hash`` take; bitmaps are built in parts by Spark."""
    at = F.pmod("hash", F.lit(FILTER_BITS))
    parts = hashes.groupBy("size_class", F.floor(at / PART_BITS).cast("int").alias("part")).agg(
        F.bitmap_construct_agg(F.pmod(at, F.lit(PART_BITS))).alias("bits"))
    filters: dict[int, np.ndarray] = {}
    for row in parts.toLocalIterator():
        flags = filters.setdefault(row["size_class"], np.zeros(FILTER_BITS, bool))
        bits = np.unpackbits(np.frombuffer(bytes(row["bits"]), np.uint8), bitorder="little")
        flags[row["part"] * PART_BITS:][:PART_BITS] = bits[:PART_BITS]
    return {k: np.packbits(v) for k, v in filters.items()}


def contained(docs: DataFrame, items: DataFrame) -> DataFrame:
    """Per document and item in it ``doc_id, item_id, n_item, n_common, containment``.

    Shingles are distinct runs of five words; an item of fewer words is one run of its own length, which a document holds if
    these words follow one another anywhere in it. Words are cut and compared as in the similarity join. Null or empty texts contain nothing and are in nothing. Rows with one doc_id count as one document, rows
    without doc_id together as one with a null id; of items with one item_id each counts by its own shingles, and the best
    is given. Empty tables give no rows.
    """
    items = stored(item_shingles(items).distinct(), "items")
    spark = docs.sparkSession
    short = sorted(r["n_words"] for r in items.select("n_words").filter(f"n_words < {SHINGLE_WORDS}").distinct().collect())
    filters = spark.sparkContext.broadcast((bit_filters(items.filter("in_sketch")), bit_filters(items)))

    def run(batches: Iterator[pa.RecordBatch], whole: bool = False) -> Iterator[pa.RecordBatch]:
        """Shingles that may be of an item, of rows that may hold one; of all rows if ``whole``."""
        sketches, wholes = filters.value
        mask = np.uint64(FILTER_BITS - 1)
        hashes = word_hashes()

        def among(bits: np.ndarray, at: np.ndarray) -> np.ndarray:
            return (bits[at >> 3] >> (7 - (at & 7)).astype(np.uint8) & 1).astype(bool)

        for batch in batches:
            ids, sent = [], []
            for doc, text in rows_in(batch, "doc_id", "text"):
                found = runs_of_document(words_of(text), hashes, short)
                at = (found & mask).astype(np.int64)
                hit = np.zeros(len(found), bool)
                for size_class, bits in sketches.items():
                    if whole or len(found) >= least_common(1 << size_class - 1) and among(bits, at).any():
                        hit |= among(wholes[size_class], at)
                chosen = found[hit].view(np.int64)
                ids.append(np.full(len(chosen), -1 if doc is None else doc, np.int64) if doc is not None else [None] * len(chosen))
                sent.append(chosen)
            ids_out = pa.concat_arrays([pa.array(x, pa.int64()) for x in ids]) if ids else pa.array([], pa.int64())
            yield pa.record_batch(
                [ids_out, pa.array(np.concatenate(sent) if sent else [], pa.int64())], names=["doc_id", "hash"])

    rows = docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string"))
    held = stored(map_batches(rows, run, "doc_id bigint, hash bigint"), "held")
    repeated = stored(rows.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select(
        F.col("doc_id").alias("again")), "repeated")
    if not repeated.isEmpty():
        theirs = rows.join(repeated, F.col("doc_id").eqNullSafe(F.col("again")), "left_semi")
        held = held.unionByName(stored(
            map_batches(theirs, lambda batches: run(batches, whole=True), "doc_id bigint, hash bigint"), "held"))
    return (
        held.join(items.drop("n_words"), "hash").groupBy("doc_id", "item_id", "n_item")
        .agg(F.count_distinct("hash").alias("n_common"), F.max("in_sketch").alias("in_sketch"))
        .filter(f"in_sketch and 100 * n_common >= {PERCENT} * n_item")
        .withColumn("containment", F.col("n_common") / F.col("n_item"))
        .groupBy("doc_id", "item_id").agg(
            F.max(F.struct("containment", "n_item", "n_common")).alias("best"))
        .select("doc_id", "item_id", "best.n_item", "best.n_common", "best.containment")
    )
