"""Exact top-k search by inner product: columnar branch and bound.

A block of rows lies in vertical layout, one line per dimension. Scores of a tile of queries against a block grow by one
block of dimensions at a time. What the dimensions that remain can add is at most the product of the two remaining norms, so
a pair whose score with that much more stays below the query's least known k-th score is out. Rows and queries without a
pair left are compacted away; once few pairs are left, these alone go on.

Queries go to all tasks in chunks of bounded size, each chunk meets every row in its own job, and the best ``k`` per task are
ranked once more per query.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickloom.llm.vectors import SEED_ROWS, Best, Rows, blocks, chunk_rows, exact, lower, matrix, seeds, sizes, usable
from tickloom.session import stored

SCALE = 1024.0
K = 10
#: Dimensions added at a time, and queries of a tile.
DIMENSIONS = 8
TILE = 256
#: Pairs go on one by one when no more than this share of a tile is left.
SPARSE = 0.125


def remaining(vectors: np.ndarray, starts: range) -> np.ndarray:
    """Norm of each row's components from each start on, one line per start."""
    squares = vectors.astype(np.float64) ** 2
    return np.sqrt(np.array([squares[:, s:].sum(axis=1) for s in starts]).reshape(len(starts), len(vectors)))


def survivors(queries: np.ndarray, rows: np.ndarray, least: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """Pairs (query, row, score) of at least ``least`` of the query, and how many products of two components it took."""
    kind = exact(queries, rows)
    starts = range(0, queries.shape[1], DIMENSIONS)
    q_rest, r_rest = remaining(queries, range(DIMENSIONS, queries.shape[1] + DIMENSIONS, DIMENSIONS)), remaining(
        rows, range(DIMENSIONS, queries.shape[1] + DIMENSIONS, DIMENSIONS))
    across, down = queries.astype(kind), np.ascontiguousarray(rows.T.astype(kind))
    floor = lower(least)
    q_at, r_at = np.arange(len(queries)), np.arange(len(rows))
    score = np.zeros((len(queries), len(rows)), kind)
    pairs, work = None, 0
    for step, start in enumerate(starts):
        part = slice(start, start + DIMENSIONS)
        if pairs is None:
            score += across[q_at, part] @ down[part]
            work += score.size * DIMENSIONS
            alive = score + q_rest[step][q_at, None] * r_rest[step][None, r_at] * (1 + 1e-9) >= floor[q_at, None]
            if alive.mean() <= SPARSE:
                one, other = np.nonzero(alive)
                pairs = q_at[one], r_at[other], score[one, other], other
                continue
            q_kept, r_kept = alive.any(axis=1), alive.any(axis=0)
            if r_kept.mean() < 0.75 or q_kept.mean() < 0.75:
                q_at, r_at, down = q_at[q_kept], r_at[r_kept], np.ascontiguousarray(down[:, r_kept])
                score = score[np.ix_(q_kept, r_kept)]
        else:
            one, other, sums, column = pairs
            work += len(one) * DIMENSIONS
            sums = sums + (across[one, part] * down[part, column].T).sum(axis=1)
            kept = sums + q_rest[step][one] * r_rest[step][other] * (1 + 1e-9) >= floor[one]
            pairs = one[kept], other[kept], sums[kept], column[kept]
    if pairs is None:
        one, other = np.nonzero(score >= floor[q_at, None])
        return q_at[one], r_at[other], score[one, other], work
    return *pairs[:3], work


def search(found: Best, queries: np.ndarray, query_rows: np.ndarray, block: Rows, order: np.ndarray) -> int:
    """Take the rows of a block into the queries' lists, but for a query's own row. Returns the products taken."""
    rows, work = block.vector[:, order], 0
    for start in range(0, len(queries), TILE):
        tile = slice(start, start + TILE)
        one, other, score, taken = survivors(queries[tile], rows, found.least[tile])
        one, work = one + start, work + taken
        others = query_rows[one] != block.row[other]
        found.add(one[others], score[others], block, other[others])
    return work


def top_k(df: DataFrame, is_query: Column, k: int = K, scale: float = SCALE) -> DataFrame:
    """``query_id, rank, vec_id, score`` of the ``k`` rows of ``df`` (``vec_id, embedding``; other columns are ignored) with
    the largest inner product with each query row, over ``floor(scale * x)``; equal scores by smaller vec_id, null last.

    A query's own row is no answer, another row with its vec_id is; each of several rows with a query's vec_id has its list.
    Rows without vec_id can be answers but not queries. Vectors that are null or hold a null or non-finite component take no
    part; of two vectors of different length the shorter counts as filled up with zeros. With fewer than ``k`` other rows all
    are returned; an empty table gives no rows.
    """
    rows = usable(df, is_query.alias("is_query"))
    n, width = sizes(rows)
    sample = seeds(rows)
    energy = (matrix(sample["vector"], width, scale) ** 2).sum(axis=0) if sample.num_rows else np.zeros(width)
    order = np.argsort(-energy, kind="stable")  # large components first, so that little mass remains early
    queries = rows.filter("is_query").drop("is_query")

    def bound(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Rows(sample, width, scale) if sample.num_rows else None
        for batch in batches:
            vectors, ids = matrix(batch["vector"], width, scale)[:, order], batch["row"].to_numpy()
            found = Best(batch.num_rows, k)
            search(found, vectors, ids, known, order)
            yield pa.record_batch([*batch.columns, pa.array(found.least)], names=[*batch.schema.names, "least"])

    asked = stored(queries.mapInArrow(
        bound, f"row bigint, vec_id bigint, vector {rows.schema['vector'].dataType.simpleString()}, least double"), "queries")
    chunks = -(-asked.count() // chunk_rows(width))
    results = [
        stored(_scan(rows, asked.filter(F.pmod(F.xxhash64("row"), F.lit(chunks)) == c).toArrow(), order, k, width, scale), "best")
        for c in range(chunks)
    ]
    schema = "query_row bigint, query_id bigint, row bigint, vec_id bigint, score bigint"
    each = reduce(DataFrame.union, results, df.sparkSession.createDataFrame([], schema))
    best = Window.partitionBy("query_row").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"), "row")
    return each.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score")


def _scan(rows: DataFrame, chunk: pa.Table, order: np.ndarray, k: int, width: int, scale: float) -> DataFrame:
    """The best ``k`` rows of each task for each query of a chunk."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queries, ids = matrix(chunk["vector"], width, scale)[:, order], chunk["row"].to_numpy()
        query_ids = chunk["vec_id"].to_numpy()
        found = Best(len(ids), k, chunk["least"].to_numpy())
        for block in blocks(batches, width, scale):
            search(found, queries, ids, block, order)
        yield pa.record_batch(
            [pa.array(ids[found.of]), pa.array(query_ids[found.of]), pa.array(found.row),
             pa.array(found.vec_id, mask=found.no_id), pa.array(found.score)],
            names=["query_row", "query_id", "row", "vec_id", "score"])

    return rows.select("row", "vec_id", "vector").mapInArrow(
        run, "query_row bigint, query_id bigint, row bigint, vec_id bigint, score bigint")
