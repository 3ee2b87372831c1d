"""What the searches over vectors share: usable rows, blocks of rows as matrices, sorted best lists, query chunks.

Components become whole numbers, so that scores are exact: blocks hold them as doubles while no inner product can pass 2^53, as
64-bit integers up to 2^62, and a score beyond that is an error, as overflow is in SQL.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.session import stored

#: Rows of a block.
BLOCK_ROWS = 4096
#: Components of the queries that are sent to all tasks at once: 32 MB of doubles. More queries go in more chunks.
CHUNK_VALUES = 4_000_000
#: Rows, of the smallest hashes, whose scores give each query a first lower bound. It only saves work.
SEED_ROWS = 2048


def usable(df: DataFrame, *columns: Column) -> DataFrame:
    """``row, vec_id, vector`` and ``columns`` of the rows whose vector and components are neither null nor infinite nor
    NaN, as a table. ``row`` tells apart rows that share a vec_id."""
    sound = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < F.lit(float("inf"))))
    rows = df.filter(F.col("embedding").isNotNull() & sound)
    return stored(rows.select(
        F.monotonically_increasing_id().alias("row"), F.col("vec_id").cast("bigint"), F.col("embedding").alias("vector"),
        *columns), "vectors")


def matrix(column: pa.ChunkedArray | pa.Array, width: int, scale: float) -> np.ndarray:
    """Rows of ``floor(scale * x)``; a vector shorter than ``width`` counts as filled up with zeros."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    lengths = column.value_lengths().to_numpy(zero_copy_only=False)
    values = np.floor(scale * column.flatten().to_numpy(zero_copy_only=False).astype(np.float64))
    if (lengths == width).all():
        return values.reshape(len(column), width)
    out = np.zeros((len(column), width))
    at = np.repeat(np.arange(len(column)), lengths)
    out[at, np.arange(len(values)) - np.repeat(np.cumsum(lengths) - lengths, lengths)] = values
    return out


def norms_of(rows: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return np.sqrt((rows * rows).sum(axis=1))


def exact(one: np.ndarray, other: np.ndarray) -> type:
    """The type in which inner products of the two matrices' rows are exact."""
    return exact_type(norms_of(one).max(initial=0), norms_of(other).max(initial=0))


def exact_type(one: float, other: float, single: bool = False) -> type:
    """The same by the largest lengths of rows on both sides. Only ``single`` allows 32-bit floats: every sum on the way to
    an inner product is a whole number of at most the product of the lengths, and exact below 2^24."""
    most = one * other
    if not most < 2.0**62:
        raise OverflowError("inner products do not fit 64 bits")
    if single and max(one, other, most) < 2.0**24:
        return np.float32
    return np.float64 if most < 2.0**53 else np.int64


def products(one: np.ndarray, other: np.ndarray) -> np.ndarray:
    """Inner products of all rows of the two matrices."""
    kind = exact(one, other)
    return one.astype(kind, copy=False) @ other.astype(kind, copy=False).T


def numbers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Values, 0 for null, and whether they are null."""
    missing = column.is_null().to_numpy(zero_copy_only=False)
    return column.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64), missing


class Rows:
    """A block of rows: ids, vectors and, where the table has them, labels."""

    def __init__(self, block: pa.Table, width: int, scale: float):
        self.row = block["row"].to_numpy().astype(np.int64)
        self.vec_id, self.no_id = numbers(block["vec_id"].combine_chunks())
        self.vector = matrix(block["vector"], width, scale)
        self.label = block["label"].to_numpy() if "label" in block.column_names else None

    @cached_property
    def norms(self) -> np.ndarray:
        return norms_of(self.vector)

    @cached_property
    def single(self) -> np.ndarray:
        return self.vector.astype(np.float32)

    def by_label(self) -> Rows:
        """The same rows in order of their labels."""
        order, sorted_rows = np.argsort(self.label, kind="stable"), Rows.__new__(Rows)
        for name in ("row", "vec_id", "no_id", "vector", "label"):
            setattr(sorted_rows, name, getattr(self, name)[order])
        return sorted_rows


def blocks(batches: Iterator[pa.RecordBatch], width: int, scale: float) -> Iterator[Rows]:
    waiting: list[pa.RecordBatch] = []
    for batch in batches:
        for at in range(0, batch.num_rows, BLOCK_ROWS):
            waiting.append(batch.slice(at, BLOCK_ROWS))
            if sum(b.num_rows for b in waiting) >= BLOCK_ROWS:
                yield Rows(pa.Table.from_batches(waiting), width, scale)
                waiting = []
    if waiting:
        yield Rows(pa.Table.from_batches(waiting), width, scale)


class Best:
    """The ``k`` best rows of each of ``n`` lists: highest score, then smallest vec_id (null last), then row."""

    FIELDS = ("score", "no_id", "vec_id", "row")

    def __init__(self, n: int, k: int, least: np.ndarray | None = None):
        self.k = k
        #: No row below it can enter its list.
        self.least = np.full(n, -np.inf) if least is None else least.astype(np.float64).copy()
        self.held = np.zeros(n, np.int64)
        #: By list and rank; only the first ``held`` of a list are set.
        self.of_field = {f: np.zeros((n, k), bool if f == "no_id" else np.int64) for f in self.FIELDS}

    def __getattr__(self, name: str) -> np.ndarray:
        """A field of all rows held, list by list and by rank."""
        if name not in Best.FIELDS:
            raise AttributeError(name)
        return self.of_field[name][self._filled()]

    @property
    def of(self) -> np.ndarray:
        """The list of each row held."""
        return np.repeat(np.arange(len(self.held)), self.held)

    def _filled(self, lists: np.ndarray | slice = slice(None)) -> np.ndarray:
        return np.arange(self.k) < self.held[lists][:, None]

    def add(self, of: np.ndarray, score: np.ndarray, rows: Rows, at: np.ndarray) -> None:
        """Only the lists that rows come for are sorted, so a call costs what it brings."""
        new = (score.astype(np.int64), rows.no_id[at], rows.vec_id[at], rows.row[at])
        enters = self._enters(of, *new)
        if not enters.any():
            return
        of, new = of[enters], [x[enters] for x in new]
        lists = np.unique(of)
        filled = self._filled(lists)
        old = [self.of_field[f][lists][filled] for f in self.FIELDS]
        of = np.concatenate([np.repeat(lists, self.held[lists]), of])
        score, no_id, vec_id, row = fields = [np.concatenate(x) for x in zip(old, new, strict=True)]
        order = np.lexsort((row, vec_id, no_id, -score, of))
        of = of[order]
        first = np.flatnonzero(np.r_[True, of[1:] != of[:-1]])
        count = np.diff(np.r_[first, len(of)])
        rank = np.arange(len(of)) - np.repeat(first, count)
        kept = rank < self.k
        for name, values in zip(self.FIELDS, fields, strict=True):
            self.of_field[name][of[kept], rank[kept]] = values[order[kept]]
        self.held[lists] = np.minimum(count, self.k)
        full = lists[count >= self.k]
        self.least[full] = np.maximum(self.least[full], self.of_field["score"][full, -1])

    def _enters(self, of: np.ndarray, score: np.ndarray, no_id: np.ndarray, vec_id: np.ndarray, row: np.ndarray) -> np.ndarray:
        """Which rows come before the last of their list, or find it not full."""
        last = {f: x[of, -1] for f, x in self.of_field.items()}
        before = row < last["row"]
        for own, other in ((vec_id, last["vec_id"]), (no_id, last["no_id"]), (-score, -last["score"])):
            before = (own < other) | ((own == other) & before)
        return before | (self.held[of] < self.k)


def lower(bound: np.ndarray) -> np.ndarray:
    """A little below, for comparisons in floating point."""
    return np.where(np.isfinite(bound), bound - np.abs(np.where(np.isfinite(bound), bound, 0)) * 1e-9 - 1e-3, bound)


def sizes(rows: DataFrame) -> tuple[int, int]:
    """Number of rows, and length of the longest vector."""
    found = rows.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("vector")).alias("width")).first()
    return found["n"], found["width"] or 0


def seeds(rows: DataFrame, n: int = SEED_ROWS) -> pa.Table:
    """At most ``n`` rows, those of the smallest hashes."""
    return rows.orderBy(F.xxhash64("row"), "row").limit(n).toArrow()


def chunk_rows(width: int) -> int:
    return max(1, CHUNK_VALUES // max(1, width))
