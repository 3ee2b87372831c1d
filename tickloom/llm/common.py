"""What several operators share: tables, words, shingles, stored rounds and connected components."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import Any

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.session import stored

#: Rows of an Arrow batch between Spark and Python. Texts can be long, so a batch holds few of them.
BATCH_ROWS = 256
#: Distinct words whose hashes a Python worker remembers before it starts afresh. Rare words fill it; frequent ones are
#: back at once.
WORD_CACHE = 250_000
SHINGLE_WORDS = 5

_STEP = np.uint64(0x9E3779B97F4A7C17)
_MIX_1, _MIX_2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_S30, _S27, _S31 = np.uint64(30), np.uint64(27), np.uint64(31)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def small_batches(df: DataFrame) -> DataFrame:
    """Bound the memory of Python workers: batches of few rows, for this session from now on."""
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    return df


def map_batches(df: DataFrame, function, schema: str) -> DataFrame:
    """``mapInArrow`` with small batches."""
    return small_batches(df).mapInArrow(function, schema)


def spread(df: DataFrame) -> int:
    """Into how many shares a hot group is dealt: as many as there are shuffle partitions, 64 at least."""
    return max(64, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))


class WordHashes(dict):
    """64-bit hash of each word, remembered."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= WORD_CACHE:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


_held: dict[tuple, Any] = {}


def held(make: Callable[..., Any], *key: str) -> Any:
    """``make(*key)``, made once for all tasks of a Python worker that ask for it in a row.

    A worker serves several operators in turn; what another one left behind is dropped, so that memory does not add up.
    """
    if (make, *key) not in _held:
        _held.clear()
        _held[make, *key] = make(*key)
    return _held[make, *key]


def word_hashes() -> WordHashes:
    return held(WordHashes)


def words_of(text: str | None) -> list[bytes]:
    """Runs of characters other than U+0020 and U+0009 to U+000D, A-Z in lower case."""
    return text.encode("utf-8", "surrogatepass").lower().split() if text else []


def mix(values: np.ndarray) -> np.ndarray:
    values = (values ^ (values >> _S30)) * _MIX_1
    values = (values ^ (values >> _S27)) * _MIX_2
    return values ^ (values >> _S31)


def shingles(words: list[bytes], hashes: WordHashes) -> np.ndarray:
    """Hashes of the distinct shingles of five words, in order; of fewer words, the sequence as one; of none, empty."""
    return runs(words, min(SHINGLE_WORDS, len(words)), hashes)


def runs(words: list[bytes], width: int, hashes: WordHashes) -> np.ndarray:
    """Hashes of the distinct runs of ``width`` words, in order; of no words, empty."""
    if not words:
        return np.empty(0, np.uint64)
    each = np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))
    count = len(each) - width + 1
    value = each[:count].copy()
    for k in range(1, width):
        value = value * _STEP + each[k:count + k]
    return np.unique(mix(value + np.uint64(width)))


def rows_in(batch: pa.RecordBatch, *names: str) -> Iterator[tuple]:
    return zip(*(batch.column(name).to_pylist() for name in names), strict=True)


def components(edges: DataFrame) -> DataFrame:
    """The smallest id that each id can reach, as rows ``id, component`` for the ids of ``edges`` (``a, b``).

    Each round gives an id the smallest label among itself and its neighbours, then the label of that label.
    Rounds are stored as tables; labels only sink, so the loop ends when their number of changes is zero.
    """
    both = stored(
        edges.select("a", "b").union(edges.select(F.col("b"), F.col("a"))).filter("a <> b").distinct(), "links"
    )
    labels = stored(both.groupBy(F.col("a").alias("id")).agg(F.least(F.first("a"), F.min("b")).alias("component")), "labels")
    while True:
        seen = both.join(labels, both["b"] == labels["id"]).groupBy(F.col("a").alias("id")).agg(F.min("component").alias("seen"))
        lower = stored(
            labels.join(seen, "id", "left").select(
                "id", F.col("component").alias("before"), F.least("component", "seen").alias("component")),
            "labels",
        )
        of = lower.select(F.col("id").alias("component"), F.col("component").alias("next"))
        jumped = stored(
            lower.join(of, "component", "left").select(
                "id", "before", F.least("component", "next").alias("component")),
            "labels",
        )
        labels = jumped.select("id", "component")
        if jumped.filter("component <> before").isEmpty():
            return labels
