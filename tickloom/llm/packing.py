"""Best-fit packing of token sequences, planned on the histogram of lengths.

Documents are cut into pieces of at most ``capacity`` tokens. Best-fit decreasing runs over the counts of pieces per
length, at most ``capacity`` numbers, not over pieces: whole runs of sequences with equal free room are filled at once. Its
plan says which sequence and offset the pieces of a length get by their rank, and pieces take their places by a join.
"""

from __future__ import annotations

import os
import re
import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator
from struct import pack as pack_ids

import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tickloom.llm.common import held, map_batches, rows_in, spread
from tickloom.session import stored

CAPACITY = 2048
END_ID = 0
END = pack_ids("<I", END_ID)
TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
#: Bytes of tokenized parts that a Python worker remembers before it starts afresh, and what an entry takes besides its own.
CACHE_BYTES, ENTRY_BYTES = 240_000_000, 200
#: Texts whose pieces can be told without the tokenizer: its normalizer only lowers their letters, and its own pattern, as far
#: as these characters go, is ``PIECE``. A text with ``SPECIAL`` may hold a special token.
PLAIN = re.compile(r"[\t-\r -~À-ÖØ-öø-ÿ]*+")
SPECIAL = "<|"
PIECE = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^a-zß-öø-ÿ0-9\t-\r ]+")
WORD_END = "</w>"


class PartTokens(dict[str | bytes, bytes]):
    """Token ids of each part of texts, as little-endian 32-bit numbers, remembered.

    The parts of a plain text are the pieces that the tokenizer would cut it into; those of a batch are tokenized as one text,
    in which each ends with a token that ends a word. The parts of another text are its words between ASCII white space, at
    which the tokenizer splits before anything else, as bytes.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        super().__init__()
        self.tokenizer = Tokenizer.from_file(path)
        vocabulary = self.tokenizer.get_vocab()
        self.ends = bytearray(max(vocabulary.values()) + 1)
        for token, number in vocabulary.items():
            self.ends[number] = token.endswith(WORD_END)
        self.held = 0

    @staticmethod
    def parts(text: str | None) -> list[str] | list[bytes]:
        if not text:
            return []
        plain = PLAIN.fullmatch(text) and SPECIAL not in text
        return PIECE.findall(text.lower()) if plain else text.encode("utf-8", "replace").split()

    def learn(self, texts: list[list]) -> None:
        """Remember the parts of a batch of texts."""
        if self.held > CACHE_BYTES:
            self.clear()
            self.held = 0
        unseen = [p for p in set().union(*texts) if p not in self]
        self._learn_pieces([p for p in unseen if isinstance(p, str)])
        words = [p for p in unseen if isinstance(p, bytes)]
        found = self.tokenizer.encode_batch_fast([w.decode("utf-8", "replace") for w in words], add_special_tokens=False)
        for word, tokens in zip(words, found, strict=True):
            ids = tokens.ids
            self._keep(word, pack_ids(f"<{len(ids)}I", *ids))

    def _learn_pieces(self, unseen: list[str]) -> None:
        if not unseen:
            return
        ids = self.tokenizer.encode_batch_fast([" ".join(unseen)], add_special_tokens=False)[0].ids
        packed, ends, start, at = pack_ids(f"<{len(ids)}I", *ids), self.ends, 0, iter(unseen)
        for place, number in enumerate(ids, 1):
            if ends[number]:
                self._keep(next(at), packed[4 * start:4 * place])
                start = place
        if start != len(ids) or next(at, None) is not None:
            raise ValueError("the tokenizer does not end each piece with a token that ends a word")

    def _keep(self, part: str | bytes, ids: bytes) -> None:
        self[part] = ids
        self.held += len(part) + len(ids) + ENTRY_BYTES

    def ids(self, parts: list) -> bytes:
        """Token ids of the parts, which are remembered, and the end id."""
        return b"".join(map(self.__getitem__, parts)) + END


def pieces(docs: DataFrame, capacity: int = CAPACITY, tokenizer: str = TOKENIZER) -> DataFrame:
    """Per piece of a document ``doc_id, piece, start, length, ids_crc32``; a null text has the end id alone."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = held(PartTokens, tokenizer)
        for batch in batches:
            columns: tuple[list, ...] = ([], [], [], [], [])
            texts = [tokens.parts(t) for (t,) in rows_in(batch, "text")]
            tokens.learn(texts)
            for (doc,), parts in zip(rows_in(batch, "doc_id"), texts, strict=True):
                ids = tokens.ids(parts)
                for number, start in enumerate(range(0, len(ids) // 4, capacity)):
                    part = ids[4 * start:4 * (start + capacity)]
                    for column, value in zip(columns, (doc, number, start, len(part) // 4, zlib.crc32(part)), strict=True):
                        column.append(value)
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
            yield pa.record_batch(
                [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
                names=["doc_id", "piece", "start", "length", "ids_crc32"])

    rows = docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string"))
    return map_batches(rows, run, "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint")


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, int, int, int, int]]:
    """Best-fit decreasing over counts: rows (length, first rank, pieces, first sequence, offset).

    Pieces of a length go to the sequences with the least room that still takes them, new ones only where none does.
    A row places one piece in each of a run of sequences.
    """
    room: dict[int, list[tuple[int, int]]] = {}  # free room: runs (first sequence, number)
    rooms: list[int] = []  # in order
    slots, sequences = [], 0

    def add(free: int, run: tuple[int, int]) -> None:
        if free not in room:
            room[free] = []
            insort(rooms, free)
        room[free].append(run)

    for length in sorted(counts, reverse=True):
        rank, left = 0, counts[length]
        while left:
            at = bisect_left(rooms, length)
            if at == len(rooms):
                new = -(-left // (capacity // length))
                add(capacity, (sequences, new))
                sequences += new
                at = bisect_left(rooms, length)
            free = rooms[at]
            first, number = room[free].pop()
            taken = min(left, number)
            if taken < number:
                room[free].append((first + taken, number - taken))
            if not room[free]:
                del room[free], rooms[at]
            slots.append((length, rank, taken, first, capacity - free))
            if free > length:
                add(free - length, (first, taken))
            rank, left = rank + taken, left - taken
    return slots


def ranked(cut: DataFrame) -> DataFrame:
    """``rank`` of each piece among those of its length, from 0. A frequent length is dealt into shares that are ranked
    on their own; a share starts where the ones before it end."""
    shared = cut.withColumn("share", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(spread(cut))))
    before = Window.partitionBy("length").orderBy("share").rowsBetween(Window.unboundedPreceding, -1)
    firsts = shared.groupBy("length", "share").agg(F.count(F.lit(1)).alias("rows")).select(
        "length", "share", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("first"))
    inside = Window.partitionBy("length", "share").orderBy("doc_id", "piece", "ids_crc32", "start")
    return (
        shared.withColumn("rank", F.row_number().over(inside).cast("bigint") - 1)
        .join(firsts, ["length", "share"]).withColumn("rank", F.col("rank") + F.col("first")).drop("share", "first")
    )


def pack(docs: DataFrame, capacity: int = CAPACITY, tokenizer: str = TOKENIZER) -> DataFrame:
    """Per piece of ``docs`` (``doc_id, text``; other columns are ignored) its place: ``doc_id, piece, start, length,
    ids_crc32, sequence_id, offset``.

    A document is its token ids and an end id; only one of more than ``capacity`` tokens is cut. An empty or null text is
    the end id alone. Repeated rows and rows without doc_id are packed like others. An empty table gives no rows.
    The driver sees one count per length and makes the plan, whose size depends on ``capacity`` only.
    """
    cut = stored(pieces(docs, capacity, tokenizer), "pieces")
    counts = {r["length"]: r["rows"] for r in cut.groupBy("length").agg(F.count(F.lit(1)).alias("rows")).collect()}
    schema = "length bigint, first_rank bigint, number bigint, first_sequence bigint, offset bigint"
    slots = cut.sparkSession.createDataFrame(plan(counts, capacity), schema)
    taken = ranked(cut).join(F.broadcast(slots), "length").filter(
        "rank >= first_rank and rank < first_rank + number")
    return taken.select(
        "doc_id", "piece", "start", "length", "ids_crc32",
        (F.col("first_sequence") + F.col("rank") - F.col("first_rank")).alias("sequence_id"), "offset")
