"""What micro-batches keep between them: the latest row of each key, and rows that wait for their turn.

Batch ``n`` writes only folders of its own, by overwrite, and reads what batch ``n - 1`` left, so a batch that is run again
after a failure replaces its own output. What no such batch can ask for any more is removed.
"""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickloom.functions.times import epoch_micros
from tickloom.operators.latest import latest_per_key
from tickloom.session import remove


def write_batch(df: DataFrame, path: str, batch: int, fmt: str = "parquet") -> None:
    """Output of one micro-batch in its own folder; running the batch again replaces it."""
    df.write.mode("overwrite").format(fmt).save(f"{path}/batch={batch}")


def read_batches(spark: SparkSession, path: str, schema: T.StructType | str, fmt: str = "parquet") -> DataFrame:
    return spark.read.schema(schema).option("recursiveFileLookup", True).format(fmt).load(path)


class Notes:
    """A small JSON value per batch. Those of the last three batches are kept."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def before(self, batch: int) -> dict:
        if batch == 0:
            return {}
        return json.loads(self.spark.read.text(f"{self.path}/batch={batch - 1}").first()[0])

    def newest(self) -> dict:
        rows = read_batches(self.spark, self.path, "value STRING", "text").collect()
        return max((json.loads(r["value"]) for r in rows), key=lambda note: note["batch"], default={})

    def write(self, note: dict, batch: int) -> None:
        text = json.dumps({**note, "batch": batch})
        write_batch(self.spark.createDataFrame([(text,)], "value STRING").coalesce(1), self.path, batch, "text")
        remove(self.spark, f"{self.path}/batch={batch - 3}")


class KeyedState:
    """Latest row per key over all micro-batches, in buckets of keys.

    A batch reads and rewrites the buckets that its own keys fall in and leaves the others alone, so its cost follows its
    keys; ``buckets`` bounds the number of folders. A note per batch says which batch wrote each bucket last. Rows are
    combined before the shuffle: a key with many rows in a batch reaches it as one row per task.

    Rows for which ``gone`` holds, such as deleted quotes, are kept until the newest ``order`` time is ``keep_seconds``
    past them, so that a row sent before the deletion does not bring the quote back when it comes late.
    """

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType, keys: Sequence[str], order: Sequence[str],
                 buckets: int = 64, gone: Column | None = None, keep_seconds: int = 3600):
        self.spark, self.path, self.schema = spark, path, schema
        self.keys, self.order, self.buckets = list(keys), list(order), buckets
        self.gone, self.keep = gone, keep_seconds * 1_000_000
        self.notes = Notes(spark, f"{path}/notes")

    def _bucket(self) -> Column:
        return F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int")

    def _touched(self, rows: DataFrame) -> list[str]:
        return [str(r[0]) for r in rows.select(self._bucket()).distinct().collect()]

    def _rows(self, slots: dict[str, int], wanted: list[str] | None = None) -> DataFrame:
        names = [f"{b}-{slots[b]}" for b in (slots if wanted is None else wanted) if b in slots]
        if not names:
            return self.spark.createDataFrame([], self.schema)
        held = self.spark.read.schema(T.StructType([*self.schema.fields, T.StructField("slot", T.StringType())]))
        return held.parquet(f"{self.path}/rows").filter(F.col("slot").isin(names)).drop("slot")

    def before(self, batch: int, of: DataFrame | None = None) -> DataFrame:
        """Rows as of the batches before ``batch``; with ``of``, only those of the buckets that its keys fall in."""
        slots = self.notes.before(batch).get("slots", {})
        return self._rows(slots, None if of is None or not slots else self._touched(of))

    def current(self) -> DataFrame:
        return self._rows(self.notes.newest().get("slots", {}))

    def write(self, rows: DataFrame, batch: int) -> None:
        note = self.notes.before(batch)
        slots, clock = dict(note.get("slots", {})), note.get("clock")
        changed = latest_per_key(rows.select(*self.schema.names), self.keys, self.order).persist()
        try:
            touched = self._touched(changed)
            merged = latest_per_key(changed.unionByName(self._rows(slots, touched)), self.keys, self.order)
            if self.gone is not None:
                at = epoch_micros(F.col(self.order[0]))
                clock = max((c for c in (clock, changed.agg(F.max(at)).first()[0]) if c is not None), default=None)
                merged = merged.filter(~(self.gone & (at <= F.lit(clock).cast("bigint") - self.keep)))
            slot = F.concat_ws("-", self._bucket().cast("string"), F.lit(str(batch)))
            merged.withColumn("slot", slot).repartition("slot").write.mode("overwrite").partitionBy("slot").option(
                "partitionOverwriteMode", "dynamic").parquet(f"{self.path}/rows")
        finally:
            changed.unpersist()
        old = self.notes.before(batch - 1).get("slots", {}) if batch else {}
        self.notes.write({"slots": slots | dict.fromkeys(touched, batch), "clock": clock}, batch)
        for bucket, version in old.items():
            if slots[bucket] != version:  # the batch before this one replaced it, and no batch goes back further
                remove(self.spark, f"{self.path}/rows/slot={bucket}-{version}")


class HeldRows:
    """Reorder buffer: rows wait until the newest time stamp seen is ``delay_seconds`` past their own.

    What ``take`` gives out is in order across batches: whatever files the rows come in, they leave in batches of rising
    time stamps. A row that comes after its time has left goes to the dead letters under ``late``, with those that lack
    a key or a time stamp; a row that is still waiting when it comes again is taken once.
    """

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType, keys: Sequence[str], order: Sequence[str],
                 delay_seconds: int):
        self.spark, self.path, self.schema = spark, path, schema
        self.keys, self.order, self.delay = list(keys), list(order), delay_seconds * 1_000_000
        self.notes = Notes(spark, f"{path}/notes")

    def take(self, rows: DataFrame, batch: int) -> DataFrame:
        """The rows whose time has come, of this batch and of those that waited."""
        at = epoch_micros(F.col(self.order[0]))
        rows = rows.select(*self.schema.names).persist()
        try:
            before, newest = self.notes.before(batch).get("clock"), rows.agg(F.max(at)).first()[0]
            clock = max((c for c in (before, newest) if c is not None), default=None)
            whole = at.isNotNull()
            for key in self.keys:
                whole = whole & F.col(key).isNotNull()
            on_time = whole if before is None else whole & (at > before - self.delay)
            write_batch(rows.filter(~on_time), f"{self.path}/late", batch)
            pool = rows.filter(on_time).unionByName(self._waiting(batch)).dropDuplicates([*self.keys, *self.order])
            due = F.lit(False) if clock is None else at <= clock - self.delay
            marked = pool.withColumn("due", due)
            marked.write.mode("overwrite").partitionBy("due").parquet(f"{self.path}/pool/batch={batch}")
        finally:
            rows.unpersist()
        self.notes.write({"clock": clock}, batch)
        remove(self.spark, f"{self.path}/pool/batch={batch - 2}")
        return self._pool(batch, True)

    def late(self) -> DataFrame:
        """Dead letters of all batches."""
        return read_batches(self.spark, f"{self.path}/late", self.schema)

    def _waiting(self, batch: int) -> DataFrame:
        return self._pool(batch - 1, False) if batch else self.spark.createDataFrame([], self.schema)

    def _pool(self, batch: int, due: bool) -> DataFrame:
        marked = T.StructType([*self.schema.fields, T.StructField("due", T.BooleanType())])
        return self.spark.read.schema(marked).parquet(f"{self.path}/pool/batch={batch}").filter(
            F.col("due") == due).drop("due")


class RollingCounts:
    """Sum of the newest ``slots`` closed slots per key: a batch adds what enters and takes off what leaves.

    ``counts`` are rows ``key, slot_end, ticks`` of closed slots, each given once. They wait in a ring of folders per slot until
    they leave, so a batch reads its own rows, the slots that leave and the totals, never the slots in between. Batches
    without rows change nothing.
    """

    def __init__(self, spark: SparkSession, path: str, key: T.StructField, slot_seconds: int, slots: int):
        self.spark, self.path, self.key, self.width = spark, path, key.name, slot_seconds * slots * 1_000_000
        self.schema = T.StructType([key, T.StructField("ticks", T.LongType())])
        self.notes = Notes(spark, f"{path}/notes")

    def _totals(self, version: int | None) -> DataFrame:
        if version is None:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(f"{self.path}/totals/batch={version}")

    def current(self) -> DataFrame:
        return self._totals(self.notes.newest().get("version"))

    def _leaving(self, after: int, until: int, batch: int) -> DataFrame:
        ring = T.StructType([*self.schema.fields, T.StructField("batch", T.LongType()), T.StructField("slot", T.LongType())])
        rows = self.spark.read.schema(ring).parquet(f"{self.path}/ring").filter(
            (F.col("slot") > after) & (F.col("slot") <= until) & (F.col("batch") < batch))
        return rows.select(self.key, (-F.col("ticks")).alias("ticks"))

    def add(self, counts: DataFrame, batch: int) -> None:
        note = self.notes.before(batch)
        clock, version, ring = note.get("clock"), note.get("version"), dict(note.get("ring", {}))
        rows = counts.select(self.key, "ticks", epoch_micros(F.col("slot_end")).alias("slot")).persist()
        try:
            newest = rows.agg(F.max("slot")).first()[0]
            if newest is not None:
                now = newest if clock is None else max(newest, clock)
                entering = rows.filter(F.col("slot") > now - self.width)
                entering.repartition("slot").write.mode("overwrite").partitionBy("slot").parquet(f"{self.path}/ring/batch={batch}")
                changed = self._totals(version).unionByName(entering.select(self.key, "ticks"))
                if clock is not None:
                    changed = changed.unionByName(self._leaving(clock - self.width, now - self.width, batch))
                changed.groupBy(self.key).agg(F.sum("ticks").alias("ticks")).filter("ticks > 0").write.mode("overwrite").parquet(
                    f"{self.path}/totals/batch={batch}")
                ring[str(batch)] = newest
                if clock is not None:  # what had left before this batch is asked for no more
                    for old in [b for b, last in ring.items() if last <= clock - self.width]:
                        remove(self.spark, f"{self.path}/ring/batch={old}")
                        del ring[old]
                clock, version = now, batch
        finally:
            rows.unpersist()
        replaced = self.notes.before(batch - 1).get("version") if batch else None
        self.notes.write({"clock": clock, "version": version, "ring": ring}, batch)
        if replaced not in (None, note.get("version"), version):
            remove(self.spark, f"{self.path}/totals/batch={replaced}")


def tagged_state(state: DataFrame, batch: DataFrame) -> DataFrame:
    """The last known row of each key in front of the batch's rows, told apart by ``__old``."""
    return batch.withColumn("__old", F.lit(False)).unionByName(state.withColumn("__old", F.lit(True)))
