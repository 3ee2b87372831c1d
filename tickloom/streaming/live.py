"""Live quotes, bars, counts, sessions, books, alerts, margin calls and time-outs.

Each function returns a started query and takes the trigger as an argument. State is either Spark's own
(watermarked aggregates and joins) or a ``KeyedState`` updated per micro-batch; no Python runs per row.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery

from tickloom.operators.accounts import crossings_between, edges_between
from tickloom.functions.times import packed_order
from tickloom.operators.bars import PERIOD_WINDOWS
from tickloom.operators.joins import spread_over
from tickloom.operators.ordered import Timeline, previous
from tickloom.operators.quotes import sessions_from_slots, with_symbol_name
from tickloom.sources.writers import bus_messages, hot_rows
from tickloom.streaming.state import HeldRows, KeyedState, RollingCounts, tagged_state, write_batch

Trigger = dict
ONCE: Trigger = {"availableNow": True}


@contextmanager
def state_partitions(spark: SparkSession, count: int | None = None):
    """Number of state partitions for queries started inside. It is fixed for the life of a query's
    checkpoint, so it follows the cluster's cores unless given."""
    key = "spark.sql.shuffle.partitions"
    before = spark.conf.get(key)
    spark.conf.set(key, str(count or spark.sparkContext.defaultParallelism))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def _start(writer, checkpoint: str, trigger: Trigger) -> StreamingQuery:
    return writer.option("checkpointLocation", checkpoint).trigger(**trigger).start()


def append(df: DataFrame, path: str, checkpoint: str, trigger: Trigger = ONCE, fmt: str = "parquet") -> StreamingQuery:
    """Append a stream to a file table."""
    return _start(df.writeStream.format(fmt).outputMode("append").option("path", path), checkpoint, trigger)


def _per_batch(df: DataFrame, fn: Callable, checkpoint: str, trigger: Trigger, mode: str = "append") -> StreamingQuery:
    return _start(df.writeStream.foreachBatch(fn).outputMode(mode), checkpoint, trigger)


def live_quotes(spots: DataFrame, names: DataFrame) -> DataFrame:
    """Named quotes from a spot stream: the symbol list is the static side of a stream-static join."""
    return with_symbol_name(spots, names)


def fan_out(quotes: DataFrame, ts: str, rule: Column, root: str, checkpoint: str,
            trigger: Trigger = ONCE) -> StreamingQuery:
    """One stream to three sinks: hot table by day, event-bus messages, alerts. The batch is kept for the
    three writes and each write replaces its own folder when the batch is run again."""
    def write(batch: DataFrame, n: int) -> None:
        kept = batch.persist()
        try:
            hot_rows(kept, ts).write.mode("overwrite").partitionBy("day").parquet(f"{root}/hot/batch={n}")
            write_batch(bus_messages(kept).select("value"), f"{root}/bus", n, "text")
            write_batch(kept.filter(rule), f"{root}/alerts", n)
        finally:
            kept.unpersist()

    return _per_batch(quotes, write, checkpoint, trigger)


def live_bars(ticks: DataFrame, period: str, delay: str, path: str, checkpoint: str,
              trigger: Trigger = ONCE) -> StreamingQuery:
    """Closed bars of a fixed-length period. Calendar months are not a fixed window: batch only."""
    at = packed_order(ticks, "ts", ("event_id",))
    window = F.window("ts", "7 days", "7 days", "4 days") if period == "W1" else F.window("ts", PERIOD_WINDOWS[period])
    bars = (
        ticks.withWatermark("ts", delay)
        .groupBy("symbolId", window.alias("w"))
        .agg(
            F.min_by("price", at).alias("open"), F.max("price").alias("high"), F.min("price").alias("low"),
            F.max_by("price", at).alias("close"), F.count(F.lit(1)).alias("volume"),
        )
        .select("symbolId", F.col("w.start").alias("bar_time"), "open", "high", "low", "close", "volume")
    )
    return append(bars, path, checkpoint, trigger)


def closed_counts(ticks: DataFrame, delay: str, slot: str = "5 minutes") -> DataFrame:
    """Tick counts per symbol and slot, each given once, when the watermark has passed the slot."""
    return (
        ticks.withWatermark("ts", delay)
        .groupBy("symbolId", F.window("ts", slot).alias("w"))
        .agg(F.count(F.lit(1)).alias("ticks"))
        .select("symbolId", F.col("w.end").alias("slot_end"), "ticks")
    )


def live_counts(ticks: DataFrame, delay: str, path: str, checkpoint: str, slot: str = "5 minutes",
                trigger: Trigger = ONCE) -> StreamingQuery:
    """Closed tick counts per symbol and slot; what the top-symbols tile reads. A sliding window in the
    stream itself would copy every tick once per slot of its length."""
    return append(closed_counts(ticks, delay, slot), path, checkpoint, trigger)


def live_tile(ticks: DataFrame, delay: str, tile: RollingCounts, checkpoint: str, slot: str = "5 minutes",
              trigger: Trigger = ONCE) -> StreamingQuery:
    """Keep the totals of the newest slots; ``top_now`` reads them without summing slots."""
    return _per_batch(closed_counts(ticks, delay, slot), tile.add, checkpoint, trigger)


def top_now(tile: RollingCounts, n: int = 20) -> DataFrame:
    """Top symbols of a kept tile."""
    return tile.current().withColumnRenamed("ticks", "tick_count").orderBy(F.desc("tick_count"), "symbolId").limit(n)


def top_tile(counts: DataFrame, slots: int = 36, slot_minutes: int = 5, n: int = 20) -> DataFrame:
    """Top symbols over the newest ``slots`` closed slots."""
    newest = counts.agg(F.max("slot_end")).first()[0]
    if newest is None:
        recent = counts
    else:
        first = F.lit(newest).cast("timestamp") - F.make_dt_interval(mins=F.lit(slots * slot_minutes))
        recent = counts.filter(F.col("slot_end") > first)
    return (
        recent.groupBy("symbolId").agg(F.sum("ticks").alias("tick_count"))
        .orderBy(F.desc("tick_count"), "symbolId").limit(n)
    )


def live_distinct(ticks: DataFrame, keys: Sequence[str], delay: str, path: str, checkpoint: str,
                  shares: int = 1, trigger: Trigger = ONCE) -> StreamingQuery:
    """Drop repeats of a quote that arrive within the watermark.

    With ``shares`` above one the repeats of a key are first dropped in as many tasks, then among what is
    left; for feeds in which one quote may be repeated without bound. It keeps the state twice.
    """
    rows = ticks.withWatermark("ts", delay)
    if shares > 1:
        rows = (
            rows.withColumn("__share", spread_over(F.lit(shares)))
            .dropDuplicatesWithinWatermark([*keys, "__share"])
            .drop("__share")
        )
    return append(rows.dropDuplicatesWithinWatermark(list(keys)), path, checkpoint, trigger)


def live_session_slots(ticks: DataFrame, delay: str, path: str, checkpoint: str, gap_seconds: int = 300,
                       trigger: Trigger = ONCE) -> StreamingQuery:
    """Closed gap-wide slots per symbol, from which ``sessions_from_slots`` reads the quote sessions."""
    slots = (
        ticks.withWatermark("ts", delay)
        .groupBy("symbolId", F.window("ts", f"{gap_seconds} seconds").alias("w"))
        .agg(F.min("ts").alias("first_ts"), F.max("ts").alias("last_ts"), F.count(F.lit(1)).alias("ticks"))
        .select("symbolId", F.floor(F.unix_seconds("w.start") / gap_seconds).alias("slot"),
                "first_ts", "last_ts", "ticks")
    )
    return append(slots, path, checkpoint, trigger)


def live_sessions(slots: DataFrame, gap_seconds: int = 300) -> DataFrame:
    return sessions_from_slots(slots, gap_seconds)


def live_latest(events: DataFrame, state: KeyedState, checkpoint: str, trigger: Trigger = ONCE) -> StreamingQuery:
    """Keep the latest row per key: book quotes, order, position and account states."""
    return _per_batch(events, state.write, checkpoint, trigger)


def refresh_symbols(changed: DataFrame, load: Callable[[DataFrame], DataFrame], state: KeyedState, checkpoint: str,
                    trigger: Trigger = ONCE) -> StreamingQuery:
    """Reload the symbols a change event names, and only these. ``load`` gets their distinct ids with the
    time of the newest change and returns rows in the state's schema."""
    def write(batch: DataFrame, n: int) -> None:
        state.write(load(batch.groupBy("symbolId").agg(F.max("ts").alias("ts"))), n)

    return _per_batch(changed, write, checkpoint, trigger)


def _ordered_changes(events: DataFrame, state: KeyedState, held: HeldRows, line: Timeline, name: str, value: Column,
                     emit: Callable[[DataFrame], DataFrame], path: str, checkpoint: str,
                     trigger: Trigger) -> StreamingQuery:
    """Compare each row with its key's previous row, which may lie in an earlier batch. Rows are held back until they are
    in order, so the result does not depend on how they are dealt out to files; rows later than that are in
    ``held.late()``."""
    def write(batch: DataFrame, n: int) -> None:
        ready = held.take(batch, n)
        rows = previous(tagged_state(state.before(n, ready), ready), line, {name: value})
        write_batch(emit(rows.filter(~F.col("__old")).drop("__old")), path, n)
        state.write(ready, n)

    return _per_batch(events, write, checkpoint, trigger)


def live_alerts(events: DataFrame, rule: Column, state: KeyedState, held: HeldRows, line: Timeline, path: str,
                checkpoint: str, trigger: Trigger = ONCE) -> StreamingQuery:
    """Rows at which a rule starts to hold for a key, across batches."""
    return _ordered_changes(events, state, held, line, "__before", rule, lambda rows: edges_between(rows, rule), path,
                            checkpoint, trigger)


def live_margin_calls(levels: DataFrame, thresholds: Sequence[tuple[str, float]], state: KeyedState, held: HeldRows,
                      line: Timeline, path: str, checkpoint: str, trigger: Trigger = ONCE) -> StreamingQuery:
    """One event per threshold a key's margin level falls through."""
    return _ordered_changes(
        levels, state, held, line, "previousLevel", F.col("marginLevel"),
        lambda rows: crossings_between(rows, thresholds, "marginLevel"), path, checkpoint, trigger,
    )


def live_timeouts(requests: DataFrame, responses: DataFrame, timeout_seconds: int, delay: str, path: str,
                  checkpoint: str, trigger: Trigger = ONCE) -> StreamingQuery:
    """Requests with their first response in time, one row each, once none can come any more.

    The replies of a request meet it in the join's state and are folded in an aggregate behind it, both bounded by the
    watermark. A request sent again with the same id and time is one request.
    """
    late = F.expr(f"sentAt + interval {timeout_seconds} seconds")
    sent = requests.withWatermark("sentAt", delay)
    back = responses.withColumnRenamed("clientMsgId", "__id").withWatermark("receivedAt", delay)
    matched = sent.join(
        back, (F.col("clientMsgId") == F.col("__id")) & F.col("receivedAt").between(F.col("sentAt"), late),
        "leftOuter",
    )
    first = matched.groupBy("clientMsgId", "sentAt").agg(F.min("receivedAt").alias("receivedAt"))
    return append(first.withColumn("timed_out", F.col("receivedAt").isNull()), path, checkpoint, trigger)
