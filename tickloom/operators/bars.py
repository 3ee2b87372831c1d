"""OHLCV bars: fourteen periods, from ticks or from finer bars, and the wire form."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickloom.functions.prices import decode_trendbar, encode_trendbar
from tickloom.functions.times import packed_order
from tickloom.operators.latest import first_per_key

# Period name to window length; W1 starts on Monday, MN1 is the calendar month.
PERIOD_WINDOWS = {
    "M1": "1 minute", "M2": "2 minutes", "M3": "3 minutes", "M4": "4 minutes", "M5": "5 minutes",
    "M10": "10 minutes", "M15": "15 minutes", "M30": "30 minutes", "H1": "1 hour", "H4": "4 hours",
    "H12": "12 hours", "D1": "1 day",
}
PERIODS = (*PERIOD_WINDOWS, "W1", "MN1")


def bar_start(ts: Column, period: str) -> Column:
    if period == "W1":
        return F.date_trunc("WEEK", ts)
    if period == "MN1":
        return F.date_trunc("MONTH", ts)
    return F.window(ts, PERIOD_WINDOWS[period]).start


def bars_from_ticks(
    ticks: DataFrame, period: str, keys: Sequence[str] = ("symbolId",), ts: str = "ts", price: str = "price",
    tie: Sequence[str] = ("event_id",),
) -> DataFrame:
    """Bars of one period. Volume is the tick count. All five aggregates combine before the shuffle."""
    at = packed_order(ticks, ts, tie)
    start = bar_start(F.col(ts), period).cast(ticks.schema[ts].dataType)
    return (
        ticks.withColumn("bar_time", start)
        .groupBy(*keys, "bar_time")
        .agg(
            F.min_by(price, at).alias("open"),
            F.max(price).alias("high"),
            F.min(price).alias("low"),
            F.max_by(price, at).alias("close"),
            F.count(F.lit(1)).alias("volume"),
        )
    )


def bars_from_bars(bars: DataFrame, period: str, keys: Sequence[str] = ("symbolId",)) -> DataFrame:
    """Coarser bars from finer ones whose starts fall inside exactly one coarse bar."""
    start = bar_start(F.col("bar_time"), period).cast(bars.schema["bar_time"].dataType)
    return (
        bars.withColumn("__start", start)
        .groupBy(*keys, "__start")
        .agg(
            F.min_by("open", "bar_time").alias("open"),
            F.max("high").alias("high"),
            F.min("low").alias("low"),
            F.max_by("close", "bar_time").alias("close"),
            F.sum("volume").alias("volume"),
        )
        .withColumnRenamed("__start", "bar_time")
    )


def encode_bars(bars: DataFrame, keys: Sequence[str] = ("symbolId",)) -> DataFrame:
    return bars.select(*keys, *encode_trendbar(F.col("bar_time")))


def decode_bars(trendbars: DataFrame, keys: Sequence[str] = ("symbolId",)) -> DataFrame:
    return trendbars.select(*keys, *decode_trendbar())


def newest_bars(
    bars: DataFrame, start: Column, end: Column, count: int, keys: Sequence[str] = ("symbolId",)
) -> DataFrame:
    """The newest ``count`` bars of each key that open in ``[start, end]``."""
    inside = bars.filter(F.col("bar_time").between(start, end))
    return first_per_key(inside, keys, [F.col("bar_time").desc()], count)


def trend_bars(
    ticks: DataFrame, period: str, start: Column, end: Column, count: int | None = None,
    keys: Sequence[str] = ("symbolId",),
) -> DataFrame:
    """Bars of ``[start, end]``; only the newest ``count`` of each key when a count is given.

    Ticks outside these bars are left out by their own time, a filter that reaches the scan.
    """
    length = {"W1": "7 days", "MN1": "1 month"}.get(period) or PERIOD_WINDOWS[period]
    inside = ticks.filter((F.col("ts") >= start) & (F.col("ts") < end + F.expr(f"interval {length}")))
    bars = bars_from_ticks(inside, period, keys)
    if count is None:
        return bars.filter(F.col("bar_time").between(start, end))
    return newest_bars(bars, start, end, count, keys)


def next_bar_label(bars: DataFrame, keys: Sequence[str] = ("symbolId",)) -> DataFrame:
    """Label each bar with whether the next one closes above its open; the last bar has no label and goes.

    Bars per key are limited by the time span over the period, whatever the number of ticks.
    """
    up = (F.col("close") > F.col("open")).cast("int")
    nxt = F.lead(up).over(Window.partitionBy(*keys).orderBy("bar_time"))
    return bars.withColumn("label", nxt).filter(F.col("label").isNotNull())
