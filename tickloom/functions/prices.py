"""Fixed-point prices, money and volumes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

PRICE_SCALE_DIGITS = 5


def to_price(raw: Column) -> Column:
    """Fixed-point 1/100000 units to a double."""
    return raw / F.lit(100000.0)


def decode_trendbar() -> list[Column]:
    """Bar columns from the wire form: the low and three offsets above it."""
    low = F.col("low")

    def at(delta: str) -> Column:
        return to_price(low + F.col(delta))

    return [
        minutes_to_timestamp(F.col("utcTimestampInMinutes")).alias("Time"),
        at("deltaOpen").alias("Open"),
        at("deltaHigh").alias("High"),
        to_price(low).alias("Low"),
        at("deltaClose").alias("Close"),
        F.col("volume").alias("Volume"),
    ]


def encode_trendbar(time: Column) -> list[Column]:
    """Wire form of raw open/high/low/close/volume columns; the inverse of ``decode_trendbar``."""
    low = F.col("low")
    return [
        F.col("volume"),
        low,
        (F.col("open") - low).alias("deltaOpen"),
        (F.col("close") - low).alias("deltaClose"),
        (F.col("high") - low).alias("deltaHigh"),
        F.floor(F.unix_seconds(time.cast("timestamp")) / 60).alias("utcTimestampInMinutes"),
    ]


def minutes_to_timestamp(minutes: Column) -> Column:
    return F.timestamp_seconds(minutes * 60)


def money(raw: Column, digits: Column) -> Column:
    """Integer money with a decimal exponent, e.g. 1234 with 2 digits is 12.34."""
    return raw / F.pow(F.lit(10.0), digits)


def units(volume: Column) -> Column:
    """Whole units to the hundredths the order messages carry."""
    return volume.cast("bigint") * 100


def spread(bid: Column, ask: Column) -> Column:
    return ask - bid


def mid(bid: Column, ask: Column) -> Column:
    return (bid + ask) / F.lit(2.0)


def pips(raw_distance: Column, pip_position: Column) -> Column:
    """Raw price distance in pips; one pip is ``10 ** -pip_position`` of price."""
    return raw_distance / F.pow(F.lit(10.0), F.lit(PRICE_SCALE_DIGITS) - pip_position)


def limit_price(order_type: Column, price: Column) -> Column:
    return F.when(F.upper(order_type) == "LIMIT", price)


def stop_price(order_type: Column, price: Column) -> Column:
    return F.when(F.upper(order_type) == "STOP", price)


def signed(side: Column, amount: Column) -> Column:
    """Positive for BUY, negative otherwise."""
    return F.when(side == "BUY", amount).otherwise(-amount)


def exact_sum(amount: Column) -> Column:
    """Integer total over very many rows: decimal accumulator, checked BIGINT result."""
    return F.sum(amount.cast("decimal(38,0)")).cast("bigint")
