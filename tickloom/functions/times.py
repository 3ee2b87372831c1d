"""Time conversions. Timestamps are UTC throughout."""

from __future__ import annotations

from collections.abc import Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def epoch_micros(ts: Column) -> Column:
    return F.unix_micros(ts.cast("timestamp"))


def epoch_millis(ts: Column) -> Column:
    """Epoch milliseconds at second precision, as history requests carry them."""
    return F.unix_seconds(ts.cast("timestamp")) * 1000


def lookback_millis(now: Column, weeks: int = 0, days: int = 0) -> Column:
    return epoch_millis(now) - F.lit((weeks * 7 + days) * 86_400_000).cast("bigint")


def from_millis(ms: Column) -> Column:
    return F.timestamp_millis(ms)


def iso_utc(ts: Column) -> Column:
    """ISO-8601 text; the fraction is left out when the microseconds are zero."""
    seconds = F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss")
    micros = epoch_micros(ts) % 1_000_000
    fraction = F.when(micros == 0, F.lit("")).otherwise(F.date_format(ts, ".SSSSSS"))
    return F.concat(seconds, fraction, F.lit("+00:00"))


def parse_iso(text: Column) -> Column:
    return text.cast("timestamp")


def day_text(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd")


def second_of_week(ts: Column, zone: str | Column = "UTC") -> Column:
    """Seconds since Sunday 00:00 in the named zone. The epoch began on a Thursday, four days into a week."""
    local = ts.cast("timestamp")
    if isinstance(zone, Column) or zone != "UTC":
        local = F.from_utc_timestamp(local, zone)
    return F.pmod(F.unix_seconds(local) + F.lit(4 * 86400), F.lit(7 * 86400)).cast("bigint")


def packed_order(rows: DataFrame, ts: str, tie: Sequence[str] = ()) -> Column:
    """One number that orders rows by ``ts`` and then ``tie``, where that is a single whole number, else a struct.

    ``min_by`` and ``max_by`` over a number of fixed width aggregate by hash; over a struct they sort.
    """
    if not tie:
        return F.col(ts)
    if len(tie) > 1 or not isinstance(rows.schema[tie[0]].dataType, T.IntegralType):
        return F.struct(ts, *tie)
    last = F.coalesce(F.col(tie[0]).cast("bigint"), F.lit(-(2**63))).cast("decimal(19,0)")
    return epoch_micros(F.col(ts)).cast("decimal(18,0)") * F.lit(Decimal(2**64)) + last
