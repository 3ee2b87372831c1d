"""Joins of large tables to lookups when one key may own a large share of the rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SHARE_ROWS = 2_000_000
BROADCAST_ROWS = 100_000


def spread_over(shares: Column, *columns: str) -> Column:
    """A share number from 0 for each row. It takes in the task as well as the content, so copies of one
    row are spread too, and is the same when the task runs again."""
    return F.pmod(F.xxhash64(F.spark_partition_id(), *columns), shares)


def is_small(rows: DataFrame, limit: int = BROADCAST_ROWS) -> bool:
    """Whether there are at most ``limit`` rows. Reads partitions only until more are found."""
    return rows.select(F.lit(1)).offset(limit).isEmpty()


def lookup_join(
    rows: DataFrame, lookup: DataFrame, keys: Sequence[str], how: str = "left", condition: Column | None = None,
    counted: DataFrame | None = None,
) -> DataFrame:
    """Join to a table that is usually small: broadcast when counted to be small, else by ``salted_join``.

    ``counted`` is a cheaper table to count that the lookup cannot outgrow, such as its input. A stream
    joins as Spark plans it, as its batches cannot be counted beforehand.

    A lookup counted to be large is never broadcast. Without hot keys adaptive execution plans it anew by the
    size of its file, which says nothing of the rows it is exploded to.
    """
    if rows.isStreaming:
        return _join(rows, lookup, keys, how, condition)
    if is_small(lookup if counted is None else counted):
        return _join(rows, F.broadcast(lookup), keys, how, condition)
    return salted_join(rows, lookup, keys, how, condition, hint="merge")


def salted_join(
    rows: DataFrame, lookup: DataFrame, keys: Sequence[str], how: str = "left", condition: Column | None = None,
    share_rows: int = SHARE_ROWS, hint: str | None = None,
) -> DataFrame:
    """Shuffle join in which a key with more than ``share_rows`` rows is dealt out to several tasks.

    Only such keys are split, and only their lookup rows are repeated, once per share. The list of hot keys
    has at most one entry per ``share_rows`` rows of the table; that bounds what is broadcast.
    Adaptive execution splits skewed joins too, but not when a side is an aggregate or a window result.
    ``hint`` is the join strategy asked for the lookup.
    """
    hot = (
        rows.groupBy(*keys)
        .agg(F.ceil(F.count(F.lit(1)) / share_rows).alias("__shares"))
        .filter(F.col("__shares") > 1)
    )
    shares = F.coalesce(F.col("__shares"), F.lit(1).cast("bigint"))
    dealt = (
        rows.join(F.broadcast(hot), list(keys), "left")
        .withColumn("__salt", F.when(shares > 1, spread_over(shares, *rows.columns)).otherwise(F.lit(0)))
        .select(*rows.columns, "__salt")
    )
    repeated = (
        lookup.join(F.broadcast(hot), list(keys), "left")
        .withColumn("__salt", F.explode(F.sequence(F.lit(0).cast("bigint"), shares - 1)))
        .select(*lookup.columns, "__salt")
    )
    if hint:
        repeated = repeated.hint(hint)
    return _join(dealt, repeated, [*keys, "__salt"], how, condition).drop("__salt")


def _join(rows: DataFrame, lookup: DataFrame, keys: Sequence[str], how: str, condition: Column | None) -> DataFrame:
    if condition is None:
        return rows.join(lookup, list(keys), how).select(
            *rows.columns, *[c for c in lookup.columns if c not in keys and c not in rows.columns]
        )
    renamed = lookup.withColumnsRenamed({k: f"__lookup_{k}" for k in keys})
    on = condition
    for key in keys:
        on = on & (F.col(key) == F.col(f"__lookup_{key}"))
    return rows.join(renamed, on, how).drop(*[f"__lookup_{k}" for k in keys])
