"""Latest row per key, first rows per key, pages."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickloom.operators.joins import spread_over

SALTS = 4096
UNSALTED_ROWS = 100
#: A key with more rows than this is cut before its first rows are ranked; sampled rows per page.
LARGE_ROWS, CUT_SAMPLE = 2_000_000, 64


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The row with the greatest ``order`` of each key; rows without the key are dropped.

    ``max_by`` combines before the shuffle, so a key with many rows costs its tasks one row each.
    """
    present = df
    for key in keys:
        present = present.filter(F.col(key).isNotNull())
    rest = [c for c in df.columns if c not in keys]
    return (
        present.groupBy(*keys)
        .agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("__row"))
        .select(*keys, "__row.*")
        .select(*df.columns)
    )


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column], n: int) -> DataFrame:
    """The first ``n`` rows of each key in ``order``, numbered from 1 in ``row_no``.

    For a small ``n`` Spark limits each key before the shuffle, so a key reaches it with at most ``n`` rows
    per task. Beyond that, with ``order`` given as names of ascending columns, only the rows up to a cut value of each
    large key go on (``up_to_cuts``); with other orders salted shares of a key are ranked first, and then their survivors.
    """
    rows = df
    if n > UNSALTED_ROWS and all(isinstance(c, str) for c in order):
        rows = up_to_cuts(df, keys, order, n)
    elif n > UNSALTED_ROWS:
        shares = Window.partitionBy(*keys, "__salt").orderBy(*order)
        rows = (
            df.withColumn("__salt", spread_over(F.lit(SALTS), *df.columns))
            .withColumn("__rank", F.row_number().over(shares))
            .filter(F.col("__rank") <= n)
            .drop("__salt", "__rank")
        )
    whole = Window.partitionBy(*keys).orderBy(*order)
    return rows.withColumn("row_no", F.row_number().over(whole)).filter(F.col("row_no") <= n)


def up_to_cuts(df: DataFrame, keys: Sequence[str], order: Sequence[str], n: int, large_rows: int = LARGE_ROWS) -> DataFrame:
    """Rows of which each key's first ``n`` are a part; of a key with more than ``large_rows`` rows, few others.

    A sample of the rows of large keys, picked by the hash of their position, proposes two positions, with about twice
    and eight times ``n`` rows up to them. These rows are counted, and the first proposal that has ``n`` is the key's
    cut; a key of which neither has keeps all rows. Large keys are at most one per ``large_rows`` rows of the table.
    """
    keys, position = list(keys), F.struct(*order)
    large = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("__rows")).filter(F.col("__rows") > max(large_rows, 8 * n))
    hot = large.select(*keys).collect()
    if not hot:
        return df
    listed = F.broadcast(df.sparkSession.createDataFrame(hot, df.select(*keys).schema))
    theirs = df.select(*keys, *order).join(listed, keys)
    every = max(1, n // CUT_SAMPLE)
    placed = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    near, far = 2 * n // every, 8 * n // every
    sample = theirs.filter(F.pmod(F.xxhash64(*keys, *order), F.lit(every)) == 0).withColumn("__n", placed).filter(
        F.col("__n") <= far)
    proposed = sample.groupBy(*keys).agg(
        *[F.max(F.when(F.col("__n") == at, position)).alias(name) for name, at in (("__near", near), ("__far", far))])
    counted = theirs.join(F.broadcast(proposed), keys).groupBy(*keys, "__near", "__far").agg(
        *[F.count(F.when(position <= F.col(name), 1)).alias(f"{name}_rows") for name in ("__near", "__far")])
    cut = F.when(F.col("__near_rows") >= n, F.col("__near")).when(F.col("__far_rows") >= n, F.col("__far"))
    cuts = counted.select(*keys, cut.alias("__cut"))
    return df.join(F.broadcast(cuts), keys, "left").filter(
        F.col("__cut").isNull() | (position <= F.col("__cut"))).drop("__cut")


def page_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str], max_rows: int) -> DataFrame:
    """First page of each key with ``has_more``: one extra row per key is read and not returned."""
    ahead = first_per_key(df, keys, order, max_rows + 1)
    more = F.max("row_no").over(Window.partitionBy(*keys)) > max_rows
    return ahead.withColumn("has_more", more).filter(F.col("row_no") <= max_rows)


def page_after(df: DataFrame, order: Sequence[str], after: Sequence | None, max_rows: int) -> DataFrame:
    """One page of a whole listing, continued from the last row's ``order`` values."""
    rows = df
    if after is not None:
        last = [F.lit(v).cast(df.schema[c].dataType).alias(c) for c, v in zip(order, after, strict=True)]
        # the first column alone is implied, and a filter on it reaches the scan
        rows = rows.filter(F.col(order[0]) >= last[0]).filter(F.struct(*order) > F.struct(*last))
    ahead = rows.orderBy(*order).limit(max_rows + 1)
    numbered = ahead.withColumn("row_no", F.row_number().over(Window.orderBy(*order)))
    more = F.max("row_no").over(Window.partitionBy()) > max_rows
    return numbered.withColumn("has_more", more).filter(F.col("row_no") <= max_rows)
