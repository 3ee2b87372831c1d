"""Reference data: the joined symbol table, key indexes, batches, listings and conversion chains."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.operators.latest import latest_per_key
from tickloom.operators.ordered import number_rows
from tickloom.schemas import DETAIL_BATCH_SIZE, FLAT_SYMBOL
from tickloom.session import stored


def index_last(rows: DataFrame, key: str, order: Sequence[str]) -> DataFrame:
    """One row per key: the last in ``order``; rows without the key are dropped."""
    return latest_per_key(rows, [key], order)


def one_per_key(rows: DataFrame, key: str) -> DataFrame:
    """The last row of each key by its ``position`` in the list, or without that column by the other columns in order."""
    order = ["position"] if "position" in rows.columns else [c for c in rows.columns if c != key]
    return index_last(rows, key, order).drop("position")


def merge_records(light: DataFrame, details: DataFrame, key: str = "symbolId") -> DataFrame:
    """All light rows with the last details of their key; a field both have takes the light value when it is set."""
    details = one_per_key(details, key)
    both = [c for c in details.columns if c in light.columns and c != key]
    extra = [c for c in details.columns if c not in light.columns]
    a, b = light.alias("a"), details.alias("b")
    shared = [F.coalesce(f"a.{c}", f"b.{c}").alias(c) if c in both else F.col(f"a.{c}") for c in light.columns]
    return a.join(b, F.col(f"a.{key}") == F.col(f"b.{key}"), "left").select(*shared, *[f"b.{c}" for c in extra])


def with_category(symbols: DataFrame, categories: DataFrame, classes: DataFrame) -> DataFrame:
    """Category and, through it, asset class, of several with one id the last. An unknown id leaves nulls and keeps the row."""
    categories, classes = one_per_key(categories, "id"), one_per_key(classes, "id")
    named = categories.select(
        F.col("id").alias("symbolCategoryId"), "assetClassId", F.col("name").alias("symbolCategory")
    )
    groups = classes.select(F.col("id").alias("assetClassId"), F.col("name").alias("assetClass"))
    return symbols.join(named.join(groups, "assetClassId", "left"), "symbolCategoryId", "left")


def with_asset(rows: DataFrame, assets: DataFrame, role: str, display: bool = True) -> DataFrame:
    """Name of the last asset whose id is in ``{role}AssetId``."""
    columns = [F.col("assetId").alias(f"{role}AssetId"), F.col("name").alias(f"{role}Asset")]
    if display:
        columns.append(F.col("displayName").alias(f"{role}AssetDisplayName"))
    return rows.join(one_per_key(assets, "assetId").select(*columns), f"{role}AssetId", "left")


def symbol_dimension(
    light: DataFrame, details: DataFrame, assets: DataFrame, classes: DataFrame, categories: DataFrame
) -> DataFrame:
    """The wide symbol table: every light row once, with details, category, class and both assets."""
    joined = with_category(merge_records(light, details), categories, classes)
    return with_asset(with_asset(joined, assets, "base"), assets, "quote")


def flat_symbols(symbols: DataFrame) -> DataFrame:
    """The published columns in order; a missing one is null, others are left out."""
    return symbols.select(
        *[
            (F.col(name) if name in symbols.columns else F.lit(None)).cast(kind).alias(name)
            for name, kind in FLAT_SYMBOL
        ]
    )


def deposit_currency(traders: DataFrame, assets: DataFrame) -> DataFrame:
    return with_asset(traders, assets, "deposit", display=False).withColumnRenamed("depositAsset", "depositCurrency")


def detail_batches(symbols: DataFrame, size: int = DETAIL_BATCH_SIZE) -> DataFrame:
    """Request batch of each symbol id: ``size`` consecutive ids per batch."""
    numbered = number_rows(symbols.select("symbolId"), "symbolId", "__position")
    return numbered.select("symbolId", F.floor(F.col("__position") / size).alias("batch_no"))


def union_all(parts: Sequence[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def active_and_archived(active: DataFrame, archived: DataFrame, include_archived: bool = True) -> DataFrame:
    """Both symbol lists in one, told apart by ``archived``; or only the active ones."""
    if not include_archived:
        return active.withColumn("archived", F.lit(False))
    old = archived.withColumnRenamed("name", "symbolName").withColumn("archived", F.lit(True))
    return active.withColumn("archived", F.lit(False)).unionByName(old, allowMissingColumns=True)


def tradable(symbols: DataFrame) -> DataFrame:
    """Enabled, not archived and, where a trading mode is known, open for trading."""
    mode = F.coalesce("tradingMode", F.lit("ENABLED")) if "tradingMode" in symbols.columns else F.lit("ENABLED")
    gone = F.coalesce("archived", F.lit(False)) if "archived" in symbols.columns else F.lit(False)
    return symbols.filter(F.col("enabled") & ~gone & (mode == "ENABLED"))


def symbols_by_id(symbols: DataFrame, ids: DataFrame) -> DataFrame:
    """Symbols among the ids, which may repeat."""
    return symbols.join(ids.select("symbolId").distinct(), "symbolId", "left_semi")


def list_sizes(lists: dict[str, DataFrame]) -> DataFrame:
    """Row count of each loaded list."""
    return union_all(
        [rows.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("list"), "rows")
         for name, rows in lists.items()]
    )


def conversion_steps(symbols: DataFrame, last_asset: int) -> DataFrame:
    """Shortest conversion of every asset that can reach ``last_asset``: number of symbols and the next one.

    Breadth-first from the target over distinct asset pairs. A chain is read by following ``symbolId`` and
    ``toAssetId``. Each round is one join against the new frontier and is stored, so the plan does not grow;
    the loop ends when a round reaches nothing new.
    """
    pairs = stored(
        symbols.filter("baseAssetId <> quoteAssetId")
        .groupBy("baseAssetId", "quoteAssetId")
        .agg(F.min("symbolId").alias("symbolId")),
        "pairs",
    )
    reached = symbols.sparkSession.createDataFrame(
        [(last_asset, 0, None, None)], "assetId BIGINT, hops INT, symbolId BIGINT, toAssetId BIGINT"
    )
    frontier, hops = reached, 0
    while True:
        hops += 1
        step = (
            pairs.join(frontier.select(F.col("assetId").alias("quoteAssetId")), "quoteAssetId")
            .groupBy(F.col("baseAssetId").alias("assetId"))
            .agg(F.min(F.struct("symbolId", F.col("quoteAssetId").alias("toAssetId"))).alias("__next"))
            .join(reached.select("assetId"), "assetId", "left_anti")
            .select("assetId", F.lit(hops).alias("hops"), "__next.symbolId", "__next.toAssetId")
        )
        frontier = stored(step, "frontier")
        if frontier.isEmpty():
            return reached
        reached = reached.unionByName(frontier)


def conversion_chains(symbols: DataFrame, wanted: DataFrame) -> DataFrame:
    """The symbols that convert ``firstAssetId`` into ``lastAssetId``, in order, for each distinct pair of ``wanted``:
    ``firstAssetId, lastAssetId, step, symbolId, fromAssetId, toAssetId``.

    Of the shortest chains the one whose first symbol, then whose second and so on, has the smallest id. A pair that no chain
    joins, or whose assets are the same, has no rows. All pairs are searched at once, breadth-first from their last assets;
    a round is one join of the new frontier and is stored, and the search ends when every pair is found or nothing is new.
    """
    spark = symbols.sparkSession
    pairs = stored(
        symbols.filter("baseAssetId <> quoteAssetId").groupBy("baseAssetId", "quoteAssetId")
        .agg(F.min("symbolId").alias("symbolId")), "pairs")
    asked = stored(wanted.select(
        F.col("firstAssetId").cast("bigint"), F.col("lastAssetId").cast("bigint")).distinct().filter(
        "firstAssetId <> lastAssetId"), "wanted")
    path = "ARRAY<STRUCT<symbolId: BIGINT, fromAssetId: BIGINT, toAssetId: BIGINT>>"
    frontier = asked.select(
        F.col("lastAssetId").alias("target"), F.col("lastAssetId").alias("assetId"), F.array().cast(path).alias("path")).distinct()
    reached, found = frontier, spark.createDataFrame([], f"firstAssetId BIGINT, lastAssetId BIGINT, path {path}")
    ends = [F.col("firstAssetId") == F.col("assetId"), F.col("lastAssetId") == F.col("target")]
    while True:
        taken = F.struct(F.col("symbolId"), F.col("baseAssetId").cast("bigint"), F.col("quoteAssetId").cast("bigint"))
        step = (
            pairs.join(frontier.withColumnRenamed("assetId", "quoteAssetId"), "quoteAssetId")
            .groupBy("target", F.col("baseAssetId").cast("bigint").alias("assetId"))
            .agg(F.min(F.struct("symbolId", "quoteAssetId", F.concat(F.array(taken).cast(path), "path").alias("path"))).alias("next"))
            .join(reached.select("target", "assetId"), ["target", "assetId"], "left_anti")
            .select("target", "assetId", "next.path")
        )
        frontier = stored(step, "frontier")
        found = found.unionByName(asked.join(frontier, ends).select("firstAssetId", "lastAssetId", "path"))
        asked = stored(asked.join(frontier, ends, "left_anti"), "wanted")
        if asked.isEmpty() or frontier.isEmpty():
            break
        reached = reached.unionByName(frontier)
    return found.select("firstAssetId", "lastAssetId", F.posexplode("path").alias("place", "link")).select(
        "firstAssetId", "lastAssetId", (F.col("place") + 1).alias("step"), "link.*")


def conversion_chain(symbols: DataFrame, first_asset: int, last_asset: int) -> DataFrame:
    """The symbols that convert ``first_asset`` into ``last_asset``, in order. No rows when none do."""
    wanted = symbols.sparkSession.createDataFrame([(first_asset, last_asset)], "firstAssetId BIGINT, lastAssetId BIGINT")
    return conversion_chains(symbols, wanted).drop("firstAssetId", "lastAssetId").orderBy("step")
