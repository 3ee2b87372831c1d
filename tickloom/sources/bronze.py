"""Raw landing of JSON payloads and the typed reads on top."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom import schemas
from tickloom.functions import text, times
from tickloom.sources.writers import write_table

BAR_FIELDS = "STRUCT<t: STRING, o: DOUBLE, h: DOUBLE, l: DOUBLE, c: DOUBLE, v: DOUBLE>"
CONTRACT_FIELDS = "STRUCT<symbol: STRING>"


def bar_requests(spark: SparkSession, symbols: Sequence[str], now: Column, days_back: int) -> DataFrame:
    """One row per symbol to load: clean symbol, date range, bar size, order and limit."""
    listed = spark.createDataFrame([(s,) for s in symbols], "requested STRING")
    return listed.select(
        "requested",
        text.strip_usd(F.col("requested")).alias("symbol"),
        times.day_text(F.date_sub(now, days_back)).alias("start"),
        times.day_text(now).alias("end"),
        F.lit(schemas.BAR_TIMEFRAME).alias("timeframe"),
        F.lit("asc").alias("sort"),
        F.lit(schemas.BAR_LIMIT).alias("limit"),
    )


def contract_requests(spark: SparkSession, underlyings: Sequence[str]) -> DataFrame:
    """One row per underlying whose active option contracts are to be listed."""
    return spark.createDataFrame([(s,) for s in underlyings], "underlying STRING").select(
        "underlying", F.lit("active").alias("status"), F.lit("asc").alias("sort"),
        F.lit(schemas.BAR_LIMIT).alias("limit"),
    )


def snapshot_requests(contracts: DataFrame) -> DataFrame:
    """One row per listed contract whose snapshot is to be loaded."""
    return contracts.select(
        "contractSymbol", F.lit("asc").alias("sort"), F.lit(schemas.SNAPSHOT_LIMIT).alias("limit")
    )


def usable_payloads(payloads: DataFrame) -> DataFrame:
    """Failed calls leave an empty payload; those are not landed and stop nothing else."""
    return payloads.filter(text.has_payload(F.col("json_raw")))


def land(payloads: DataFrame, table: str, mode: str, fmt: str = "parquet") -> bool:
    """Store usable payloads with one ingestion time per write. Returns whether there were any; with none
    even ``overwrite`` leaves the old table."""
    rows = usable_payloads(payloads).select("json_raw", F.current_timestamp().alias("ingestion_timestamp"))
    return write_table(rows, table, mode, fmt)


def run_batch(loads: dict[str, DataFrame], fmt: str = "parquet") -> dict[str, bool]:
    """Replace each table with a full load."""
    return {table: land(rows, table, "overwrite", fmt) for table, rows in loads.items()}


def run_incremental(loads: dict[str, DataFrame], fmt: str = "parquet") -> dict[str, bool]:
    """Append each load; overlaps with what is there are kept."""
    return {table: land(rows, table, "append", fmt) for table, rows in loads.items()}


def load_sizes(bronze: DataFrame) -> DataFrame:
    """Rows of each write, told apart by its ingestion time."""
    return bronze.groupBy("ingestion_timestamp").agg(F.count(F.lit(1)).alias("rows"))


def parse_bars(bronze: DataFrame, fields: str = BAR_FIELDS) -> DataFrame:
    """Bars of payloads of the form ``{"bars": {symbol: [bar, ...]}}``."""
    parsed = F.from_json("json_raw", f"bars MAP<STRING, ARRAY<{fields}>>")
    return (
        bronze.select(F.explode(parsed["bars"]).alias("symbol", "bars"))
        .select("symbol", F.explode("bars").alias("bar"))
        .select("symbol", "bar.*")
    )


def parse_any(bronze: DataFrame, path: str, as_type: str, name: str) -> DataFrame:
    """One field of payloads whose shape is not known in advance."""
    return bronze.withColumn(name, F.try_variant_get(F.try_parse_json("json_raw"), path, as_type))


def explode_contracts(bronze: DataFrame, keep: Sequence[str] = (), fields: str = CONTRACT_FIELDS) -> DataFrame:
    """One row per contract; a payload without the list counts as one with an empty list, and contracts
    without a symbol are skipped."""
    parsed = F.from_json("json_raw", f"contracts ARRAY<{fields}>")
    contracts = F.coalesce(parsed["contracts"], F.array().cast(f"ARRAY<{fields}>"))
    return (
        bronze.select(*keep, F.explode(contracts).alias("contract"))
        .select(*keep, F.col("contract.symbol").alias("contractSymbol"))
        .filter(F.col("contractSymbol").isNotNull() & (F.col("contractSymbol") != ""))
    )


def contract_snapshots(contracts: DataFrame, snapshots: DataFrame) -> DataFrame:
    """Landed snapshot of each contract; a contract whose snapshot call failed has no row."""
    return contracts.join(usable_payloads(snapshots), "contractSymbol")
