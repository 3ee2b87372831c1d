"""Table, JSON, CSV, document, event-bus and alert writers."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery

from tickloom.operators.refdata import flat_symbols
from tickloom.session import remove, workspace


def write_table(df: DataFrame, table: str, mode: str, fmt: str = "parquet") -> bool:
    """Managed table write that does nothing when there are no rows. Returns whether it wrote.

    The rows are computed once, into the shared folder, and the table is touched only when they are all there: a load that
    comes out empty or fails leaves it as it was, and a table may be overwritten by rows that were read from it.
    """
    spark, path = df.sparkSession, workspace(df.sparkSession, "staged")
    try:
        df.write.parquet(path)
        staged = spark.read.schema(df.schema).parquet(path)
        if staged.isEmpty():
            return False
        staged.write.format(fmt).mode(mode).saveAsTable(table)
        return True
    finally:
        remove(spark, path)


def write_json(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def write_flat_csv(symbols: DataFrame, path: str) -> None:
    flat_symbols(symbols).write.mode("overwrite").option("header", True).option("emptyValue", "").csv(path)


def document_sections(header: DataFrame, lists: dict[str, DataFrame], pretty: bool = True) -> DataFrame:
    """The metadata document as rows ``(section, json)``: the header, then every record of every list.

    The lists are not folded into one value, as a value is built by a single task.
    """
    options = {"pretty": "true"} if pretty else {}

    def section(name: str, rows: DataFrame) -> DataFrame:
        return rows.select(F.lit(name).alias("section"), F.to_json(F.struct("*"), options).alias("json"))

    parts = section("document", header)
    for name, rows in lists.items():
        parts = parts.unionByName(section(name, rows))
    return parts


def write_document(header: DataFrame, lists: dict[str, DataFrame], path: str) -> None:
    """Pretty-printed JSON text files, one folder per section."""
    document_sections(header, lists).write.mode("overwrite").partitionBy("section").text(path)


def bus_messages(quotes: DataFrame) -> DataFrame:
    """One JSON message per quote, keyed by symbol as a bus expects."""
    return quotes.select(F.col("Symbol").alias("key"), F.to_json(F.struct(*quotes.columns)).alias("value"))


def hot_rows(quotes: DataFrame, ts: str) -> DataFrame:
    return quotes.withColumn("day", F.to_date(ts))


def publish(quotes: DataFrame, checkpoint: str, fmt: str = "kafka", trigger: dict | None = None,
            **options: str) -> StreamingQuery:
    """Send a quote stream to a bus, one JSON message per quote; any sink that takes key and value works."""
    writer = bus_messages(quotes).writeStream.format(fmt).options(checkpointLocation=checkpoint, **options)
    return writer.trigger(**(trigger or {"availableNow": True})).start()


def expire_days(spark: SparkSession, table: str, now: dt.datetime, keep_days: int = 1) -> list[str]:
    """Drop the ``day`` partitions that lie wholly before the retention limit; no data file is read. Days
    and a ``now`` without a zone are UTC."""
    if now.tzinfo is not None:
        now = now.astimezone(dt.timezone.utc)
    limit = (now - dt.timedelta(days=keep_days)).date().isoformat()
    days = [row["partition"].split("=", 1)[1] for row in spark.sql(f"show partitions {table}").collect()]
    expired = sorted(d for d in days if d < limit)
    for day in expired:
        spark.sql(f"alter table {table} drop if exists partition (day = date'{day}')")
    return expired
