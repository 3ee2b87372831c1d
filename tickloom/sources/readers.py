"""Readers of feed messages, reference lists and history tables. Every schema is explicit."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom import schemas

REFERENCE_LISTS = {
    "assets": schemas.ASSET,
    "assetClasses": schemas.ASSET_CLASS,
    "symbolCategories": schemas.SYMBOL_CATEGORY,
    "trader": schemas.TRADER,
    "lightSymbols": schemas.LIGHT_SYMBOL,
    "archivedSymbols": schemas.ARCHIVED_SYMBOL,
    "symbolDetails": schemas.SYMBOL_DETAIL,
    "accounts": schemas.TRADING_ACCOUNT,
}


def read_messages(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Decoded messages, one JSON object per line."""
    return spark.read.schema(schema).json(path)


def read_reference_list(spark: SparkSession, path: str, name: str) -> DataFrame:
    return read_messages(spark, path, REFERENCE_LISTS[name])


def read_accounts(spark: SparkSession, path: str) -> DataFrame:
    """Trading accounts from a payload that is one JSON document with the list under ``data``."""
    return (
        spark.read.schema(f"data ARRAY<STRUCT<{schemas.TRADING_ACCOUNT}>>").option("multiLine", True).json(path)
        .select(F.explode("data").alias("a")).select("a.*")
    )


def read_payload_files(spark: SparkSession, path: str) -> DataFrame:
    """Landed payload files, one JSON document each, as bronze input rows."""
    return spark.read.text(path, wholetext=True).select(F.col("value").alias("json_raw"))


def rows_to_frame(spark: SparkSession, rows: list[dict], schema: str) -> DataFrame:
    return spark.createDataFrame(rows, schema)


def document_to_frame(spark: SparkSession, document: dict, schema: str) -> DataFrame:
    """One nested record as a one-row table. The schema is given: inference fails on mixed types."""
    return spark.createDataFrame([document], schema)


def read_event_stream(spark: SparkSession, path: str, schema: str, fmt: str = "json",
                      **options: str) -> DataFrame:
    """Event stream from files, or from any streaming format the session has, such as ``kafka``."""
    if fmt == "kafka":
        raw = spark.readStream.format("kafka").options(**options).load()
        return raw.select(F.from_json(F.col("value").cast("string"), schema).alias("e")).select("e.*")
    return spark.readStream.schema(schema).format(fmt).options(**options).load(path)


def decode_envelopes(envelopes: DataFrame, payload_type: int, schema: str,
                     message: str | None = None, descriptor: str | None = None) -> DataFrame:
    """Messages of one payload type, decoded.

    Binary payloads are decoded by Spark's protobuf function, which needs its package and a descriptor
    file; text payloads are decoded JSON.
    """
    mine = envelopes.filter(F.col("payloadType") == payload_type)
    if descriptor is not None:
        from pyspark.sql.protobuf.functions import from_protobuf

        body = from_protobuf("payload", message, descFilePath=descriptor, options={"enums.as.ints": "false"})
    else:
        body = F.from_json(F.col("payload").cast("string"), schema)
    return mine.select("clientMsgId", body.alias("m")).select("clientMsgId", "m.*")


def read_history(spark: SparkSession, path: str, ts: str, start: Column, end: Column,
                 symbol_id: int | None = None, fmt: str = "parquet") -> DataFrame:
    """Rows of ``[start, end]``, optionally of one symbol. Literal bounds reach the scan as pushed filters,
    and prune partitions when the table is partitioned by them."""
    rows = spark.read.format(fmt).load(path).filter(F.col(ts).between(start, end))
    return rows if symbol_id is None else rows.filter(F.col("symbolId") == symbol_id)


def read_document(spark: SparkSession, path: str) -> DataFrame:
    """The records of a written metadata document as rows ``(section, json)``. A record starts with a brace at the start of a
    line, so large sections are split between tasks."""
    lines = spark.read.schema("value string, section string").option("lineSep", "\n{").text(path)
    record = F.when(F.col("value").startswith("{"), F.col("value")).otherwise(F.concat(F.lit("{"), F.col("value")))
    return lines.select("section", record.alias("json"))
