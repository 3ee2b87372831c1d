"""Corpus pipeline: each stage reads what the one before kept, as Parquet, and calls one operator.

Quality rules drop documents, the similarity join leaves one document of each group, documents that hold a benchmark item
go, secrets are masked in the text, and what remains is packed into sequences.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.llm import decontaminate, packing, quality, secret_scan, similar
from tickloom.llm.common import table
from tickloom.session import stored


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that a rule rejects. Each row is judged by its own text, a null one as empty, so repeated rows
    and rows without doc_id stay or go alike. An empty table stays empty."""
    return quality.keep(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest doc_id of each group, and one of the rows that share doc_id and text. Rows that share a
    doc_id but not the text are one document and go or stay together; of rows without doc_id one of each text stays. Empty
    and null texts are near to nothing. An empty table stays empty."""
    joined = stored(similar.similar_components(docs), "components")
    others = joined.filter("doc_id is not null and component_id <> doc_id").select("doc_id").distinct()
    digest = F.sha2(F.coalesce(F.col("text"), F.lit("")), 256)
    kept = docs.join(others, "doc_id", "left_anti").withColumn("__text", digest)
    return kept.dropDuplicates(["doc_id", "__text"]).select(*docs.columns)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that contain a benchmark item. Rows that share a doc_id are one document; a row without
    doc_id is judged by its own text. Null and empty texts contain nothing. An empty table stays empty."""
    benchmark = table(spark, sf_dir, "benchmark")
    named, unnamed = docs.filter("doc_id is not null"), docs.filter("doc_id is null")
    found = stored(decontaminate.contained(named, benchmark).select("doc_id").distinct(), "leaks")
    clean = named.join(found, "doc_id", "left_anti").select(*docs.columns)
    if unnamed.isEmpty():
        return clean
    by_text = unnamed.withColumn("__row", F.xxhash64(F.coalesce(F.col("text"), F.lit(""))))
    texts = by_text.select(F.col("__row").alias("doc_id"), "text").distinct()
    leaks = stored(decontaminate.contained(texts, benchmark).select(F.col("doc_id").alias("__row")).distinct(), "leaks")
    return clean.unionByName(by_text.join(leaks, "__row", "left_anti").select(*docs.columns))


def secret_scans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, their secrets masked; ``n_chars`` is that of the masked text, null for a null one."""
    masked = docs.withColumn("text", secret_scan.mask_secrets(docs))
    return masked.withColumn("n_chars", F.char_length("text").cast("bigint")).select(*docs.columns)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Places of the pieces of all documents, repeated rows and rows without doc_id among them; an empty or null text is its
    end token alone. An empty table gives no rows."""
    return packing.pack(docs)


STAGES = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("benchmark_decontamination", benchmark_decontamination),
    ("secret_scans", secret_scans),
    ("best_fit_packing", best_fit_packing),
]

#: SQL cannot express the tokens of the last stage; tests hold the stages to brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``, each result written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
