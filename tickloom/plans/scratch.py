"""Scratch databases and stream runs for the registered queries."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql.streaming.query import StreamingQuery

from tickloom.session import workspace


def scratch_database(spark: SparkSession) -> str:
    """A database of managed tables in a fresh shared folder."""
    folder = workspace(spark, "db")
    name = "tl_" + folder.rsplit("-", 1)[1]
    spark.sql(f"create database {name} location '{folder}'")
    return name


def drain(*started: StreamingQuery) -> None:
    """Wait until queries over what is available now have ended; a failure is raised here."""
    for running in started:
        running.awaitTermination()
