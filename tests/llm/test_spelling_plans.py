"""Spelling variants keep the vocabulary off the driver, whatever size Spark takes their files for."""

import pytest

from tickloom.llm import spelling


@pytest.fixture
def plans(spark, monkeypatch):
    """Plans of the tables that are stored, as they are before the run."""
    found, store = [], spelling.stored

    def keep(df, name):
        found.append(df._jdf.queryExecution().executedPlan().toString())
        return store(df, name)

    monkeypatch.setattr(spelling, "stored", keep)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10m")
    yield found
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_no_join_is_broadcast(spark, plans):
    words = [("windows", 500), ("window", 20), ("windowss", 5), ("letters", 5), ("lettets", 100)]
    result = spelling.variants(spark.createDataFrame(words, "word string, n bigint"))
    forms = {r.word: (r.form, r.root) for r in result.collect()}
    assert forms["windowss"] == ("windows", "windows") and forms["letters"] == ("lettets", "lettets")
    plans.append(result._jdf.queryExecution().executedPlan().toString())
    assert sum("SortMergeJoin" in p for p in plans) >= 4
    assert not [p for p in plans if "Broadcast" in p]
