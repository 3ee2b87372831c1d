"""Lookup joins with a key that holds most rows, exact copies included."""

import pytest
from pyspark.sql import functions as F

from tickloom.operators import accounts as A
from tickloom.operators import joins as J


@pytest.fixture(scope="module")
def rows(spark):
    """1200 rows: 400 copies of one row of key 1, 400 other rows of key 1, 400 of keys 2 to 41, one null."""
    data = [(1, 0)] * 400 + [(1, i) for i in range(400)] + [(2 + i % 40, i) for i in range(400)] + [(None, 5)]
    return spark.createDataFrame(data, "k long, v long").repartition(16)


@pytest.fixture(scope="module")
def lookup(spark):
    return spark.createDataFrame([(i, f"n{i}") for i in range(0, 40)], "k long, name string")


def sorted_rows(df):
    return sorted(map(str, df.collect()))


@pytest.mark.parametrize("how", ["left", "inner", "left_semi", "left_anti"])
@pytest.mark.parametrize("share_rows", [10, 100_000])
def test_salted_join_equals_plain_join(rows, lookup, how, share_rows):
    want = rows.join(lookup, ["k"], how)
    if how in ("left_semi", "left_anti"):
        dealt = J.salted_join(rows, lookup.select("k"), ["k"], how, share_rows=share_rows)
    else:
        dealt = J.salted_join(rows, lookup, ["k"], how, share_rows=share_rows)
    assert dealt.columns == want.columns
    assert sorted_rows(dealt) == sorted_rows(want)


def test_copies_of_one_row_are_dealt_out(rows):
    shares = rows.filter("k = 1 and v = 0").withColumn("s", J.spread_over(F.lit(20), "k", "v"))
    sizes = [r["count"] for r in shares.groupBy("s").count().collect()]
    assert len(sizes) > 8 and max(sizes) < 130


@pytest.mark.parametrize("limit", [5, 1000])
def test_lookup_join_on_both_ways(rows, lookup, limit, monkeypatch):
    monkeypatch.setattr(J, "is_small", lambda df: df.limit(limit + 1).count() <= limit)
    assert sorted_rows(J.lookup_join(rows, lookup, ["k"])) == sorted_rows(rows.join(lookup, ["k"], "left"))


@pytest.mark.parametrize("small", [True, False])
def test_tiers_on_both_ways(spark, small, monkeypatch):
    monkeypatch.setattr(J, "is_small", lambda df: small)
    ladders = spark.createDataFrame([(1, [(0, 500), (10, 200)])],
                                    "leverageId long, tiers array<struct<volume: bigint, leverage: bigint>>")
    rows = spark.range(30).selectExpr("1L as leverageId", "id as volume")
    got = {r.volume: r.leverage for r in A.leverage_tier(rows, ladders).collect()}
    assert got == {v: 500 if v < 10 else 200 for v in range(30)}
