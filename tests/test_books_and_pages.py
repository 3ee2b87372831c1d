"""Depth ladders, schedules in their own zones, conversion chains and large pages against brute force."""

import datetime as dt
import random
from collections import deque
from zoneinfo import ZoneInfo

import pytest
from pyspark.sql import functions as F

from tickloom.operators import joins
from tickloom.operators import latest as T
from tickloom.operators import quotes as Q
from tickloom.operators import refdata as R

rng = random.Random(11)


def test_price_levels(spark):
    book = spark.createDataFrame(
        [(1, 1, 10, 100, None), (1, 2, 5, 100, None), (1, 3, 7, 90, None), (1, 4, 1, None, 110), (1, 5, 2, None, 105), (2, 1, 3, None, None)],
        "symbolId long, quoteId long, size long, bid long, ask long")
    got = {(r.symbolId, r.side, r.level): (r.price, r["size"], r.quotes) for r in Q.price_levels(book).collect()}
    assert got == {(1, "BID", 1): (100, 15, 2), (1, "BID", 2): (90, 7, 1), (1, "ASK", 1): (105, 2, 1), (1, "ASK", 2): (110, 1, 1)}
    assert {(r.symbolId, r.best_bid, r.best_ask) for r in Q.best_prices(book).collect()} == {(1, 100, 105), (2, None, None)}


def test_schedules_follow_their_zone_and_daylight_saving(spark):
    zones = {1: "America/New_York", 2: "Europe/Berlin", 3: None, 4: "Asia/Kolkata"}
    ranges = {1: [(0, 3600), (122_400, 145_800)], 2: [(30_600, 200_000), (100_000, 210_000)], 3: [(604_000, 604_800), (5, 5)], 4: [(86_400, 86_401)]}
    details = spark.createDataFrame(
        [(k, z, ranges[k]) for k, z in zones.items()] + [(5, "UTC", None)],
        "symbolId long, scheduleTimeZone string, schedule array<struct<startSecond: long, endSecond: long>>")
    base = dt.datetime(2024, 3, 8)  # both changes of the clock follow within a month
    ticks = [(i, rng.randrange(1, 7), base + dt.timedelta(seconds=rng.randrange(30 * 86400))) for i in range(6000)]
    ticks += [(9000 + i, 4, dt.datetime(2024, 3, 10, 18, 30) + dt.timedelta(seconds=i - 2)) for i in range(4)]
    df = spark.createDataFrame(ticks, "event_id long, symbolId long, ts timestamp_ntz")
    want = set()
    for i, symbol, ts in ticks:
        local = ts.replace(tzinfo=dt.timezone.utc).astimezone(ZoneInfo(zones.get(symbol) or "UTC"))
        second = (local.isoweekday() % 7) * 86400 + local.hour * 3600 + local.minute * 60 + local.second
        if any(a <= second < b for a, b in ranges.get(symbol, [])):
            want.add((i, second))
    for slot in (3600, 900, 604_800):
        rows = Q.in_symbol_session(df, details, slot_seconds=slot).collect()
        assert len(rows) == len(want) and {(r.event_id, r.second_of_week) for r in rows} == want


def test_many_schedules_are_not_broadcast(spark, tmp_path, monkeypatch):
    """Zones and slots of a schedule table counted to be large are shuffled, however small its file is."""
    monkeypatch.setattr(joins, "is_small", lambda df: False)
    spark.range(3000).selectExpr(
        "id as symbolId", "if(id % 2 = 0, 'Asia/Tokyo', null) as scheduleTimeZone",
        "array(named_struct('startSecond', 0L, 'endSecond', 302400L + id % 7)) as schedule").write.parquet(str(tmp_path / "d"))
    spark.range(4000).selectExpr(
        "id as event_id", "id % 4000 as symbolId", "timestamp_ntz '2024-01-01 00:00:00' + make_dt_interval(0, 0, 0, id * 300) as ts",
    ).write.parquet(str(tmp_path / "t"))
    inside = Q.in_symbol_session(spark.read.parquet(str(tmp_path / "t")), spark.read.parquet(str(tmp_path / "d")))
    got = {(r.event_id, r.second_of_week) for r in inside.collect()}
    local = {i: (86400 + i * 300 + (9 * 3600 if i % 2 == 0 else 0)) % 604_800 for i in range(3000)}
    assert got == {(i, s) for i, s in local.items() if s < 302_400 + i % 7}
    ran = inside._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert "SortMergeJoin" in ran and "BroadcastHashJoin" not in ran


def test_slots_are_counted_not_ranges(spark, monkeypatch):
    """Three ranges of a whole week are 504 slots, which a limit of 100 rows keeps from being broadcast."""
    monkeypatch.setattr(joins, "is_small", lambda df: df.count() <= 100)
    details = spark.range(3).selectExpr(
        "id as symbolId", "'UTC' as scheduleTimeZone", "array(named_struct('startSecond', 0L, 'endSecond', 604800L)) as schedule")
    ticks = spark.range(60).selectExpr("id as event_id", "id % 6 as symbolId", "timestamp_ntz '2024-01-01 00:00:00' as ts")
    inside = Q.in_symbol_session(ticks, details)
    assert {r.event_id for r in inside.collect()} == {i for i in range(60) if i % 6 < 3}
    ran = inside._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert "SortMergeJoin" in ran and "LeftSemi, BuildRight" not in ran


def chain(edges, first, last):
    """Shortest chain, smallest symbols first, by distances to the last asset."""
    far, queue = {last: 0}, deque([last])
    while queue:
        at = queue.popleft()
        for (base, quote) in edges:
            if quote == at and base not in far:
                far[base] = far[at] + 1
                queue.append(base)
    steps, at = [], first
    while first in far and at != last:
        symbol, to = min((s, q) for (b, q), s in edges.items() if b == at and far.get(q) == far[at] - 1)
        steps.append((len(steps) + 1, symbol, at, to))
        at = to
    return steps


@pytest.mark.parametrize("edges", [20, 45])
def test_conversion_chains(spark, edges):
    symbols = [(i, rng.randrange(15), rng.randrange(15)) for i in range(edges)]
    df = spark.createDataFrame(symbols, "symbolId long, baseAssetId long, quoteAssetId long")
    best = {}
    for s, b, q in symbols:
        if b != q:
            best[b, q] = min(s, best.get((b, q), s))
    wanted = [(a, b) for a in range(16) for b in range(0, 16, 3)] + [(None, 1), (1, None), (0, 3), (0, 3)]
    got = {}
    for r in R.conversion_chains(df, spark.createDataFrame(wanted, "firstAssetId int, lastAssetId int")).collect():
        got.setdefault((r.firstAssetId, r.lastAssetId), []).append((r.step, r.symbolId, r.fromAssetId, r.toAssetId))
    want = {(a, b): c for a, b in wanted if a is not None and b is not None and a != b and (c := chain(best, a, b))}
    assert {k: sorted(v) for k, v in got.items()} == want and max(map(len, want.values())) > 2


PAGE = "k long, ts timestamp_ntz, id long"


@pytest.fixture(scope="module")
def hot(spark):
    """One key with 30,000 rows, most of them at one instant, another with 5,000, and small ones."""
    start = "timestamp_ntz'2024-01-01 00:00:00'"
    return spark.range(36_000).selectExpr(
        "case when id < 30000 then 1 when id < 35000 then 2 else id % 50 + 10 end as k",
        f"case when id < 25000 then {start} else {start} + make_dt_interval(0, 0, 0, pmod(hash(id), 100000)) end as ts", "id").repartition(6)


@pytest.mark.parametrize("n", [150, 1000, 4900])
def test_large_pages_rank_few_rows_of_a_hot_key(spark, hot, n):
    cut = T.up_to_cuts(hot, ["k"], ["ts", "id"], n, large_rows=4000)
    left = {r.k: r["count"] for r in cut.groupBy("k").count().collect()}
    whole = {r.k: r["count"] for r in hot.groupBy("k").count().collect()}
    assert n <= left[1] <= (4 * n if 8 * n < 30_000 else 30_000)
    assert all(left[k] == whole[k] for k in whole if k > 2)


@pytest.mark.parametrize("n", [150, 3000])
def test_large_pages_are_exact(hot, n, monkeypatch):
    monkeypatch.setattr(T.up_to_cuts, "__defaults__", (4000,))
    page = T.page_per_key(hot, ["k"], ["ts", "id"], n)
    listed = {}
    for r in hot.collect():
        listed.setdefault(r.k, []).append((r.ts, r.id))
    want = {(k, i, at, len(rows) > n) for k, rows in listed.items() for at, (_, i) in enumerate(sorted(rows)[:n], 1)}
    assert {(r.k, r.id, r.row_no, r.has_more) for r in page.collect()} == want


def test_a_page_beyond_both_proposals_is_whole(spark, monkeypatch):
    """All positions alike: the sample has all rows or none, and no row is lost."""
    rows = spark.range(5000).selectExpr("1L as k", "timestamp_ntz'2024-01-01 00:00:00' as ts", "0L as id")
    assert T.up_to_cuts(rows, ["k"], ["ts", "id"], 500, large_rows=100).count() >= 500
