"""Ordered operators against brute force, with one key holding a third or more of the rows."""

import datetime as dt
import random

import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from tickloom.operators import ordered as O
from tickloom.operators.latest import first_per_key, latest_per_key, page_after, page_per_key
from tickloom.operators.quotes import sessions

BASE = dt.datetime(2024, 1, 1)


def skewed(n=600, burst=True, seed=1):
    """Half of the rows belong to key 7, a third of them inside one minute, many at the same instant."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        key = 7 if rng.random() < 0.5 else rng.randrange(5)
        if burst and key == 7 and rng.random() < 0.4:
            ts = BASE + dt.timedelta(days=3, hours=5, microseconds=rng.randrange(60) * 1_000_000)
        else:
            ts = BASE + dt.timedelta(seconds=rng.randrange(6 * 86400))
        rows.append((key, ts, i, rng.choice([None, None, rng.randrange(100)])))
    return rows


DDL = "k long, ts timestamp_ntz, id long, v long"


@pytest.fixture(scope="module")
def rows(spark):
    return spark.createDataFrame(skewed(), DDL)


@pytest.fixture(scope="module")
def frame():
    df = pd.DataFrame(skewed(), columns=["k", "ts", "id", "v"], dtype=object)
    return df.sort_values(["k", "ts", "id"])


def as_map(df, column):
    return {r["id"]: r[column] for r in df.collect()}


def clean(series):
    return [None if pd.isna(x) else int(x) for x in series]


@pytest.mark.parametrize("max_rows", [10_000, 40, 3])
def test_fill_forward(rows, frame, max_rows):
    line = O.Timeline(("k",), "ts", ("id",), max_rows)
    got = as_map(O.fill_forward(rows, line, {"f": F.col("v")}), "f")
    filled = frame.assign(v=frame.v.astype("float")).groupby("k").v.ffill()
    assert got == dict(zip(frame.id, clean(filled), strict=True))


@pytest.mark.parametrize("max_rows", [10_000, 3])
def test_running_sum(rows, frame, max_rows):
    line = O.Timeline(("k",), "ts", ("id",), max_rows)
    got = as_map(O.running_sum(rows, line, {"s": F.coalesce("v", F.lit(0).cast("long"))}), "s")
    total = frame.assign(v=frame.v.astype("float").fillna(0)).groupby("k").v.cumsum()
    assert got == dict(zip(frame.id, clean(total), strict=True))


@pytest.mark.parametrize("max_rows", [10_000, 3])
def test_previous(rows, frame, max_rows):
    line = O.Timeline(("k",), "ts", ("id",), max_rows)
    got = as_map(O.previous(rows, line, {"p": F.col("v")}), "p")
    shifted = frame.assign(v=frame.v.astype("float")).groupby("k").v.shift(1)
    assert got == dict(zip(frame.id, clean(shifted), strict=True))


def ranges_of(rows, line):
    cuts = O.splitters(rows, line).cache()
    most = cuts.agg(F.max(F.size("__splitters"))).first()[0]
    return O.in_ranges(rows, line, cuts, most)


def test_ranges_stay_small_on_a_hot_key(rows):
    """The key with half of all rows, a dense day among them, is cut into ranges of equal size; small keys are not cut."""
    hot = rows.filter("k = 7").count()
    line = O.Timeline(("k",), "ts", ("id",), hot // 10)
    sizes = ranges_of(rows, line).groupBy(*line.chunk).count().collect()
    assert hot > 200 and sum(r["count"] for r in sizes) == rows.count()
    assert max(r["count"] for r in sizes) <= hot // 10
    assert max(r["__range"] for r in sizes if r.k == 7) >= 9


def test_one_instant_is_cut_too(spark):
    """A thousand rows with one stamp, told apart by the tie column alone."""
    rows = spark.createDataFrame([(1, BASE, (i * 37) % 1000, i) for i in range(1000)], DDL).repartition(7)
    line = O.Timeline(("k",), "ts", ("id",), 10)
    sizes = ranges_of(rows, line).groupBy("__range").agg(F.count("*").alias("n"), F.min("id"), F.max("id")).collect()
    assert max(r.n for r in sizes) <= 20 and len(sizes) == 100
    ends = sorted((r["min(id)"], r["max(id)"], r["__range"]) for r in sizes)
    assert all(a[1] < b[0] and a[2] < b[2] for a, b in zip(ends, ends[1:], strict=False))
    sums = as_map(O.running_sum(rows, line, {"s": F.lit(1).cast("long")}), "s")
    assert sums == {i: i + 1 for i in range(1000)}


def test_sampled_splitters_keep_near_the_wanted_size(spark):
    """With one row in fifteen sampled, ranges stay within half of the wanted size."""
    rows = spark.range(40_000).selectExpr(
        "1L as k", "timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(cast(id div 20000 as int)) as ts", "id", "id as v")
    line = O.Timeline(("k",), "ts", ("id",), 1000)
    sizes = [r["count"] for r in ranges_of(rows, line).groupBy("__range").count().collect()]
    assert 30 <= len(sizes) <= 50 and max(sizes) < 1500


def test_source_is_read_twice_with_a_hot_key(spark, rows, tmp_path):
    """Once for the sample, once for the rows; all else reads the stored ranges."""
    rows.write.parquet(f"{tmp_path}/rows")
    seen = spark.sparkContext.accumulator(0)

    @F.udf("long")
    def counted(v):
        seen.add(1)
        return v

    source = spark.read.parquet(f"{tmp_path}/rows").withColumn("v", counted.asNondeterministic()("id"))
    O.running_sum(source, O.Timeline(("k",), "ts", ("id",), 20), {"s": F.col("v")}).collect()
    assert rows.count() <= seen.value <= 2 * rows.count()


@pytest.mark.parametrize("max_rows", [10_000, 5])
def test_as_of(spark, max_rows):
    facts = spark.createDataFrame([r for r in skewed(seed=2) if r[3] is not None], DDL)
    probes = spark.createDataFrame([(r[0], r[1], r[2]) for r in skewed(300, seed=3)], "k long, ts timestamp_ntz, pid long")
    got = {r.pid: r.v for r in O.as_of(probes, facts, ["k"], "ts", ["v"], "id", max_rows).collect()}
    listed = sorted(r for r in skewed(seed=2) if r[3] is not None)
    want = {}
    for k, ts, pid, _ in skewed(300, seed=3):
        before = [(f[1], f[2], f[3]) for f in listed if f[0] == k and f[1] <= ts]
        want[pid] = max(before)[2] if before else None
    assert got == want


def test_number_rows_on_sparse_ids(spark):
    ids = [0, 5, 999_999, 1_000_000, 1_000_001, 10**12 + 3, 10**12 + 4, 5 * 10**15, 9 * 10**18]
    df = spark.createDataFrame([(i,) for i in reversed(ids)], "id long")
    assert as_map(O.number_rows(df, "id", "n"), "n") == {v: i for i, v in enumerate(ids)}


def test_latest_per_key_drops_missing_keys_and_takes_last(spark):
    df = spark.createDataFrame([(1, "a", 1), (2, "b", 2), (1, "c", 3), (None, "d", 4)], "k long, v string, o long")
    assert {(r.k, r.v) for r in latest_per_key(df, ["k"], ["o"]).collect()} == {(1, "c"), (2, "b")}


@pytest.mark.parametrize("n", [1, 7, 150])
def test_first_per_key(rows, n):
    w = Window.partitionBy("k").orderBy("ts", "id")
    plain = rows.withColumn("row_no", F.row_number().over(w)).filter(F.col("row_no") <= n)
    got = first_per_key(rows, ["k"], [F.col("ts"), F.col("id")], n)
    assert sorted(got.select("id", "row_no").collect()) == sorted(plain.select("id", "row_no").collect())


def test_page_flags(spark):
    df = spark.createDataFrame([(1, i) for i in range(5)] + [(2, i) for i in range(3)], "k long, o long")
    got = page_per_key(df, ["k"], ["o"], 3).collect()
    assert {(r.k, r.has_more) for r in got} == {(1, True), (2, False)} and len(got) == 6


def test_pages_cover_a_listing_once(rows):
    seen, after = [], None
    while True:
        page = page_after(rows, ["ts", "id"], after, 170).collect()
        seen += [r.id for r in page]
        if not page[-1].has_more:
            break
        after = (page[-1].ts, page[-1].id)
    assert sorted(seen) == sorted(r.id for r in rows.collect()) and len(set(seen)) == len(seen)


def test_sessions(spark):
    rows = skewed(400, seed=5)
    ticks = spark.createDataFrame([(r[0], r[1], r[2]) for r in rows], "symbolId long, ts timestamp_ntz, event_id long")
    want = []
    for key in {r[0] for r in rows}:
        times = sorted(r[1] for r in rows if r[0] == key)
        run = [times[0]]
        for t in times[1:]:
            if t - run[-1] >= dt.timedelta(minutes=5):
                want.append((key, run[0], run[-1], len(run)))
                run = []
            run.append(t)
        want.append((key, run[0], run[-1], len(run)))
    got = sessions(ticks).select("symbolId", "session_start", "session_last", "ticks").collect()
    assert sorted(map(tuple, got)) == sorted(want)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.integers(0, 2), st.integers(0, 3 * 86400), st.one_of(st.none(), st.integers(0, 9))),
                min_size=1, max_size=40), st.integers(1, 6))
def test_fill_forward_property(spark, items, max_rows):
    data = [(k, BASE + dt.timedelta(seconds=s), i, v) for i, (k, s, v) in enumerate(items)]
    line = O.Timeline(("k",), "ts", ("id",), max_rows)
    got = as_map(O.fill_forward(spark.createDataFrame(data, DDL), line, {"f": F.col("v")}), "f")
    want = {}
    for k in range(3):
        last = None
        for _, _, i, v in sorted((r for r in data if r[0] == k), key=lambda r: (r[1], r[2])):
            last = v if v is not None else last
            want[i] = last
    assert got == want
