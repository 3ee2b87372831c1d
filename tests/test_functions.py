import datetime as dt
import time

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from tickloom.functions import prices, text, times
from tickloom.operators import bars as B
from tickloom.operators import quotes as Q
from tickloom.schemas import ENUMS, FLAT_SYMBOL, PAYLOAD_TYPES


def one(df):
    return df.first()[0]


def values(spark, rows, ddl, column):
    return [r[0] for r in spark.createDataFrame(rows, ddl).select(column).collect()]


def test_trendbar_decode(spark):
    bar = spark.createDataFrame(
        [(7, 107000, 100, 200, 250, 28401120)],
        "volume long, low long, deltaOpen long, deltaClose long, deltaHigh long, utcTimestampInMinutes long",
    )
    row = B.decode_bars(bar, keys=()).select("*", F.unix_seconds("Time").alias("s")).first()
    assert row.s == 1704067200
    assert (row.Open, row.High, row.Low, row.Close, row.Volume) == (1.071, 1.0725, 1.07, 1.072, 7)


def test_trendbar_encode_is_inverse(spark):
    bars = spark.createDataFrame(
        [(1, dt.datetime(2024, 1, 1), 107100, 107250, 107000, 107200, 7)],
        "symbolId long, bar_time timestamp_ntz, open long, high long, low long, close long, volume long",
    )
    wire = B.encode_bars(bars).first().asDict()
    assert wire == {
        "symbolId": 1, "volume": 7, "low": 107000, "deltaOpen": 100, "deltaClose": 200, "deltaHigh": 250,
        "utcTimestampInMinutes": 28401120,
    }


def test_next_bar_label_drops_last(spark):
    bars = spark.createDataFrame(
        [(1, i, o, c) for i, (o, c) in enumerate([(1, 2), (2, 1), (1, 1), (1, 3)])],
        "symbolId long, bar_time long, open long, close long",
    )
    labels = [r.label for r in B.next_bar_label(bars).orderBy("bar_time").collect()]
    assert labels == [0, 0, 1]


def test_id_cast(spark):
    got = values(spark, [(None,), ("",), ("42",), ("x",)], "v string", text.as_id(F.col("v")))
    assert got == [None, None, 42, None]
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        values(spark, [("x",)], "v string", text.as_id(F.col("v"), strict=True))


def test_iso_round_trip(spark):
    texts = ["2024-01-01T00:00:00.123456+00:00", "2024-01-01T00:00:00+00:00"]
    df = spark.createDataFrame([(t,) for t in texts], "v string").select("v", times.parse_iso(F.col("v")).alias("t"))
    assert [r.iso for r in df.select(times.iso_utc(F.col("t")).alias("iso")).collect()] == texts


def test_volume_and_pair(spark):
    assert values(spark, [("10",)], "v string", prices.units(F.col("v"))) == [1000]
    assert values(spark, [("SOL/USD",), ("AAPL",)], "v string", text.strip_usd(F.col("v"))) == ["SOL", "AAPL"]


def test_error_text(spark):
    rows = [("E1", "closed"), (None, "closed"), ("E1", None), (None, None), ("E1: ", " x")]
    got = values(spark, rows, "c string, d string", text.error_text(F.col("c"), F.col("d")))
    assert got == ["E1: closed", "closed", "E1", "", "E1: :  x"]


def test_enum_case_rules(spark):
    assert values(spark, [("M5",), (None,)], "v string", text.enum_number("trendbarPeriod", F.col("v"))) == [5, None]
    assert values(spark, [("bid",)], "v string", text.enum_number("quoteType", F.col("v"), any_case=True)) == [1]
    with pytest.raises(Exception, match="unknown trendbarPeriod"):
        values(spark, [("m5",)], "v string", text.enum_number("trendbarPeriod", F.col("v")))
    assert values(spark, [(2,), (9,)], "v int", text.enum_name("tradeSide", F.col("v"))) == ["SELL", None]


def test_enum_tables_are_one_to_one():
    for names in ENUMS.values():
        assert len(set(names.values())) == len(names)
    assert len(FLAT_SYMBOL) == 34
    assert PAYLOAD_TYPES["SPOT"] == 2131


def test_price_routing_and_money(spark):
    df = spark.createDataFrame([("LIMIT", 1.5), ("stop", 2.5), ("MARKET", 3.5)], "t string, p double")
    got = [tuple(r) for r in df.select(
        prices.limit_price(F.col("t"), F.col("p")), prices.stop_price(F.col("t"), F.col("p"))).collect()]
    assert got == [(1.5, None), (None, 2.5), (None, None)]
    assert values(spark, [(1234, 2)], "v long, d int", prices.money(F.col("v"), F.col("d"))) == [12.34]


def test_second_of_week(spark):
    rows = [(dt.datetime(2024, 1, 7, 0, 0, 0),), (dt.datetime(2024, 1, 8, 1, 0, 5),), (dt.datetime(2024, 1, 6, 23, 59, 59),)]
    got = values(spark, rows, "t timestamp_ntz", times.second_of_week(F.col("t")))
    assert got == [0, 90005, 604799]
    shifted = values(spark, rows[:1], "t timestamp_ntz", times.second_of_week(F.col("t"), "America/New_York"))
    assert shifted == [604800 - 5 * 3600]


def test_lookback(spark):
    now = F.lit("2024-01-08 00:00:00.7").cast("timestamp")
    df = spark.range(1)
    assert one(df.select(times.lookback_millis(now, weeks=1))) == 1704067200000
    assert one(df.select(times.epoch_millis(now))) == 1704672000000
    assert one(df.select(times.day_text(now))) == "2024-01-08"


def test_payload_presence(spark):
    rows = [(None,), ("{}",), ("[]",), ("null",), (" {} ",), ('{"a":1}',)]
    assert values(spark, rows, "v string", text.has_payload(F.col("v"))) == [False] * 5 + [True]


def test_json_result(spark):
    assert values(spark, [("ok",)], "v string", text.json_result(F.col("v"))) == ['{"result":"ok"}']
    row = spark.createDataFrame([Row(a=1, b=None)], "a long, b string").select(text.json_record("a", "b"))
    assert one(row) == '{"a":1}'


@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
@pytest.mark.parametrize("kind", ["timestamp", "timestamp_ntz"])
def test_look_back_from_the_newest_row(spark, kind, zone, monkeypatch):
    monkeypatch.setenv("TZ", zone)
    time.tzset()
    try:
        texts = [("2024-01-01 00:00:00",), ("2024-01-01 02:00:00",), ("2024-01-01 05:00:00",)]
        ticks = spark.createDataFrame(texts, "v string").select(F.col("v").cast(kind).alias("ts"), F.lit("A").alias("Symbol"))
        now = Q.latest_time(ticks)
        assert Q.since(ticks, 3, now).count() == 2
        assert Q.between(ticks, now - dt.timedelta(hours=1), now).count() == 1
        counts = Q.counts_in_range(spark, ticks, now - dt.timedelta(hours=5), now).first()
        assert tuple(counts) == ("A", 3)
        assert Q.since(ticks, 3).count() == 0
    finally:
        monkeypatch.undo()
        time.tzset()
