"""Streams over several ordered files, one file per micro-batch, against the batch forms."""

import pytest
from pyspark.sql import functions as F

from tickloom.operators import bars as B
from tickloom.operators import quotes as Q
from tickloom.operators.accounts import rising_edges, threshold_crossings
from tickloom.operators.latest import latest_per_key
from tickloom.operators.ordered import Timeline
from tickloom.plans.scratch import drain
from tickloom.plans.views import THRESHOLDS, Tables
from tickloom.sources.writers import publish
from tickloom.streaming import live as L
from tickloom.streaming.state import HeldRows, KeyedState, RollingCounts, read_batches

FILES = 5
LINE = Timeline(("account",), "ts", ("event_id",))


@pytest.fixture(scope="module")
def feed(spark, tmp_path_factory, sf_dir):
    """Levels in FILES files ordered by time, a hot account with a third of the rows."""
    root = tmp_path_factory.mktemp("feed")
    rows = Tables(spark, sf_dir).view("v_levels").withColumn(
        "account", F.when(F.col("event_id") % 3 == 0, 1).otherwise(F.col("account") % 20).cast("bigint"))
    n = rows.count()
    for i in range(FILES):
        part = rows.filter((F.col("event_id") >= n * i // FILES) & (F.col("event_id") < n * (i + 1) // FILES))
        part.coalesce(1).write.parquet(f"{root}/part-{i}")
    return f"{root}/part-*", rows


def stream(spark, feed):
    return spark.readStream.schema(feed[1].schema).option("maxFilesPerTrigger", 1).parquet(feed[0])


def same(a, b):
    assert a.columns == b.columns
    assert sorted(map(tuple, a.collect()), key=str) == sorted(map(tuple, b.collect()), key=str)


RULE = "marginLevel > 100"
EVER = 10**9  # a delay longer than the feed


def kept(spark, tmp_path, schema, delay, buckets=4):
    keys, order = ["account"], ["ts", "event_id"]
    return (KeyedState(spark, f"{tmp_path}/state", schema, keys, order, buckets),
            HeldRows(spark, f"{tmp_path}/held", schema, keys, order, delay))


def settled(rows, seconds):
    newest = rows.agg(F.max("ts")).first()[0]
    return rows.filter(F.col("ts") <= F.lit(newest) - F.expr(f"interval {seconds} seconds"))


def test_margin_calls_across_batches(spark, feed, tmp_path):
    state, held = kept(spark, tmp_path, feed[1].schema, 60)
    drain(L.live_margin_calls(stream(spark, feed), THRESHOLDS, state, held, LINE, f"{tmp_path}/out", f"{tmp_path}/cp"))
    rows = settled(feed[1], 60)
    want = threshold_crossings(rows, THRESHOLDS, LINE)
    same(read_batches(spark, f"{tmp_path}/out", want.schema), want)
    same(state.current(), latest_per_key(rows, ["account"], ["ts", "event_id"]))
    same(state.before(FILES), state.current())


@pytest.mark.parametrize("split", ["event_id % 3", "2 - event_id % 3", "pmod(hash(event_id), 4)", "-floor(event_id / 2000)"])
def test_alerts_do_not_depend_on_files(spark, feed, tmp_path, split):
    """Rows dealt out to files in any way and order, the newest first among them, each file its own run."""
    state, held = kept(spark, tmp_path, feed[1].schema, EVER)
    numbered = feed[1].withColumn("part", F.expr(split).cast("int"))
    parts = sorted(r[0] for r in numbered.select("part").distinct().collect())
    end = spark.createDataFrame([(-1, 10**7, -1, 0.0)], "event_id long, s long, account long, marginLevel double").selectExpr(
        "event_id", "timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(0, 0, 0, s) * 300 as ts", "account", "marginLevel")
    pieces = [numbered.filter(F.col("part") == k).drop("part") for k in parts] + [end]
    for piece in pieces:
        piece.select(*feed[1].columns).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
        source = spark.readStream.schema(feed[1].schema).parquet(f"{tmp_path}/in")
        drain(L.live_alerts(source, F.expr(RULE), state, held, LINE, f"{tmp_path}/out", f"{tmp_path}/cp"))
    same(read_batches(spark, f"{tmp_path}/out", feed[1].schema), rising_edges(feed[1], F.expr(RULE), LINE))
    assert held.late().count() == 0


def levels(spark, *items):
    made = spark.createDataFrame([(i, s, a, v) for i, s, a, v in items], "event_id long, s long, account long, marginLevel double")
    return made.selectExpr("event_id", "cast(timestamp_seconds(s) as timestamp_ntz) as ts", "account", "marginLevel")


def test_late_rows_are_dead_letters_and_repeats_raise_no_alert(spark, tmp_path):
    loads = (
        [(1, 100, 1, 50.0), (2, 200, 1, 150.0), (7, 150, None, 150.0), (8, None, 1, 150.0)],
        [(2, 200, 1, 150.0), (4, 300, 1, 170.0), (3, 95, 1, 160.0), (3, 95, 1, 160.0)],
        [(5, 400, 1, 10.0), (9, 1000, 2, 0.0)],
        [(6, 500, 1, 120.0), (10, 990, 2, 200.0), (10, 990, 2, 200.0), (11, 2000, 3, 0.0)],
    )
    schema = levels(spark, *loads[0]).schema
    state, held = kept(spark, tmp_path, schema, 100)
    for load in loads:
        levels(spark, *load).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
        source = spark.readStream.schema(schema).parquet(f"{tmp_path}/in")
        drain(L.live_alerts(source, F.expr(RULE), state, held, LINE, f"{tmp_path}/out", f"{tmp_path}/cp"))
    assert sorted(r.event_id for r in read_batches(spark, f"{tmp_path}/out", schema).collect()) == [2, 10]
    assert sorted(r.event_id for r in held.late().collect()) == [3, 3, 6, 7, 8]


def test_a_batch_run_again_changes_nothing(spark, feed, tmp_path):
    state, held = kept(spark, tmp_path, feed[1].schema, 0)
    early = feed[1].filter("event_id < 3000")
    late = feed[1].filter("event_id >= 3000")
    for batch, rows in ((0, early), (1, late), (2, late), (2, late), (3, early), (3, early)):
        state.write(rows, batch)
    same(state.before(4), latest_per_key(feed[1], ["account"], ["ts", "event_id"]))
    same(state.current(), state.before(4))
    first = sorted(held.take(early, 0).collect())
    assert first == sorted(held.take(early, 0).collect()) == sorted(early.collect())
    assert sorted(held.take(late, 1).collect()) == sorted(held.take(late, 1).collect())


def test_a_batch_reads_the_buckets_of_its_keys(spark, tmp_path):
    schema = levels(spark, (1, 1, 1, 1.0)).schema
    state = KeyedState(spark, str(tmp_path), schema, ["account"], ["ts", "event_id"], 32)
    state.write(levels(spark, *[(i, 100, i, 1.0) for i in range(640)]), 0)
    one = levels(spark, (1000, 200, 7, 2.0))
    read = state.before(1, one)
    assert 7 in {r.account for r in read.collect()} and read.count() < 640 // 8
    assert read.select(F.input_file_name()).distinct().count() == 1
    for batch in range(1, 6):
        state.write(levels(spark, (1000 + batch, 200 + batch, 7, 2.0)), batch)
    held = spark.read.parquet(f"{tmp_path}/rows")
    assert held.select("slot").distinct().count() <= 32 + 2, "replaced buckets are removed"
    assert state.current().count() == 640 and state.current().filter("account = 7").first().event_id == 1005


def test_deleted_quotes_expire(spark, tmp_path):
    def quotes(*items):
        return spark.createDataFrame(items, "symbolId long, quoteId long, s long, event_id long, action string").selectExpr(
            "symbolId", "quoteId", "cast(timestamp_seconds(s) as timestamp_ntz) as ts", "event_id", "action")

    state = KeyedState(spark, str(tmp_path), quotes((1, 1, 1, 1, "N")).schema, ["symbolId", "quoteId"], ["ts", "event_id"], 1,
                       gone=F.col("action") == "D", keep_seconds=100)
    state.write(quotes((1, 1, 10, 1, "N"), (1, 2, 10, 2, "N")), 0)
    state.write(quotes((1, 1, 50, 4, "D")), 1)
    state.write(quotes((1, 1, 40, 3, "N")), 2)  # sent before the deletion, comes after it
    assert {(r.quoteId, r.action) for r in state.current().collect()} == {(1, "D"), (2, "N")}
    state.write(quotes((1, 3, 151, 5, "N")), 3)
    assert {(r.quoteId, r.action) for r in state.current().collect()} == {(2, "N"), (3, "N")}


def test_first_reply_of_two_files(spark, tmp_path):
    """Replies in two files, the later one first, and a request without one: a row each, as in batch."""
    def at(rows, column):
        return spark.createDataFrame(rows, f"clientMsgId string, s long").selectExpr(
            "clientMsgId", f"timestamp_seconds(s) as {column}")

    sent = [at([("a", 100), ("b", 101), ("c", 102)], "sentAt"), at([("z", 9000)], "sentAt")]
    replies = [at([("a", 104), ("c", 110)], "receivedAt"), at([("a", 102), ("b", 106), ("a", 105), ("y", 9500)], "receivedAt")]
    with L.state_partitions(spark, 2):
        for asked, back in zip(sent, replies, strict=True):
            asked.coalesce(1).write.mode("append").parquet(f"{tmp_path}/sent")
            back.coalesce(1).write.mode("append").parquet(f"{tmp_path}/back")
            streams = (spark.readStream.schema(x.schema).parquet(f"{tmp_path}/{n}") for n, x in (("sent", asked), ("back", back)))
            drain(L.live_timeouts(*streams, 5, "100 seconds", f"{tmp_path}/out", f"{tmp_path}/cp"))
    got = {(r.clientMsgId, r.receivedAt, r.timed_out) for r in spark.read.parquet(f"{tmp_path}/out").collect()}
    want = Q.match_responses(sent[0], replies[0].unionByName(replies[1]), 5)
    assert got == {(r.clientMsgId, r.receivedAt, r.timed_out) for r in want.collect()} and len(got) == 3


def test_bars_close_with_the_watermark(spark, feed, tmp_path):
    ticks = feed[1].selectExpr("event_id", "cast(ts as timestamp) as ts", "account as symbolId", "marginLevel as price")
    live = stream(spark, feed).selectExpr(
        "event_id", "cast(ts as timestamp) as ts", "account as symbolId", "marginLevel as price")
    with L.state_partitions(spark, 4):
        drain(L.live_bars(live, "H4", "1 hour", f"{tmp_path}/out", f"{tmp_path}/cp"))
    end = ticks.agg(F.max("ts") - F.expr("interval 1 hour")).first()[0]
    bars = B.bars_from_ticks(ticks, "H4").filter(F.col("bar_time") + F.expr("interval 4 hours") <= F.lit(end))
    same(spark.read.parquet(f"{tmp_path}/out").select("symbolId", "bar_time", "open", "high", "low", "close", "volume"),
         bars.select("symbolId", "bar_time", "open", "high", "low", "close", "volume"))


def test_weekly_bars_start_on_monday(spark, feed, tmp_path):
    live = stream(spark, feed).selectExpr(
        "event_id", "cast(ts as timestamp) as ts", "account as symbolId", "marginLevel as price")
    with L.state_partitions(spark, 4):
        drain(L.live_bars(live, "W1", "1 hour", f"{tmp_path}/out", f"{tmp_path}/cp"))
    starts = spark.read.parquet(f"{tmp_path}/out").select(F.dayofweek("bar_time")).distinct().collect()
    assert [r[0] for r in starts] == [2]


def test_fan_out_writes_each_batch_once(spark, feed, tmp_path):
    quotes = stream(spark, feed).selectExpr("ts", "cast(account as string) as Symbol", "marginLevel as price")
    drain(L.fan_out(quotes, "ts", F.col("price") > 100, f"{tmp_path}/out", f"{tmp_path}/cp"))
    n = feed[1].count()
    assert read_batches(spark, f"{tmp_path}/out/hot", "Symbol string").count() == n
    assert read_batches(spark, f"{tmp_path}/out/bus", "value string", "text").count() == n
    assert read_batches(spark, f"{tmp_path}/out/alerts", "Symbol string").count() == feed[1].filter("marginLevel > 100").count()


@pytest.mark.parametrize("shares", [1, 4])
def test_repeats_are_dropped(spark, feed, tmp_path, shares):
    live = stream(spark, feed).selectExpr("event_id", "cast(ts as timestamp) as ts", "explode(array(1, 2)) as copy")
    with L.state_partitions(spark, 4):
        drain(L.live_distinct(live, ["event_id"], "10 minutes", f"{tmp_path}/out", f"{tmp_path}/cp",
                              shares))
    assert spark.read.parquet(f"{tmp_path}/out").count() == feed[1].count()


def test_publish_one_message_per_quote(spark, feed, tmp_path):
    quotes = stream(spark, feed).selectExpr("cast(account as string) as Symbol", "event_id")
    drain(publish(quotes, f"{tmp_path}/cp", fmt="parquet", path=f"{tmp_path}/out"))
    sent = spark.read.parquet(f"{tmp_path}/out").select("key", F.from_json("value", "Symbol STRING, event_id BIGINT").alias("q"))
    assert sent.filter("key = q.Symbol").select("q.event_id").distinct().count() == feed[1].count()


def test_top_tile_reads_closed_slots(spark, feed, tmp_path):
    live = stream(spark, feed).selectExpr("event_id", "cast(ts as timestamp) as ts", "account as symbolId")
    with L.state_partitions(spark, 4):
        drain(L.live_counts(live, "10 minutes", f"{tmp_path}/out", f"{tmp_path}/cp"))
    counts = spark.read.parquet(f"{tmp_path}/out")
    end = counts.agg(F.max("slot_end")).first()[0]
    ticks = feed[1].selectExpr("cast(ts as timestamp) as ts", "account as symbolId").filter(
        (F.col("ts") >= F.lit(end) - F.expr("interval 3 hours")) & (F.col("ts") < F.lit(end)))
    want = Q.tick_counts(ticks, "symbolId").orderBy(F.desc("tick_count"), "symbolId").limit(20)
    assert [tuple(r) for r in L.top_tile(counts).collect()] == [tuple(r) for r in want.collect()]


def test_kept_tile_equals_the_summed_one_after_each_file(spark, feed, tmp_path):
    """One file a run; the window is shorter than a file, so slots leave, and some runs close nothing."""
    shape = feed[1].selectExpr("account as symbolId").schema["symbolId"]
    tile = RollingCounts(spark, f"{tmp_path}/tile", shape, 300, 6)
    quiet = feed[1].selectExpr("event_id", "account", "marginLevel", "ts").limit(1)
    parts = [spark.read.schema(feed[1].schema).parquet(feed[0].replace("*", str(k))) for k in range(FILES)]
    for part in [parts[0], quiet.select(*feed[1].columns), parts[1], parts[2]]:
        part.coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
        live = spark.readStream.schema(feed[1].schema).parquet(f"{tmp_path}/in").selectExpr(
            "event_id", "cast(ts as timestamp) as ts", "account as symbolId")
        with L.state_partitions(spark, 4):
            drain(L.live_tile(live, "10 minutes", tile, f"{tmp_path}/cp-tile"))
            drain(L.live_counts(live, "10 minutes", f"{tmp_path}/out", f"{tmp_path}/cp"))
        want = L.top_tile(spark.read.parquet(f"{tmp_path}/out"), slots=6).collect()
        assert want and [tuple(r) for r in L.top_now(tile).collect()] == [tuple(r) for r in want]


def test_a_tile_batch_run_again_changes_nothing(spark, tmp_path):
    def counts(*items):
        return spark.createDataFrame(items, "symbolId long, s long, ticks long").selectExpr(
            "symbolId", "timestamp_seconds(s) as slot_end", "ticks")

    shape = counts((1, 300, 1)).schema["symbolId"]
    tile = RollingCounts(spark, str(tmp_path), shape, 300, 3)
    batches = [counts((1, 300, 5), (2, 300, 1)), counts((1, 600, 2)).filter("false"), counts((1, 900, 2), (None, 900, 4)),
               counts((1, 1200, 1)), counts((3, 9000, 7)), counts((3, 9300, 1))]
    want = [{1: 5, 2: 1}, {1: 5, 2: 1}, {1: 7, 2: 1, None: 4}, {1: 3, None: 4}, {3: 7}, {3: 8}]
    for n, (batch, totals) in enumerate(zip(batches, want, strict=True)):
        for _ in range(2):
            tile.add(batch, n)
            assert {r.symbolId: r.ticks for r in tile.current().collect()} == totals
    ring = spark.read.parquet(f"{tmp_path}/ring")
    assert {r.batch for r in ring.select("batch").distinct().collect()} == {4, 5}, "slots that left are removed"
