"""Streaming queries: the given tables as file streams, run to the end, results read back.

Append-mode results hold the closed windows only; their SQL counterparts cut at the final watermark. Queries with state of
their own get their rows in several loads, each run to the end and gone on from; some rows come a load late.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery

from tickloom.functions.times import epoch_micros, parse_iso
from tickloom.operators import quotes as Q
from tickloom.operators.ordered import Timeline
from tickloom.plans import quotes as batch
from tickloom.plans.accounts import LATEST_STATE
from tickloom.plans.bars import bars_sql
from tickloom.plans.registry import query
from tickloom.plans.scratch import drain
from tickloom.plans.views import THRESHOLDS, Tables
from tickloom.schemas import QUOTE_JSON
from tickloom.session import workspace
from tickloom.sources.readers import read_event_stream
from tickloom.sources.writers import bus_messages
from tickloom.streaming import live as L
from tickloom.streaming.state import HeldRows, KeyedState, RollingCounts, read_batches

DELAY = "10 minutes"
DELAY_SECONDS, JITTER_SECONDS, LOADS, BUCKETS = 600, 420, 3, 16
LINE = Timeline(("account",), "ts", ("event_id",))
_CLOSED = "(select max(ts) from v_spot) - interval 10 minute"


def _on_clock(rows: DataFrame, ts: str = "ts") -> DataFrame:
    """Watermarks need TIMESTAMP; the tables hold TIMESTAMP_NTZ."""
    return rows.withColumn(ts, F.col(ts).cast("timestamp"))


def _off_clock(rows: DataFrame, *columns: str) -> DataFrame:
    return rows.withColumns({c: F.col(c).cast("timestamp_ntz") for c in columns})


def _folders(db: Tables, name: str) -> tuple[str, str]:
    root = workspace(db.spark, name)
    return f"{root}/out", f"{root}/checkpoint"


@query("live_quotes", ("v_spot", "v_enabled"), """
select event_id, ts, coalesce(symbolName, cast(symbolId as varchar(20))) as Symbol, bid, ask
from v_spot left join v_enabled using (symbolId)""")
def live_quotes(db: Tables):
    """Spot stream, symbol names joined on, appended to the hot table."""
    out, checkpoint = _folders(db, "live-quotes")
    named = L.live_quotes(db.stream("v_spot"), db.view("v_enabled")).select("event_id", "ts", "Symbol", "bid", "ask")
    drain(L.append(named, out, checkpoint, L.ONCE))
    return db.spark.read.parquet(out)


@query("live_json", ("v_spot", "v_enabled"), """
select ts, coalesce(symbolName, cast(symbolId as varchar(20))) as Symbol, bid as Bid, ask as Ask
from v_spot left join v_enabled using (symbolId)""")
def live_json(db: Tables):
    """Quotes published as JSON messages, read back as an event stream and landed in the hot table."""
    out, checkpoint = _folders(db, "live-json")
    quotes = Q.quote_events(db.stream("v_spot"), db.view("v_enabled"), F.col("ts"))
    drain(L.append(bus_messages(quotes).select("value"), f"{out}-bus", f"{checkpoint}-bus", L.ONCE, "text"))
    events = read_event_stream(db.spark, f"{out}-bus", QUOTE_JSON)
    landed = events.withColumn("ts", parse_iso(F.col("timestamp")).cast("timestamp_ntz"))
    drain(L.append(landed.select("ts", "Symbol", "Bid", "Ask"), out, checkpoint, L.ONCE))
    return db.spark.read.parquet(out)


@query("live_bars", ("v_spot",), f"""
with bars as ({bars_sql("H1")}) select * from bars where bar_time + interval 1 hour <= {_CLOSED}""")
def live_bars(db: Tables):
    out, checkpoint = _folders(db, "live-bars")
    with L.state_partitions(db.spark):
        drain(L.live_bars(_on_clock(db.stream("v_spot")), "H1", DELAY, out, checkpoint))
    return _off_clock(db.spark.read.parquet(out), "bar_time")


_TOP = f"""
with slots as (select symbolId, time_bucket(interval '5 minutes', ts) + interval 5 minute as slot_end from v_spot),
     closed as (select * from slots where slot_end <= {_CLOSED})
select symbolId, count(*) as tick_count from closed
where slot_end > (select max(slot_end) from closed) - interval 180 minute
group by 1 order by 2 desc, 1 limit 20"""


@query("live_top", ("v_spot",), _TOP)
def live_top(db: Tables):
    out, checkpoint = _folders(db, "live-top")
    with L.state_partitions(db.spark):
        drain(L.live_counts(_on_clock(db.stream("v_spot")), DELAY, out, checkpoint))
    return L.top_tile(db.spark.read.parquet(out))


@query("live_tile", ("v_spot",), _TOP)
def live_tile(db: Tables):
    """The same tile from totals that each batch brings up to date, over several loads."""
    out, checkpoint = _folders(db, "live-tile")
    rows = db.view("v_spot").select("event_id", "symbolId", "ts")
    tile = RollingCounts(db.spark, out, rows.schema["symbolId"], 300, 36)
    with L.state_partitions(db.spark):
        in_loads(rows, "ts", f"{out}-in", lambda ticks: L.live_tile(_on_clock(ticks), DELAY, tile, checkpoint))
    return L.top_now(tile)


@query("live_sessions", ("v_spot",), f"""
with closed as (select symbolId, ts from v_spot
                where time_bucket(interval '5 minutes', ts) + interval 5 minute <= {_CLOSED}),
     marked as (select symbolId, ts, case when ts - lag(ts) over w < interval 5 minute then 0 else 1 end as first
                from closed window w as (partition by symbolId order by ts)),
     runs as (select symbolId, ts, sum(first) over (partition by symbolId order by ts) as run from marked)
select symbolId, min(ts) as session_start, max(ts) as session_last, count(*) as ticks from runs group by symbolId, run""")
def live_sessions(db: Tables):
    out, checkpoint = _folders(db, "live-sessions")
    with L.state_partitions(db.spark):
        drain(L.live_session_slots(_on_clock(db.stream("v_spot")), DELAY, out, checkpoint))
    return _off_clock(L.live_sessions(db.spark.read.parquet(out)), "session_start", "session_last")


@query("late_dedup", ("v_spot",), "select event_id, symbolId, ts, price from v_spot")
def late_dedup(db: Tables):
    """Every quote sent twice; one of each is kept."""
    out, checkpoint = _folders(db, "late-dedup")
    twice = _on_clock(db.stream("v_spot")).withColumn("copy", F.explode(F.array(F.lit(1), F.lit(2))))
    rows = twice.select("event_id", "symbolId", "ts", "price")
    with L.state_partitions(db.spark):
        drain(L.live_distinct(rows, ["event_id"], DELAY, out, checkpoint))
    return _off_clock(db.spark.read.parquet(out), "ts")


@query("fanout", ("v_spot",), """
select 'hot' as sink, symbolId, count(*) as rows, sum(price)::bigint as price from v_spot group by 2
union all select 'bus', symbolId, count(*), sum(price)::bigint from v_spot group by 2
union all select 'alerts', symbolId, count(*), sum(price)::bigint from v_spot where price > 10000000 group by 2""")
def fanout(db: Tables):
    out, checkpoint = _folders(db, "fanout")
    rows = db.stream("v_spot").select("ts", F.col("symbolId").cast("string").alias("Symbol"), "price")
    drain(L.fan_out(rows, "ts", F.col("price") > 10_000_000, out, checkpoint))
    quote = "Symbol STRING, price BIGINT"
    sinks = {
        "hot": read_batches(db.spark, f"{out}/hot", quote),
        "bus": read_batches(db.spark, f"{out}/bus", "value STRING", "text").select(
            F.from_json("value", quote).alias("q")).select("q.*"),
        "alerts": read_batches(db.spark, f"{out}/alerts", quote),
    }
    parts = [
        rows.groupBy(F.col("Symbol").cast("bigint").alias("symbolId")).agg(
            F.count(F.lit(1)).alias("rows"), F.sum("price").alias("price")).withColumn("sink", F.lit(name))
        for name, rows in sinks.items()
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def in_loads(rows: DataFrame, ts: str, inbox: str, start: Callable[[DataFrame], StreamingQuery], loads: int = LOADS) -> None:
    """Land the rows in ``loads`` parts by time, rows near a border in either part, and let the stream take each part
    before the next one is there, every time from its checkpoint."""
    at = epoch_micros(F.col(ts))
    low, high = rows.agg(F.min(at), F.max(at)).first()
    if low is None:
        return
    strayed = at + F.pmod(F.xxhash64(*rows.columns), F.lit(JITTER_SECONDS * 1_000_000)) - low
    part = F.least(F.floor(strayed * loads / (high - low + 1)).cast("int"), F.lit(loads - 1))
    for k in range(loads):
        rows.filter(part == k).write.mode("append").parquet(inbox)
        drain(start(rows.sparkSession.readStream.schema(rows.schema).parquet(inbox)))


def _state(db: Tables, path: str, view: str, keys: list[str], order: list[str], **options) -> KeyedState:
    return KeyedState(db.spark, path, db.view(view).schema, keys, order, BUCKETS, **options)


@query("live_book", ("v_depth",), """
with last as (select symbolId, quoteId, arg_max(row(action, size), row(ts, event_id)) as a from v_depth group by 1, 2)
select symbolId, quoteId, a[2] as size from last where a[1] = 'N'""")
def live_book(db: Tables):
    out, checkpoint = _folders(db, "live-book")
    state = _state(db, out, "v_depth", ["symbolId", "quoteId"], ["ts", "event_id"], gone=F.col("action") == "D")
    in_loads(db.view("v_depth"), "ts", f"{out}-in", lambda rows: L.live_latest(rows, state, checkpoint))
    return Q.price_book(state.current())


@query("live_best", ("v_wire",), batch.BEST)
def live_best(db: Tables):
    """Best prices of a book that is fed by depth events in wire form."""
    out, checkpoint = _folders(db, "live-best")
    events = db.view("v_wire")
    shape = Q.depth_actions(batch.wire_events(events)).schema
    state = KeyedState(db.spark, out, shape, ["symbolId", "quoteId"], ["ts", "event_id"], BUCKETS, F.col("action") == "D")
    in_loads(events, "ts", f"{out}-in",
             lambda rows: L.live_latest(Q.depth_actions(batch.wire_events(rows)), state, checkpoint))
    return Q.best_prices(Q.price_book(state.current()))


@query("live_order_state", ("v_orders",), LATEST_STATE)
def live_order_state(db: Tables):
    out, checkpoint = _folders(db, "live-orders")
    state = _state(db, out, "v_orders", ["positionId"], ["createdAt", "orderId"])
    in_loads(db.view("v_orders"), "createdAt", f"{out}-in", lambda rows: L.live_latest(rows, state, checkpoint))
    return state.current()


@query("symbol_refresh", ("v_symbols",), """
select symbolId, symbolName, enabled, max(ts) as changedAt from v_symbols join events on user_id = symbolId
group by 1, 2, 3""")
def symbol_refresh(db: Tables):
    """Changed symbols reloaded from the symbol list, unchanged ones left alone."""
    out, checkpoint = _folders(db, "symbol-refresh")
    symbols = db.view("v_symbols").select("symbolId", "symbolName", "enabled")

    def load(ids: DataFrame) -> DataFrame:
        return symbols.join(ids.withColumnRenamed("ts", "changedAt"), "symbolId")

    shape = symbols.withColumn("changedAt", F.lit(None).cast("timestamp_ntz")).schema
    state = KeyedState(db.spark, out, shape, ["symbolId"], ["changedAt"], BUCKETS)
    in_loads(db.view("v_spot").select("symbolId", "ts"), "ts", f"{out}-in",
             lambda rows: L.refresh_symbols(rows, load, state, checkpoint))
    return state.current()


def _levels(sql: str) -> str:
    """The SQL over the rows whose time has come when the stream ends."""
    settled = "v_settled as (select * from v_levels where ts <= (select max(ts) from v_levels) - interval 10 minute)"
    return f"with {settled}, {sql.strip().removeprefix('with ').replace('from v_levels', 'from v_settled')}"


def _changes(db: Tables, out: str) -> tuple[KeyedState, HeldRows]:
    schema = db.view("v_levels").schema
    state = KeyedState(db.spark, f"{out}-state", schema, ["account"], ["ts", "event_id"], BUCKETS)
    return state, HeldRows(db.spark, f"{out}-held", schema, ["account"], ["ts", "event_id"], DELAY_SECONDS)


@query("live_alerts", ("v_levels",), _levels(batch.EDGES))
def live_alerts(db: Tables):
    out, checkpoint = _folders(db, "live-alerts")
    state, held = _changes(db, out)
    rule = F.col("marginLevel") > 100
    in_loads(db.view("v_levels"), "ts", f"{out}-in",
             lambda rows: L.live_alerts(rows, rule, state, held, LINE, out, checkpoint))
    return read_batches(db.spark, out, db.view("v_levels").schema)


@query("live_margin_calls", ("v_levels",), _levels(batch.CROSSINGS))
def live_margin_calls(db: Tables):
    out, checkpoint = _folders(db, "live-margin-calls")
    state, held = _changes(db, out)
    in_loads(db.view("v_levels"), "ts", f"{out}-in",
             lambda rows: L.live_margin_calls(rows, THRESHOLDS, state, held, LINE, out, checkpoint))
    return read_batches(db.spark, out, batch.margin_call_crossings(db).schema)


@query("late_levels", ("v_levels",), f"""
select * from v_levels where event_id % 50 = 0 and ts <= (select max(ts) from v_levels where event_id % 50 <> 0) - interval 10 minute""")
def late_levels(db: Tables):
    """Dead letters: every fiftieth row comes after all others, most of them too late for alerts."""
    out, checkpoint = _folders(db, "late-levels")
    state, held = _changes(db, out)
    rows, inbox = db.view("v_levels"), f"{out}-in"
    for part in (rows.filter("event_id % 50 <> 0"), rows.filter("event_id % 50 = 0")):
        part.write.mode("append").parquet(inbox)
        source = db.spark.readStream.schema(rows.schema).parquet(inbox)
        drain(L.live_alerts(source, F.col("marginLevel") > 100, state, held, LINE, out, checkpoint))
    return held.late()


@query("live_timeouts", ("v_requests", "v_responses"), """
with twice as (select clientMsgId, receivedAt from v_responses
               union all select clientMsgId, receivedAt + interval 1 second from v_responses),
     matched as (select q.clientMsgId, sentAt, min(receivedAt) as receivedAt
     from v_requests q left join twice r
       on q.clientMsgId = r.clientMsgId and receivedAt between sentAt and sentAt + interval 5 second group by 1, 2),
     clock as (select least((select max(sentAt) from v_requests), (select max(receivedAt) from twice))
                      - interval 10 minute as mark)
select matched.*, receivedAt is null as timed_out from matched, clock where sentAt + interval 5 second < mark""")
def live_timeouts(db: Tables):
    """Requests once no first reply can come any more; each reply is sent twice, the second time in another load."""
    out, checkpoint = _folders(db, "live-timeouts")
    sent, back = _on_clock(db.stream("v_requests"), "sentAt"), db.view("v_responses")
    with L.state_partitions(db.spark):
        for again in (F.col("receivedAt"), F.col("receivedAt") + F.expr("interval 1 second")):
            back.withColumn("receivedAt", again).write.mode("append").parquet(f"{out}-in")
            replies = _on_clock(db.spark.readStream.schema(back.schema).parquet(f"{out}-in"), "receivedAt")
            drain(L.live_timeouts(sent, replies, 5, DELAY, out, checkpoint))
    return _off_clock(db.spark.read.parquet(out), "sentAt", "receivedAt")
