"""Quote queries."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from tickloom.functions import text, times
from tickloom.operators import quotes as Q
from tickloom.operators.accounts import rising_edges, threshold_crossings
from tickloom.operators.latest import first_per_key
from tickloom.operators.ordered import Timeline
from tickloom.operators.refdata import index_last
from tickloom.plans.registry import query
from tickloom.plans.views import SESSIONS, THRESHOLDS, Tables
from tickloom.schemas import QUOTE_JSON
from tickloom.sources.writers import bus_messages

LEVELS = Timeline(("account",), "ts", ("event_id",))

ISO = (
    "strftime(ts, '%Y-%m-%dT%H:%M:%S') || case when microsecond(ts) % 1000000 = 0 then '' "
    "else strftime(ts, '.%f') end || '+00:00'"
)


@query("top_symbols_3h", ("v_spot",), """
select cast(symbolId as varchar(20)) as Symbol, count(*) as tick_count from v_spot
where ts >= (select max(ts) from v_spot) - interval 3 hour
group by 1 order by tick_count desc, Symbol limit 20""")
def top_symbols_3h(db: Tables):
    ticks = db.view("v_spot").withColumn("Symbol", F.col("symbolId").cast("string"))
    return Q.top_symbols(ticks, now=Q.latest_time(ticks))


@query("time_range_param", ("v_spot",), """
select symbolId, count(*) as tick_count from v_spot
where ts between (select max(ts) from v_spot) - interval 1 hour and (select max(ts) from v_spot)
group by symbolId""")
def time_range_param(db: Tables):
    ticks = db.view("v_spot")
    end = Q.latest_time(ticks)
    return Q.counts_in_range(db.spark, ticks, end - dt.timedelta(hours=1), end, "symbolId")


@query("quote_json", ("v_spot", "v_enabled"), f"""
select {ISO} as iso, ts, coalesce(symbolName, cast(symbolId as varchar(20))) as Symbol, bid as Bid, ask as Ask
from v_spot left join v_enabled using (symbolId)""")
def quote_json(db: Tables):
    quotes = Q.quote_events(db.view("v_spot"), db.view("v_enabled"), F.col("ts"))
    parsed = F.from_json("value", QUOTE_JSON)
    return bus_messages(quotes).select(parsed.alias("q")).select(
        F.col("q.timestamp").alias("iso"),
        times.parse_iso(F.col("q.timestamp")).cast("timestamp_ntz").alias("ts"),
        "q.Symbol", "q.Bid", "q.Ask",
    )


@query("json_fields", (), """
select event_id, json_extract_string(props, '$.k') as k_text, cast(json_extract_string(props, '$.k') as bigint) as k
from events""")
def json_fields(db: Tables):
    typed = F.try_variant_get(F.try_parse_json("props"), "$.k", "bigint")
    return db.table("events").select(
        "event_id", F.get_json_object("props", "$.k").alias("k_text"), typed.alias("k")
    )


@query("spot_filter", ("v_messages",), "select event_id, payloadType from v_messages where payloadType = 2131")
def spot_filter(db: Tables):
    return Q.spot_messages(db.view("v_messages")).select("event_id", "payloadType")


@query("noise_filter", ("v_messages",), """
select event_id, payloadType from v_messages where payloadType not in (51, 2101, 2103, 2115, 2138)""")
def noise_filter(db: Tables):
    return Q.without_noise(db.view("v_messages")).select("event_id", "payloadType")


@query("error_split", ("v_messages",), """
select event_id, case when payloadType in (50, 2132, 2142) then 'dead' else 'good' end as route,
       case when payloadType in (50, 2132, 2142)
            then trim(coalesce(errorCode, '') || ': ' || coalesce(description, ''), ': ') end as error
from v_messages""")
def error_split(db: Tables):
    good, dead = Q.split_errors(db.view("v_messages"))
    return good.select("event_id", F.lit("good").alias("route"), F.lit(None).cast("string").alias("error")).unionByName(
        dead.select("event_id", F.lit("dead").alias("route"), "error")
    )


@query("error_text", ("v_messages",), """
select event_id, trim(coalesce(errorCode, '') || ': ' || coalesce(description, ''), ': ') as error from v_messages""")
def error_text(db: Tables):
    return db.view("v_messages").select(
        "event_id", text.error_text(F.col("errorCode"), F.col("description")).alias("error")
    )


@query("symbol_name_lookup", ("v_spot", "v_enabled"), """
select event_id, symbolId, coalesce(symbolName, cast(symbolId as varchar(20))) as Symbol,
       upper(event_type) as kind, lower(coalesce(symbolName, cast(symbolId as varchar(20)))) as symbol_key
from v_spot left join v_enabled using (symbolId)""")
def symbol_name_lookup(db: Tables):
    named = Q.with_symbol_name(db.view("v_spot"), db.view("v_enabled"))
    return named.select(
        "event_id", "symbolId", "Symbol", F.upper("event_type").alias("kind"), F.lower("Symbol").alias("symbol_key")
    )


@query("subscribed_only", ("v_spot", "v_enabled"), """
select event_id, symbolId, bid, ask from v_spot where symbolId in (select symbolId from v_enabled)""")
def subscribed_only(db: Tables):
    kept = Q.subscribed_only(db.view("v_spot"), db.view("v_enabled"))
    return kept.select("event_id", "symbolId", "bid", "ask")


@query("dedup_last_wins", (), """
with keyed as (select case when event_type = 'error' then null else user_id end as id, ts, event_id, value from events)
select id, event_id, value from keyed where id is not null
qualify row_number() over (partition by id order by ts desc, event_id desc) = 1""")
def dedup_last_wins(db: Tables):
    keyed = db.table("events").selectExpr(
        "case when event_type = 'error' then null else user_id end as id", "ts", "event_id", "value"
    )
    return index_last(keyed, "id", ["ts", "event_id"]).select("id", "event_id", "value")


@query("exactly_one_symbol", ("v_symbols", "v_enabled"), """
select e.symbolName, max(s.symbolId) as symbolId from v_enabled e join v_symbols s on s.symbolName = e.symbolName
group by e.symbolName having count(*) = 1""")
def exactly_one_symbol(db: Tables):
    return Q.exactly_one(db.view("v_enabled").select("symbolName"), db.view("v_symbols"))


@query("id_cast", (), """
select event_id, case event_type when 'error' then null when 'click' then null when 'view' then null
                 else user_id end as id from events""")
def id_cast(db: Tables):
    raw = F.expr(
        "case event_type when 'error' then '' when 'click' then null when 'view' then concat('n', user_id) "
        "else cast(user_id as string) end"
    )
    return db.table("events").select("event_id", text.as_id(raw).alias("id"))


@query("numeric_cast", (), """
select event_id, cast(json_extract_string(props, '$.k') as double) as k,
       try_cast(case when event_type = 'error' then 'n/a' else '1.5' end as double) as v from events""")
def numeric_cast(db: Tables):
    mixed = F.when(F.col("event_type") == "error", "n/a").otherwise("1.5")
    return db.table("events").select(
        "event_id", text.to_number(F.get_json_object("props", "$.k")).alias("k"), text.to_number(mixed).alias("v")
    )


@query("quote_ffill", ("v_spot",), """
select event_id, symbolId,
       last_value(nullif(bid, 0) ignore nulls) over w as bid, last_value(nullif(ask, 0) ignore nulls) over w as ask
from v_spot
window w as (partition by symbolId order by ts, event_id rows between unbounded preceding and current row)""")
def quote_ffill(db: Tables):
    return Q.fill_quotes(db.view("v_spot")).select("event_id", "symbolId", "bid", "ask")


@query("spread_pips", ("v_spot", "v_symbol_details"), """
select event_id, symbolId, ask - bid as spread, (bid + ask) / 2.0::double as mid,
       (ask - bid) / pow(10.0::double, 5 - pipPosition) as spread_pips
from v_spot left join v_symbol_details using (symbolId) where bid > 0 and ask > 0""")
def spread_pips(db: Tables):
    return Q.spreads(db.view("v_spot"), db.view("v_symbol_details")).select(
        "event_id", "symbolId", "spread", "mid", "spread_pips"
    )


@query("session_close_change", ("v_spot",), """
with daily as (select symbolId, cast(ts as date) as session_day, arg_max(price, row(ts, event_id)) as last_price
               from v_spot group by 1, 2),
     lagged as (select *, lag(last_price) over (partition by symbolId order by session_day) as session_close from daily)
select symbolId, session_day, last_price, session_close, last_price - session_close as change
from lagged where session_close is not null""")
def session_close_change(db: Tables):
    return Q.session_close_change(db.view("v_spot"))


@query("sessions", ("v_spot",), """
with marked as (select symbolId, ts, case when ts - lag(ts) over w < interval 5 minute then 0 else 1 end as first
                from v_spot window w as (partition by symbolId order by ts)),
     runs as (select symbolId, ts, sum(first) over (partition by symbolId order by ts) as run from marked)
select symbolId, min(ts) as session_start, max(ts) as session_last, count(*) as ticks from runs group by symbolId, run""")
def sessions(db: Tables):
    return Q.sessions(db.view("v_spot"))


IN_SESSION = " or ".join(f"(second_of_week >= {a} and second_of_week < {b})" for a, b in SESSIONS)


@query("in_session_quotes", ("v_spot",), f"""
with timed as (select event_id, symbolId, cast(dayofweek(ts) * 86400 + hour(ts) * 3600 + minute(ts) * 60
               + floor(second(ts)) as bigint) as second_of_week from v_spot)
select event_id, symbolId, second_of_week from timed where {IN_SESSION}""")
def in_session_quotes(db: Tables):
    return Q.in_session(db.view("v_spot"), SESSIONS).select("event_id", "symbolId", "second_of_week")


@query("symbol_session_quotes", ("v_spot", "v_hours"), """
with zoned as (select event_id, symbolId, timezone(coalesce(zone, 'UTC'), timezone('UTC', ts)) as t, firstStart, firstEnd, secondStart, secondEnd
               from v_spot join v_hours using (symbolId)),
     timed as (select *, cast(dayofweek(t) * 86400 + hour(t) * 3600 + minute(t) * 60 + floor(second(t)) as bigint) as second_of_week
               from zoned)
select event_id, symbolId, second_of_week from timed
where (second_of_week >= firstStart and second_of_week < firstEnd) or (second_of_week >= secondStart and second_of_week < secondEnd)""")
def symbol_session_quotes(db: Tables):
    """Quotes inside their own symbol's schedule, which is kept in one of four time zones."""
    hours = db.view("v_hours")

    def span(name: str):
        return F.struct(F.col(f"{name}Start").cast("bigint").alias("startSecond"), F.col(f"{name}End").cast("bigint").alias("endSecond"))

    details = hours.select("symbolId", F.col("zone").alias("scheduleTimeZone"), F.array(span("first"), span("second")).alias("schedule"))
    return Q.in_symbol_session(db.view("v_spot"), details).select("event_id", "symbolId", "second_of_week")


@query("holiday_anti", ("v_spot",), """
select event_id, symbolId from v_spot
where not (month(ts) = 1 and day(ts) = 1) and cast(ts as date) <> date '2024-01-15'""")
def holiday_anti(db: Tables):
    return Q.outside_holidays(db.view("v_spot"), db.holidays()).select("event_id", "symbolId")


@query("depth_book", ("v_depth",), """
with last as (select symbolId, quoteId, arg_max(row(action, size), row(ts, event_id)) as a from v_depth group by 1, 2)
select symbolId, quoteId, a[2] as size from last where a[1] = 'N'""")
def depth_book(db: Tables):
    return Q.price_book(db.view("v_depth"))


WIRE_BOOK = """
with actions as (
  select event_id, ts, symbolId, event_id % 40 as quoteId, true as added, size,
         case when event_id % 2 = 0 then price end as bid, case when event_id % 2 = 1 then price + 100 end as ask from v_wire where adds
  union all select event_id, ts, symbolId, (event_id + 21) % 40, true, size + 1, case when event_id % 2 = 1 then price - 10 end,
         case when event_id % 2 = 0 then price + 110 end from v_wire where adds
  union all select event_id, ts, symbolId, event_id % 40, false, null, null, null from v_wire where not adds
  union all select event_id, ts, symbolId, (event_id + 1) % 40, false, null, null, null from v_wire where not adds),
book as (select symbolId, quoteId, size, bid, ask
         from (select * from actions qualify row_number() over (partition by symbolId, quoteId order by ts desc, event_id desc) = 1)
         where added)
"""


def wire_events(rows):
    """Depth events as they come from the wire: a list of new quotes, each with one side, and a list of deleted ids."""
    odd, none = F.col("event_id") % 2 == 1, F.lit(None).cast("bigint")
    price, size, first = F.col("price"), F.col("size"), F.col("event_id") % 40

    def quote(number, size, bid, ask):
        return F.struct(number.alias("id"), size.alias("size"), bid.alias("bid"), ask.alias("ask"))

    added = F.array(
        quote(first, size, F.when(~odd, price), F.when(odd, price + 100)),
        quote((F.col("event_id") + 21) % 40, size + 1, F.when(odd, price - 10), F.when(~odd, price + 110)))
    deleted = F.array(first, (F.col("event_id") + 1) % 40)
    return rows.select(
        "event_id", "ts", "symbolId", F.when(F.col("adds"), added).alias("newQuotes"),
        F.when(~F.col("adds"), deleted).alias("deletedQuotes"))


def _wire_book(db: Tables):
    return Q.price_book(Q.depth_actions(wire_events(db.view("v_wire"))))


@query("depth_wire", ("v_wire",), WIRE_BOOK + "select * from book")
def depth_wire(db: Tables):
    return _wire_book(db)


BEST = WIRE_BOOK + "select symbolId, max(bid) as best_bid, min(ask) as best_ask from book group by 1"


@query("depth_best", ("v_wire",), BEST)
def depth_best(db: Tables):
    return Q.best_prices(_wire_book(db))


@query("depth_ladder", ("v_wire",), WIRE_BOOK + """, sides as (
  select symbolId, 'BID' as side, bid as price, size, -bid as place from book where bid is not null
  union all select symbolId, 'ASK', ask, size, ask from book where ask is not null),
levels as (select symbolId, side, price, place, sum(size)::bigint as size, count(*) as quotes from sides group by all)
select symbolId, side, price, size, quotes, (row_number() over (partition by symbolId, side order by place))::int as level from levels""")
def depth_ladder(db: Tables):
    return Q.price_levels(_wire_book(db))


@query("request_response_match", ("v_requests", "v_responses"), """
select q.clientMsgId, sentAt, receivedAt, receivedAt is null as timed_out
from v_requests q left join v_responses r
  on q.clientMsgId = r.clientMsgId and receivedAt between sentAt and sentAt + interval 5 second""")
def request_response_match(db: Tables):
    return Q.match_responses(db.view("v_requests"), db.view("v_responses"), 5)


@query("latest_per_key_limit", ("v_spot",), """
select symbolId, event_id, cast(row_number() over (partition by symbolId order by ts desc, event_id desc) as integer)
       as row_no from v_spot qualify row_no <= 10""")
def latest_per_key_limit(db: Tables):
    newest = first_per_key(db.view("v_spot"), ["symbolId"], [F.desc("ts"), F.desc("event_id")], 10)
    return newest.select("symbolId", "event_id", "row_no")


@query("tail_rows", ("v_spot",), "select event_id, ts, symbolId, price from v_spot order by ts desc, event_id desc limit 5")
def tail_rows(db: Tables):
    return db.view("v_spot").select("event_id", "ts", "symbolId", "price").orderBy(
        F.desc("ts"), F.desc("event_id")
    ).limit(5)


CROSSINGS = """
with lagged as (select *, lag(marginLevel) over (partition by account order by ts, event_id) as previousLevel
                from v_levels),
     marks(marginCallType, threshold) as (values ('MARGIN_LEVEL_THRESHOLD_1', 100.0::double),
       ('MARGIN_LEVEL_THRESHOLD_2', 50.0::double), ('MARGIN_LEVEL_THRESHOLD_3', 20.0::double))
select event_id, ts, account, marginLevel, previousLevel, marginCallType, threshold
from lagged join marks on marginLevel < threshold and (previousLevel is null or previousLevel >= threshold)"""


@query("margin_call_crossings", ("v_levels",), CROSSINGS)
def margin_call_crossings(db: Tables):
    return threshold_crossings(db.view("v_levels"), THRESHOLDS, LEVELS)


EDGES = """
with lagged as (select *, lag(marginLevel > 100) over (partition by account order by ts, event_id) as b from v_levels)
select event_id, ts, account, marginLevel from lagged where marginLevel > 100 and not coalesce(b, false)"""


@query("alert_edges", ("v_levels",), EDGES)
def alert_edges(db: Tables):
    return rising_edges(db.view("v_levels"), F.col("marginLevel") > 100, LEVELS)
