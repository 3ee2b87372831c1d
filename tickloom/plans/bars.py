"""Bar queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from tickloom.functions import times
from tickloom.operators import bars as B
from tickloom.operators import quotes as Q
from tickloom.plans.registry import query
from tickloom.plans.views import Tables

FROM, TO = "2024-01-05 00:00:00", "2024-01-20 00:00:00"


def _bucket(period: str) -> str:
    if period == "W1":
        return "date_trunc('week', ts)::timestamp"
    if period == "MN1":
        return "date_trunc('month', ts)::timestamp"
    return f"time_bucket(interval '{B.PERIOD_WINDOWS[period]}', ts)"


def bars_sql(period: str) -> str:
    return f"""
select symbolId, {_bucket(period)} as bar_time, arg_min(price, row(ts, event_id)) as open, max(price) as high,
       min(price) as low, arg_max(price, row(ts, event_id)) as close, count(*) as volume
from v_spot group by 1, 2"""


def _register(period: str) -> None:
    @query(f"bars_{period.lower()}", ("v_spot",), bars_sql(period))
    def plan(db: Tables):
        return B.bars_from_ticks(db.view("v_spot"), period)


for _period in B.PERIODS:
    _register(_period)


@query("bars_reaggregate", ("v_spot",), bars_sql("D1"))
def bars_reaggregate(db: Tables):
    return B.bars_from_bars(B.bars_from_ticks(db.view("v_spot"), "M30"), "D1")


@query("trendbar_roundtrip", ("v_spot",), f"""
with bars as ({bars_sql("H1")})
select symbolId, bar_time as Time, open / 100000.0::double as Open, high / 100000.0::double as High,
       low / 100000.0::double as Low, close / 100000.0::double as Close, volume as Volume from bars""")
def trendbar_roundtrip(db: Tables):
    bars = B.bars_from_ticks(db.view("v_spot"), "H1")
    return B.decode_bars(B.encode_bars(bars)).withColumn("Time", F.col("Time").cast("timestamp_ntz"))


@query("trendbar_encode", ("v_spot",), f"""
with bars as ({bars_sql("M15")})
select symbolId, volume, low, open - low as deltaOpen, close - low as deltaClose, high - low as deltaHigh,
       cast(epoch(bar_time) as bigint) // 60 as utcTimestampInMinutes from bars""")
def trendbar_encode(db: Tables):
    return B.encode_bars(B.bars_from_ticks(db.view("v_spot"), "M15"))


@query("bars_latest_n", ("v_spot",), f"""
with bars as ({bars_sql("H1")})
select *, cast(row_number() over (partition by symbolId order by bar_time desc) as integer) as row_no
from bars where bar_time between timestamp '{FROM}' and timestamp '{TO}' qualify row_no <= 5""")
def bars_latest_n(db: Tables):
    return B.trend_bars(db.view("v_spot"), "H1", F.expr(f"timestamp_ntz'{FROM}'"), F.expr(f"timestamp_ntz'{TO}'"), 5)


@query("ticks_page", ("v_spot",), f"""
with sides as (select symbolId, 'BID' as quoteType, ts, event_id, bid as tick from v_spot where bid > 0
               union all select symbolId, 'ASK', ts, event_id, ask from v_spot where ask > 0),
     numbered as (select *, row_number() over w as n, count(*) over (partition by symbolId, quoteType) as total
                  from sides where ts between timestamp '{FROM}' and timestamp '{TO}'
                  window w as (partition by symbolId, quoteType order by ts, event_id))
select symbolId, quoteType, cast(epoch(date_trunc('second', ts)) as bigint) * 1000 as timestamp, tick,
       cast(n as integer) as row_no, total > 10 as has_more from numbered where n <= 10""")
def ticks_page(db: Tables):
    page = Q.tick_data(db.view("v_spot"), F.expr(f"timestamp_ntz'{FROM}'"), F.expr(f"timestamp_ntz'{TO}'"), 10)
    return page.select(
        "symbolId", "quoteType", times.epoch_millis(F.col("ts")).alias("timestamp"), "tick", "row_no", "has_more"
    )


@query("next_bar_label", ("v_spot",), f"""
with bars as ({bars_sql("D1")}),
     labelled as (select *, cast(lead(case when close > open then 1 else 0 end)
                                 over (partition by symbolId order by bar_time) as integer) as label from bars)
select * from labelled where label is not null""")
def next_bar_label(db: Tables):
    return B.next_bar_label(B.bars_from_ticks(db.view("v_spot"), "D1"))
