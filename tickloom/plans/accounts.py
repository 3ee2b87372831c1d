"""Account queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from tickloom.functions import prices, text
from tickloom.operators import accounts as A
from tickloom.operators import quotes as Q
from tickloom.operators.latest import latest_per_key, page_after
from tickloom.plans.registry import query
from tickloom.plans.views import Tables

FROM, TO = "1996-01-01 00:00:00", "2000-12-31 00:00:00"
_DEALS = "executedAt, orderId, lineNo, symbolId, account, amountCents"


def _bounds():
    return F.expr(f"timestamp_ntz'{FROM}'"), F.expr(f"timestamp_ntz'{TO}'")


@query("deals_page", ("v_deals",), f"""
with numbered as (select *, row_number() over (partition by account order by {_DEALS}) as n,
                         count(*) over (partition by account) as total
                  from v_deals where executedAt between timestamp '{FROM}' and timestamp '{TO}')
select account, executedAt, orderId, lineNo, symbolId, amountCents, cast(n as integer) as row_no,
       total > 25 as has_more from numbered where n <= 25""")
def deals_page(db: Tables):
    page = A.deals_page(db.view("v_deals"), 25, *_bounds())
    return page.select(
        "account", "executedAt", "orderId", "lineNo", "symbolId", "amountCents", "row_no", "has_more"
    )


@query("deals_next_page", ("v_deals",), f"""
with after as (select *, row_number() over (order by {_DEALS}) as n, count(*) over () as total from v_deals
               where ({_DEALS}) > (timestamp '1997-06-01 00:00:00', 5000, 0, 0, 0, 0))
select account, executedAt, orderId, lineNo, symbolId, amountCents, cast(n as integer) as row_no,
       total > 200 as has_more from after where n <= 200""")
def deals_next_page(db: Tables):
    page = page_after(
        db.view("v_deals"), list(A.DEAL_ORDER), ("1997-06-01 00:00:00", 5000, 0, 0, 0, 0), 200
    )
    return page.select(
        "account", "executedAt", "orderId", "lineNo", "symbolId", "amountCents", "row_no", "has_more"
    )


@query("orders_page", ("v_orders",), f"""
with numbered as (select *, row_number() over (partition by positionId order by createdAt, orderId) as n,
                         count(*) over (partition by positionId) as total
                  from v_orders where createdAt between timestamp '{FROM}' and timestamp '{TO}')
select positionId, createdAt, orderId, orderStatus, cast(n as integer) as row_no, total > 3 as has_more
from numbered where n <= 3""")
def orders_page(db: Tables):
    page = A.orders_page(db.view("v_orders"), 3, *_bounds())
    return page.select("positionId", "createdAt", "orderId", "orderStatus", "row_no", "has_more")


@query("deals_by_position", ("v_deals", "v_orders"), f"""
select positionId, orderId, lineNo, executedAt, symbolId, volume, tradeSide from v_deals join v_orders using (orderId)
where executedAt between timestamp '{FROM}' and timestamp '{TO}'""")
def deals_by_position(db: Tables):
    return A.deals_by_position(db.view("v_deals"), db.view("v_orders"), *_bounds()).select(
        "positionId", "orderId", "lineNo", "executedAt", "symbolId", "volume", "tradeSide"
    )


@query("deals_by_position_page", ("v_deals", "v_orders"), f"""
with theirs as (select d.*, o.positionId from v_deals d join v_orders o on d.orderId = o.orderId
                where executedAt between timestamp '{FROM}' and timestamp '{TO}'),
     numbered as (select *, row_number() over (partition by positionId order by {_DEALS}) as n,
                         count(*) over (partition by positionId) as total from theirs)
select positionId, orderId, lineNo, executedAt, cast(n as integer) as row_no, total > 10 as has_more from numbered where n <= 10""")
def deals_by_position_page(db: Tables):
    page = A.deals_by_position_page(db.view("v_deals"), db.view("v_orders"), 10, *_bounds())
    return page.select("positionId", "orderId", "lineNo", "executedAt", "row_no", "has_more")


@query("account_orders_page", ("v_account_orders",), f"""
with numbered as (select *, row_number() over (partition by account order by createdAt, orderId) as n,
                         count(*) over (partition by account) as total
                  from v_account_orders where createdAt between timestamp '{FROM}' and timestamp '{TO}')
select account, createdAt, orderId, positionId, cast(n as integer) as row_no, total > 500 as has_more from numbered where n <= 500""")
def account_orders_page(db: Tables):
    """Orders of each account, a large page."""
    page = A.orders_page(db.view("v_account_orders"), 500, *_bounds(), keys=["account"])
    return page.select("account", "createdAt", "orderId", "positionId", "row_no", "has_more")


@query("orders_by_position", ("v_orders",), f"""
with numbered as (select *, row_number() over (partition by positionId order by createdAt, orderId) as n,
                         count(*) over (partition by positionId) as total
                  from v_orders where createdAt >= timestamp '{FROM}')
select positionId, createdAt, orderId, amountCents, cast(n as integer) as row_no, total > 5 as has_more
from numbered where n <= 5""")
def orders_by_position(db: Tables):
    page = A.orders_page(db.view("v_orders"), 5, _bounds()[0])
    return page.select("positionId", "createdAt", "orderId", "amountCents", "row_no", "has_more")


@query("order_details", ("v_orders", "v_deals"), """
select o.orderId, o.positionId, o.orderStatus, d.lineNo, d.symbolId, d.volume, d.dealStatus
from v_orders o left join v_deals d on d.orderId = o.orderId""")
def order_details(db: Tables):
    deals = db.view("v_deals").select("orderId", "lineNo", "symbolId", "volume", "dealStatus")
    return A.order_details(db.view("v_orders"), deals).select(
        "orderId", "positionId", "orderStatus", "lineNo", "symbolId", "volume", "dealStatus"
    )


@query("deal_offsets", ("v_deals",), f"""
with opening as (select * from v_deals where tradeSide = 'BUY'
                 qualify row_number() over (partition by orderId order by {_DEALS}) = 1),
     links as (select c.orderId, o.lineNo as oLine, o.executedAt as oAt, o.symbolId as oSymbol, c.lineNo as cLine,
                      c.executedAt as cAt, c.symbolId as cSymbol, c.volume
               from v_deals c join opening o on o.orderId = c.orderId where c.tradeSide = 'SELL')
select 'offsetBy' as direction, orderId, oLine as lineNo, oAt as executedAt, cLine as otherLineNo,
       cSymbol as otherSymbolId, cAt as otherExecutedAt, volume from links
union all select 'offsetting', orderId, cLine, cAt, oLine, oSymbol, oAt, volume from links""")
def deal_offsets(db: Tables):
    return A.deal_offsets(A.closing_links(db.view("v_deals")))


@query("deal_status", ("v_deals",), """
select dealStatus, tradeSide, count(*) as deals from v_deals where dealStatus in ('PARTIALLY_FILLED', 'REJECTED')
group by 1, 2""")
def deal_status(db: Tables):
    open_deals = A.with_status(db.view("v_deals"), "dealStatus", "PARTIALLY_FILLED", "REJECTED")
    return open_deals.groupBy("dealStatus", "tradeSide").agg(F.count(F.lit(1)).alias("deals"))


@query("accounts_filter", ("v_accounts", "v_deals"), """
select account, traderLogin, isLive, max(executedAt) as lastClosingDeal
from v_accounts left join (select account, executedAt from v_deals where tradeSide = 'SELL') using (account)
where isLive group by 1, 2, 3""")
def accounts_filter(db: Tables):
    closing = db.view("v_deals").filter("tradeSide = 'SELL'")
    return A.accounts(db.view("v_accounts"), closing, live_only=True).select(
        "account", "traderLogin", "isLive", "lastClosingDeal"
    )


LATEST_STATE = """
select positionId, orderId, createdAt, orderStatus, amountCents from v_orders
qualify row_number() over (partition by positionId order by createdAt desc, orderId desc) = 1"""


@query("latest_state", ("v_orders",), LATEST_STATE)
def latest_state(db: Tables):
    return A.latest_state(db.view("v_orders"), ["positionId"], ["createdAt", "orderId"])


@query("reconcile_open", ("v_orders",), f"""
with latest as ({LATEST_STATE})
select 'position' as kind, orderId, positionId, createdAt, amountCents, orderStatus from latest
where orderStatus = 'ORDER_STATUS_FILLED'
union all select 'order', orderId, positionId, createdAt, amountCents, orderStatus from v_orders
where orderStatus = 'ORDER_STATUS_ACCEPTED'""")
def reconcile_open(db: Tables):
    return A.reconcile(db.view("v_orders"))


@query("realised_pnl", ("v_closed",), """
select account, closedOn, sum(grossProfit)::bigint as grossProfit, sum(swap)::bigint as swap,
       sum(commission)::bigint as commission, sum(pnlConversionFee)::bigint as pnlConversionFee, count(*) as deals,
       sum(grossProfit + swap + commission - pnlConversionFee)::bigint as netProfit
from v_closed group by 1, 2""")
def realised_pnl(db: Tables):
    return A.realised_pnl(db.view("v_closed"), ["account", "closedOn"])


@query("realised_pnl_by_symbol", ("v_closed",), """
select symbolId, sum(grossProfit)::bigint as grossProfit, sum(swap)::bigint as swap,
       sum(commission)::bigint as commission, sum(pnlConversionFee)::bigint as pnlConversionFee, count(*) as deals,
       sum(grossProfit + swap + commission - pnlConversionFee)::bigint as netProfit
from v_closed group by 1""")
def realised_pnl_by_symbol(db: Tables):
    return A.realised_pnl(db.view("v_closed"), ["symbolId"])


@query("exposure", ("v_deals",), """
select symbolId, sum(case when tradeSide = 'BUY' then volume else 0 end)::bigint as buyVolume,
       sum(case when tradeSide = 'SELL' then volume else 0 end)::bigint as sellVolume,
       sum(case when tradeSide = 'BUY' then volume else -volume end)::bigint as netVolume
from v_deals group by 1""")
def exposure(db: Tables):
    return A.exposure(db.view("v_deals"))


@query("fill_ratio", ("v_deals",), """
select account, tradeSide, sum(volume)::bigint as volume, sum(filledVolume)::bigint as filledVolume,
       sum(filledVolume)::double / sum(volume)::double as fillRatio from v_deals group by 1, 2""")
def fill_ratio(db: Tables):
    return A.fill_ratio(db.view("v_deals"), ["account", "tradeSide"])


@query("cash_flow_totals", ("v_cash_flow",), """
select operationType, count(*) as operations, sum(delta)::bigint as delta from v_cash_flow group by 1""")
def cash_flow_totals(db: Tables):
    return A.cash_flow_totals(db.view("v_cash_flow"))


@query("cash_flow_history", ("v_cash_flow",), f"""
with running as (select *, (sum(delta) over w)::bigint as balance, row_number() over w as balanceVersion
                 from v_cash_flow window w as (partition by account order by changedAt, balanceHistoryId
                                               rows between unbounded preceding and current row))
select balanceHistoryId, account, changedAt, operationType, delta, balance, balanceVersion from running
where changedAt between timestamp '{FROM}' and timestamp '{TO}'""")
def cash_flow_history(db: Tables):
    return A.cash_flow_history(db.view("v_cash_flow"), *_bounds())


@query("unrealised_pnl_asof", ("v_positions", "v_firm"), """
select p.positionId, p.symbolId, p.ts, p.tradeSide, p.volume, p.entry_raw, f.bid, f.ask,
       case when p.tradeSide = 'BUY' then (f.bid - p.entry_raw) * p.volume else -((f.ask - p.entry_raw) * p.volume) end
       as grossUnrealizedPnL
from v_positions p asof left join v_firm f on p.symbolId = f.symbolId and p.ts >= f.ts""")
def unrealised_pnl_asof(db: Tables):
    priced = Q.quotes_as_of(db.view("v_positions"), db.view("v_firm"), ("bid", "ask"))
    return A.unrealised_pnl(priced)


@query("unrealised_pnl_latest", ("v_positions", "v_firm"), """
with latest as (select symbolId, arg_max(bid, row(ts, event_id)) as bid, arg_max(ask, row(ts, event_id)) as ask
                from v_firm group by 1)
select positionId, symbolId, tradeSide, volume, entry_raw, bid, ask,
       case when tradeSide = 'BUY' then (bid - entry_raw) * volume else -((ask - entry_raw) * volume) end
       as grossUnrealizedPnL
from v_positions left join latest using (symbolId)""")
def unrealised_pnl_latest(db: Tables):
    return A.unrealised_pnl(Q.at_latest_quote(db.view("v_positions").drop("ts"), db.view("v_firm")))


@query("account_snapshot", ("v_open", "v_firm", "v_balances"), """
with latest as (select symbolId, arg_max(bid, row(ts, event_id)) as bid, arg_max(ask, row(ts, event_id)) as ask
                from v_firm group by 1),
     priced as (select account, case when tradeSide = 'BUY' then (bid - entry_raw) * volume
                                     else -((ask - entry_raw) * volume) end as pnl,
                       case when tradeSide = 'BUY' then bid else ask end * volume as notional, volume
                from v_open left join latest using (symbolId)),
     sums as (select account, sum(pnl)::bigint as pnl, (sum(notional)::hugeint // 100)::bigint as margin,
                     count(*) filter (notional is null) as n, sum(volume) filter (notional is null) as v
              from priced group by 1)
select account, balance, coalesce(pnl, 0) as unrealizedPnL, coalesce(margin, 0) as usedMargin,
       coalesce(n, 0) as unpricedPositions, coalesce(v, 0)::bigint as unpricedVolume,
       balance + coalesce(pnl, 0) as equity,
       (balance + coalesce(pnl, 0)) * 100 / nullif(coalesce(margin, 0), 0) as marginLevel
from v_balances left join sums using (account)""")
def account_snapshot(db: Tables):
    latest = latest_per_key(db.view("v_firm"), ["symbolId"], ["ts", "event_id"])
    return A.account_snapshot(db.view("v_open"), latest, db.view("v_balances"))


_LADDERS = """(values (1, 0, 1000, 500), (1, 1000, 3000, 200), (1, 3000, 9000000000, 100), (2, 0, 2000, 100),
               (2, 2000, 9000000000, 50)) as t(leverageId, lo, hi, leverage)"""


@query("leverage_tier", ("v_deals",), f"""
select orderId, lineNo, symbolId, account, amountCents, volume, cast(leverage as bigint) as leverage
from v_deals join {_LADDERS} on leverageId = 1 + symbolId % 2 and volume >= lo and volume < hi""")
def leverage_tier(db: Tables):
    deals = db.view("v_deals").withColumn("leverageId", 1 + F.col("symbolId") % 2)
    return A.leverage_tier(deals, db.ladders()).select(
        "orderId", "lineNo", "symbolId", "account", "amountCents", "volume", "leverage"
    )


@query("expected_margin", ("v_firm",), f"""
with latest as (select symbolId, arg_max(bid, row(ts, event_id)) as bid, arg_max(ask, row(ts, event_id)) as ask
                from v_firm group by 1),
     asked as (select * from latest, (values (500), (1500), (5000)) as x(volume))
select symbolId, cast(volume as bigint) as volume, cast(leverage as bigint) as leverage,
       floor(volume * ask / leverage)::bigint as buyMargin, floor(volume * bid / leverage)::bigint as sellMargin
from asked join {_LADDERS} on leverageId = 1 + symbolId % 2 and volume >= lo and volume < hi""")
def expected_margin(db: Tables):
    latest = latest_per_key(db.view("v_firm"), ["symbolId"], ["ts", "event_id"])
    symbols = latest.withColumn("leverageId", 1 + F.col("symbolId") % 2)
    return A.expected_margin(symbols, [500, 1500, 5000], db.ladders()).select(
        "symbolId", "volume", "leverage", "buyMargin", "sellMargin"
    )


@query("order_columns", ("v_order_forms",), """
select orderId, case upper(orderType) when 'MARKET' then 1 when 'LIMIT' then 2 else 3 end as orderTypeNo,
       case upper(tradeSide) when 'BUY' then 1 else 2 end as tradeSideNo, cast(volume as bigint) * 100 as volume,
       case when upper(orderType) = 'LIMIT' then price end as limitPrice,
       case when upper(orderType) = 'STOP' then price end as stopPrice from v_order_forms""")
def order_columns(db: Tables):
    kind, price = F.col("orderType"), F.col("price")
    return db.view("v_order_forms").select(
        "orderId",
        text.enum_number("orderType", kind, any_case=True).alias("orderTypeNo"),
        text.enum_number("tradeSide", F.col("tradeSide"), any_case=True).alias("tradeSideNo"),
        prices.units(F.col("volume")).alias("volume"),
        prices.limit_price(kind, price).alias("limitPrice"),
        prices.stop_price(kind, price).alias("stopPrice"),
    )
