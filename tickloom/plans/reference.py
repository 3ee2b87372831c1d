"""Reference-data queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from tickloom.functions import prices, text
from tickloom.operators import refdata as R
from tickloom.plans.registry import query
from tickloom.plans.views import Tables
from tickloom.schemas import FLAT_SYMBOL, LIGHT_SYMBOL, PAYLOAD_TYPES
from tickloom.sources import bronze
from tickloom.sources.readers import decode_envelopes

_SQL_TYPES = {"bigint": "bigint", "string": "varchar", "boolean": "boolean", "int": "integer", "double": "double"}
_JOINED = {
    "symbolId": "s.symbolId", "symbolName": "s.symbolName", "enabled": "s.enabled",
    "assetClassId": "c.assetClassId", "assetClass": "k.name", "symbolCategoryId": "s.symbolCategoryId",
    "symbolCategory": "c.name", "baseAssetId": "s.baseAssetId", "baseAsset": "b.name",
    "baseAssetDisplayName": "b.displayName", "quoteAssetId": "s.quoteAssetId", "quoteAsset": "q.name",
    "quoteAssetDisplayName": "q.displayName", "digits": "d.digits", "pipPosition": "d.pipPosition",
    "lotSize": "d.lotSize", "swapLong": "d.swapLong",
}
_FLAT = ", ".join(
    f"{_JOINED[name]} as {name}" if name in _JOINED else f"cast(null as {_SQL_TYPES[kind]}) as {name}"
    for name, kind in FLAT_SYMBOL
)
_DIMENSION_VIEWS = ("v_symbols", "v_categories", "v_asset_classes", "v_assets", "v_symbol_details")
DIMENSION_SQL = f"""
select {_FLAT} from v_symbols s left join v_categories c on c.id = s.symbolCategoryId
left join v_asset_classes k on k.id = c.assetClassId left join v_assets b on b.assetId = s.baseAssetId
left join v_assets q on q.assetId = s.quoteAssetId left join v_symbol_details d on d.symbolId = s.symbolId"""


def dimension(db: Tables):
    return R.symbol_dimension(
        db.view("v_symbols"), db.view("v_symbol_details"), db.view("v_assets"), db.view("v_asset_classes"),
        db.view("v_categories"),
    )


@query("symbol_dimension", _DIMENSION_VIEWS, DIMENSION_SQL)
def symbol_dimension(db: Tables):
    return R.flat_symbols(dimension(db))


@query("deposit_currency", ("v_traders", "v_assets"), """
select account, depositAssetId, a.name as depositCurrency, brokerName, balance / pow(10.0::double, moneyDigits) as funds
from v_traders left join v_assets a on a.assetId = depositAssetId""")
def deposit_currency(db: Tables):
    traders = R.deposit_currency(db.view("v_traders"), db.view("v_assets"))
    funds = prices.money(F.col("balance"), F.col("moneyDigits")).alias("funds")
    return traders.select("account", "depositAssetId", "depositCurrency", "brokerName", funds)


@query("detail_batches", (), """
select p_partkey as symbolId, cast((row_number() over (order by p_partkey) - 1) // 100 as bigint) as batch_no
from part""")
def detail_batches(db: Tables):
    return R.detail_batches(db.table("part").select(F.col("p_partkey").alias("symbolId")))


@query("detail_union", (), """
select symbolId, count(*) as details from (select p_partkey as symbolId from part
union all select s_suppkey from supplier union all select c_custkey from customer) group by 1""")
def detail_union(db: Tables):
    parts = [db.table(t).select(F.col(c).alias("symbolId"))
             for t, c in (("part", "p_partkey"), ("supplier", "s_suppkey"), ("customer", "c_custkey"))]
    return R.union_all(parts).groupBy("symbolId").agg(F.count(F.lit(1)).alias("details"))


@query("active_archived", ("v_symbols",), """
select symbolId, symbolName, case when enabled then enabled end as enabled, not enabled as archived from v_symbols""")
def active_archived(db: Tables):
    symbols = db.view("v_symbols")
    active = symbols.filter("enabled").select("symbolId", "symbolName", "enabled")
    archived = symbols.filter("not enabled").select("symbolId", F.col("symbolName").alias("name"))
    return R.active_and_archived(active, archived)


@query("tradable_symbols", ("v_symbols",), "select symbolId, symbolName from v_symbols where enabled")
def tradable_symbols(db: Tables):
    return R.tradable(db.view("v_symbols")).select("symbolId", "symbolName")


@query("symbols_by_id", ("v_symbols",), """
select symbolId, symbolName, enabled from v_symbols where symbolId in (select user_id from events)""")
def symbols_by_id(db: Tables):
    ids = db.table("events").select(F.col("user_id").alias("symbolId"))
    return R.symbols_by_id(db.view("v_symbols"), ids).select("symbolId", "symbolName", "enabled")


@query("reference_lists", ("v_symbols",), """
select 'assets' as list, count(*) as rows from nation union all select 'assetClasses', count(*) from region
union all select 'symbolCategories', count(*) from nation union all select 'symbols', count(*) from v_symbols
union all select 'symbolDetails', count(*) from supplier union all select 'traders', count(*) from customer""")
def reference_lists(db: Tables):
    views = {"assets": "v_assets", "assetClasses": "v_asset_classes", "symbolCategories": "v_categories",
             "symbols": "v_symbols", "symbolDetails": "v_symbol_details", "traders": "v_traders"}
    return R.list_sizes({name: db.view(view) for name, view in views.items()})


@query("conversion_path", ("v_symbols",), """
with recursive pairs as (select baseAssetId, quoteAssetId, min(symbolId) as symbolId from v_symbols
               where baseAssetId <> quoteAssetId group by 1, 2),
     walk(assetId, hops) as (select cast(3 as bigint), 0
       union select p.baseAssetId, hops + 1 from walk join pairs p on p.quoteAssetId = walk.assetId where hops < 60),
     dist as (select assetId, min(hops) as hops from walk group by assetId),
     step as (select d.assetId, d.hops, p.symbolId, p.quoteAssetId as toAssetId,
                     row_number() over (partition by d.assetId order by p.symbolId, p.quoteAssetId) as n
              from dist d join pairs p on p.baseAssetId = d.assetId
              join dist t on t.assetId = p.quoteAssetId and t.hops = d.hops - 1)
select assetId, cast(hops as integer) as hops, symbolId, toAssetId from step where n = 1
union all select cast(3 as bigint), 0, null, null""")
def conversion_path(db: Tables):
    return R.conversion_steps(db.view("v_symbols"), 3)


@query("conversion_chains", ("v_symbols", "v_assets"), """
with recursive pairs as (select baseAssetId, quoteAssetId, min(symbolId) as symbolId from v_symbols
               where baseAssetId <> quoteAssetId group by 1, 2),
     wanted as (select assetId as firstAssetId, (assetId * 7 + 3) % 25 as lastAssetId from v_assets),
     walk(target, assetId, hops) as (select distinct lastAssetId, lastAssetId, 0 from wanted
       union select w.target, p.baseAssetId, hops + 1 from walk w join pairs p on p.quoteAssetId = w.assetId where hops < 60),
     dist as (select target, assetId, min(hops) as hops from walk group by 1, 2),
     link as (select d.target, d.assetId, p.symbolId, p.quoteAssetId as toAssetId,
                     row_number() over (partition by d.target, d.assetId order by p.symbolId, p.quoteAssetId) as n
              from dist d join pairs p on p.baseAssetId = d.assetId
              join dist t on t.target = d.target and t.assetId = p.quoteAssetId and t.hops = d.hops - 1),
     chain as (select firstAssetId, lastAssetId, 1 as step, symbolId, assetId as fromAssetId, toAssetId
               from wanted join link on target = lastAssetId and assetId = firstAssetId and n = 1
               union all
               select c.firstAssetId, c.lastAssetId, c.step + 1, l.symbolId, l.assetId, l.toAssetId
               from chain c join link l on l.target = c.lastAssetId and l.assetId = c.toAssetId and l.n = 1)
select * from chain""")
def conversion_chains(db: Tables):
    """The symbols that convert each asset into another one, for all pairs at once."""
    wanted = db.view("v_assets").selectExpr("assetId as firstAssetId", "(assetId * 7 + 3) % 25 as lastAssetId")
    return R.conversion_chains(db.view("v_symbols"), wanted)


@query("message_json", ("v_symbols",), """
select cast(symbolId as varchar(20)) as clientMsgId, symbolId, symbolName, enabled, baseAssetId, quoteAssetId,
       symbolCategoryId, cast(null as varchar) as description from v_symbols""")
def message_json(db: Tables):
    """Records as JSON messages in envelopes, sorted out by payload type and decoded again."""
    light = db.view("v_symbols")
    envelopes = light.select(
        F.lit(PAYLOAD_TYPES["SYMBOLS_LIST_RES"]).alias("payloadType"),
        text.json_record(*light.columns).alias("payload"),
        F.col("symbolId").cast("string").alias("clientMsgId"),
    )
    noise = light.select(
        F.lit(PAYLOAD_TYPES["HEARTBEAT"]).alias("payloadType"),
        text.json_result(F.col("symbolName")).alias("payload"),
        F.lit(None).cast("string").alias("clientMsgId"),
    )
    return decode_envelopes(envelopes.unionByName(noise), PAYLOAD_TYPES["SYMBOLS_LIST_RES"], LIGHT_SYMBOL)


@query("contracts_explode", ("v_spot",), """
select symbolId, symbolId || '/' || event_type as contractSymbol, arg_max(price, row(ts, event_id)) as lastPrice
from v_spot group by symbolId, event_type having arg_max(price, row(ts, event_id)) >= 100000""")
def contracts_explode(db: Tables):
    """Contract lists per underlying, one row per contract, with the snapshots whose call succeeded."""
    ticks = db.view("v_spot").withColumn("contractSymbol", F.concat_ws("/", "symbolId", "event_type"))
    listed = (
        ticks.groupBy("symbolId", "contractSymbol").agg(F.lit(1).alias("one"))
        .groupBy("symbolId")
        .agg(F.to_json(F.struct(F.collect_list(F.struct(F.col("contractSymbol").alias("symbol"))).alias("contracts")))
             .alias("json_raw"))
    )
    last = ticks.groupBy("contractSymbol").agg(F.max_by("price", F.struct("ts", "event_id")).alias("lastPrice"))
    snapshots = last.select(
        "contractSymbol",
        F.when(F.col("lastPrice") >= 100000, text.json_record("lastPrice")).otherwise("{}").alias("json_raw"),
    )
    contracts = bronze.explode_contracts(bronze.usable_payloads(listed), ["symbolId"])
    found = bronze.contract_snapshots(contracts, snapshots)
    price = F.from_json("json_raw", "lastPrice BIGINT")["lastPrice"]
    return found.select("symbolId", "contractSymbol", price.alias("lastPrice"))
