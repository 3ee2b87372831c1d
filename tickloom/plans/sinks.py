"""Landing and sink queries: each writes the whole table and reads it back."""

from __future__ import annotations

from pyspark.sql import functions as F

from tickloom.functions import text, times
from tickloom.operators import bars as B
from tickloom.operators import quotes as Q
from tickloom.plans import reference
from tickloom.plans.bars import bars_sql
from tickloom.plans.registry import query
from tickloom.plans.scratch import scratch_database
from tickloom.plans.views import Tables
from tickloom.schemas import FLAT_SYMBOL
from tickloom.session import workspace
from tickloom.sources import bronze, readers, writers

_FLAT = ", ".join(f"{name} {kind}" for name, kind in FLAT_SYMBOL)
ISO_DAY = "strftime(bar_time, '%Y-%m-%dT%H:%M:%S') || '+00:00'"


@query("bronze_land_parse", ("v_spot",), f"""
with bars as ({bars_sql("D1")})
select 'S' || symbolId as symbol, {ISO_DAY} as t, strftime(bar_time, '%Y-%m-%d') as day, open / 100000.0::double as o,
       high / 100000.0::double as h, low / 100000.0::double as l, close / 100000.0::double as c, volume::double as v
from bars where volume > 1""")
def bronze_land_parse(db: Tables):
    """Bar payloads, where a failed call left an empty one, landed in a table, read back and parsed."""
    daily = B.bars_from_ticks(db.view("v_spot"), "D1")
    bar = F.struct(
        times.iso_utc(F.col("bar_time")).alias("t"),
        *[(F.col(c) / F.lit(100000.0)).alias(c[0]) for c in ("open", "high", "low", "close")],
        F.col("volume").alias("v"),
    )
    symbol = text.strip_usd(F.concat(F.lit("S"), F.col("symbolId"), F.lit("/USD")))
    payload = F.to_json(F.struct(F.create_map(symbol, F.array(bar)).alias("bars")))
    payloads = daily.select(F.when(F.col("volume") > 1, payload).otherwise("{}").alias("json_raw"))
    table = f"{scratch_database(db.spark)}.bars_bronze"
    bronze.run_batch({table: payloads})
    parsed = bronze.parse_bars(db.spark.table(table))
    return parsed.withColumn("day", times.day_text(times.parse_iso(F.col("t"))))


@query("sink_guard", ("v_spot",), "select symbolId, count(*) as rows from v_spot group by 1")
def sink_guard(db: Tables):
    """An empty overwrite leaves the table as it was."""
    table = f"{scratch_database(db.spark)}.guarded"
    rows = db.view("v_spot").select("symbolId", "event_id")
    writers.write_table(rows, table, "overwrite")
    writers.write_table(rows.filter(F.lit(False)), table, "overwrite")
    return db.spark.table(table).groupBy("symbolId").agg(F.count(F.lit(1)).alias("rows"))


@query("sink_append", ("v_spot",), "select symbolId, 2 * count(*) as rows from v_spot group by 1")
def sink_append(db: Tables):
    """A full load and an incremental one over the same rows: the overlap stays."""
    table = f"{scratch_database(db.spark)}.landed"
    payloads = db.view("v_spot").select(text.json_record("symbolId").alias("json_raw"))
    bronze.run_batch({table: payloads})
    bronze.run_incremental({table: payloads})
    symbol = F.get_json_object("json_raw", "$.symbolId").cast("bigint").alias("symbolId")
    return db.spark.table(table).groupBy(symbol).agg(F.count(F.lit(1)).alias("rows"))


@query("sink_json", reference._DIMENSION_VIEWS, reference.DIMENSION_SQL)
def sink_json(db: Tables):
    path = workspace(db.spark, "json")
    writers.write_json(reference.symbol_dimension(db), path)
    return db.spark.read.schema(_FLAT).json(path)


@query("sink_csv34", reference._DIMENSION_VIEWS, reference.DIMENSION_SQL)
def sink_csv34(db: Tables):
    path = workspace(db.spark, "csv")
    writers.write_flat_csv(reference.dimension(db), path)
    return db.spark.read.schema(_FLAT).option("header", True).csv(path)


@query("sink_document", ("v_symbols", "v_symbol_details", "v_assets", "v_categories"), """
select 'document' as section, count(*) as records, 'depositCurrency' as field from region
union all select 'assets', count(*), 'assetId' from v_assets
union all select 'symbolCategories', count(*), 'assetClassId' from v_categories
union all select 'symbolDetails', count(*), 'pipPosition' from v_symbol_details
union all select 'lightSymbols', count(*), 'symbolName' from v_symbols""")
def sink_document(db: Tables):
    """The metadata document as pretty-printed JSON, one folder per section; read back whole."""
    path = workspace(db.spark, "document")
    header = db.table("region").select(
        F.col("r_regionkey").cast("bigint").alias("ctidTraderAccountId"), F.col("r_name").alias("depositCurrency")
    )
    writers.write_document(header, {
        "assets": db.view("v_assets"), "symbolCategories": db.view("v_categories"),
        "symbolDetails": db.view("v_symbol_details"), "lightSymbols": db.view("v_symbols"),
    }, path)
    marks = F.create_map(*[F.lit(x) for x in (
        "document", "depositCurrency", "assets", "assetId", "symbolCategories", "assetClassId",
        "symbolDetails", "pipPosition", "lightSymbols", "symbolName",
    )])
    lines = db.spark.read.text(path).withColumn("field", marks[F.col("section")])
    hits = lines.filter(F.col("value").contains(F.concat(F.lit('"'), F.col("field"), F.lit('" :'))))
    return hits.groupBy("section", "field").agg(F.count(F.lit(1)).alias("records"))


_DOCUMENT_VIEWS = (*reference._DIMENSION_VIEWS, "v_traders")


@query("document_contents", _DOCUMENT_VIEWS, f"""
with joined as ({reference.DIMENSION_SQL})
select 'document' as section, r_regionkey::bigint as id, r_name as name, null::bigint as number from region
union all select 'assets', assetId, name, null from v_assets
union all select 'assetClasses', id, name, null from v_asset_classes
union all select 'symbolCategories', id, name, assetClassId from v_categories
union all select 'trader', account, brokerName, balance from v_traders
union all select 'symbols', symbolId, symbolName, pipPosition from joined
union all select 'archivedSymbols', symbolId, symbolName, null from v_symbols where not enabled""")
def document_contents(db: Tables):
    """All sections of the metadata document, the joined symbols among them, written and read back record by record."""
    path = workspace(db.spark, "document")
    header = db.table("region").select(
        F.col("r_regionkey").cast("bigint").alias("ctidTraderAccountId"), F.col("r_name").alias("depositCurrency"))
    archived = db.view("v_symbols").filter("not enabled").select("symbolId", F.col("symbolName").alias("name"))
    writers.write_document(header, {
        "assets": db.view("v_assets"), "assetClasses": db.view("v_asset_classes"), "symbolCategories": db.view("v_categories"),
        "trader": db.view("v_traders"), "symbols": reference.symbol_dimension(db), "archivedSymbols": archived,
    }, path)
    fields = {  # section: id, name and number of a record
        "document": ("ctidTraderAccountId", "depositCurrency", None), "assets": ("assetId", "name", None),
        "assetClasses": ("id", "name", None), "symbolCategories": ("id", "name", "assetClassId"),
        "trader": ("account", "brokerName", "balance"), "symbols": ("symbolId", "symbolName", "pipPosition"),
        "archivedSymbols": ("symbolId", "name", None),
    }

    def field(at: int, kind: str):
        paths = {name: f"$.{names[at]}" for name, names in fields.items() if names[at]}
        found = F.coalesce(*[
            F.when(F.col("section") == name, F.get_json_object("json", path)) for name, path in paths.items()])
        return found.cast(kind)

    return readers.read_document(db.spark, path).select(
        "section", field(0, "bigint").alias("id"), field(1, "string").alias("name"), field(2, "bigint").alias("number"))


@query("landed_accounts", ("v_accounts",), """
select account as ctidTraderAccountId, isLive, account * 10 as traderLogin from v_accounts""")
def landed_accounts(db: Tables):
    """Account payloads, one JSON document of at most a thousand accounts per file, read with their schema."""
    path = workspace(db.spark, "accounts")
    one = F.struct(F.col("account").alias("ctidTraderAccountId"), "isLive", (F.col("account") * 10).alias("traderLogin"))
    documents = db.view("v_accounts").groupBy(F.floor(F.col("account") / 1000).alias("part")).agg(
        F.to_json(F.struct(F.collect_list(one).alias("data"))).alias("value"))
    documents.repartition("part").write.partitionBy("part").text(path)
    return readers.read_accounts(db.spark, f"{path}/*").select("ctidTraderAccountId", "isLive", "traderLogin")


@query("landed_lists", ("v_assets", "v_symbols"), """
select 'assets' as list, assetId as id, name from v_assets union all select 'lightSymbols', symbolId, symbolName from v_symbols""")
def landed_lists(db: Tables):
    """Reference lists as landed messages, each read with the schema of its list."""
    path = workspace(db.spark, "lists")
    for name, view in (("assets", "v_assets"), ("lightSymbols", "v_symbols")):
        writers.write_json(db.view(view), f"{path}/{name}")
    assets = readers.read_reference_list(db.spark, f"{path}/assets", "assets")
    symbols = readers.read_reference_list(db.spark, f"{path}/lightSymbols", "lightSymbols")
    return assets.select(F.lit("assets").alias("list"), F.col("assetId").alias("id"), "name").unionByName(
        symbols.select(F.lit("lightSymbols").alias("list"), F.col("symbolId").alias("id"), F.col("symbolName").alias("name")))


@query("landed_payloads", ("v_spot",), f"""
with bars as ({bars_sql("D1")})
select 'S' || symbolId as symbol, {ISO_DAY} as t, volume::double as v from bars""")
def landed_payloads(db: Tables):
    """Payload files, one JSON document of a symbol's bars each, read as bronze rows and parsed."""
    path = workspace(db.spark, "payloads")
    bar = F.struct(times.iso_utc(F.col("bar_time")).alias("t"), F.col("volume").cast("double").alias("v"))
    symbol = F.concat(F.lit("S"), F.col("symbolId"))
    documents = B.bars_from_ticks(db.view("v_spot"), "D1").groupBy("symbolId").agg(
        F.to_json(F.struct(F.map_from_arrays(F.array(symbol), F.array(F.collect_list(bar))).alias("bars"))).alias("value"))
    documents.repartition("symbolId").write.partitionBy("symbolId").text(path)
    return bronze.parse_bars(readers.read_payload_files(db.spark, f"{path}/*")).select("symbol", "t", "v")


@query("retention", (), """
select cast(ts as date) as day, count(*) as ticks from events
where cast(ts as date) >= (select cast(max(ts) - interval 1 day as date) from events) group by 1""")
def retention(db: Tables):
    """Hot table by day with the days beyond the one-day retention dropped."""
    table = f"{scratch_database(db.spark)}.hot"
    ticks = db.view("v_spot")
    writers.hot_rows(ticks, "ts").write.partitionBy("day").saveAsTable(table)
    writers.expire_days(db.spark, table, Q.latest_time(ticks), keep_days=1)
    return db.spark.table(table).groupBy("day").agg(F.count(F.lit(1)).alias("ticks"))
