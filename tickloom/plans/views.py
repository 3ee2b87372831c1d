"""Domain views over the given tables, as expressions that Spark and the SQL counterpart both accept."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class View:
    table: str
    columns: tuple[str, ...]
    where: str | None = None

    def sql(self) -> str:
        where = f" where {self.where}" if self.where else ""
        return f"select {', '.join(self.columns)} from {self.table}{where}"


_MID = "cast(round(value * 100) as bigint) * 1000"
_CENTS = "cast(round(l_extendedprice * 100) as bigint)"
_VOLUME = "cast(round(l_quantity * 100) as bigint)"

VIEWS = {
    "v_spot": View("events", (
        "event_id", "ts", "user_id as symbolId", "event_type", f"{_MID} as price",
        f"case when event_id % 3 = 0 then 0 else {_MID} end as bid",
        f"case when event_id % 5 = 0 then 0 else {_MID} + 10 * (1 + event_id % 7) end as ask",
    )),
    "v_firm": View("events", (
        "event_id", "ts", "user_id as symbolId", f"{_MID} as bid", f"{_MID} + 10 * (1 + event_id % 7) as ask",
    ), "event_type <> 'purchase'"),
    "v_positions": View("events", (
        "event_id as positionId", "ts + interval 1 hour as ts", "user_id as symbolId", f"{_MID} as entry_raw",
        "case when event_id % 2 = 0 then 'BUY' else 'SELL' end as tradeSide", "100 * (1 + event_id % 5) as volume",
    ), "event_type = 'purchase'"),
    "v_messages": View("events", (
        "event_id", "ts",
        "case event_type when 'view' then 2131 when 'click' then 51 when 'signup' then 2103 "
        "when 'error' then 2142 else 2126 end as payloadType",
        "case when value < 5 then null else concat('CODE_', cast(event_id % 10 as varchar(20))) end as errorCode",
        "case when value > 60 then null else concat('reason ', cast(user_id as varchar(20))) end as description",
    )),
    "v_symbols": View("customer", (
        "c_custkey as symbolId", "c_name as symbolName", "c_acctbal >= 0 as enabled",
        "c_custkey % 30 as baseAssetId", "(c_custkey * 7) % 25 as quoteAssetId",
        "cast(c_nationkey as bigint) as symbolCategoryId",
    )),
    "v_enabled": View("customer", ("c_custkey as symbolId", "c_name as symbolName"), "c_acctbal >= 0"),
    "v_categories": View("nation", (
        "cast(n_nationkey as bigint) as id", "cast(n_regionkey as bigint) as assetClassId", "n_name as name",
    )),
    "v_asset_classes": View("region", ("cast(r_regionkey as bigint) as id", "r_name as name")),
    "v_assets": View("nation", (
        "cast(n_nationkey as bigint) as assetId", "n_name as name", "lower(n_name) as displayName",
    )),
    "v_symbol_details": View("supplier", (
        "s_suppkey as symbolId", "5 as digits", "4 as pipPosition", "cast(10000000 as bigint) as lotSize",
        "s_acctbal as swapLong",
    )),
    "v_traders": View("customer", (
        "c_custkey as account", "c_custkey % 30 as depositAssetId", "c_name as brokerName",
        "cast(round(c_acctbal * 100) as bigint) as balance", "2 as moneyDigits",
    )),
    "v_balances": View("supplier", (
        "s_suppkey as account", "cast(round(s_acctbal * 100) as bigint) * 1000000 as balance",
    )),
    "v_accounts": View("customer", (
        "c_custkey as account", "c_name as traderLogin", "c_acctbal >= 0 as isLive",
    )),
    "v_orders": View("orders", (
        "o_orderkey as orderId", "o_custkey as positionId", "o_orderdate as createdAt",
        "cast(round(o_totalprice * 100) as bigint) as amountCents",
        "case o_orderstatus when 'F' then 'ORDER_STATUS_FILLED' when 'O' then 'ORDER_STATUS_ACCEPTED' "
        "else 'ORDER_STATUS_CANCELLED' end as orderStatus",
    )),
    "v_order_forms": View("orders", (
        "o_orderkey as orderId",
        "case substring(o_orderpriority, 1, 1) when '1' then 'market' when '2' then 'Limit' when '3' then 'stop' "
        "when '4' then 'LIMIT' else 'STOP' end as orderType",
        "case when o_orderstatus = 'F' then 'buy' else 'Sell' end as tradeSide",
        "cast(cast(floor(o_totalprice / 1000) as bigint) as varchar(20)) as volume", "o_totalprice as price",
    )),
    "v_deals": View("lineitem", (
        "l_orderkey as orderId", "l_linenumber as lineNo", "l_suppkey as account", "l_partkey as symbolId",
        f"{_VOLUME} as volume", f"{_CENTS} as amountCents",
        f"case when l_linestatus = 'F' then {_VOLUME} else cast(floor({_VOLUME} / 2) as bigint) end as filledVolume",
        "case when l_returnflag = 'R' then 'SELL' else 'BUY' end as tradeSide",
        "case when l_linestatus = 'F' then 'FILLED' else 'PARTIALLY_FILLED' end as dealStatus",
        "l_shipdate as executedAt",
    )),
    "v_closed": View("lineitem", (
        "l_suppkey as account", "cast(l_shipdate as date) as closedOn", "l_partkey as symbolId",
        f"case when l_returnflag = 'R' then -1 else 1 end * {_CENTS} as grossProfit",
        "-cast(round(l_tax * 1000) as bigint) as swap",
        "-cast(round(l_extendedprice * l_discount) as bigint) as commission",
        "cast(round(l_tax * l_extendedprice) as bigint) as pnlConversionFee",
    ), "l_linestatus = 'F'"),
    "v_open": View("lineitem", (
        "l_suppkey as account", "l_partkey as symbolId",
        "case when l_returnflag = 'R' then 'SELL' else 'BUY' end as tradeSide", f"{_VOLUME} as volume",
        f"cast(floor(cast({_CENTS} as double) * 1000 / {_VOLUME}) as bigint) as entry_raw",
    ), "l_linestatus = 'O'"),
    "v_cash_flow": View("orders", (
        "o_orderkey as balanceHistoryId", "o_custkey as account", "o_orderdate as changedAt",
        "case when o_orderstatus = 'F' then 'BALANCE_DEPOSIT' else 'BALANCE_WITHDRAW' end as operationType",
        "case when o_orderstatus = 'F' then 1 else -1 end * cast(round(o_totalprice * 100) as bigint) as delta",
    )),
    "v_depth": View("events", (
        "event_id", "ts", "user_id as symbolId", "event_id % 40 as quoteId",
        "case when event_type = 'error' then 'D' else 'N' end as action",
        "cast(round(value * 100) as bigint) as size",
    )),
    "v_wire": View("events", (
        "event_id", "ts", "user_id as symbolId", "event_type <> 'error' as adds", f"{_MID} as price",
        "cast(round(value * 100) as bigint) as size",
    )),
    "v_hours": View("customer", (
        "c_custkey as symbolId",
        "case c_custkey % 4 when 0 then 'America/New_York' when 1 then 'Europe/Berlin' when 2 then 'Asia/Tokyo' end as zone",
        "86400 * (c_custkey % 5) + 30600 as firstStart", "86400 * (c_custkey % 5) + 57600 as firstEnd",
        "86400 * (c_custkey % 3) + 36000 as secondStart", "86400 * (2 + c_custkey % 3) + 1800 as secondEnd",
    )),
    "v_account_orders": View("orders", (
        "o_orderkey as orderId", "o_custkey as positionId", "o_custkey % 20 as account", "o_orderdate as createdAt",
    )),
    "v_requests": View("events", (
        "cast(event_id as varchar(20)) as clientMsgId", "ts as sentAt",
    ), "event_type = 'click'"),
    "v_responses": View("events", (
        "cast(event_id as varchar(20)) as clientMsgId",
        "case event_id % 4 when 0 then ts + interval 7 second when 1 then ts + interval 5 second "
        "when 2 then ts + interval 2 second else ts end as receivedAt",
    ), "event_type = 'click' and value >= 5"),
    "v_levels": View("events", ("event_id", "ts", "user_id as account", "value as marginLevel")),
}

# Two leverage ladders, trading sessions as seconds of the week and two holidays: fixed values.
LADDERS = ((1, ((0, 500), (1000, 200), (3000, 100))), (2, ((0, 100), (2000, 50))))
SESSIONS = ((0, 28800), (115200, 144000))
HOLIDAYS = (("2024-01-01", True), ("2024-01-15", False))
THRESHOLDS = (
    ("MARGIN_LEVEL_THRESHOLD_1", 100.0), ("MARGIN_LEVEL_THRESHOLD_2", 50.0), ("MARGIN_LEVEL_THRESHOLD_3", 20.0),
)


class Tables:
    """The given tables of one folder and the views over them."""

    def __init__(self, spark: SparkSession, folder: str):
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        self.spark, self.folder = spark, folder.rstrip("/")

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    def view(self, name: str) -> DataFrame:
        return self._project(self.table(VIEWS[name].table), VIEWS[name])

    def stream(self, name: str) -> DataFrame:
        """A view over its table read as a file stream. The pattern lets the table be a file or a folder."""
        view = VIEWS[name]
        rows = self.spark.readStream.schema(self.table(view.table).schema).parquet(
            f"{self.folder}/{view.table}.parque[t]"
        )
        return self._project(rows, view)

    @staticmethod
    def _project(rows: DataFrame, view: View) -> DataFrame:
        return (rows.filter(view.where) if view.where else rows).selectExpr(*view.columns)

    def ladders(self) -> DataFrame:
        return self.spark.createDataFrame(
            list(LADDERS), "leverageId BIGINT, tiers ARRAY<STRUCT<volume: BIGINT, leverage: BIGINT>>"
        )

    def holidays(self) -> DataFrame:
        return self.spark.createDataFrame(list(HOLIDAYS), "d STRING, isRecurring BOOLEAN").selectExpr(
            "cast(d as date) as holidayDate", "isRecurring"
        )


def with_views(names: tuple[str, ...], sql: str) -> str:
    """The SQL with the views it names in front, so it runs on the bare tables."""
    if not names:
        return sql.strip()
    heads = ", ".join(f"{n} as ({VIEWS[n].sql()})" for n in names)
    body = sql.strip()
    if body.lower().startswith("with recursive "):
        return f"with recursive {heads}, {body[len('with recursive '):]}"
    if body.lower().startswith("with "):
        return f"with {heads}, {body[len('with '):]}"
    return f"with {heads} {body}"
