"""Account queries over stored deals, orders, positions and balance changes.

Amounts are integers in hundredths, prices integers in 1/100000. The remote service publishes no formulas;
the ones here are our definitions: a BUY position closes at the bid and a SELL position at the ask,
profit = direction x (close - entry) x volume, margin = notional / leverage.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickloom.functions.prices import exact_sum, signed
from tickloom.operators.joins import lookup_join, salted_join
from tickloom.operators.latest import latest_per_key, page_per_key
from tickloom.operators.ordered import Timeline, previous, running_sum

DEAL_ORDER = ("executedAt", "orderId", "lineNo", "symbolId", "account", "amountCents")


def in_range(rows: DataFrame, ts: str, start: Column | None = None, end: Column | None = None) -> DataFrame:
    """Rows with ``ts`` in the closed range; an absent bound is open."""
    if start is not None:
        rows = rows.filter(F.col(ts) >= start)
    if end is not None:
        rows = rows.filter(F.col(ts) <= end)
    return rows


def deals_page(
    deals: DataFrame, max_rows: int, start: Column | None = None, end: Column | None = None,
    keys: Sequence[str] = ("account",),
) -> DataFrame:
    return page_per_key(in_range(deals, "executedAt", start, end), keys, DEAL_ORDER, max_rows)


def orders_page(
    orders: DataFrame, max_rows: int, start: Column | None = None, end: Column | None = None,
    keys: Sequence[str] = ("positionId",),
) -> DataFrame:
    """First page of the orders of each position, or of each account with ``keys`` so."""
    return page_per_key(in_range(orders, "createdAt", start, end), keys, ("createdAt", "orderId"), max_rows)


def deals_by_position(
    deals: DataFrame, orders: DataFrame, start: Column | None = None, end: Column | None = None
) -> DataFrame:
    """Deals with the position of their order."""
    return in_range(deals, "executedAt", start, end).join(orders.select("orderId", "positionId"), "orderId")


def deals_by_position_page(
    deals: DataFrame, orders: DataFrame, max_rows: int, start: Column | None = None, end: Column | None = None
) -> DataFrame:
    """First page of each position's deals, with ``has_more``."""
    return page_per_key(deals_by_position(deals, orders, start, end), ["positionId"], DEAL_ORDER, max_rows)


def order_details(orders: DataFrame, deals: DataFrame) -> DataFrame:
    """Every order with its deals, one row per deal; an order without deals keeps one row.

    The deals are not gathered into an array, so an order may have any number of them. The inner part is
    apart from the orders without deals because only an inner join can split the deals of one busy order.
    """
    theirs = deals.drop("positionId")
    matched = orders.join(theirs, "orderId")
    bare = orders.join(deals.select("orderId").distinct(), "orderId", "left_anti")
    return matched.unionByName(bare, allowMissingColumns=True)


def closing_links(deals: DataFrame, deal_columns: Sequence[str] = DEAL_ORDER) -> DataFrame:
    """Which deal closes which: each SELL deal closes the first BUY deal of its order. One link per closing
    deal, so the table is never larger than the deals."""
    key = F.struct(*deal_columns)
    opening = (
        deals.filter("tradeSide = 'BUY'").groupBy("orderId").agg(F.min(key).alias("openingDeal"))
    )
    closing = deals.filter("tradeSide = 'SELL'").select("orderId", key.alias("closingDeal"), "volume")
    return salted_join(closing, opening, ["orderId"], "inner")


def deal_offsets(links: DataFrame) -> DataFrame:
    """Both directions of every link, one row each: the deals that close a deal (``offsetBy``) and the
    deals it closes (``offsetting``)."""
    def side(direction: str, deal: str, other: str) -> Column:
        return F.struct(
            F.lit(direction).alias("direction"),
            F.col("orderId"),
            F.col(f"{deal}.lineNo").alias("lineNo"),
            F.col(f"{deal}.executedAt").alias("executedAt"),
            F.col(f"{other}.lineNo").alias("otherLineNo"),
            F.col(f"{other}.symbolId").alias("otherSymbolId"),
            F.col(f"{other}.executedAt").alias("otherExecutedAt"),
            F.col("volume"),
        )

    both = F.array(side("offsetBy", "openingDeal", "closingDeal"), side("offsetting", "closingDeal", "openingDeal"))
    return links.select(F.inline(both))


def with_status(rows: DataFrame, column: str, *names: str) -> DataFrame:
    """Rows whose order, deal, position or execution status is one of ``names``."""
    return rows.filter(F.col(column).isin(list(names)))


def latest_state(events: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    return latest_per_key(events, keys, order)


def reconcile(orders: DataFrame, open_status: str = "ORDER_STATUS_FILLED",
              pending_status: str = "ORDER_STATUS_ACCEPTED") -> DataFrame:
    """Open positions (positions whose latest order is filled) and pending orders, told apart by ``kind``."""
    latest = latest_state(orders, ["positionId"], ["createdAt", "orderId"])
    positions = with_status(latest, "orderStatus", open_status)
    pending = with_status(orders, "orderStatus", pending_status)
    return positions.select(F.lit("position").alias("kind"), *orders.columns).unionByName(
        pending.select(F.lit("order").alias("kind"), *orders.columns)
    )


def realised_pnl(closed: DataFrame, by: Sequence[str]) -> DataFrame:
    """Gross profit, costs and net result of closed deals."""
    totals = closed.groupBy(*by).agg(
        *[F.sum(c).alias(c) for c in ("grossProfit", "swap", "commission", "pnlConversionFee")],
        F.count(F.lit(1)).alias("deals"),
    )
    net = F.col("grossProfit") + F.col("swap") + F.col("commission") - F.col("pnlConversionFee")
    return totals.withColumn("netProfit", net)


def exposure(deals: DataFrame) -> DataFrame:
    side, volume, none = F.col("tradeSide"), F.col("volume"), F.lit(0).cast("bigint")
    return deals.groupBy("symbolId").agg(
        F.sum(F.when(side == "BUY", volume).otherwise(none)).alias("buyVolume"),
        F.sum(F.when(side == "SELL", volume).otherwise(none)).alias("sellVolume"),
        F.sum(signed(side, volume)).alias("netVolume"),
    )


def fill_ratio(deals: DataFrame, by: Sequence[str]) -> DataFrame:
    totals = deals.groupBy(*by).agg(F.sum("volume").alias("volume"), F.sum("filledVolume").alias("filledVolume"))
    return totals.withColumn("fillRatio", F.col("filledVolume") / F.nullif(F.col("volume"), F.lit(0).cast("bigint")))


def cash_flow_totals(changes: DataFrame) -> DataFrame:
    return changes.groupBy("operationType").agg(
        F.count(F.lit(1)).alias("operations"), exact_sum(F.col("delta")).alias("delta")
    )


def cash_flow_history(
    changes: DataFrame, start: Column | None = None, end: Column | None = None
) -> DataFrame:
    """Balance changes with the balance after each; the balance counts all changes, the range cuts the list."""
    line = Timeline(("account",), "changedAt", ("balanceHistoryId",))
    balance = running_sum(changes, line, {"balance": F.col("delta"), "balanceVersion": F.lit(1).cast("bigint")})
    return in_range(balance, "changedAt", start, end)


def unrealised_pnl(positions: DataFrame) -> DataFrame:
    """Profit of open positions that carry the quote (``bid``, ``ask``) they would close at."""
    close = F.when(F.col("tradeSide") == "BUY", F.col("bid")).otherwise(F.col("ask"))
    gross = signed(F.col("tradeSide"), (close - F.col("entry_raw")) * F.col("volume"))
    return positions.withColumn("grossUnrealizedPnL", gross)


def open_totals(positions: DataFrame) -> DataFrame:
    """Positions folded by account, symbol and side: all that profit and margin need of them."""
    return positions.groupBy("account", "symbolId", "tradeSide").agg(
        exact_sum(F.col("volume")).alias("volume"),
        F.sum((F.col("volume") * F.col("entry_raw")).cast("decimal(38,0)")).alias("cost"),
        F.count(F.lit(1)).alias("positions"),
    )


def account_snapshot(
    positions: DataFrame, latest_quotes: DataFrame, traders: DataFrame, leverage: int = 100
) -> DataFrame:
    """Profit of open positions, used margin, equity and margin level per account.

    Positions are folded before they meet the quotes, so a busy symbol reaches the join as one row per
    account and side. Positions of a symbol without a quote add nothing to profit and margin, which is then incomplete;
    ``unpricedPositions`` and ``unpricedVolume`` say how many they are.
    """
    totals = open_totals(positions)
    close = F.when(F.col("tradeSide") == "BUY", F.col("bid")).otherwise(F.col("ask"))
    notional = close.cast("decimal(20,0)") * F.col("volume")
    priced = (
        totals.join(latest_quotes.select("symbolId", "bid", "ask"), "symbolId", "left")
        .withColumn("pnl", signed(F.col("tradeSide"), notional - F.col("cost")))
        .withColumn("notional", notional)
    )
    sums = priced.groupBy("account").agg(
        F.sum("pnl").cast("bigint").alias("unrealizedPnL"),
        F.floor(F.sum("notional") / leverage).cast("bigint").alias("usedMargin"),
        F.coalesce(F.sum(F.when(close.isNull(), F.col("positions"))), F.lit(0)).alias("unpricedPositions"),
        F.coalesce(F.sum(F.when(close.isNull(), F.col("volume"))), F.lit(0)).cast("bigint").alias("unpricedVolume"),
    )
    full = traders.select("account", "balance").join(sums, "account", "left").fillna(
        0, ["unrealizedPnL", "usedMargin", "unpricedPositions", "unpricedVolume"]
    )
    equity = F.col("balance") + F.col("unrealizedPnL")
    return full.withColumn("equity", equity).withColumn(
        "marginLevel", F.col("equity") * 100 / F.nullif(F.col("usedMargin"), F.lit(0).cast("bigint"))
    )


def ladder_ranges(ladders: DataFrame) -> DataFrame:
    """Tiers as half-open volume ranges; each reaches up to the next tier of its ladder, the last has no end."""
    tiers = ladders.select("leverageId", F.explode("tiers").alias("t")).select(
        "leverageId", F.col("t.volume").alias("__from"), F.col("t.leverage").alias("leverage")
    )
    line = Window.partitionBy("leverageId").orderBy("__from")
    return tiers.withColumn("__to", F.lead("__from").over(line))


def leverage_tier(rows: DataFrame, ladders: DataFrame, volume: str = "volume") -> DataFrame:
    """Leverage of each row's volume: the tier with the greatest lower bound not above it. The ranges of a
    ladder do not overlap and are tested inside the join, so a row stays one row."""
    v = F.col(volume)
    inside = (v >= F.col("__from")) & (F.col("__to").isNull() | (v < F.col("__to")))
    joined = lookup_join(rows, ladder_ranges(ladders), ["leverageId"], condition=inside)
    return joined.drop("__from", "__to")


def expected_margin(
    symbols: DataFrame, volumes: Sequence[int], ladders: DataFrame, bid: str = "bid", ask: str = "ask"
) -> DataFrame:
    """Margin to buy or sell each of the volumes at the current quote."""
    asked = symbols.withColumn("volume", F.explode(F.array(*[F.lit(v).cast("bigint") for v in volumes])))
    tiered = leverage_tier(asked, ladders)

    def margin(price: str) -> Column:
        """Whole numbers throughout: a double would lose cents above 2 to the 53."""
        return F.expr(
            f"(cast(volume as decimal(19,0)) * cast({price} as decimal(19,0))) div cast(leverage as decimal(19,0))")

    return tiered.withColumn("buyMargin", margin(ask)).withColumn("sellMargin", margin(bid))


def threshold_crossings(
    levels: DataFrame, thresholds: Sequence[tuple[str, float]], line: Timeline, value: str = "marginLevel"
) -> DataFrame:
    """One row each time a key's level falls below a threshold it was not below in its previous row."""
    return crossings_between(previous(levels, line, {"previousLevel": F.col(value)}), thresholds, value)


def crossings_between(rows: DataFrame, thresholds: Sequence[tuple[str, float]], value: str) -> DataFrame:
    marks = F.array(*[F.struct(F.lit(n).alias("marginCallType"), F.lit(float(x)).alias("threshold"))
                      for n, x in thresholds])
    crossed = F.filter(
        marks,
        lambda m: (F.col(value) < m["threshold"])
        & (F.col("previousLevel").isNull() | (F.col("previousLevel") >= m["threshold"])),
    )
    return rows.withColumn("__mark", F.explode(crossed)).select(*rows.columns, "__mark.*")


def rising_edges(rows: DataFrame, rule: Column, line: Timeline) -> DataFrame:
    """Rows where a rule starts to hold: it holds now and did not in the key's previous row."""
    return edges_between(previous(rows, line, {"__before": rule}), rule)


def edges_between(rows: DataFrame, rule: Column) -> DataFrame:
    return rows.filter(rule & ~F.coalesce("__before", F.lit(False))).drop("__before")


def accounts(customers: DataFrame, deals: DataFrame, live_only: bool | None = None) -> DataFrame:
    """Accounts with the time of their last closing deal, optionally only the live or the demo ones."""
    last = deals.groupBy("account").agg(F.max("executedAt").alias("lastClosingDeal"))
    wanted = customers if live_only is None else customers.filter(F.col("isLive") == live_only)
    return wanted.join(last, "account", "left")
