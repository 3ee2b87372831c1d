"""Quote operators: names, time filters, top symbols, fills, spreads, sessions."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickloom.functions import prices, text, times
from tickloom.functions.times import epoch_micros, packed_order
from tickloom.operators.joins import lookup_join, salted_join
from tickloom.operators.latest import latest_per_key, page_per_key
from tickloom.operators.ordered import Timeline, as_of, fill_forward
from tickloom.schemas import ERROR_PAYLOADS, NOISE_PAYLOADS, PAYLOAD_TYPES


def latest_time(df: DataFrame, ts: str = "ts") -> dt.datetime | None:
    """Newest time stamp as a value, so that look-back filters on it are literals the scan can use."""
    return df.agg(F.max(ts)).first()[0]


def quote_events(spots: DataFrame, names: DataFrame, produced_at: Column | None = None) -> DataFrame:
    """Quote rows from spot events: producer clock, symbol name, raw prices with 0 for a missing side."""
    clock = F.current_timestamp() if produced_at is None else produced_at
    return with_symbol_name(spots, names).select(
        times.iso_utc(clock).alias("timestamp"),
        F.col("Symbol"),
        F.coalesce("bid", F.lit(0).cast("bigint")).alias("Bid"),
        F.coalesce("ask", F.lit(0).cast("bigint")).alias("Ask"),
    )


def with_symbol_name(ticks: DataFrame, symbols: DataFrame) -> DataFrame:
    """Add ``Symbol``: the name of the tick's symbol or its id as text. The symbol list is made unique per
    id first, so a tick is never duplicated: the first name by ``position`` in the list, or without that column the
    smallest name."""
    first = F.min_by("symbolName", "position") if "position" in symbols.columns else F.min("symbolName")
    names = symbols.groupBy("symbolId").agg(first.alias("__name"))
    return lookup_join(ticks, names, ["symbolId"], counted=symbols).select(
        *ticks.columns, text.name_or_id(F.col("__name"), F.col("symbolId")).alias("Symbol")
    )


def subscribed_only(ticks: DataFrame, subscriptions: DataFrame) -> DataFrame:
    return ticks.join(subscriptions.select("symbolId"), "symbolId", "left_semi").select(*ticks.columns)


def spot_messages(messages: DataFrame) -> DataFrame:
    return messages.filter(F.col("payloadType") == PAYLOAD_TYPES["SPOT"])


def without_noise(messages: DataFrame, drop: tuple[str, ...] = NOISE_PAYLOADS) -> DataFrame:
    return messages.filter(~F.col("payloadType").isin([PAYLOAD_TYPES[name] for name in drop]))


def is_error(payload_type: Column) -> Column:
    return payload_type.isin([PAYLOAD_TYPES[name] for name in ERROR_PAYLOADS])


def split_errors(messages: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Good messages and dead letters; the latter carry the error text."""
    error = is_error(F.col("payloadType"))
    dead = messages.filter(error).withColumn("error", text.error_text(F.col("errorCode"), F.col("description")))
    return messages.filter(~error), dead


def since(ticks: DataFrame, hours: float, now: dt.datetime | None = None, ts: str = "ts") -> DataFrame:
    """Rows of the last ``hours``; ``now`` is the wall clock unless a point in time is given."""
    if now is None:
        start = F.current_timestamp() - F.make_dt_interval(secs=F.lit(hours * 3600))
        return ticks.filter(F.col(ts) >= start.cast(ticks.schema[ts].dataType))
    return ticks.filter(F.col(ts) >= _literal(ticks, ts, now - dt.timedelta(hours=hours)))


def between(ticks: DataFrame, start: dt.datetime, end: dt.datetime, ts: str = "ts") -> DataFrame:
    return ticks.filter(F.col(ts).between(_literal(ticks, ts, start), _literal(ticks, ts, end)))


def _point(df: DataFrame, column: str, value: dt.datetime) -> dt.datetime | str:
    """The point in time as a value that casts to the column's type. Without a zone it is what
    ``latest_time`` returns: a wall clock reading for TIMESTAMP_NTZ, local time for TIMESTAMP."""
    if isinstance(df.schema[column].dataType, T.TimestampType):
        return value
    if value.tzinfo is not None:
        value = value.astimezone(dt.timezone.utc).replace(tzinfo=None)
    return value.isoformat(sep=" ")


def _literal(df: DataFrame, column: str, value: dt.datetime) -> Column:
    return F.lit(_point(df, column, value)).cast(df.schema[column].dataType)


def tick_counts(ticks: DataFrame, by: str = "Symbol") -> DataFrame:
    return ticks.groupBy(by).agg(F.count(F.lit(1)).alias("tick_count"))


def top_symbols(
    ticks: DataFrame, now: dt.datetime | None = None, hours: float = 3, n: int = 20, by: str = "Symbol",
    ts: str = "ts",
) -> DataFrame:
    """The ``n`` symbols with the most ticks in the last ``hours``; ties go to the smaller name."""
    return tick_counts(since(ticks, hours, now, ts), by).orderBy(F.desc("tick_count"), F.asc(by)).limit(n)


def counts_in_range(
    spark: SparkSession, ticks: DataFrame, start: dt.datetime, end: dt.datetime, by: str = "Symbol", ts: str = "ts"
) -> DataFrame:
    """Tick counts for a dashboard time range, as a parameterised statement."""
    kind = ticks.schema[ts].dataType.simpleString()
    return spark.sql(
        f"select {by}, count(*) as tick_count from {{ticks}} "
        f"where {ts} between cast(:start_time as {kind}) and cast(:end_time as {kind}) group by {by}",
        args={"start_time": _point(ticks, ts, start), "end_time": _point(ticks, ts, end)},
        ticks=ticks,
    )


def exactly_one(requested: DataFrame, symbols: DataFrame) -> DataFrame:
    """Symbol id of each requested name. A name that no symbol or more than one has fails the query."""
    found = symbols.groupBy("symbolName").agg(
        F.count(F.lit(1)).alias("__n"), F.max("symbolId").alias("symbolId")
    )
    matches = F.coalesce(F.col("__n"), F.lit(0))
    problem = F.concat(F.col("symbolName"), F.lit(" matches "), matches.cast("string"), F.lit(" symbols"))
    checked = F.when(matches == 1, F.col("symbolId")).otherwise(F.raise_error(problem).cast("bigint"))
    return requested.join(found, "symbolName", "left").select("symbolName", checked.alias("symbolId"))


def fill_quotes(ticks: DataFrame, ts: str = "ts", tie: tuple[str, ...] = ("event_id",)) -> DataFrame:
    """Carry the last non-zero bid and ask of each symbol forward over zero sides."""
    line = Timeline(("symbolId",), ts, tie)
    return fill_forward(
        ticks, line, {side: F.nullif(F.col(side), F.lit(0).cast("bigint")) for side in ("bid", "ask")}
    )


def spreads(ticks: DataFrame, details: DataFrame) -> DataFrame:
    """Spread, mid price and spread in pips of two-sided quotes; pips need the symbol's pip position."""
    both = ticks.filter((F.col("bid") > 0) & (F.col("ask") > 0))
    gap = prices.spread(F.col("bid"), F.col("ask"))
    return both.join(details.select("symbolId", "pipPosition"), "symbolId", "left").select(
        *ticks.columns,
        gap.alias("spread"),
        prices.mid(F.col("bid"), F.col("ask")).alias("mid"),
        prices.pips(gap, F.col("pipPosition")).alias("spread_pips"),
    )


def at_latest_quote(rows: DataFrame, ticks: DataFrame, values: tuple[str, ...] = ("bid", "ask")) -> DataFrame:
    """Rows with the values of their symbol's newest quote."""
    newest = latest_per_key(ticks.select("symbolId", "ts", "event_id", *values), ["symbolId"], ["ts", "event_id"])
    return salted_join(rows, newest.select("symbolId", *values), ["symbolId"])


def quote_sides(ticks: DataFrame) -> DataFrame:
    """Bid and ask ticks of quotes as rows ``(quoteType, tick)``; an absent side has none."""
    def side(name: str) -> Column:
        return F.struct(F.lit(name.upper()).alias("quoteType"), F.col(name).alias("tick"))

    kept = [c for c in ticks.columns if c not in ("bid", "ask")]
    return ticks.select(*kept, F.inline(F.array(side("bid"), side("ask")))).filter("tick > 0")


def tick_data(
    ticks: DataFrame, start: Column, end: Column, max_rows: int, keys: Sequence[str] = ("symbolId", "quoteType"),
    ts: str = "ts",
) -> DataFrame:
    """First page of each symbol's bid and ask ticks in ``[start, end]``, with ``has_more``."""
    inside = quote_sides(ticks).filter(F.col(ts).between(start, end))
    return page_per_key(inside, keys, [ts, "event_id"], max_rows)


def quotes_as_of(probes: DataFrame, ticks: DataFrame, values: tuple[str, ...], ts: str = "ts") -> DataFrame:
    return as_of(probes, ticks, ["symbolId"], ts, list(values), tie="event_id")


def session_close_change(ticks: DataFrame, price: str = "price") -> DataFrame:
    """Last price of each symbol and day against the previous traded day's last price."""
    daily = (
        ticks.withColumn("session_day", F.to_date("ts"))
        .groupBy("symbolId", "session_day")
        .agg(F.max_by(price, packed_order(ticks, "ts", ("event_id",))).alias("last_price"))
    )
    close = F.lag("last_price").over(Window.partitionBy("symbolId").orderBy("session_day"))
    return (
        daily.withColumn("session_close", close)
        .filter(F.col("session_close").isNotNull())
        .withColumn("change", F.col("last_price") - F.col("session_close"))
    )


def session_slots(ticks: DataFrame, gap_seconds: int = 300, ts: str = "ts") -> DataFrame:
    """First, last and number of ticks per symbol and gap-wide time slot. Ticks that share a slot are
    always in one session, so this is all a session needs to know of them."""
    slot = F.floor(epoch_micros(F.col(ts)) / (gap_seconds * 1_000_000))
    return ticks.groupBy("symbolId", slot.alias("slot")).agg(
        F.min(ts).alias("first_ts"), F.max(ts).alias("last_ts"), F.count(F.lit(1)).alias("ticks")
    )


def sessions_from_slots(slots: DataFrame, gap_seconds: int = 300) -> DataFrame:
    line = Window.partitionBy("symbolId").orderBy("slot")
    pause = epoch_micros(F.col("first_ts")) - epoch_micros(F.lag("last_ts").over(line))
    return (
        slots.withColumn("__start", F.when(pause < gap_seconds * 1_000_000, 0).otherwise(1))
        .withColumn("__run", F.sum("__start").over(line))
        .groupBy("symbolId", "__run")
        .agg(
            F.min("first_ts").alias("session_start"),
            F.max("last_ts").alias("session_last"),
            F.sum("ticks").alias("ticks"),
        )
        .drop("__run")
    )


def sessions(ticks: DataFrame, gap_seconds: int = 300, ts: str = "ts") -> DataFrame:
    """Runs of quotes per symbol without a pause of ``gap_seconds`` or more. The rows are combined into
    slots before the shuffle; the window sees one row per symbol and slot."""
    return sessions_from_slots(session_slots(ticks, gap_seconds, ts), gap_seconds)


def in_session(
    ticks: DataFrame, schedule: Sequence[tuple[int, int]], zone: str = "UTC", ts: str = "ts"
) -> DataFrame:
    """Ticks inside a trading session shared by all symbols: half-open intervals of seconds of the week."""
    now = F.col("second_of_week")
    inside = F.lit(False)
    for start, end in schedule:
        inside = inside | ((now >= start) & (now < end))
    return ticks.withColumn("second_of_week", times.second_of_week(F.col(ts), zone)).filter(inside)


def in_symbol_session(ticks: DataFrame, details: DataFrame, ts: str = "ts", slot_seconds: int = 3600) -> DataFrame:
    """Ticks inside their own symbol's schedule (``schedule`` of ``startSecond``, ``endSecond``, half-open seconds of the week)
    in its ``scheduleTimeZone``, UTC where that is null, daylight saving included.

    Each range stands in the slots of the week that it covers. A tick meets the ranges of its symbol and slot by an equi-join
    and is tested against these only; ranges that overlap do not repeat it.
    """
    zones = details.select("symbolId", F.coalesce("scheduleTimeZone", F.lit("UTC")).alias("__zone"))
    ranges = details.select("symbolId", F.inline("schedule")).filter("startSecond < endSecond")
    first, last = (F.floor(F.col(c) / slot_seconds) for c in ("startSecond", "lastSecond"))
    covered = ranges.withColumn("lastSecond", F.col("endSecond") - 1).select(
        "symbolId", "startSecond", "endSecond", F.explode(F.sequence(first, last)).alias("__slot"))
    timed = lookup_join(ticks, zones, ["symbolId"], "inner").withColumn(
        "second_of_week", times.second_of_week(F.col(ts), F.col("__zone"))).drop("__zone")
    inside = (F.col("second_of_week") >= F.col("startSecond")) & (F.col("second_of_week") < F.col("endSecond"))
    return lookup_join(
        timed.withColumn("__slot", F.floor(F.col("second_of_week") / slot_seconds)), covered, ["symbolId", "__slot"],
        "left_semi", inside).drop("__slot")


def outside_holidays(ticks: DataFrame, holidays: DataFrame, ts: str = "ts") -> DataFrame:
    """Ticks on no holiday; a recurring holiday matches month and day of any year."""
    day = F.to_date(ts)
    fixed = holidays.filter(~F.col("isRecurring")).select(F.col("holidayDate").alias("__date"))
    yearly = holidays.filter("isRecurring").select(F.date_format("holidayDate", "MM-dd").alias("__day"))
    return (
        ticks.join(fixed, day == F.col("__date"), "left_anti")
        .join(yearly, F.date_format(day, "MM-dd") == F.col("__day"), "left_anti")
    )


def price_book(actions: DataFrame) -> DataFrame:
    """Live quotes of each symbol's book: the latest action per quote id, where that is not a deletion."""
    keys = ["symbolId", "quoteId"]
    order = ["ts", "event_id"]
    rest = [c for c in actions.columns if c not in (*keys, *order)]
    last = latest_per_key(actions, keys, order).filter(F.col("action") == "N")
    return last.select(*keys, *[c for c in rest if c != "action"])


def depth_actions(events: DataFrame) -> DataFrame:
    """One row per added or deleted quote of depth events that carry both lists."""
    shape = "ARRAY<STRUCT<quoteId: BIGINT, action: STRING, size: BIGINT, bid: BIGINT, ask: BIGINT>>"
    added = F.transform("newQuotes", lambda q: F.struct(q["id"], F.lit("N"), q["size"], q["bid"], q["ask"]))
    none = F.lit(None).cast("bigint")
    gone = F.transform("deletedQuotes", lambda i: F.struct(i, F.lit("D"), none, none, none))
    empty = F.array().cast(shape)
    both = F.concat(F.coalesce(added.cast(shape), empty), F.coalesce(gone.cast(shape), empty))
    base = [c for c in events.columns if c not in ("newQuotes", "deletedQuotes")]
    return events.select(*base, F.inline(both))


def best_prices(book: DataFrame) -> DataFrame:
    """Highest bid and lowest ask of each symbol's live quotes; a quote has one of the two sides."""
    return book.groupBy("symbolId").agg(F.max("bid").alias("best_bid"), F.min("ask").alias("best_ask"))


def price_levels(book: DataFrame) -> DataFrame:
    """Each symbol's ladder: quotes of one side and price as one level, numbered from the best price on."""
    def of(side: str) -> Column:
        return F.struct(F.lit(side).alias("side"), F.col(side.lower()).alias("price"))

    sides = book.select("symbolId", "size", F.inline(F.array(of("BID"), of("ASK"))))
    levels = sides.filter("price is not null").groupBy("symbolId", "side", "price").agg(
        F.sum("size").alias("size"), F.count(F.lit(1)).alias("quotes"))
    best_first = F.when(F.col("side") == "BID", -F.col("price")).otherwise(F.col("price"))
    return levels.withColumn("level", F.row_number().over(Window.partitionBy("symbolId", "side").orderBy(best_first)))


def match_responses(
    requests: DataFrame, responses: DataFrame, timeout_seconds: int, sent: str = "sentAt",
    received: str = "receivedAt",
) -> DataFrame:
    """Each request row with its first response inside the time-out; without one it is timed out."""
    late = F.col(sent) + F.expr(f"interval {timeout_seconds} seconds")
    asked = requests.select("clientMsgId", sent)
    inner = responses.withColumnRenamed("clientMsgId", "__id")
    first = asked.distinct().join(
        inner, (F.col("clientMsgId") == F.col("__id")) & F.col(received).between(F.col(sent), late),
    ).groupBy("clientMsgId", sent).agg(F.min(received).alias(received))
    return asked.join(first, ["clientMsgId", sent], "left").withColumn("timed_out", F.col(received).isNull())
