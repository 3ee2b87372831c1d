import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from tickloom import schemas
from tickloom.ml import direction as M
from tickloom.ml import newton
from tickloom.operators import accounts as A
from tickloom.operators import quotes as Q
from tickloom.operators import refdata as R
from tickloom.operators.ordered import Timeline
from tickloom.session import workspace
from tickloom.sources import bronze, readers, writers


@pytest.fixture(scope="module")
def lists(spark):
    return {
        "light": spark.createDataFrame(
            [(1, "EURUSD", True, 10, 20, 100, None), (2, "XAUUSD", True, 11, 20, 999, None)],
            schemas.LIGHT_SYMBOL),
        "details": spark.createDataFrame([(1, 5, "from details"), (3, 2, "other")],
                                         "symbolId long, digits int, description string"),
        "assets": spark.createDataFrame([(10, "EUR", "Euro", 2), (20, "USD", None, 2)], schemas.ASSET),
        "classes": spark.createDataFrame([(7, "Forex")], schemas.ASSET_CLASS),
        "categories": spark.createDataFrame([(100, 7, "Majors")], schemas.SYMBOL_CATEGORY),
    }


def test_symbol_dimension_keeps_unresolved_rows(lists):
    wide = R.flat_symbols(R.symbol_dimension(*[lists[n] for n in ("light", "details", "assets", "classes", "categories")]))
    assert wide.columns == [n for n, _ in schemas.FLAT_SYMBOL]
    rows = {r.symbolId: r for r in wide.collect()}
    assert (rows[1].assetClass, rows[1].symbolCategory, rows[1].baseAsset, rows[1].digits) == ("Forex", "Majors", "EUR", 5)
    assert rows[2].symbolCategory is None and rows[2].assetClass is None and rows[2].digits is None
    assert set(rows) == {1, 2}


def test_merge_prefers_light_values(spark, lists):
    light = spark.createDataFrame([(1, "mine"), (3, None)], "symbolId long, description string")
    merged = {r.symbolId: r.description for r in R.merge_records(light, lists["details"]).collect()}
    assert merged == {1: "mine", 3: "other"}


def test_conversion_chain(spark):
    edges = spark.createDataFrame([(1, 10, 11), (2, 11, 12), (3, 10, 13), (4, 12, 13), (5, 12, 10), (6, 14, 14)],
                                  "symbolId long, baseAssetId long, quoteAssetId long")
    chain = [tuple(r) for r in R.conversion_chain(edges, 11, 13).collect()]
    assert chain == [(1, 2, 11, 12), (2, 4, 12, 13)]
    assert R.conversion_chain(edges, 13, 11).count() == 0


def test_name_lookup(spark):
    ticks = spark.createDataFrame([(1,), (9,)], "symbolId long")
    names = spark.createDataFrame([(1, "EURUSD"), (1, "EURUSD")], "symbolId long, symbolName string")
    assert sorted(r.Symbol for r in Q.with_symbol_name(ticks, names).collect()) == ["9", "EURUSD"]


def test_quote_event_defaults(spark):
    spots = spark.createDataFrame([(1, None, 5)], "symbolId long, bid long, ask long")
    names = spark.createDataFrame([(1, "A")], "symbolId long, symbolName string")
    row = Q.quote_events(spots, names).first()
    assert (row.Symbol, row.Bid, row.Ask) == ("A", 0, 5) and row.timestamp.endswith("+00:00")


def test_exactly_one(spark):
    symbols = spark.createDataFrame([(1, "A"), (2, "B"), (3, "B")], "symbolId long, symbolName string")

    def ask(name):
        return Q.exactly_one(spark.createDataFrame([(name,)], "symbolName string"), symbols).collect()

    assert ask("A")[0].symbolId == 1
    for name, count in (("B", 2), ("C", 0)):
        with pytest.raises(Exception, match=f"{name} matches {count} symbols"):
            ask(name)


def test_empty_overwrite_keeps_table(spark):
    spark.sql(f"create database guard location '{workspace(spark, 'guard')}'")
    rows = spark.createDataFrame([("{\"a\":1}",)], "json_raw string")
    assert bronze.land(rows, "guard.t", "overwrite")
    assert not bronze.land(spark.createDataFrame([("{}",), (None,)], "json_raw string"), "guard.t", "overwrite")
    assert spark.table("guard.t").count() == 1
    bronze.run_incremental({"guard.t": rows})
    assert spark.table("guard.t").count() == 2
    assert [r.rows for r in bronze.load_sizes(spark.table("guard.t")).collect()] == [1, 1]
    bronze.run_batch({"guard.t": rows})
    assert spark.table("guard.t").count() == 1
    assert spark.table("guard.t").dtypes == [("json_raw", "string"), ("ingestion_timestamp", "timestamp")]


def test_bar_requests(spark):
    now = F.lit("2024-04-01 12:00:00").cast("timestamp")
    rows = bronze.bar_requests(spark, schemas.CRYPTO_PAIRS, now, schemas.BATCH_LOOKBACK_DAYS).collect()
    assert len(rows) == 10
    first = rows[0].asDict()
    assert first == {"requested": "SOL/USD", "symbol": "SOL", "start": "2024-01-02", "end": "2024-04-01",
                     "timeframe": "5Min", "sort": "asc", "limit": 10000}


def test_payload_parsing(spark, tmp_path):
    payload = {"bars": {"AAPL": [{"t": "2024-01-01T00:00:00Z", "o": 1.0, "h": 2.0, "l": 0.5, "c": 1.5, "v": 10}],
                        "MSFT": []}, "next_page_token": None}
    (tmp_path / "a.json").write_text(json.dumps(payload, indent=1))
    (tmp_path / "b.json").write_text("{}")
    landed = bronze.usable_payloads(readers.read_payload_files(spark, str(tmp_path)))
    assert landed.count() == 1
    assert [tuple(r)[:2] for r in bronze.parse_bars(landed).collect()] == [("AAPL", "2024-01-01T00:00:00Z")]
    assert bronze.parse_any(landed, "$.bars.AAPL[0].c", "double", "c").first().c == 1.5


def test_option_requests(spark):
    listed = bronze.contract_requests(spark, schemas.STOCKS)
    assert listed.count() == 10 and listed.first().status == "active"
    contracts = spark.createDataFrame([("C1",)], "contractSymbol string")
    assert bronze.snapshot_requests(contracts).first().asDict() == {"contractSymbol": "C1", "sort": "asc", "limit": 1}


def test_contract_expansion(spark):
    raw = ['{"contracts":[{"symbol":"C1"},{"symbol":""},{"x":1},{"symbol":"C2"}]}', '{"page":1}']
    contracts = bronze.explode_contracts(spark.createDataFrame([(r,) for r in raw], "json_raw string"))
    assert sorted(r.contractSymbol for r in contracts.collect()) == ["C1", "C2"]
    snaps = spark.createDataFrame([("C1", '{"p":1}'), ("C2", "{}")], "contractSymbol string, json_raw string")
    assert [r.contractSymbol for r in bronze.contract_snapshots(contracts, snaps).collect()] == ["C1"]


def test_message_readers(spark, tmp_path):
    (tmp_path / "accounts.json").write_text(json.dumps({"data": [
        {"ctidTraderAccountId": 1, "isLive": True}, {"ctidTraderAccountId": 2, "isLive": False}]}, indent=1))
    accounts = readers.read_accounts(spark, str(tmp_path / "accounts.json"))
    assert [r.ctidTraderAccountId for r in accounts.filter("isLive").collect()] == [1]
    (tmp_path / "assets.json").write_text('{"assetId": 1, "name": "EUR"}\n{"assetId": 2, "name": "USD", "digits": 2}\n')
    assert readers.read_reference_list(spark, str(tmp_path / "assets.json"), "assets").count() == 2


def test_envelope_dispatch(spark):
    envelopes = spark.createDataFrame([
        (2131, bytearray(b'{"symbolId": 5, "bid": 7}'), "a"), (51, bytearray(b"{}"), None),
        (2142, bytearray(b'{"errorCode": "E", "description": "d"}'), "b"),
    ], schemas.ENVELOPE)
    spot = readers.decode_envelopes(envelopes, 2131, schemas.SPOT_EVENT).first()
    assert (spot.clientMsgId, spot.symbolId, spot.bid, spot.ask) == ("a", 5, 7, None)
    errors = readers.decode_envelopes(envelopes, 2142, schemas.ERROR)
    assert errors.first().errorCode == "E"


def test_document_frame_and_csv(spark, tmp_path):
    doc = readers.document_to_frame(
        spark, {"host": "demo", "assets": [{"assetId": 1, "name": "EUR"}]},
        "host string, assets array<struct<assetId: bigint, name: string>>")
    writers.write_json(doc, str(tmp_path / "doc"))
    assert spark.read.json(str(tmp_path / "doc")).first().assets[0].name == "EUR"
    symbols = spark.createDataFrame([(1, "A", "x")], "symbolId long, symbolName string, extra string").coalesce(1)
    writers.write_flat_csv(symbols, str(tmp_path / "csv"))
    header, row = [l for f in (tmp_path / "csv").glob("*.csv") for l in f.read_text().splitlines()]
    assert header.split(",") == [n for n, _ in schemas.FLAT_SYMBOL] and row == "1,A" + "," * 32


def test_history_scan_is_pushed_down(spark, tmp_path):
    path = str(tmp_path / "ticks")
    spark.range(100).selectExpr("id as symbolId", "id as ts", "id as tick").write.parquet(path)
    rows = readers.read_history(spark, path, "ts", F.lit(10), F.lit(19), symbol_id=12)
    assert rows.count() == 1
    plan = rows._jdf.queryExecution().toString()
    assert "PushedFilters: [IsNotNull(ts), IsNotNull(symbolId), GreaterThanOrEqual(ts,10)" in plan


def test_depth_events(spark):
    events = spark.createDataFrame([
        (1, "2024-01-01 00:00:00", 1, [(1, 5, 100, None), (2, 5, None, 103), (3, 5, 101, None)], None),
        (2, "2024-01-01 00:00:01", 1, [(4, 9, None, 102)], [3]),
    ], "event_id long, at string, symbolId long, newQuotes array<struct<id: bigint, size: bigint, bid: bigint, "
       "ask: bigint>>, deletedQuotes array<bigint>").withColumn("ts", F.col("at").cast("timestamp")).drop("at")
    book = Q.price_book(Q.depth_actions(events))
    assert sorted(r.quoteId for r in book.collect()) == [1, 2, 4]
    assert tuple(Q.best_prices(book).first()) == (1, 100, 102)


def test_symbol_sessions(spark):
    ticks = spark.createDataFrame([(1, "2024-01-07 06:00:00"), (1, "2024-01-07 02:00:00")], "symbolId long, at string")
    ticks = ticks.withColumn("ts", F.col("at").cast("timestamp_ntz"))
    details = spark.createDataFrame([(1, "America/New_York", [(0, 7200)])],
                                    "symbolId long, scheduleTimeZone string, schedule array<struct<startSecond: bigint, endSecond: bigint>>")
    assert [r.at for r in Q.in_symbol_session(ticks, details).collect()] == ["2024-01-07 06:00:00"]


def test_leverage_tier_edges(spark):
    ladders = spark.createDataFrame([(1, [(1000, 200), (100, 500), (3000, 100)])],
                                    "leverageId long, tiers array<struct<volume: bigint, leverage: bigint>>")
    rows = spark.createDataFrame([(1, v) for v in (99, 100, 999, 1000, 3000, 10**9)], "leverageId long, volume long")
    got = {r.volume: r.leverage for r in A.leverage_tier(rows, ladders).collect()}
    assert got == {99: None, 100: 500, 999: 500, 1000: 200, 3000: 100, 10**9: 100}


def test_crossings_and_edges(spark):
    rows = spark.createDataFrame([(1, i, v) for i, v in enumerate([150.0, 90.0, 80.0, 10.0, 120.0, 99.0])],
                                 "account long, s long, marginLevel double")
    rows = rows.withColumn("ts", F.timestamp_seconds(F.col("s") * 50000))
    line = Timeline(("account",), "ts", ("s",))
    marks = (("T1", 100.0), ("T2", 50.0))
    got = sorted((r.s, r.marginCallType) for r in A.threshold_crossings(rows, marks, line).collect())
    assert got == [(1, "T1"), (3, "T2"), (5, "T1")]
    assert sorted(r.s for r in A.rising_edges(rows, F.col("marginLevel") < 100, line).collect()) == [1, 5]


def test_six_row_model(spark):
    data = list(zip([-2.0, -1.0, 0.0, 1.0, 2.0, 1.0], [0.0, 0.0, 1.0, 1.0, 1.0, 0.0], strict=True))
    rows = spark.createDataFrame(data, "x double, label double")
    model = M.fit(rows, penalty=1 / 6, features=["x"])
    assert round(M.accuracy(M.predict(model, rows)).first().accuracy, 4) == 0.6667


def test_split_is_stable(spark):
    rows = spark.range(5000).selectExpr("id", "timestamp_ntz'1960-01-01 00:00:00' + make_dt_interval(cast(pmod(hash(id), 40000) as int)) as day")
    train, test = M.split_rows(rows, "id", "day")
    again, _ = M.split_rows(rows.repartition(3), "id", "day")
    assert train.count() + test.count() == 5000 and 0.65 < train.count() / 5000 < 0.75
    assert sorted(train.collect()) == sorted(again.collect())


def test_saved_pipeline(spark, tmp_path):
    rows = spark.createDataFrame([(-1.0, 0.0), (1.0, 1.0), (0.5, 1.0)], "x double, label double")
    model = M.fit(rows, penalty=0.1, features=["x"])
    M.save(model, f"{tmp_path}/model")
    assert M.predict(M.load(f"{tmp_path}/model"), rows).collect() == M.predict(model, rows).collect()


def test_newton_fit(spark, tmp_path):
    """Against Spark ML on standardised features, and its own gradient; null rows, constant features, separable classes, none."""
    rng = np.random.default_rng(8)
    x = rng.normal(size=(800, 2)) * [1, 50] + [0, 1000]
    y = (x[:, 0] + 0.01 * (x[:, 1] - 1000) + rng.normal(size=800) > 0.3).astype(float)
    data = [(float(a), float(b), 7.0, float(c)) for (a, b), c in zip(x, y, strict=True)] + [(None, 1.0, 7.0, 1.0), (1.0, 1.0, 7.0, None)]
    rows = spark.createDataFrame(data, "a double, b double, c double, label double")
    model = newton.fit(rows, ("a", "b", "c"), 1e-3)
    assert max(map(abs, model.gradient)) < 1e-12 and model.coefficients[3] == 0
    scaled = rows.dropna().select("label", *[((F.col(f) - m) / d).alias(f) for f, m, d in zip(model.features, model.means, model.deviations, strict=True)])
    other = M.fit(scaled, 1e-3, ["a", "b"], 200).stages[-1]
    assert np.allclose([other.intercept, *other.coefficients], model.coefficients[:3], atol=1e-4)
    model.table(spark).write.parquet(f"{tmp_path}/m")
    assert newton.load(spark.read.parquet(f"{tmp_path}/m")) == model
    parted = spark.createDataFrame([(-1.0, 0.0), (1.0, 1.0), (2.0, 1.0)], "x double, label double")
    assert [r.prediction for r in newton.fit(parted, ("x",), 1e-3).predict(parted).orderBy("x").collect()] == [0, 1, 1]
    assert newton.fit(rows.filter("false"), ("a",), 1e-3).coefficients == (0.0, 0.0)


def test_duplicate_list_rows_do_not_multiply(spark):
    light = spark.createDataFrame([(1, 10, 20, 30)], "symbolId long, symbolCategoryId long, baseAssetId long, quoteAssetId long")
    details = spark.createDataFrame([(1, "new", 2), (1, "old", 1)], "symbolId long, note string, position int")
    assets = spark.createDataFrame([(20, "A", "a", 1), (20, "B", "b", 2), (30, "C", "c", 3)], "assetId long, name string, displayName string, position int")
    classes = spark.createDataFrame([(5, "FX", 1), (5, "Forex", 2)], "id long, name string, position int")
    categories = spark.createDataFrame([(10, 5, "x", 1), (10, 5, "y", 2)], "id long, assetClassId long, name string, position int")
    rows = R.symbol_dimension(light, details, assets, classes, categories).collect()
    assert [(r.note, r.baseAsset, r.quoteAsset, r.assetClass, r.symbolCategory) for r in rows] == [("new", "B", "C", "Forex", "y")]
    traders = spark.createDataFrame([(7, 20)], "account long, depositAssetId long")
    assert [r.depositCurrency for r in R.deposit_currency(traders, assets).collect()] == ["B"]


def test_first_listed_name_wins(spark):
    ticks = spark.createDataFrame([(7,)], "symbolId long")
    names = spark.createDataFrame([(7, "ABC", 2), (7, "ZED", 1)], "symbolId long, symbolName string, position int")
    assert [r.Symbol for r in Q.with_symbol_name(ticks, names).collect()] == ["ZED"]


def test_first_reply_answers_the_request(spark):
    requests = spark.sql("select 'a' as clientMsgId, timestamp_ntz'2024-01-01 00:00:00' as sentAt")
    replies = spark.sql("select 'a' as clientMsgId, timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(0, 0, 0, s) as receivedAt from values (2), (1) as t(s)")
    rows = Q.match_responses(requests, replies, 5).collect()
    assert [(r.receivedAt.second, r.timed_out) for r in rows] == [(1, False)]


def test_each_request_row_is_answered(spark):
    requests = spark.sql("select id as clientMsgId, timestamp_ntz'2024-01-01 00:00:00' as sentAt from values ('a'), ('a'), ('b'), (null), (null) as t(id)")
    replies = spark.sql("select 'a' as clientMsgId, timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(0, 0, 0, s) as receivedAt from values (2), (1), (9) as t(s)")
    rows = Q.match_responses(requests, replies, 5).collect()
    got = sorted((r.clientMsgId or "", r.receivedAt.second if r.receivedAt else -1, r.timed_out) for r in rows)
    assert got == [("", -1, True), ("", -1, True), ("a", 1, False), ("a", 1, False), ("b", -1, True)]


def test_margin_is_exact_and_unpriced_positions_are_counted(spark):
    from tickloom.operators import accounts as A

    ladders = spark.sql("select 1L as leverageId, array(named_struct('volume', 0L, 'leverage', 1L)) as tiers")
    symbols = spark.sql("select 1L as symbolId, 1L as leverageId, 1L as bid, 90071992547409931L as ask")
    assert A.expected_margin(symbols, [1], ladders).first().buyMargin == 90071992547409931
    positions = spark.createDataFrame(
        [(1, 1, "BUY", 2, 100), (1, 9, "SELL", 5, 100)], "account long, symbolId long, tradeSide string, volume long, entry_raw long")
    quotes = spark.sql("select 1L as symbolId, 110L as bid, 111L as ask")
    traders = spark.sql("select 1L as account, 1000L as balance")
    row = A.account_snapshot(positions, quotes, traders).first()
    assert (row.unrealizedPnL, row.usedMargin, row.unpricedPositions, row.unpricedVolume) == (20, 2, 1, 5)


def test_ordering_numbers_follow_time_then_tie(spark):
    from pyspark.sql import functions as F
    from tickloom.functions.times import packed_order

    rows = spark.sql("select timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(0, 0, 0, s) as ts, e from values (0, -5L), (0, null), (1, -9223372036854775807L), (0, 9223372036854775807L) as t(s, e)")
    ordered = rows.orderBy(packed_order(rows, "ts", ("e",))).collect()
    assert ordered == rows.orderBy(F.col("ts"), F.col("e").asc_nulls_first()).collect()


def test_table_write_computes_its_rows_once(spark):
    seen = spark.sparkContext.accumulator(0)

    @F.udf("bigint")
    def counted(x):
        seen.add(1)
        return x

    spark.sql("create database if not exists staged_writes")
    table = "staged_writes.rows"
    spark.sql(f"drop table if exists {table}")
    rows = spark.range(100).repartition(4).select(counted("id").alias("id"))
    assert writers.write_table(rows, table, "overwrite") and seen.value == 100
    assert writers.write_table(spark.table(table).filter("id < 40"), table, "overwrite")  # from itself
    assert not writers.write_table(rows.filter("id < 0"), table, "overwrite")
    failing = spark.range(9).select(F.raise_error(F.lit("lost")).cast("bigint").alias("id"))
    with pytest.raises(Exception, match="lost"):
        writers.write_table(failing, table, "overwrite")
    assert spark.table(table).count() == 40
    spark.sql("drop database staged_writes cascade")


def test_document_records_come_back_one_by_one(spark, tmp_path):
    header = spark.createDataFrame([(1, "a}\n{b")], "id bigint, name string")
    odd = spark.createDataFrame([(None, None), (2, ["{", "}"]), (None, None)], "id bigint, parts array<string>").coalesce(1)
    writers.write_document(header, {"odd": odd, "none": header.filter("false")}, str(tmp_path / "d"))
    rows = readers.read_document(spark, str(tmp_path / "d")).collect()
    got = sorted((r.section, json.dumps(json.loads(r.json))) for r in rows)
    assert got == [("document", '{"id": 1, "name": "a}\\n{b"}'), ("odd", '{"id": 2, "parts": ["{", "}"]}'), ("odd", "{}"), ("odd", "{}")]
