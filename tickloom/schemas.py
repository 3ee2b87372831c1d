"""Row shapes of the market-data feed (as DDL), its enumerations and the flat symbol columns."""

from __future__ import annotations

QUOTE_JSON = "timestamp STRING, Symbol STRING, Bid BIGINT, Ask BIGINT"
BRONZE = "json_raw STRING, ingestion_timestamp TIMESTAMP"

TRENDBAR = (
    "volume BIGINT, period STRING, low BIGINT, deltaOpen BIGINT, deltaClose BIGINT, deltaHigh BIGINT, "
    "utcTimestampInMinutes BIGINT"
)
SPOT_EVENT = (
    "ctidTraderAccountId BIGINT, symbolId BIGINT, bid BIGINT, ask BIGINT, "
    "trendbar ARRAY<STRUCT<volume: BIGINT, period: STRING, low: BIGINT, deltaOpen: BIGINT, deltaClose: BIGINT, "
    "deltaHigh: BIGINT, utcTimestampInMinutes: BIGINT>>, sessionClose BIGINT, timestamp BIGINT"
)
DEPTH_EVENT = (
    "symbolId BIGINT, newQuotes ARRAY<STRUCT<id: BIGINT, size: BIGINT, bid: BIGINT, ask: BIGINT>>, "
    "deletedQuotes ARRAY<BIGINT>"
)
ENVELOPE = "payloadType INT, payload BINARY, clientMsgId STRING"
DECODED_ENVELOPE = "payloadType INT, payload STRING, clientMsgId STRING"
ERROR = "errorCode STRING, description STRING"

ASSET = "assetId BIGINT, name STRING, displayName STRING, digits INT"
ASSET_CLASS = "id BIGINT, name STRING"
SYMBOL_CATEGORY = "id BIGINT, assetClassId BIGINT, name STRING"
LIGHT_SYMBOL = (
    "symbolId BIGINT, symbolName STRING, enabled BOOLEAN, baseAssetId BIGINT, quoteAssetId BIGINT, "
    "symbolCategoryId BIGINT, description STRING"
)
ARCHIVED_SYMBOL = "symbolId BIGINT, name STRING, utcLastUpdateTimestamp BIGINT, description STRING"
SCHEDULE = "ARRAY<STRUCT<startSecond: BIGINT, endSecond: BIGINT>>"
HOLIDAY = (
    "ARRAY<STRUCT<holidayId: BIGINT, name: STRING, description: STRING, scheduleTimeZone: STRING, "
    "holidayDate: BIGINT, isRecurring: BOOLEAN, startSecond: INT, endSecond: INT>>"
)
SYMBOL_DETAIL = (
    "symbolId BIGINT, digits INT, pipPosition INT, lotSize BIGINT, tradingMode STRING, "
    "enableShortSelling BOOLEAN, swapLong DOUBLE, swapShort DOUBLE, swapRollover3Days STRING, "
    "swapCalculationType STRING, swapPeriod INT, swapTime INT, skipSWAPPeriods INT, "
    "chargeSwapAtWeekends BOOLEAN, minVolume BIGINT, maxVolume BIGINT, stepVolume BIGINT, "
    "maxExposure BIGINT, commissionType STRING, preciseTradingCommissionRate BIGINT, "
    f"scheduleTimeZone STRING, leverageId BIGINT, schedule {SCHEDULE}, holiday {HOLIDAY}"
)
TRADER = (
    "ctidTraderAccountId BIGINT, balance BIGINT, balanceVersion BIGINT, depositAssetId BIGINT, "
    "leverageInCents BIGINT, accountType STRING, brokerName STRING, moneyDigits INT"
)
TRADING_ACCOUNT = (
    "ctidTraderAccountId BIGINT, isLive BOOLEAN, traderLogin BIGINT, lastClosingDealTimestamp BIGINT, "
    "lastBalanceUpdateTimestamp BIGINT"
)
TICK = "symbolId BIGINT, quoteType STRING, timestamp BIGINT, tick BIGINT"
TRADE_DATA = (
    "STRUCT<symbolId: BIGINT, volume: BIGINT, tradeSide: STRING, openTimestamp: BIGINT, label: STRING, "
    "comment: STRING>"
)
ORDER = (
    f"orderId BIGINT, tradeData {TRADE_DATA}, orderType STRING, orderStatus STRING, executedVolume BIGINT, "
    "limitPrice DOUBLE, stopPrice DOUBLE, positionId BIGINT, utcLastUpdateTimestamp BIGINT"
)
POSITION = (
    f"positionId BIGINT, tradeData {TRADE_DATA}, positionStatus STRING, swap BIGINT, price DOUBLE, "
    "commission BIGINT, usedMargin BIGINT, moneyDigits INT"
)
DEAL = (
    "dealId BIGINT, orderId BIGINT, positionId BIGINT, volume BIGINT, filledVolume BIGINT, symbolId BIGINT, "
    "createTimestamp BIGINT, executionTimestamp BIGINT, executionPrice DOUBLE, tradeSide STRING, "
    "dealStatus STRING, commission BIGINT, moneyDigits INT, closePositionDetail STRUCT<entryPrice: DOUBLE, "
    "grossProfit: BIGINT, swap: BIGINT, commission: BIGINT, balance: BIGINT, closedVolume: BIGINT, "
    "pnlConversionFee: BIGINT>"
)
CASH_FLOW = (
    "operationType STRING, balanceHistoryId BIGINT, balance BIGINT, delta BIGINT, "
    "changeBalanceTimestamp BIGINT, balanceVersion BIGINT, equity BIGINT, moneyDigits INT"
)
LEVERAGE = "leverageId BIGINT, tiers ARRAY<STRUCT<volume: BIGINT, leverage: BIGINT>>"

# The columns of the flat symbol table, in published order.
FLAT_SYMBOL = (
    ("symbolId", "bigint"),
    ("symbolName", "string"),
    ("enabled", "boolean"),
    ("description", "string"),
    ("assetClassId", "bigint"),
    ("assetClass", "string"),
    ("symbolCategoryId", "bigint"),
    ("symbolCategory", "string"),
    ("baseAssetId", "bigint"),
    ("baseAsset", "string"),
    ("baseAssetDisplayName", "string"),
    ("quoteAssetId", "bigint"),
    ("quoteAsset", "string"),
    ("quoteAssetDisplayName", "string"),
    ("digits", "int"),
    ("pipPosition", "int"),
    ("lotSize", "bigint"),
    ("tradingMode", "string"),
    ("enableShortSelling", "boolean"),
    ("swapLong", "double"),
    ("swapShort", "double"),
    ("swapRollover3Days", "string"),
    ("swapCalculationType", "string"),
    ("swapPeriod", "int"),
    ("swapTime", "int"),
    ("skipSWAPPeriods", "int"),
    ("chargeSwapAtWeekends", "boolean"),
    ("minVolume", "bigint"),
    ("maxVolume", "bigint"),
    ("stepVolume", "bigint"),
    ("maxExposure", "bigint"),
    ("commissionType", "string"),
    ("preciseTradingCommissionRate", "bigint"),
    ("scheduleTimeZone", "string"),
)

# Payload type numbers on the wire.
PAYLOAD_TYPES = {
    "COMMON_ERROR": 50,
    "HEARTBEAT": 51,
    "APPLICATION_AUTH_RES": 2101,
    "ACCOUNT_AUTH_RES": 2103,
    "SYMBOLS_LIST_RES": 2115,
    "EXECUTION": 2126,
    "SPOT": 2131,
    "ORDER_ERROR": 2132,
    "TRENDBARS_RES": 2138,
    "ERROR_RES": 2142,
    "DEPTH": 2155,
}
ERROR_PAYLOADS = ("COMMON_ERROR", "ORDER_ERROR", "ERROR_RES")
NOISE_PAYLOADS = (
    "HEARTBEAT", "APPLICATION_AUTH_RES", "ACCOUNT_AUTH_RES", "SYMBOLS_LIST_RES", "TRENDBARS_RES",
)

# Enumeration names and numbers of the message schema.
ENUMS: dict[str, dict[str, int]] = {
    "dayOfWeek": {
        "NONE": 0, "MONDAY": 1, "TUESDAY": 2, "WEDNESDAY": 3, "THURSDAY": 4, "FRIDAY": 5, "SATURDAY": 6,
        "SUNDAY": 7,
    },
    "commissionType": {
        "USD_PER_MILLION_USD": 1, "USD_PER_LOT": 2, "PERCENTAGE_OF_VALUE": 3, "QUOTE_CCY_PER_LOT": 4,
    },
    "symbolDistanceType": {"SYMBOL_DISTANCE_IN_POINTS": 1, "SYMBOL_DISTANCE_IN_PERCENTAGE": 2},
    "minCommissionType": {"CURRENCY": 1, "QUOTE_CURRENCY": 2},
    "tradingMode": {
        "ENABLED": 0, "DISABLED_WITHOUT_PENDINGS_EXECUTION": 1, "DISABLED_WITH_PENDINGS_EXECUTION": 2,
        "CLOSE_ONLY_MODE": 3,
    },
    "swapCalculationType": {"PIPS": 0, "PERCENTAGE": 1},
    "accessRights": {"FULL_ACCESS": 0, "CLOSE_ONLY": 1, "NO_TRADING": 2, "NO_LOGIN": 3},
    "totalMarginCalculationType": {"MAX": 0, "SUM": 1, "NET": 2},
    "accountType": {"HEDGED": 0, "NETTED": 1, "SPREAD_BETTING": 2},
    "positionStatus": {
        "POSITION_STATUS_OPEN": 1, "POSITION_STATUS_CLOSED": 2, "POSITION_STATUS_CREATED": 3,
        "POSITION_STATUS_ERROR": 4,
    },
    "tradeSide": {"BUY": 1, "SELL": 2},
    "orderType": {
        "MARKET": 1, "LIMIT": 2, "STOP": 3, "STOP_LOSS_TAKE_PROFIT": 4, "MARKET_RANGE": 5, "STOP_LIMIT": 6,
    },
    "timeInForce": {
        "GOOD_TILL_DATE": 1, "GOOD_TILL_CANCEL": 2, "IMMEDIATE_OR_CANCEL": 3, "FILL_OR_KILL": 4,
        "MARKET_ON_OPEN": 5,
    },
    "orderStatus": {
        "ORDER_STATUS_ACCEPTED": 1, "ORDER_STATUS_FILLED": 2, "ORDER_STATUS_REJECTED": 3,
        "ORDER_STATUS_EXPIRED": 4, "ORDER_STATUS_CANCELLED": 5,
    },
    "orderTriggerMethod": {"TRADE": 1, "OPPOSITE": 2, "DOUBLE_TRADE": 3, "DOUBLE_OPPOSITE": 4},
    "executionType": {
        "ORDER_ACCEPTED": 2, "ORDER_FILLED": 3, "ORDER_REPLACED": 4, "ORDER_CANCELLED": 5, "ORDER_EXPIRED": 6,
        "ORDER_REJECTED": 7, "ORDER_CANCEL_REJECTED": 8, "SWAP": 9, "DEPOSIT_WITHDRAW": 10,
        "ORDER_PARTIAL_FILL": 11, "BONUS_DEPOSIT_WITHDRAW": 12,
    },
    "changeBonusType": {"BONUS_DEPOSIT": 0, "BONUS_WITHDRAW": 1},
    "changeBalanceType": {
        "BALANCE_DEPOSIT": 0, "BALANCE_WITHDRAW": 1, "BALANCE_DEPOSIT_STRATEGY_COMMISSION_INNER": 3,
        "BALANCE_WITHDRAW_STRATEGY_COMMISSION_INNER": 4, "BALANCE_DEPOSIT_IB_COMMISSIONS": 5,
        "BALANCE_WITHDRAW_IB_SHARED_PERCENTAGE": 6, "BALANCE_DEPOSIT_IB_SHARED_PERCENTAGE_FROM_SUB_IB": 7,
        "BALANCE_DEPOSIT_IB_SHARED_PERCENTAGE_FROM_BROKER": 8, "BALANCE_DEPOSIT_REBATE": 9,
        "BALANCE_WITHDRAW_REBATE": 10, "BALANCE_DEPOSIT_STRATEGY_COMMISSION_OUTER": 11,
        "BALANCE_WITHDRAW_STRATEGY_COMMISSION_OUTER": 12, "BALANCE_WITHDRAW_BONUS_COMPENSATION": 13,
        "BALANCE_WITHDRAW_IB_SHARED_PERCENTAGE_TO_BROKER": 14, "BALANCE_DEPOSIT_DIVIDENDS": 15,
        "BALANCE_WITHDRAW_DIVIDENDS": 16, "BALANCE_WITHDRAW_GSL_CHARGE": 17, "BALANCE_WITHDRAW_ROLLOVER": 18,
        "BALANCE_DEPOSIT_NONWITHDRAWABLE_BONUS": 19, "BALANCE_WITHDRAW_NONWITHDRAWABLE_BONUS": 20,
        "BALANCE_DEPOSIT_SWAP": 21, "BALANCE_WITHDRAW_SWAP": 22, "BALANCE_DEPOSIT_MANAGEMENT_FEE": 27,
        "BALANCE_WITHDRAW_MANAGEMENT_FEE": 28, "BALANCE_DEPOSIT_PERFORMANCE_FEE": 29,
        "BALANCE_WITHDRAW_FOR_SUBACCOUNT": 30, "BALANCE_DEPOSIT_TO_SUBACCOUNT": 31,
        "BALANCE_WITHDRAW_FROM_SUBACCOUNT": 32, "BALANCE_DEPOSIT_FROM_SUBACCOUNT": 33,
        "BALANCE_WITHDRAW_COPY_FEE": 34, "BALANCE_WITHDRAW_INACTIVITY_FEE": 35, "BALANCE_DEPOSIT_TRANSFER": 36,
        "BALANCE_WITHDRAW_TRANSFER": 37, "BALANCE_DEPOSIT_CONVERTED_BONUS": 38,
        "BALANCE_DEPOSIT_NEGATIVE_BALANCE_PROTECTION": 39,
    },
    "dealStatus": {
        "FILLED": 2, "PARTIALLY_FILLED": 3, "REJECTED": 4, "INTERNALLY_REJECTED": 5, "ERROR": 6, "MISSED": 7,
    },
    "trendbarPeriod": {
        "M1": 1, "M2": 2, "M3": 3, "M4": 4, "M5": 5, "M10": 6, "M15": 7, "M30": 8, "H1": 9, "H4": 10, "H12": 11,
        "D1": 12, "W1": 13, "MN1": 14,
    },
    "quoteType": {"BID": 1, "ASK": 2},
    "permissionScope": {"SCOPE_VIEW": 0, "SCOPE_TRADE": 1},
    "notificationType": {
        "MARGIN_LEVEL_THRESHOLD_1": 61, "MARGIN_LEVEL_THRESHOLD_2": 62, "MARGIN_LEVEL_THRESHOLD_3": 63,
    },
    "errorCode": {
        "OA_AUTH_TOKEN_EXPIRED": 1, "ACCOUNT_NOT_AUTHORIZED": 2, "ALREADY_LOGGED_IN": 14,
        "CH_CLIENT_AUTH_FAILURE": 101, "CH_CLIENT_NOT_AUTHENTICATED": 102, "CH_CLIENT_ALREADY_AUTHENTICATED": 103,
        "CH_ACCESS_TOKEN_INVALID": 104, "CH_SERVER_NOT_REACHABLE": 105, "CH_CTID_TRADER_ACCOUNT_NOT_FOUND": 106,
        "CH_OA_CLIENT_NOT_FOUND": 107, "REQUEST_FREQUENCY_EXCEEDED": 108, "SERVER_IS_UNDER_MAINTENANCE": 109,
        "CHANNEL_IS_BLOCKED": 110, "CONNECTIONS_LIMIT_EXCEEDED": 67, "WORSE_GSL_NOT_ALLOWED": 68,
        "SYMBOL_HAS_HOLIDAY": 69, "NOT_SUBSCRIBED_TO_SPOTS": 112, "ALREADY_SUBSCRIBED": 113, "SYMBOL_NOT_FOUND": 114,
        "UNKNOWN_SYMBOL": 115, "INCORRECT_BOUNDARIES": 35, "NO_QUOTES": 117, "NOT_ENOUGH_MONEY": 118,
        "MAX_EXPOSURE_REACHED": 119, "POSITION_NOT_FOUND": 120, "ORDER_NOT_FOUND": 121, "POSITION_NOT_OPEN": 122,
        "POSITION_LOCKED": 123, "TOO_MANY_POSITIONS": 124, "TRADING_BAD_VOLUME": 125, "TRADING_BAD_STOPS": 126,
        "TRADING_BAD_PRICES": 127, "TRADING_BAD_STAKE": 128, "PROTECTION_IS_TOO_CLOSE_TO_MARKET": 129,
        "TRADING_BAD_EXPIRATION_DATE": 130, "PENDING_EXECUTION": 131, "TRADING_DISABLED": 132,
        "TRADING_NOT_ALLOWED": 133, "UNABLE_TO_CANCEL_ORDER": 134, "UNABLE_TO_AMEND_ORDER": 135,
        "SHORT_SELLING_NOT_ALLOWED": 136,
    },
    "commonErrorCode": {
        "UNKNOWN_ERROR": 1, "UNSUPPORTED_MESSAGE": 2, "INVALID_REQUEST": 3, "TIMEOUT_ERROR": 5, "ENTITY_NOT_FOUND": 6,
        "CANT_ROUTE_REQUEST": 7, "FRAME_TOO_LONG": 8, "MARKET_CLOSED": 9, "CONCURRENT_MODIFICATION": 10,
        "BLOCKED_PAYLOAD_TYPE": 11,
    },
    "limitedRiskMarginStrategy": {
        "ACCORDING_TO_LEVERAGE": 0, "ACCORDING_TO_GSL": 1, "ACCORDING_TO_GSL_AND_LEVERAGE": 2,
    },
}

# The instruments the bar and option loads cover, the bar size and the request limits.
STOCKS = ("AAPL", "MSFT", "GOOGL", "AMZN", "TSLA", "META", "NVDA", "JPM", "V", "WMT")
CRYPTO_PAIRS = (
    "SOL/USD", "XRP/USD", "ADA/USD", "DOGE/USD", "DOT/USD", "MATIC/USD", "LINK/USD", "AVAX/USD", "UNI/USD",
    "ATOM/USD",
)
BAR_TIMEFRAME = "5Min"
BAR_LIMIT = 10000
SNAPSHOT_LIMIT = 1
DETAIL_BATCH_SIZE = 100
BATCH_LOOKBACK_DAYS = 90
INCREMENTAL_LOOKBACK_DAYS = 1
RESPONSE_TIMEOUT_SECONDS = 5
