"""Explicit schemas of raw pages, catalogs and stored tables. Nothing here is ever inferred.

Each name of _DDL is an attribute of this module, a StructType; it is parsed when first used, as that takes a session.
"""

from __future__ import annotations

from pyspark.sql.types import StructType

_OLD = "open:string,high:string,low:string,close:string"
_NEW = "open_dollars:string,high_dollars:string,low_dollars:string,close_dollars:string,mean_dollars:string"

_DDL: dict[str, str] = {}

#: Text of a page that cannot be read as its schema says; Spark's name for it.
BROKEN = "_corrupt_record"

#: One candle page; holds both wire shapes, whose fields do not collide. Dataset and ticker come with the page. Numbers of
#: pages and candles are read as texts, so that a wrong one is seen and not NULL.
_DDL["CANDLE_PAGE"] = (
    "market_ticker string, tape string, period_minutes string, start_ts string, ingest_ts string, adjustedEndTs string, candlesticks array<struct<"
    f"end_period_ts:string,volume:string,open_interest:string,volume_fp:string,open_interest_fp:string,price:struct<{_OLD},mean:string,{_NEW}>,yes_bid:struct<{_OLD}>>>, {BROKEN} string"
)
_TRADE = "trade_id:string,ticker:string,created_time:string,yes_price_dollars:string,no_price_dollars:string,count_fp:string,taker_side:string,is_block_trade:boolean"
_DDL["TRADE_PAGE"] = f"tape string, ingest_ts string, page string, cursor string, trades array<struct<{_TRADE}>>, {BROKEN} string"
_DDL["BOOK_PAGE"] = f"market_ticker string, ts_ms string, ingest_ts string, page string, orderbook_fp struct<yes_dollars:array<array<string>>,no_dollars:array<array<string>>>, {BROKEN} string"
_MARKET = "ticker:string,event_ticker:string,title:string,status:string,open_time:string,expiration_time:string,latest_expiration_time:string"
_DDL["MARKET_PAGE"] = f"listing string, cursor string, markets array<struct<{_MARKET}>>, {BROKEN} string"
_DDL["EVENT_PAGE"] = f"listing string, variant string, cursor string, events array<struct<event_ticker:string,title:string,series_ticker:string>>, {BROKEN} string"
_DDL["EVENT_PAYLOAD"] = f"event struct<event_ticker:string,title:string,series_ticker:string>, markets array<struct<{_MARKET}>>, {BROKEN} string"
_DDL["MARKET_PAYLOAD"] = f"tape string, ingest_ts bigint, market struct<{_MARKET}>, {BROKEN} string"
_DDL["SERIES_PAGE"] = f"series array<struct<ticker:string,title:string,category:string,frequency:string,tags:array<string>>>, {BROKEN} string"
_DDL["CATALOG"] = (
    "series string, events array<struct<event_ticker:string,title:string>>, "
    "markets array<struct<event_ticker:string,market_ticker:string,title:string,status:string,source:string>>, tickers array<string>"
)
_DDL["TICKER_LIST"] = "tickers array<string>"

_DDL["CANDLES"] = (
    "ts_ms bigint, open double, high double, low double, close double, mean double, volume double, open_interest double, "
    "market_ticker string, event_ticker string, series_ticker string"
)
_DDL["TRADES"] = "trade_id string, market_ticker string, ts_ms bigint, yes_price double, no_price double, count double, taker_side string"
_DDL["ORDERBOOK"] = "ts_ms bigint, market_ticker string, side string, price double, quantity double, cumulative_qty double, distance_from_top bigint"
_DDL["QUARANTINE"] = "dataset string, market_ticker string, reason string, payload string"
#: Stored beside each table, for each partition, ticker and month of it.
_DDL["SUMMARY"] = (
    "market_ticker string, at_month string, n_rows bigint, first_ts_ms bigint, last_ts_ms bigint, volume double, last_trade_id string, days array<struct<ts_ms:bigint,volume:double>>"
)

#: Keys under which the last row wins.
CANDLE_KEY = ("ts_ms", "market_ticker")
TRADE_KEY = ("trade_id",)
BOOK_KEY = ("ts_ms", "market_ticker", "side", "price")


def __getattr__(name: str) -> StructType:
    if name not in _DDL:
        raise AttributeError(name)
    globals()[name] = schema = StructType.fromDDL(_DDL[name])
    return schema
