from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from marketlake import schemas
from marketlake.operators import normalize, quality
from marketlake.sources import landing

OLD = {
    "end_period_ts": 1658980800, "volume": "5247.00", "open_interest": "7119.00",
    "price": {"open": "0.7900", "high": "0.7900", "low": "0.5900", "close": "0.6900", "mean": "0.6886"},
    "yes_bid": {"open": "0.7900", "high": "0.7900", "low": "0.2500", "close": "0.6500"},
}
NEW = {
    "end_period_ts": 1786161600, "volume_fp": "11747.08", "open_interest_fp": "897507.46",
    "price": {"open_dollars": "0.0700", "high_dollars": "0.0700", "low_dollars": "0.0300", "close_dollars": "0.0600", "mean_dollars": "0.0521"},
}
TRADES = [
    {"trade_id": "t-1", "ticker": "A-1", "created_time": "2022-07-28T13:31:07.61886Z", "yes_price_dollars": "0.9900", "no_price_dollars": "0.0100", "count_fp": "13.41", "taker_side": "yes", "is_block_trade": False},
    {"trade_id": "t-2", "ticker": "A-1", "created_time": "2022-07-28T13:09:01.664058Z", "yes_price_dollars": "0.5000", "no_price_dollars": "0.5000", "count_fp": "50.00", "taker_side": "yes", "is_block_trade": False},
]


def landed(tmp_path, *pages) -> str:
    path = tmp_path / "pages.json"
    path.write_text("\n".join(json.dumps(p) for p in pages))
    return str(path)


def candles(spark, tmp_path, tape, *raw):
    page = {"market_ticker": "A-1", "tape": tape, "period_minutes": 1440, "start_ts": 0, "ingest_ts": 1, "candlesticks": list(raw)}
    rows = normalize.normalize_candles(landing.candle_pages(spark, landed(tmp_path, page))).orderBy("_seq")
    return rows.collect()


def test_historical_candle(spark, tmp_path):
    (r,) = candles(spark, tmp_path, "historical", OLD)
    assert (r.ts_ms, r.close, r.volume, r.open_interest) == (1658980800000, 0.69, 5247.0, 7119.0)
    assert all(0 <= r[c] <= 1 for c in ("open", "high", "low", "close", "mean"))


def test_live_candle(spark, tmp_path):
    (r,) = candles(spark, tmp_path, "live", NEW)
    assert (r.ts_ms, r.close, r["mean"], r.volume, r.open_interest) == (1786161600000, 0.06, 0.0521, 11747.08, 897507.46)


def test_zero_is_a_price_and_missing_ones_come_from_bids(spark, tmp_path):
    zero = {**OLD, "price": {"open": "0.0000", "close": "0.0000"}, "yes_bid": dict.fromkeys(normalize.BARS, "0.5000")}
    bids = {**OLD, "price": {"mean": "0.5"}, "yes_bid": {"open": "0.40", "high": "0.60", "low": "0.30", "close": "0.55"}}
    null = {**OLD, "price": None}
    a, b, c = candles(spark, tmp_path, "historical", zero, bids, null)
    assert (a.open, a.close, a.high) == (0.0, 0.0, 0.5)
    assert (b.open, b.high, b.low, b.close) == (0.40, 0.60, 0.30, 0.55)
    assert (c.open, c["mean"]) == (0.79, None)


def test_absent_keys_are_null(spark, tmp_path):
    (r,) = candles(spark, tmp_path, "historical", {"end_period_ts": 5, "price": {}, "yes_bid": {}})
    assert [r[c] for c in ("open", "mean", "volume", "open_interest")] == [None] * 4
    (bad,) = candles(spark, tmp_path, "historical", {"price": {}})
    assert bad.ts_ms is None


def test_trades(spark, tmp_path):
    pages = landing.trade_pages(spark, landed(tmp_path, {"tape": "live", "ingest_ts": 1, "page": 0, "trades": TRADES, "cursor": ""}))
    rows = normalize.normalize_trades(normalize.unite_tapes(pages)).drop("_seq")
    assert rows.schema.simpleString() == schemas.TRADES.simpleString()
    got = rows.orderBy("ts_ms").collect()
    assert [(r.trade_id, r["count"]) for r in got] == [("t-2", 50.0), ("t-1", 13.41)]
    assert got[1].ts_ms == 1659015067618


def test_bad_rows_go_to_quarantine(spark):
    wire = spark.createDataFrame([{**TRADES[0], "count_fp": "x"}, {**TRADES[1], "created_time": "never"}, {**TRADES[0], "yes_price_dollars": "NaN"}, TRADES[0]])
    good, bad = quality.split_bad(normalize.normalize_trades(wire), "trades", ("trade_id", "ts_ms", "yes_price", "count"))
    assert good.count() == 1
    assert sorted(r.reason for r in bad.collect()) == ["no count", "no ts_ms", "no yes_price"]
    assert bad.schema.simpleString() == schemas.QUARANTINE.simpleString()


@pytest.fixture
def books(spark, tmp_path):
    both = {"yes_dollars": [["0.40", "10"], ["0.42", "5.5"], ["0.40", "1"]], "no_dollars": [["0.55", "7"]]}
    pages = [
        {"market_ticker": "A", "ts_ms": 1, "orderbook_fp": both},
        {"market_ticker": "B", "ts_ms": 1, "orderbook_fp": {"yes_dollars": None, "no_dollars": [["0.10", "2"]]}},
        {"market_ticker": "C", "ts_ms": 1, "orderbook_fp": {"yes_dollars": [], "no_dollars": None}},
    ]
    return normalize.book_levels(landing.book_pages(spark, landed(tmp_path, *pages)))


def test_book_levels(books):
    assert books.schema.simpleString() == schemas.ORDERBOOK.simpleString()
    yes = books.where("market_ticker = 'A' AND side = 'YES'").orderBy("distance_from_top").collect()
    assert [(r.price, r.quantity, r.cumulative_qty) for r in yes] == [(0.42, 5.5, 5.5), (0.40, 10.0, 15.5), (0.40, 1.0, 16.5)]
    assert {r.market_ticker for r in books.collect()} == {"A", "B"}


def test_top_of_book(books):
    top = {r.market_ticker: r for r in normalize.top_of_book(books).collect()}
    assert top["A"].yes_ask == pytest.approx(0.45) and top["A"].spread == pytest.approx(0.03) and top["A"].mid == pytest.approx(0.435)
    assert top["B"].yes_bid is None and top["B"].yes_ask == pytest.approx(0.9) and top["B"].mid is None


def test_violations(spark):
    rows = spark.createDataFrame([(1, 0.5, 2.0), (2, 1.5, 3.0), (3, float("nan"), float("nan")), (4, None, None)], "id int, close double, volume double")
    got = {(r.id, r.violated) for r in quality.violations(rows).collect()}
    assert got == {(2, "close"), (3, "close"), (3, "volume")}
    assert quality.violations(spark.createDataFrame([("x",)], "a string")).count() == 0
    assert quality.template_titles(spark.createDataFrame([("above_below_between 3",), ("CPI",)], "title string").withColumn("x", F.lit(1))).count() == 1
