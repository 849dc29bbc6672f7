from __future__ import annotations

import json

from marketlake.operators.upsert import read_table, tables
from marketlake.streaming import feeds


def put(folder, name, *pages):
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text("\n".join(json.dumps(p) for p in pages))


def candle_page(ticker, minutes, ingest, *bars):
    raw = [{"end_period_ts": t, "volume": str(v), "open_interest": "1", "price": dict.fromkeys(("open", "high", "low", "close", "mean"), p), "yes_bid": {}} for t, p, v in bars]
    return {"market_ticker": ticker, "tape": "historical", "period_minutes": minutes, "start_ts": 0, "ingest_ts": ingest, "candlesticks": raw}


def rows(spark, root, name):
    return sorted((r.market_ticker, r.ts_ms, r.close) for r in read_table(spark, root, tables()[name]).collect())


def test_stream_equals_batch_with_late_duplicate_and_bad_rows(spark, tmp_path):
    landing, root = tmp_path / "landing", str(tmp_path / "lake")
    first = candle_page("KXCPI-1", 1440, 1, (86_400, "0.5", 3), (172_800, "0.6", 4))
    put(landing / "candles", "1.json", first, candle_page("KXCPI-1", 60, 1, (3600, "0.1", 1)))
    for q in feeds.start_feeds(spark, str(landing), root, only=("daily", "hourly"), once=True).values():
        q.awaitTermination()
    assert rows(spark, root, "daily") == [("KXCPI-1", 86_400_000, 0.5), ("KXCPI-1", 172_800_000, 0.6)]
    fixed = candle_page("KXCPI-1", 1440, 2, (172_800, "0.9", 5), (3, "0.2", 1), (None, "0.3", 1))
    put(landing / "candles", "2.json", fixed, first)
    feeds.start_feed(spark, "daily", str(landing), root, once=True).awaitTermination()
    want = [("KXCPI-1", 3000, 0.2), ("KXCPI-1", 86_400_000, 0.5), ("KXCPI-1", 172_800_000, 0.9)]
    assert rows(spark, root, "daily") == want
    assert rows(spark, root, "hourly") == [("KXCPI-1", 3_600_000, 0.1)]
    assert spark.read.parquet(f"{root}/quarantine").where("dataset = 'daily'").count() == 1
    put(landing / "trades", "1.json", {"tape": "live", "ingest_ts": 1, "page": 0, "trades": []})
    other = str(tmp_path / "batch")
    assert feeds.backfill(spark, str(landing), other) == {"daily": 3, "hourly": 1, "minute": 0, "trades": 0}
    assert rows(spark, other, "daily") == want


def test_trades_and_books(spark, tmp_path):
    landing, root = tmp_path / "landing", str(tmp_path / "lake")
    trade = {"trade_id": "a", "ticker": "KXCPI-1", "created_time": "2022-07-28T13:31:07.6Z", "yes_price_dollars": "0.9", "no_price_dollars": "0.1", "count_fp": "1", "taker_side": "yes"}
    put(landing / "trades", "1.json", {"tape": "live", "ingest_ts": 9, "page": 0, "trades": [trade]}, {"tape": "historical", "ingest_ts": 1, "page": 0, "trades": [{**trade, "count_fp": "2"}]})
    book = {"yes_dollars": [["0.4", "1"]], "no_dollars": None}
    put(landing / "orderbook", "1.json", {"market_ticker": "IN", "ts_ms": 1, "orderbook_fp": book}, {"market_ticker": "OUT", "ts_ms": 1, "orderbook_fp": book})
    for q in feeds.start_feeds(spark, str(landing), root, only=("trades", "orderbook"), once=True, focus=["IN"]).values():
        q.awaitTermination()
    assert [(r.trade_id, r["count"], r.series_ticker) for r in read_table(spark, root, tables()["trades"]).collect()] == [("a", 2.0, "KXCPI")]
    assert [r.market_ticker for r in read_table(spark, root, tables()["orderbook"]).collect()] == ["IN"]


def test_a_repeated_batch_changes_nothing_and_bad_values_are_quarantined(spark, tmp_path):
    trade = {"trade_id": "a", "ticker": "KXCPI-1", "created_time": "2022-07-28T13:31:07.6Z", "yes_price_dollars": "0.9", "no_price_dollars": "0.1", "count_fp": "1", "taker_side": "yes"}
    odd = [{**trade, "trade_id": "b", "yes_price_dollars": "n/a"}, {**trade, "trade_id": "c", "count_fp": "NaN"}, {**trade, "trade_id": "d", "no_price_dollars": None}, {**trade, "trade_id": None}]
    put(tmp_path / "landing", "1.json", {"tape": "live", "ingest_ts": 9, "page": 0, "trades": [trade, *odd]})
    _, schema, rows_of = feeds.feeds()["trades"]
    root = str(tmp_path / "lake")
    for _ in range(2):
        feeds.merge_batch(spark.read.schema(schema).json(str(tmp_path / "landing")), "trades", root, rows_of, batch_id="5")
    assert sorted((r.trade_id, r["count"]) for r in read_table(spark, root, tables()["trades"]).collect()) == [("a", 1.0), ("c", None), ("d", 1.0)]
    bad = spark.read.parquet(f"{root}/quarantine").collect()
    assert sorted((r.dataset, r.reason) for r in bad) == [("trades", "cannot parse yes_price n/a"), ("trades", "no trade_id")]
    assert all("KXCPI-1" in r.payload for r in bad)
