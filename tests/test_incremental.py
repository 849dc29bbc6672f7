from __future__ import annotations

import pytest

from marketlake.operators import audit as A
from marketlake.operators import incremental as I
from marketlake.operators import quality as Q


def tape(spark, *rows):
    return spark.createDataFrame(list(rows), "trade_id string, market_ticker string, ts_ms bigint")


def test_resume_points(spark):
    tickers = spark.createDataFrame([(t,) for t in "ABCD"], "market_ticker string")
    stored = spark.createDataFrame([("A", 5999), ("A", 1000), ("B", 99_000)], "market_ticker string, ts_ms bigint")
    meta = spark.createDataFrame([("A", 1), ("C", 7500), ("D", None)], "market_ticker string, open_ts_ms bigint")
    points = I.resume_points(tickers, stored, meta, as_of_s=99)
    got = {r.market_ticker: (r.start_s, r.reason) for r in points.collect()}
    assert got == {"A": (5, None), "B": (99, "up to date"), "C": (7, None), "D": (None, "no stored rows and no open time")}
    assert {r.start_s for r in I.resume_points(tickers, stored, meta, 99, since_s=50).collect()} == {50}
    counters = Q.run_counters(points, 12, 0.7).first()
    assert (counters.processed, counters.skipped, counters.rows_written) == (2, 2, 12)
    assert Q.skipped(points, "daily").count() == 2


@pytest.mark.parametrize(("minutes", "days"), [(1, 3), (60, 30), (1440, 365)])
def test_windows_cover_without_gap(spark, minutes, days):
    end = 1000 * 86_400 + 7
    points = spark.createDataFrame([("A", 5), ("B", end), ("C", None), ("D", end - 1)], "market_ticker string, start_s bigint")
    got = sorted((r.market_ticker, r.window_start_s, r.window_end_s) for r in I.windows(points, end, minutes).collect())
    a = [w for w in got if w[0] == "A"]
    assert a[0][1] == 5 and a[-1][2] == end and all(x[2] == y[1] for x, y in zip(a, a[1:]))
    assert all(w[2] - w[1] <= days * 86_400 for w in got)
    assert [w for w in got if w[0] != "A"] == [("D", end - 1, end)]


def test_truncated_and_missing(spark):
    pages = spark.createDataFrame([("A", 0, 50, 5000), ("A", 60, 60, 5000), ("B", 0, 9, 4999), ("C", 0, None, 6000)], "market_ticker string, start_ts bigint, adjusted_end_ts bigint, n_candles int")
    assert [tuple(r) for r in I.truncated_pages(pages).collect()] == [("A", 50)]
    work = spark.createDataFrame([("A", 0, 1), ("A", 60, 61), ("D", 0, 1)], "market_ticker string, window_start_s bigint, window_end_s bigint")
    assert [r.market_ticker for r in I.missing_windows(work, pages).collect()] == ["D"]


def test_new_trades(spark):
    stored = tape(spark, ("a", "T", 10), ("b", "T", 20))
    fetched = tape(spark, ("a", "T", 10), ("b", "T", 20), ("c", "T", 20), ("d", "T", 5), ("e", "T", 30), ("f", "U", 1))
    ids = lambda df: sorted(r.trade_id for r in df.collect())
    assert ids(I.new_trades(fetched, stored)) == ["c", "d", "e", "f"]
    assert ids(I.new_trades(fetched, stored, "strict_ts")) == ["e", "f"]
    assert ids(I.new_trades(fetched.where("trade_id <> 'b'"), stored, "strict_ts")) == ["a", "c", "d", "e", "f"]
    assert ids(I.new_trades(fetched, stored, since_ms=20)) == ["c", "e"]
    with pytest.raises(ValueError):
        I.new_trades(fetched, stored, "none")
    assert {r.last_trade_id for r in I.latest_trades(fetched).collect()} == {"e", "f"}


def test_range_and_focus(spark):
    rows = tape(spark, ("a", "T", 999), ("b", "T", 1000), ("c", "U", 2000))
    assert sorted(r.trade_id for r in I.in_range(rows, 1, 2).collect()) == ["b"]
    assert I.only(rows, spark.createDataFrame([("U",), ("U",)], "market_ticker string")).count() == 1


def test_audit(spark, tmp_path):
    as_of = 100 * 86_400_000
    edge = as_of - A.RECENT_MS
    daily = spark.createDataFrame(
        [("A", "S", edge, 100.0), ("A", "S", edge - 1, 1.0), ("B", "S", 0, 1000.0), ("B", "S", 1, None), ("C", "R", as_of, 500.0), ("D", "R", 3, float("nan"))],
        "market_ticker string, series_ticker string, ts_ms bigint, volume double",
    )
    rows = A.audit_tickers(daily, as_of)
    got = {r.ticker: (r.daily_rows, r.total_volume, r.recent_volume_30d, r.hourly_expectation, r.minute_expectation) for r in rows.collect()}
    assert got == {
        "A": (2, 101.0, 100.0, "dense", "sparse"), "B": (2, 1000.0, 0.0, "dense", "sparse"),
        "C": (1, 500.0, 500.0, "dense", "dense"), "D": (1, 0.0, 0.0, "sparse", "sparse"),
    }
    total = {(r.series, r.is_total): (r.n_tickers, r.daily_rows, r.dense_hourly, r.dense_minute) for r in A.audit_series(rows).collect()}
    assert total == {("S", False): (2, 4, 2, 0), ("R", False): (2, 2, 1, 1), (None, True): (4, 6, None, None)}
    A.write_audit(rows, str(tmp_path), "2026-01-02")
    assert list((tmp_path / "audit_20260102").glob("*.csv"))
    assert [r.market_ticker for r in A.coverage(daily).collect()] == ["A", "B", "C", "D"]


def test_missing(spark):
    tickers = spark.createDataFrame([(t,) for t in "CBA"], "market_ticker string")
    stored = spark.createDataFrame([("B",)], "market_ticker string")
    assert [r[0] for r in A.missing_tickers(tickers, stored).collect()] == ["A", "C"]
    assert A.missing_tickers(tickers, stored, show=2).count() == 2 and A.missing_tickers(tickers, stored, show=1).count() == 0
