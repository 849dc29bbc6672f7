from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from marketlake.functions import scalars as S
from marketlake.operators import catalog as C
from marketlake.sources import landing

TICKERS = ["FEDDECISION-23JUL-C>25", "GDP-232022 Q4-T0.0", "KXPAYROLLS-24DEC-T-100000", "CPI-22AUG-TN0.1", "KXRECSSNBER-26"]


@pytest.fixture
def folder(tmp_path):
    def put(series, events, markets):
        rows = [dict(zip(("event_ticker", "market_ticker", "title", "status", "source"), m)) for m in markets]
        doc = {"series": series, "events": [{"event_ticker": e, "title": t} for e, t in events], "markets": rows, "tickers": sorted({m[1] for m in markets})}
        (tmp_path / f"{series}_tickers.json").write_text(json.dumps(doc, indent=1))

    put("KXA", [("KXA-1", "one"), ("A-2", "two")], [("KXA-1", "KXA-1-T1", "x", "active", "live_event"), ("A-2", "A-23-T", "y above_below_between", "finalized", "historical")])
    put("KXB", [("KXB-1", "b")], [("KXB-1", "KXB-1", "z", "active", "live_event"), ("KXB-1", "A-23-T", "again", "active", "live_event")])
    (tmp_path / "all_tickers.json").write_text(json.dumps({"series": ["KXA"], "tickers": ["no"]}))
    return str(tmp_path)


def test_ticker_sources(spark, tmp_path, folder):
    (tmp_path / "t.txt").write_text("\n  KXB-1\t\n\nA-23-T\r\nKXB-1\n")
    read = lambda *a, **k: [r[0] for r in landing.tickers(spark, *a, **k).collect()]
    assert read(f"{folder}/t.txt") == ["A-23-T", "KXB-1"]
    assert read(f"{folder}/KXA_tickers.json") == ["A-23-T", "KXA-1-T1"]
    assert read("KXRECSSNBER-26") == ["KXRECSSNBER-26"]
    assert read(TICKERS) == sorted(TICKERS)
    assert read(TICKERS, limit=2) == sorted(TICKERS)[:2] and read(TICKERS, limit=0) == sorted(TICKERS)


def test_stored_table_may_be_absent(spark, tmp_path):
    from marketlake import schemas

    assert landing.stored(spark, str(tmp_path / "none"), schemas.CANDLES).count() == 0


def test_plain_files_of_another_layout(spark, tmp_path):
    """One file per ticker in folders that mean nothing; a column without values has no type of its own."""
    import pyarrow as pa
    import pyarrow.parquet as pq

    from marketlake import schemas
    from marketlake.operators.audit import coverage

    for ticker, n in (("A>1", 2), ("B 2", 1)):
        (tmp_path / "2026" / ticker).mkdir(parents=True)
        cols = {"ts_ms": list(range(n)), "open": [0.5] * n, "mean": pa.nulls(n), "market_ticker": [ticker] * n}
        pq.write_table(pa.table(cols), tmp_path / "2026" / ticker / "x.parquet")
    rows = landing.stored(spark, str(tmp_path), schemas.CANDLES, layout="files")
    assert {(r.market_ticker, r["mean"], r.volume) for r in rows.collect()} == {("A>1", None, None), ("B 2", None, None)}
    assert [(r.market_ticker, r.n_rows) for r in coverage(rows).collect()] == [("A>1", 2), ("B 2", 1)]


def test_meta_last_file_wins_and_fallback(spark, folder):
    meta = C.ticker_meta(landing.catalogs(spark, folder))
    assert {(r.market_ticker, r.series_ticker) for r in meta.collect()} == {("KXA-1-T1", "KXA"), ("A-23-T", "KXB"), ("KXB-1", "KXB")}
    facts = spark.createDataFrame([("A-23-T",), ("KXCPIYOY-26JUL-T3.5",), ("CPIYOY-1",), ("KXFED",)], "market_ticker string")
    got = {r.market_ticker: (r.series_ticker, r.event_ticker) for r in C.with_ticker_meta(facts, meta).collect()}
    assert got == {"A-23-T": ("KXB", "KXB-1"), "KXCPIYOY-26JUL-T3.5": ("KXCPIYOY",) + ("KXCPIYOY-26JUL-T3.5",), "CPIYOY-1": ("CPIYOY", "CPIYOY-1"), "KXFED": ("KXFED", "KXFED")}


def test_catalog_members_counts_and_exports(spark, folder, tmp_path):
    cats = landing.catalogs(spark, folder)
    assert [r[0] for r in C.catalog(cats).collect()] == ["A-23-T", "KXA-1-T1", "KXB-1"]
    assert C.catalog(cats, "events").count() == 3 and C.catalog(cats, "markets").count() == 4 and C.catalog(cats, "all").count() == 2
    with pytest.raises(ValueError):
        C.catalog(cats, "prices")
    counts = {r.series: (r.n_events, r.n_markets, r.n_tickers) for r in C.catalog_counts(cats).collect()}
    assert counts == {"KXA": (2, 2, 2), "KXB": (1, 2, 2), None: (3, 4, 3)}
    C.write_catalog(cats, str(tmp_path / "out"))
    (text,) = (tmp_path / "out/txt/of=KXB").glob("*.txt")
    assert text.read_text().split() == ["A-23-T", "KXB-1"]
    C.write_combined(cats, str(tmp_path / "all"))
    (one,) = (tmp_path / "all/json").glob("*.json")
    doc = json.loads(one.read_text())
    assert (doc["series"], doc["total_events"], doc["total_markets"], doc["tickers"]) == (["KXA", "KXB"], 3, 4, ["A-23-T", "KXA-1-T1", "KXB-1"])
    assert doc["by_series"]["KXB"] == {"events": 1, "markets": 2, "tickers": ["A-23-T", "KXB-1"]}


def test_spellings(spark):
    rows = spark.createDataFrame([("KXCPI",), ("GDP",)], "series string")
    got = [(r.series, r.variant_pos, r.variant) for r in C.series_variants(rows).collect()]
    assert got == [("KXCPI", 0, "KXCPI"), ("KXCPI", 1, "CPI"), ("GDP", 0, "KXGDP"), ("GDP", 1, "GDP")]
    events = spark.createDataFrame([("CPI-22AUG",), ("KXRECSSNBER",)], "e string").select(S.series_of_event("e").alias("s"))
    assert [r.s for r in events.collect()] == ["KXCPI", "KXRECSSNBER"]


def test_discovery_takes_first_title(spark):
    listings = spark.createDataFrame(
        [("live", "KXA", 0, "KXA-1", "live"), ("events", "KXA", 5, "KXA-1", "first"), ("events", "A", 0, "KXA-1", "old"), ("historical", "A", 0, "A-9", "nine"), ("events", "KXA", 1, "", "none"), ("events", "KXA", 2, None, "none")],
        "listing string, variant string, pos int, event_ticker string, title string",
    )
    got = C.discovered_events(listings, spark.createDataFrame([("KXA",)], "series string")).collect()
    assert [(r.series, r.event_ticker, r.title) for r in got] == [("KXA", "A-9", "nine"), ("KXA", "KXA-1", "first")]


def test_market_tiers(spark):
    def tier(source, *rows):
        df = spark.createDataFrame([(e, m, None, "open") for e, m in rows], "event_ticker string, ticker string, title string, status string")
        return C.market_rows(df, source)

    events = spark.createDataFrame([("E1",), ("E2",), ("E3",)], "event_ticker string")
    got = C.markets_of_events(events, tier("live_event", ("E1", "a")), tier("live_markets", ("E1", "b"), ("E2", "c"), ("E2", "d")), tier("historical", ("E2", "e"), ("E4", "f")))
    assert sorted((r.event_ticker, r.market_ticker, r.title, r.source) for r in got.collect()) == [("E1", "a", "", "live_event"), ("E2", "c", "", "live_markets"), ("E2", "d", "", "live_markets")]


def test_one_market_of_event(spark):
    tier = lambda *rows: spark.createDataFrame(list(rows), "event_ticker string, market_ticker string, pos int")
    events = spark.createDataFrame([("E1",), ("E2",), ("E3",), ("E4",)], "event_ticker string")
    known = spark.createDataFrame([("E3",), ("E1",)], "market_ticker string")
    got = C.market_of_event(events, tier(("E1", "z", 0), ("E1", "a", 1)), tier(("E1", "b", 0), ("E2", "c", 3)), known_markets=known)
    assert {r.event_ticker: r.market_ticker for r in got.collect()} == {"E1": "z", "E2": "c", "E3": "E3", "E4": None}


def test_resolved_events(spark):
    schema = "event_ticker string, series_ticker string, markets array<string>"
    got = C.resolved_events(
        spark.createDataFrame([("CPI-1",), ("X-2",), ("KXY-3",)], "event_ticker string"),
        spark.createDataFrame([("CPI-1", "KXCPI", ["m"])], schema),
        spark.createDataFrame([("CPI-1", "no", ["n"]), ("X-2", "", ["o"])], schema),
    )
    assert {r.event_ticker: (r.series_ticker, r.markets) for r in got.collect()} == {"CPI-1": ("KXCPI", ["m"]), "X-2": ("KXX", ["o"]), "KXY-3": ("KXY", [])}


def test_metadata_tiers(spark):
    schema = "ticker string, open_time string, expiration_time string, latest_expiration_time string, status string"
    live = C.metadata_columns(spark.createDataFrame([("A", "2022-07-28T13:31:07.61886Z", "", "2023", None), ("B", None, "x", "y", "open")], schema))
    old = C.metadata_columns(spark.createDataFrame([("B", "2020-01-01T00:00:00Z", "o", "o", "o"), ("C", "bad", None, None, "")], schema))
    got = C.market_metadata(spark.createDataFrame([(t,) for t in "ABCD"], "market_ticker string"), live, old)
    assert {r.market_ticker: tuple(r)[1:] for r in got.collect()} == {
        "A": (1659015067618, "2023", "unknown"), "B": (None, "x", "open"), "C": (None, "unknown", "unknown"), "D": (None, "unknown", "unknown"),
    }


def test_series_listing(spark, tmp_path):
    page = {"series": [{"ticker": "A", "title": "t", "category": "Economics", "frequency": "monthly", "tags": ["x", "y"]}, {"ticker": "B", "category": None, "tags": None}]}
    (tmp_path / "s.json").write_text(json.dumps(page))
    rows = C.series_rows(landing.series_listing(spark, str(tmp_path / "s.json")))
    assert [r.tags for r in rows.orderBy("ticker").collect()] == ["x, y", ""]
    assert [r.ticker for r in C.in_category(rows).collect()] == ["A"]
    assert [(r.category, r.n) for r in C.category_counts(rows).collect()] == [("Economics", 1)]


def test_scalars(spark):
    row = spark.createDataFrame([("0.6900", "NaN", "x", 1999, 5.0, 2.5)], "a string, b string, c string, ms bigint, v double, w double").select(
        S.number("a"), S.number("b"), S.number_or_zero("c"), S.ms_to_seconds(S.F.col("ms")), S.volume_text("v"), S.volume_text("w"), S.day_of("ms"), S.year_month("ms"), S.day_to_ms("1970-01-02")
    )
    assert tuple(row.first()) == (0.69, None, 0.0, 1, "5", "2.5", "1970-01-01", "1970-01", 86_400_000)


def test_lookups_take_the_last_row_of_a_key(spark):
    tickers = spark.createDataFrame([("A",), ("B",)], "market_ticker string")
    live = spark.createDataFrame([(2, "A", 20, "x", "new"), (1, "A", 30, "y", "old")], "ingest_ts bigint, market_ticker string, open_ts_ms bigint, expiration string, status string")
    got = C.market_metadata(tickers, live, live.limit(0)).collect()
    assert sorted((r.market_ticker, r.status) for r in got) == [("A", "new"), ("B", "unknown")]
    facts = spark.createDataFrame([("A", 1), ("A", 2)], "market_ticker string, n int")
    meta = spark.createDataFrame([("A", "S", "E"), ("A", "S", "F")], "market_ticker string, series_ticker string, event_ticker string")
    assert sorted((r.n, r.event_ticker) for r in C.with_ticker_meta(facts, meta).collect()) == [(1, "F"), (2, "F")]
    both = spark.createDataFrame([("X-1", "S", ["m"]), ("X-1", "S", ["n"])], "event_ticker string, series_ticker string, markets array<string>")
    assert [r.markets for r in C.resolved_events(spark.createDataFrame([("X-1",)], "event_ticker string"), both, both).collect()] == [["n"]]


def test_member_counts_equal_those_of_the_catalog(spark):
    events = spark.createDataFrame([("S", "e1", "t"), ("S", "e1", "t"), ("S", "e2", "t"), ("T", "e3", None), ("U", "e4", "x")], "series string, event_ticker string, title string")
    markets = spark.createDataFrame([("S", "e1", "m1"), ("S", "e1", "m1"), ("T", "e3", "m1")], "series string, event_ticker string, market_ticker string")
    markets = markets.withColumns({c: F.lit("") for c in ("title", "status", "source")})
    key = lambda df: sorted(((r.series or "", r.n_events, r.n_markets, r.n_tickers) for r in df.collect()))
    assert key(C.member_counts(events, markets)) == key(C.catalog_counts(C.build_catalog(events, markets))) == [("", 4, 3, 1), ("S", 2, 2, 1), ("T", 1, 1, 1), ("U", 1, 0, 0)]
