"""Stored tables as a whole: recovery, summaries, places of keys, snapshots, broken pages, work lists, named files."""

from __future__ import annotations

import json
import random

import pytest
from pyspark.sql import functions as F

from marketlake import schemas
from marketlake.operators import catalog, incremental, normalize, quality
from marketlake.operators import upsert as U
from marketlake.sources import landing
from marketlake.streaming import feeds

MONTH = 31 * 86_400_000


def put(folder, name, *lines):
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text("\n".join(x if isinstance(x, str) else json.dumps(x) for x in lines))


def trades(spark, *rows):
    return spark.createDataFrame([(i, m, t, 0.5, 0.5, 1.0, "yes", m.split("-")[0]) for i, m, t in rows], U.tables()["trades"].schema)


def where(spark, root):
    return sorted((r.trade_id, r.series_ticker, r.ym) for r in U.read_table(spark, root, U.tables()["trades"]).collect())


def summed(df):
    return sorted((r.market_ticker, r.at_month, r.n_rows, r.first_ts_ms, r.last_ts_ms, r.volume, r.last_trade_id, sorted(tuple(d) for d in r.days or [])) for r in df.collect())


def test_a_key_that_moves_is_stored_once_and_an_empty_partition_goes(spark, tmp_path):
    root, table = str(tmp_path), U.tables()["trades"]
    assert U.upsert(trades(spark, ("a", "T-1", 0), ("b", "T > x", 1)), root, table) == 2
    assert U.upsert(trades(spark, ("a", "T-1", MONTH), ("c", "T-1", MONTH)), root, table) == 1
    assert where(spark, root) == [("a", "T", "1970-02"), ("b", "T > x", "1970-01"), ("c", "T", "1970-02")]
    assert not (tmp_path / "trades" / "series_ticker=T" / "ym=1970-01").exists()
    assert U.upsert(trades(spark, ("a", "T-1", 5)), root, table) == 0  # and back
    assert where(spark, root) == [("a", "T", "1970-01"), ("b", "T > x", "1970-01"), ("c", "T", "1970-02")]
    assert summed(U.read_summary(spark, root, table)) == summed(U.summarised(U.read_table(spark, root, table), table))


def test_tables_without_notes_get_them(spark, tmp_path):
    import shutil

    root, table = str(tmp_path), U.tables()["trades"]
    U.upsert(trades(spark, ("a", "T-1", 0), ("b", "S-1", 1)), root, table)
    for folder in ("_places", "_summary"):
        shutil.rmtree(tmp_path / folder)
    U.summarise(spark, root, table)
    assert summed(U.read_summary(spark, root, table)) == summed(U.summarised(U.read_table(spark, root, table), table))
    assert U.upsert(trades(spark, ("b", "S-1", MONTH)), root, table) == 0
    U.note_places(spark, root, table)
    assert U.upsert(trades(spark, ("b", "S-1", 2)), root, table) == 0
    assert where(spark, root) == [("a", "T", "1970-01"), ("b", "S", "1970-01")]


@pytest.mark.parametrize("at", ["before", "within"])
def test_a_run_that_breaks_off_is_finished_by_the_next(spark, tmp_path, monkeypatch, at):
    root, table = str(tmp_path), U.tables()["trades"]
    U.upsert(trades(spark, ("a", "T-1", 0), ("z", "S-1", 0)), root, table)

    def fail(*args):
        raise OSError("gone")

    moves, real = [], U.move

    def second(spark_, source, target):
        moves.append(target)
        if len(moves) == 2:
            fail()
        real(spark_, source, target)

    with monkeypatch.context() as m:
        m.setattr(U, "_publish" if at == "before" else "move", fail if at == "before" else second)
        with pytest.raises(OSError):
            U.upsert(trades(spark, ("a", "T-1", MONTH), ("b", "S-1", 3)), root, table, writer="feed")
    if at == "before":
        points = incremental.summarised_points(U.read_summary(spark, root, table))
        assert {(r.market_ticker, r.ts_ms) for r in points.collect()} == {("T-1", 0), ("S-1", 0)}
    assert U.upsert(trades(spark, ("c", "T-1", 9)), root, table, writer="feed") == 1
    assert where(spark, root) == [("a", "T", "1970-02"), ("b", "S", "1970-01"), ("c", "T", "1970-01"), ("z", "S", "1970-01")]
    assert summed(U.read_summary(spark, root, table)) == summed(U.summarised(U.read_table(spark, root, table), table))
    last = {r.market_ticker: (r.ts_ms, r.last_trade_id) for r in incremental.summarised_points(U.read_summary(spark, root, table)).collect()}
    assert last == {"T-1": (MONTH, "a"), "S-1": (3, "b")}


def book(ticker, ts, ingest, page, yes, no=None):
    return {"market_ticker": ticker, "ts_ms": ts, "ingest_ts": ingest, "page": page, "orderbook_fp": {"yes_dollars": yes, "no_dollars": no}}


def test_a_snapshot_is_one_however_often_it_lands(spark, tmp_path):
    two = [["0.4", "10"], ["0.3", "5"]]
    put(tmp_path / "in" / "orderbook", "1.json", book("A", 1, 1, 0, two), book("A", 1, 1, 0, two), book("A", 1, 0, 9, [["0.9", "1"]]))
    root = str(tmp_path / "lake")
    run = lambda: feeds.start_feed(spark, "orderbook", str(tmp_path / "in"), root, focus=["A", "B"], once=True).awaitTermination()
    levels = lambda: sorted((r.market_ticker, r.side, r.price, r.quantity, r.cumulative_qty, r.distance_from_top) for r in U.read_table(spark, root, U.tables()["orderbook"]).collect())
    run()
    assert levels() == [("A", "YES", 0.3, 5.0, 15.0, 1), ("A", "YES", 0.4, 10.0, 10.0, 0)]
    # fewer levels replace all of the snapshot; a quantity that is no number keeps a snapshot out; of equal prices the last stays
    put(tmp_path / "in" / "orderbook", "2.json", book("A", 1, 2, 0, None, [["0.5", "3"], ["0.5", "4"]]), book("B", 1, 2, 0, [["0.5", "n/a"], ["0.4", "1"]]), book("B", None, 2, 0, two), book("B", "x", 2, 0, two))
    run()
    assert levels() == [("A", "NO", 0.5, 4.0, 7.0, 1)]
    bad = spark.read.parquet(f"{root}/quarantine").collect()
    assert sorted(r.reason for r in bad) == ["cannot parse quantity n/a", "cannot parse ts_ms x", "no ts_ms"]
    assert all(r.file.endswith("2.json") and '"orderbook_fp"' in r.payload for r in bad)


def test_pages_that_cannot_be_taken(spark, tmp_path):
    bar = {"end_period_ts": 60, "volume": "1", "price": {"open": "0.5"}, "yes_bid": {}}
    page = {"market_ticker": "KXCPI-1", "tape": "historical", "period_minutes": 1440, "start_ts": 0, "ingest_ts": 1, "candlesticks": [bar]}
    odd = [json.dumps(page)[:-30], {**page, "period_minutes": None}, {**page, "start_ts": "soon"}, {**page, "candlesticks": [{**bar, "end_period_ts": "x"}, bar]}, {**page, "candlesticks": None}]
    put(tmp_path / "in" / "candles", "1.json", page, *odd, "not json at all")
    put(tmp_path / "in" / "trades", "1.json", '{"tape": "live", "trades": [', {"tape": "live", "page": "one", "trades": []})
    root = str(tmp_path / "lake")
    for _ in range(2):
        assert feeds.backfill(spark, str(tmp_path / "in"), root)["minute"] == 0
    assert U.read_table(spark, root, U.tables()["daily"]).count() == 1
    bad = sorted((r.dataset, r.reason) for r in spark.read.parquet(f"{root}/quarantine").collect())
    assert bad == [
        ("candles", "broken page"), ("candles", "broken page"), ("candles", "cannot parse start_ts soon"), ("candles", "no period_minutes"),
        ("daily", "no ts_ms; cannot parse end_period_ts x"), ("trades", "broken page"), ("trades", "cannot parse page one"),
    ]
    runs = {r.target: r for r in quality.run_summaries(spark, root, "candles").collect()}
    assert (runs["daily"].processed, runs["daily"].quarantined, runs["daily"].rows_written, runs["candles"].broken_pages) == (1, 1, 0, 4)
    listings = tmp_path / "listings"
    put(listings, "1.json", {"listing": "live", "markets": []}, '{"listing": "live", "mark')
    pages = spark.read.schema(schemas.MARKET_PAGE).json(str(listings))
    assert [r.dataset for r in quality.broken_pages(pages, "listings").collect()] == ["listings"]


def test_tickers_of_pages_that_cannot_be_taken_are_skipped_by_name(spark, tmp_path):
    page = lambda ticker, **more: {"market_ticker": ticker, "tape": "historical", "period_minutes": 1440, "ingest_ts": 1, **more, "candlesticks": [{"end_period_ts": 60, "volume": "1"}]}
    cut = lambda ticker: json.dumps(page(ticker))[:-30]
    first = '{"market_ticker" :"C\\u003e1 \\"x\\"", "candlesticks": [{"end'  # escapes
    put(tmp_path / "in" / "candles", "1.json", page("A"), page("A", period_minutes=7), cut("B"), cut("B"), first, '{"market_ticker": "D', "not json at all")
    book = {"market_ticker": "E", "ts_ms": 1, "orderbook_fp": {"yes_dollars": [["0.4", "1"]]}}
    put(tmp_path / "in" / "orderbook", "1.json", book, json.dumps({**book, "market_ticker": "F"})[:-9])
    root = str(tmp_path / "lake")
    for feed in ("candles", "orderbook"):
        feeds.start_feed(spark, feed, str(tmp_path / "in"), root, focus=["E"], once=True).awaitTermination()
    bad = spark.read.parquet(f"{root}/quarantine").collect()
    assert sorted((r.dataset, r.market_ticker or "", r.reason) for r in bad) == [
        ("candles", "", "broken page"), ("candles", "", "broken page"), ("candles", "A", "no such period 7"), ("candles", "B", "broken page"), ("candles", "B", "broken page"),
        ("candles", 'C>1 "x"', "broken page"), ("orderbook", "F", "broken page"),
    ]
    runs = {r.target: (r.processed, r.skipped, r.broken_pages) for r in quality.run_summaries(spark, root).collect()}
    assert (runs["daily"], runs["candles"], runs["orderbook"]) == ((1, 0, 0), (0, 3, 6), (1, 1, 1))


def test_tickers_in_texts_of_any_length(spark):
    texts = {'{"market_ticker":"A\\\\","x': "A\\", '{"market_ticker":"A\\\\\\"b","x': 'A\\"b', '{"market_ticker":"","x': "", '{"market_ticker":"A\\': None, '{"market_ticker":null,"x": "': None, '{"market_ticker":"\\q","x': None}
    texts['{"market_ticker":"' + '\\"' * 300_000 + '","x'] = '"' * 300_000
    found = spark.createDataFrame([(t,) for t in texts], "text string").select("text", landing._named_in("text").alias("ticker")).collect()
    assert [r.ticker == texts[r.text] for r in found] == [True] * len(texts)


def test_candle_pages_are_parsed_once(spark, tmp_path):
    put(tmp_path / "candles", "1.json", {"market_ticker": "A", "period_minutes": 1, "candlesticks": []})
    _, schema, rows_of = feeds.feeds()["candles"]
    plan = rows_of(spark.read.schema(schema).json(str(tmp_path / "candles")))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan json") == 1


def test_what_has_not_landed_against_seconds(spark):
    rng = random.Random(7)
    work, there = [], []
    for ticker in "ABCD":
        at = 0
        while at < 200:
            end = at + rng.randint(1, 40)
            work.append((ticker, at, end))
            at = end + rng.choice([0, 0, 5])
        there += [(ticker, s, s + rng.randint(1, 25)) for s in (rng.randint(-10, 210) for _ in range(rng.randint(0, 12)))]
    there += there[:3]
    landed = spark.createDataFrame(there, "market_ticker string, start_s bigint, end_s bigint")
    got = incremental.not_landed(spark.createDataFrame(work, "market_ticker string, window_start_s bigint, window_end_s bigint"), landed).collect()
    seconds = lambda rows: sorted((t, x) for t, a, b in rows for x in range(a, b))
    taken = set(seconds(there))
    assert seconds([tuple(r) for r in got]) == [x for x in seconds(work) if x not in taken]
    assert all(any(t == r[0] and a <= r[1] and r[2] <= b for t, a, b in work) for r in got)
    islands = incremental.coalesced(landed).collect()
    assert set(seconds([(r.market_ticker, r.start_s, r.end_s) for r in islands])) == taken
    assert len(islands) == sum((t, x - 1) not in taken for t, x in taken)


def test_a_feed_that_keeps_failing_is_given_up(spark, tmp_path):
    put(tmp_path / "in" / "trades", "1.json", {"tape": "live", "trades": [{"trade_id": "a", "ticker": "T-1"}]})
    bad = spark.createDataFrame([("T-1", "x", "y")], "market_ticker string, series_ticker string, event_ticker string").withColumn("series_ticker", F.raise_error(F.lit("no catalog")))
    told = []
    with pytest.raises(Exception, match="no catalog"):
        feeds.supervise(lambda: feeds.start_feed(spark, "trades", str(tmp_path / "in"), str(tmp_path / "lake"), meta=bad, once=True), restarts=1, first_wait_s=0.01, told=told.append)
    assert len(told) == 2


def test_files_by_name(spark, tmp_path):
    events = spark.createDataFrame([("KXA B>1", "E1", "one"), ("KXNONE", "E2", "two")], "series string, event_ticker string, title string")
    markets = spark.createDataFrame([("KXA B>1", "E1", m, "", "", "live") for m in ("b", "a", "b")], "series string, event_ticker string, market_ticker string, title string, status string, source string")
    cats = catalog.build_catalog(events, markets)
    for _ in range(2):
        catalog.write_files(cats, str(tmp_path))
    assert sorted(p.name for p in tmp_path.iterdir() if not p.name.startswith(".")) == ["KXA B>1_tickers.json", "KXA B>1_tickers.txt", "KXNONE_tickers.json", "all_tickers.json", "all_tickers.txt"]
    assert (tmp_path / "KXA B>1_tickers.txt").read_text() == "a\nb\n"
    read = {r.series: (r.tickers, r.file_name) for r in landing.catalogs(spark, str(tmp_path)).collect()}
    assert set(read) == {"KXA B>1", "KXNONE"} and read["KXA B>1"][0] == ["a", "b"]


def test_levels_without_identity(spark):
    pages = spark.createDataFrame([("A", 1, ([["0.4", "1"]], None))], "market_ticker string, ts_ms bigint, orderbook_fp struct<yes_dollars:array<array<string>>,no_dollars:array<array<string>>>")
    assert [(r.side, r.cumulative_qty) for r in normalize.book_levels(pages).collect()] == [("YES", 1.0)]


def test_a_batch_is_noted_in_one_unsorted_folder_and_names_files_only_where_something_is_wrong(spark, tmp_path):
    candle = lambda volume: {"end_period_ts": "86400", "volume": volume}
    page = lambda volume: {"market_ticker": "A", "tape": "historical", "period_minutes": 1440, "start_ts": 0, "ingest_ts": 1, "candlesticks": [candle(volume)]}
    put(tmp_path / "in", "a.json", page("1.5"), page("n/a"), '{"market_ticker": "A"')
    pages = spark.read.schema(schemas.CANDLE_PAGE).json(str(tmp_path / "in")).select("*", F.col("_metadata.file_path").alias("_file"))
    folder, counts = feeds._noted(pages, "candles", str(tmp_path / "lake"), feeds.feeds()["candles"][2], None, "run")
    assert {k: n for k, n in counts.items() if n} == {("daily", "good"): 1, ("daily", "bad"): 1, ("candles", "page"): 1}
    assert not [f for f in (tmp_path / "lake" / "_batches" / "candles" / "run").iterdir() if f.is_dir()]
    assert sorted((r.target, r.verdict, r.file is not None) for r in spark.read.parquet(folder).collect()) == [("candles", "page", True), ("daily", "bad", True), ("daily", "good", False)]


def test_the_focus_of_books_may_be_a_table(spark, tmp_path):
    book = lambda ticker: {"market_ticker": ticker, "ts_ms": 0, "ingest_ts": 1, "page": 0, "orderbook_fp": {"yes_dollars": [["0.5", "1"]]}}
    put(tmp_path / "in" / "orderbook", "a.json", book("A"), book("B"), book("C"), book(None), '{"market_ticker"')
    focus, root = spark.createDataFrame([("A",), ("C",), ("C",), (None,)], "market_ticker string"), str(tmp_path / "lake")
    feeds.start_feed(spark, "orderbook", str(tmp_path / "in"), root, focus=focus, once=True).awaitTermination()
    assert sorted(r.market_ticker for r in U.read_table(spark, root, U.tables()["orderbook"]).collect()) == ["A", "C"]
    assert sorted(r.reason for r in spark.read.parquet(f"{root}/quarantine").collect()) == ["broken page", "no market_ticker"]
