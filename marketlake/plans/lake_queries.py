"""Queries over stored tables as they are kept by feeds: broken pages, snapshots, moved keys, summaries, runs, work lists and
named files. The driver's events, orders and lines stand in for pages, as in queries.py."""

from __future__ import annotations

import time

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketlake import schemas
from marketlake.fixed import SERIES
from marketlake.functions import scalars as S
from marketlake.operators import audit, catalog, incremental, quality, upsert
from marketlake.plans.queries import AS_OF, DAY_MS, MS, TICKER, _candle_pages, _candle_rows, _catalog, _one_series, _trade_pages, query, scratch, table, user_events
from marketlake.sources import landing
from marketlake.streaming import feeds


def _lines(pages: DataFrame, *broken: tuple[Column, Column]) -> DataFrame:
    """Pages as lines of JSON, some changed: (which, the line instead)."""
    line = F.to_json(F.struct(*pages.columns))
    for which, instead in broken:
        line = F.when(which, instead).otherwise(line)
    return pages.select(line.alias("value"))


def _odd_pages(spark, sf_dir) -> DataFrame:
    """Candle pages as lines: of ten, one is cut off, one has no period, one an unknown one, one a start that is no number,
    and one a candle with a volume that is no number."""
    pages, tens = _candle_pages(spark, sf_dir), F.col("ingest_ts") % 10
    odd = pages.withColumns({
        "period_minutes": F.when(tens == 4, F.lit(None)).when(tens == 6, F.lit(7)).otherwise(F.col("period_minutes")),
        "start_ts": F.when(tens == 5, F.lit("soon")).otherwise(F.col("start_ts").cast("string")),
    })
    whole = F.to_json(F.struct(*odd.columns))
    return _lines(odd, (tens == 3, F.substring(whole, F.lit(1), F.length(whole) - 20)))


@query(
    """
    SELECT CASE event_id % 10 WHEN 3 THEN 'broken page' WHEN 4 THEN 'no period_minutes' WHEN 5 THEN 'cannot parse start_ts soon' WHEN 6 THEN 'no such period 7'
        ELSE 'cannot parse volume n/a' END AS reason, count(*) AS n, true AS has_file
    FROM events WHERE event_id % 10 IN (3, 4, 5, 6, 7) GROUP BY ALL
    """
)
def quarantined_pages(spark, sf_dir):
    """Pages that are cut off or cannot be placed, and a row that cannot be parsed, after the feed took them twice."""
    root = scratch(spark, "broken")
    for _ in range(2):
        _odd_pages(spark, sf_dir).write.mode("overwrite").text(f"{root}/landing/candles")
    for _ in range(2):
        feeds.backfill_candles(spark, f"{root}/landing", f"{root}/lake", _one_series(spark, sf_dir))
    found = spark.read.parquet(f"{root}/lake/quarantine").where("dataset IN ('candles', 'daily')")
    return found.groupBy("reason", F.endswith("file", F.lit(".txt")).alias("has_file")).agg(F.count("*").alias("n"))


def _book_pages(spark, sf_dir, ingest: int, wrong: Column, keep: Column) -> DataFrame:
    """A book for each user, as a page of its own; quantities that are wrong are a thousand more."""
    pair = F.array(F.col("value").cast("string"), (F.col("event_id") + F.when(wrong, 1000).otherwise(0)).cast("string"))
    entry = F.struct("event_id", pair.alias("level"))
    side = lambda yes: F.transform(F.array_sort(F.collect_list(F.when(yes, entry))), lambda x: x["level"])
    click, ticker = F.col("event_type") == "click", F.concat(F.lit("U"), F.col("user_id").cast("string"))
    pages = table(spark, sf_dir, "events").where(keep).groupBy(ticker.alias("market_ticker")).agg(side(click).alias("yes_dollars"), side(~click).alias("no_dollars"))
    return pages.select("market_ticker", F.lit(5 * DAY_MS).alias("ts_ms"), F.lit(ingest).alias("ingest_ts"), F.lit(0).alias("page"), F.struct("yes_dollars", "no_dollars").alias("orderbook_fp"))


@query(
    f"""
    WITH l AS (
        SELECT {TICKER} AS market_ticker, CASE WHEN event_type = 'click' THEN 'YES' ELSE 'NO' END AS side, value AS price, CAST(event_id AS DOUBLE) AS quantity,
            sum(CAST(event_id AS DOUBLE)) OVER (w ROWS UNBOUNDED PRECEDING) AS cumulative_qty, row_number() OVER w - 1 AS distance_from_top
        FROM events WHERE user_id % 3 <> 0 OR event_type = 'click' WINDOW w AS (PARTITION BY user_id, event_type = 'click' ORDER BY value DESC, event_id)
    )
    SELECT * FROM l QUALIFY row_number() OVER (PARTITION BY market_ticker, side, price ORDER BY distance_from_top DESC) = 1
    """
)
def landed_books_twice(spark, sf_dir):
    """Books that landed twice and in an older state in one batch, and of a third of the tickers again with one side only:
    of each snapshot the last page counts, as a whole."""
    root, never = scratch(spark, "books"), F.lit(False)
    focus = user_events(spark, sf_dir).select("market_ticker").distinct()
    right = _book_pages(spark, sf_dir, 2, never, ~never)
    first = right.union(right).union(_book_pages(spark, sf_dir, 1, ~never, F.col("event_id") % 2 == 0))
    again = _book_pages(spark, sf_dir, 3, never, (F.col("event_type") == "click") & (F.col("user_id") % 3 == 0))
    again = again.union(_book_pages(spark, sf_dir, 9, never, F.col("user_id") % 3 == 1).withColumn("orderbook_fp", F.struct(F.array(F.array(F.lit("0.5"), F.lit("n/a"))).alias("yes_dollars"), F.col("orderbook_fp.no_dollars").alias("no_dollars"))))
    for pages in (first, again):
        pages.write.mode("append").json(f"{root}/landing/orderbook")
        feeds.start_feed(spark, "orderbook", f"{root}/landing", f"{root}/lake", focus=focus, once=True).awaitTermination()
    return upsert.read_table(spark, f"{root}/lake", upsert.tables()["orderbook"]).select("market_ticker", "side", "price", "quantity", "cumulative_qty", "distance_from_top")


@query(
    f"""
    SELECT CAST(event_id AS VARCHAR) AS trade_id, {TICKER} AS market_ticker, {MS} + CASE WHEN event_id % 5 = 0 THEN {40 * DAY_MS} ELSE 0 END AS ts_ms,
        strftime(make_timestamp(1000 * ({MS} + CASE WHEN event_id % 5 = 0 THEN {40 * DAY_MS} ELSE 0 END)), '%Y-%m') AS ym,
        (SELECT count(*) FROM events WHERE event_id % 5 = 1) AS second_new
    FROM events
    """
)
def moved_trades(spark, sf_dir):
    """Trades of which a fifth comes again with a time that is forty days later, so in another month, and a fifth only then:
    each is stored once, where its last time says, and what is new is counted by trade."""
    trades, root, e = upsert.tables()["trades"], scratch(spark, "moved"), F.col("event_id")
    rows = user_events(spark, sf_dir).withColumns({
        "trade_id": e.cast("string"), "yes_price": F.lit(0.5), "no_price": F.lit(0.5), "count": F.lit(1.0), "taker_side": F.lit("yes"), "series_ticker": F.lit("ALL"),
    })
    upsert.upsert(rows.where(e % 5 != 1).select(*trades.schema.names), root, trades)
    later = rows.where(e % 5 < 2).withColumn("ts_ms", F.col("ts_ms") + F.when(e % 5 == 0, 40 * DAY_MS).otherwise(0))
    new = upsert.upsert(later.select(*trades.schema.names), root, trades)
    stored = upsert.read_table(spark, root, trades)
    return stored.select("trade_id", "market_ticker", "ts_ms", "ym", F.lit(new).cast("long").alias("second_new"))


@query(
    f"""
    WITH e AS (SELECT *, {TICKER} AS market_ticker, {MS} // {DAY_MS} * {DAY_MS} AS ts_ms, CASE event_id % 3 WHEN 0 THEN 'daily' WHEN 1 THEN 'hourly' ELSE 'minute' END AS t FROM events)
    SELECT t AS stored_in, market_ticker, ts_ms, arg_max(value, event_id) AS volume FROM e WHERE event_id % 10 <> 7 GROUP BY ALL
    UNION ALL
    SELECT 'trades', market_ticker, {MS}, CAST(event_id + CASE WHEN event_id % 5 = 0 THEN 1000000 ELSE 0 END AS DOUBLE) FROM e
    """
)
def backfill_all(spark, sf_dir):
    """All four tables after one backfill of pages of all periods and of both tapes."""
    root = scratch(spark, "backfill")
    minutes = F.when(F.col("ingest_ts") % 3 == 0, 1440).when(F.col("ingest_ts") % 3 == 1, 60).otherwise(1)
    _candle_pages(spark, sf_dir).withColumn("period_minutes", minutes).write.json(f"{root}/landing/candles")
    _trade_pages(spark, sf_dir).write.json(f"{root}/landing/trades")
    feeds.backfill(spark, f"{root}/landing", f"{root}/lake", _one_series(spark, sf_dir))
    read = lambda name, v: upsert.read_table(spark, f"{root}/lake", upsert.tables()[name]).select(F.lit(name).alias("stored_in"), "market_ticker", "ts_ms", F.col(v).alias("volume"))
    return read("daily", "volume").union(read("hourly", "volume")).union(read("minute", "volume")).union(read("trades", "count"))


@query(
    f"""
    SELECT {TICKER} AS market_ticker, coalesce(epoch_us(max(ts) FILTER (WHERE event_id % 4 <> 3)) // 86400000000 * 86400, -1) AS start_s,
        CASE WHEN count(*) FILTER (WHERE event_id % 4 <> 3) = 0 THEN 'no stored rows and no open time' ELSE '' END AS reason
    FROM events GROUP BY 1
    """
)
def resume_points_stored(spark, sf_dir):
    """Resume points from what is stored beside a table after two upserts: no stored row is read."""
    hourly, root, rows = upsert.tables()["hourly"], scratch(spark, "points"), _candle_rows(spark, sf_dir)
    for part in (F.col("event_id") % 4 < 2, F.col("event_id") % 4 == 2):
        upsert.upsert(rows.where(part).select(*hourly.schema.names, "event_id"), root, hourly, "event_id")
    points = incremental.summarised_points(upsert.read_summary(spark, root, hourly))
    none = spark.createDataFrame([], "market_ticker string, open_ts_ms bigint")
    return incremental.resume_points(rows.select("market_ticker"), points, none, 1 << 40).fillna({"start_s": -1, "reason": ""})


@query(
    f"""
    WITH w AS (
        SELECT o_custkey AS market_ticker, a + 31536000 * i AS a, least(a + 31536000 * (i + 1), {AS_OF // 1000}) AS b
        FROM (SELECT o_custkey, a, unnest(range(({AS_OF // 1000} - a + 31535999) // 31536000)) AS i
              FROM (SELECT o_custkey, epoch_us(min(o_orderdate)::TIMESTAMP) // 1000000 AS a FROM orders GROUP BY 1) WHERE a < {AS_OF // 1000})
    ), l AS (
        SELECT o_custkey AS market_ticker, s, least(s + CASE WHEN o_orderkey % 3 = 0 THEN 30 * 86400 ELSE 31536000 END, {AS_OF // 1000}) AS e
        FROM (SELECT *, epoch_us(o_orderdate::TIMESTAMP) // 1000000 AS s FROM orders) WHERE o_orderkey % 2 = 0 AND s < {AS_OF // 1000}
    ), r AS (
        SELECT *, max(e) OVER (PARTITION BY market_ticker ORDER BY s, e ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM l
    ), i AS (
        SELECT *, count(*) FILTER (WHERE reach IS NULL OR s > reach) OVER (PARTITION BY market_ticker ORDER BY s, e ROWS UNBOUNDED PRECEDING) AS island FROM r
    ), c AS (
        SELECT market_ticker, min(s) AS s, max(e) AS e FROM i GROUP BY market_ticker, island
    ), g AS (
        SELECT market_ticker, lag(e, 1, -99999999999) OVER o AS a, s AS b FROM c WINDOW o AS (PARTITION BY market_ticker ORDER BY s)
        UNION ALL SELECT market_ticker, max(e), 99999999999 FROM c GROUP BY 1
        UNION ALL SELECT market_ticker, -99999999999, 99999999999 FROM (SELECT DISTINCT market_ticker FROM w) WHERE market_ticker NOT IN (SELECT market_ticker FROM c)
    )
    SELECT market_ticker, greatest(w.a, g.a) AS window_start_s, least(w.b, g.b) AS window_end_s FROM w JOIN g USING (market_ticker) WHERE greatest(w.a, g.a) < least(w.b, g.b)
    """
)
def work_list(spark, sf_dir):
    """Windows from each customer's first order on, without what pages cover: each second order is a page from its day on,
    and each third of these was cut off after thirty days."""
    seconds = F.unix_seconds(F.col("o_orderdate").cast("timestamp"))
    orders = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("market_ticker"), "o_orderkey", seconds.alias("start_ts"))
    points = orders.groupBy("market_ticker").agg(F.min("start_ts").alias("start_s"))
    cut = F.col("o_orderkey") % 3 == 0
    pages = orders.where("o_orderkey % 2 = 0").withColumns({"n_candles": F.when(cut, 5000).otherwise(10), "adjusted_end_ts": F.when(cut, F.least(F.col("start_ts") + 30 * 86_400, F.lit(AS_OF // 1000)))})
    return incremental.work_list(points, pages, AS_OF // 1000, 1440)


@query(
    f"""
    WITH e AS (SELECT *, {TICKER} AS market_ticker, event_id % 10 AS tens FROM events),
    t AS (SELECT market_ticker, count(*) FILTER (WHERE tens NOT IN (3, 4, 5, 6, 7)) AS good, count(*) FILTER (WHERE tens = 7) AS bad FROM e GROUP BY 1)
    SELECT 'daily' AS target, count(*) FILTER (WHERE good > 0) AS processed, count(*) FILTER (WHERE good = 0 AND bad > 0) AS skipped, CAST(sum(good + bad) AS BIGINT) AS rows_read,
        CAST(sum(bad) AS BIGINT) AS quarantined, CAST(0 AS BIGINT) AS broken_pages,
        (SELECT count(*) FROM (SELECT DISTINCT market_ticker, {MS} // {DAY_MS} FROM e WHERE tens NOT IN (3, 4, 5, 6, 7))) AS rows_written, CAST(1 AS BIGINT) AS restarts
    FROM t
    UNION ALL
    SELECT 'candles', 0, (SELECT count(DISTINCT market_ticker) FROM e WHERE tens IN (3, 4, 5, 6)), 0, 0, (SELECT count(*) FROM e WHERE tens IN (3, 4, 5, 6)), 0, 1
    UNION ALL SELECT 'hourly', 0, 0, 0, 0, 0, 0, 1 UNION ALL SELECT 'minute', 0, 0, 0, 0, 0, 0, 1
    """
)
def run_summary(spark, sf_dir):
    """The stored metrics of a feed that fails once, as its catalog cannot be read, is started again and gets through."""
    root = scratch(spark, "runs")
    _odd_pages(spark, sf_dir).write.text(f"{root}/landing/candles")
    good = _one_series(spark, sf_dir)
    metas = [good.withColumn("series_ticker", F.raise_error(F.lit("the catalog cannot be read"))), good]
    start = lambda: feeds.start_feed(spark, "candles", f"{root}/landing", f"{root}/lake", meta=metas.pop(0), once=True)
    restarts = feeds.supervise(start, first_wait_s=0.1)
    runs = quality.run_summaries(spark, f"{root}/lake", "candles")
    shown = runs.groupBy("target").agg(*[F.sum(c).alias(c) for c in ("processed", "skipped", "rows_read", "quarantined", "broken_pages", "rows_written")])
    return shown.withColumn("restarts", F.lit(restarts).cast("long"))


_FILES_SQL = "SELECT r_name AS series, n_name AS event_ticker, 'S' || s_suppkey AS market_ticker, s_name AS title FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey"


@query(_FILES_SQL)
def catalog_files(spark, sf_dir):
    """The markets of catalog files that were written by name and read back; the combined file beside them is left out."""
    folder = scratch(spark, "files")
    for _ in range(2):
        catalog.write_files(_catalog(spark, sf_dir), folder)
    return catalog.catalog(landing.catalogs(spark, folder), "markets").select("series", "event_ticker", "market_ticker", "title")


@query("SELECT 'S' || s_suppkey AS market_ticker FROM supplier JOIN nation ON s_nationkey = n_nationkey WHERE n_regionkey = 2")
def tickers_of_series(spark, sf_dir):
    """The tickers of one series, asked for by its name, from its catalog file; the same as from the text file."""
    folder, names = scratch(spark, "named"), F.array(*map(F.lit, SERIES))
    regions = table(spark, sf_dir, "region").select(F.col("r_name").alias("_n"), F.get(names, F.col("r_regionkey").cast("int")).alias("_s"))
    cats = _catalog(spark, sf_dir)
    catalog.write_files(cats.join(regions, F.col("series") == F.col("_n")).withColumn("series", F.col("_s")).select(*cats.columns), folder)
    return landing.tickers(spark, SERIES[2], folder).join(landing.tickers(spark, f"{folder}/{SERIES[2]}_tickers.txt"), "market_ticker", "left_semi")


@query(
    f"""
    WITH k AS (
        SELECT {TICKER} AS ticker, event_type AS series, {MS} // {DAY_MS} * {DAY_MS} AS ts_ms, arg_max(value, event_id) AS v FROM events GROUP BY ALL
    ), a AS (
        SELECT max(ts_ms) - {10 * DAY_MS} AS as_of FROM k
    ), f AS (
        SELECT ticker, min(series) AS series, count(*) AS daily_rows, sum(v) AS total, sum(CASE WHEN ts_ms >= as_of - {30 * DAY_MS} THEN v ELSE 0 END) AS recent
        FROM (SELECT ticker, ts_ms, arg_max(v, m) AS v, min(series) AS series FROM (SELECT {TICKER} AS ticker, 'ALL' AS series, {MS} // {DAY_MS} * {DAY_MS} AS ts_ms, value AS v, event_id AS m FROM events) GROUP BY ALL), a
        GROUP BY ticker
    )
    SELECT series, false AS is_total, count(*) AS n_tickers, CAST(sum(daily_rows) AS BIGINT) AS daily_rows, round(sum(total), 4) AS total_volume, round(sum(recent), 4) AS recent_volume_30d,
        count(*) FILTER (WHERE total >= 1000 OR recent >= 100) AS dense_hourly, count(*) FILTER (WHERE recent >= 500) AS dense_minute
    FROM f GROUP BY series
    UNION ALL SELECT '', true, count(*), CAST(sum(daily_rows) AS BIGINT), round(sum(total), 4), round(sum(recent), 4), -1, -1 FROM f
    """
)
def audit_series_stored(spark, sf_dir):
    """The audit by series from the summaries that two upserts of daily candles left beside their table."""
    daily, root, rows = upsert.tables()["daily"], scratch(spark, "audit"), _candle_rows(spark, sf_dir)
    for part in (F.col("event_id") % 3 > 0, F.col("event_id") % 3 == 0):
        # a value of a later event stays, in whichever batch it came
        last = rows.groupBy("market_ticker", "ts_ms").agg(F.max("event_id").alias("_last")).withColumnsRenamed({"market_ticker": "_t", "ts_ms": "_m"})
        own = rows.where(part).join(last, (F.col("market_ticker") == F.col("_t")) & (F.col("ts_ms") == F.col("_m")) & (F.col("event_id") == F.col("_last")))
        upsert.upsert(own.select(*daily.schema.names, "event_id"), root, daily, "event_id")
    summary = upsert.read_summary(spark, root, daily)
    as_of = summary.agg(F.max("last_ts_ms")).first()[0] - 10 * DAY_MS
    out = audit.audit_series(audit.audit_summary(summary, as_of))
    return out.withColumns({c: F.round(c, 4) for c in ("total_volume", "recent_volume_30d")}).fillna({"series": "", "dense_hourly": -1, "dense_minute": -1})


@query(
    """
    SELECT 'E' || o_custkey AS event_ticker, CASE WHEN o_custkey % 3 = 0 THEN 'KXE' || o_custkey ELSE max(o_orderstatus) END AS series_ticker, count(*) AS n_markets
    FROM orders GROUP BY o_custkey
    """
)
def landed_event_payloads(spark, sf_dir):
    """Events resolved from payloads as they land; a third have no series and get it by name."""
    market = F.struct(F.concat(F.lit("O"), F.col("o_orderkey").cast("string")).alias("ticker"))
    name = F.concat(F.lit("E"), F.col("o_custkey").cast("string"))
    each = table(spark, sf_dir, "orders").groupBy(name.alias("event_ticker"), "o_custkey").agg(F.max("o_orderstatus").alias("s"), F.collect_list(market).alias("markets"))
    event = F.struct("event_ticker", F.when(F.col("o_custkey") % 3 != 0, F.col("s")).alias("series_ticker"))
    path = f"{scratch(spark, 'payloads')}/events"
    each.select(event.alias("event"), "markets").write.json(path)
    found = catalog.event_columns(landing.event_payloads(spark, path))
    out = catalog.resolved_events(each.select("event_ticker"), found, found.limit(0))
    return out.select("event_ticker", "series_ticker", F.size("markets").cast("long").alias("n_markets"))


@query(
    f"""
    SELECT {TICKER} AS ticker, 'ALL' AS series, count(*) AS daily_rows, round(sum(value), 4) AS total_volume FROM events GROUP BY 1
    """
)
def audit_csv(spark, sf_dir):
    """The audit as the CSV file that it is written to, read back."""
    folder = scratch(spark, "csv")
    rows = user_events(spark, sf_dir).select("market_ticker", "ts_ms", F.col("value").alias("volume"), F.lit("ALL").alias("series_ticker"))
    audit.write_audit(audit.audit_tickers(rows, AS_OF), folder, "1998-12-01")
    read = spark.read.option("header", True).schema("ticker string, series string, daily_rows bigint, first_ts_ms bigint, last_ts_ms bigint, total_volume double, recent_volume_30d double, hourly_expectation string, minute_expectation string").csv(f"{folder}/audit_19981201")
    return read.select("ticker", "series", "daily_rows", F.round("total_volume", 4).alias("total_volume"))


@query(f"SELECT {TICKER} AS market_ticker, count(*) AS n_rows, min({MS}) AS first_ts_ms, max({MS}) AS last_ts_ms FROM events GROUP BY 1")
def coverage_of_files(spark, sf_dir):
    """Coverage over a tree of plain files, whose folders' names mean nothing, with the stored columns of candles."""
    root = scratch(spark, "tree")
    rows = user_events(spark, sf_dir).select(*[F.lit(None).cast(t).alias(c) if c not in ("ts_ms", "market_ticker") else F.col(c) for c, t in ((f.name, f.dataType) for f in schemas.CANDLES)], "event_type")
    rows.write.partitionBy("event_type").parquet(f"{root}/daily")
    return audit.coverage(landing.stored(spark, f"{root}/daily", schemas.CANDLES, layout="files"))


@query(
    """
    SELECT 'C' || c_custkey AS market_ticker FROM customer
    WHERE c_custkey NOT IN (SELECT o_custkey FROM orders) AND (SELECT count(*) FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders)) <= 20
    UNION ALL SELECT 'S' || s_suppkey FROM supplier WHERE s_suppkey % 10 = 3 AND s_suppkey < 100
    """
)
def missing_few(spark, sf_dir):
    """Missing tickers, listed only if they are few: customers without orders, and of the first hundred suppliers a tenth."""
    name = lambda prefix, c: F.concat(F.lit(prefix), F.col(c).cast("string")).alias("market_ticker")
    customers, orders, suppliers = table(spark, sf_dir, "customer"), table(spark, sf_dir, "orders"), table(spark, sf_dir, "supplier").where("s_suppkey < 100")
    few = audit.missing_tickers(suppliers.select(name("S", "s_suppkey")), suppliers.where("s_suppkey % 10 <> 3").select(name("S", "s_suppkey")), show=20)
    return audit.missing_tickers(customers.select(name("C", "c_custkey")), orders.select(name("C", "o_custkey")), show=20).union(few)


@query(f"SELECT {TICKER} AS market_ticker, 'failed' AS daily, 'stored' AS orderbook, count(*) AS n_levels FROM (SELECT DISTINCT user_id, event_type = 'click' AS yes, value FROM events) GROUP BY 1")
def feeds_apart(spark, sf_dir):
    """Two chosen feeds at a cadence of a second: one fails, as its catalog cannot be read, and the other goes on."""
    root = scratch(spark, "apart")
    focus = user_events(spark, sf_dir).select("market_ticker").distinct()
    _candle_pages(spark, sf_dir).write.json(f"{root}/landing/candles")
    _book_pages(spark, sf_dir, 1, F.lit(False), F.lit(True)).write.json(f"{root}/landing/orderbook")
    meta = _one_series(spark, sf_dir).withColumn("series_ticker", F.raise_error(F.lit("the catalog cannot be read")))
    running = feeds.start_feeds(spark, f"{root}/landing", f"{root}/lake", only=("daily", "orderbook"), meta=meta, focus=focus, every_s=1)
    try:
        while running["daily"].isActive or not (running["orderbook"].lastProgress or {}).get("batchId", 0) >= 0:
            time.sleep(0.2)
        running["orderbook"].processAllAvailable()
    finally:
        for q in running.values():
            if q.isActive:
                q.stop()
    state = F.lit("failed" if running["daily"].exception() else "went on")
    levels = upsert.read_table(spark, f"{root}/lake", upsert.tables()["orderbook"]).groupBy("market_ticker").agg(F.count("*").alias("n_levels"))
    return levels.select("market_ticker", state.alias("daily"), F.lit("stored").alias("orderbook"), "n_levels")


_SERIES_OF = "'S' || (user_id % 500)"


@query(f"SELECT {TICKER} AS market_ticker, {_SERIES_OF} AS series_ticker, {MS} // {DAY_MS} * {DAY_MS} AS ts_ms, arg_max(value, event_id) AS volume FROM events GROUP BY ALL")
def upsert_many_series(spark, sf_dir):
    """Two upserts into a table of up to five hundred series, a partition each."""
    daily, root = upsert.tables()["daily"], scratch(spark, "many")
    user = S.whole(F.substring("market_ticker", 2, 20))
    rows = _candle_rows(spark, sf_dir).withColumn("series_ticker", F.concat(F.lit("S"), (user % 500).cast("string")))
    for part in (F.col("event_id") % 2 == 0, F.lit(True)):
        upsert.upsert(rows.where(part).select(*daily.schema.names, "event_id"), root, daily, "event_id")
    return upsert.read_table(spark, root, daily).select("market_ticker", "series_ticker", "ts_ms", "volume")


