"""Feeds that keep the stored tables fresh: one Structured Streaming query per landing folder."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterable, Mapping

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from marketlake import schemas
from marketlake.fixed import CADENCE, FOCUS, SERIES, WINDOW_DAYS
from marketlake.operators import normalize
from marketlake.operators.catalog import with_ticker_meta
from marketlake.operators.quality import judged, run_metrics
from marketlake.operators.upsert import recover, tables, upsert
from marketlake.sources import landing as pages_of

Batch = Callable[[DataFrame], DataFrame]
#: Tables of candles by minutes.
PERIODS = {1440: "daily", 60: "hourly", 1: "minute"}
#: What goes with each row from its page: why the page cannot be taken, its text then, and the file that it is in.
PAGE = ("_fault", "_page", "_file")


def _checked(pages: DataFrame, check: Batch) -> DataFrame:
    """Pages with PAGE; _page only where there is a fault."""
    own = [c for c in pages.columns if c not in ("_file", schemas.BROKEN)]
    filed = pages if "_file" in pages.columns else pages.withColumn("_file", F.lit(None).cast("string"))
    text = F.coalesce(schemas.BROKEN, F.to_json(F.struct(*own)))
    return check(filed.withColumn("_text", text)).withColumn("_page", F.when(F.col("_fault").isNotNull(), F.col("_text"))).drop("_text")


def _candles(*minutes: int) -> Batch:
    def of(pages: DataFrame) -> DataFrame:
        seen = _checked(pages, pages_of.checked_candle_pages)
        seen = seen.where(F.col("_fault").isNotNull() | F.col("period_minutes").isin(*minutes))
        each = seen.select("*", F.posexplode_outer(F.when(F.col("_fault").isNull(), F.col("candlesticks"))).alias("pos", "c"))
        rows = normalize.normalize_candles(each.where(F.col("_fault").isNotNull() | F.col("pos").isNotNull()), tell=True, also=PAGE)
        target = F.coalesce(*[F.when(F.col("_fault").isNull() & (F.col("period_minutes") == m), F.lit(PERIODS[m])) for m in minutes])
        return rows.withColumn("target", target).drop("period_minutes")

    return of


def _trades(pages: DataFrame) -> DataFrame:
    seen = _checked(pages, pages_of.checked_trade_pages)
    each = seen.select("tape", "ingest_ts", "page", *PAGE, F.posexplode_outer(F.when(F.col("_fault").isNull(), F.col("trades"))).alias("pos", "t"))
    each = normalize.unite_tapes(each.where(F.col("_fault").isNotNull() | F.col("pos").isNotNull()), also=PAGE)
    return normalize.normalize_trades(each, tell=True, also=PAGE).withColumn("target", F.lit("trades"))


def _in_focus(pages: DataFrame, focus: Iterable[str] | DataFrame) -> DataFrame:
    """Pages of the tickers in focus, and those that cannot be taken. A list is one by hand; a DataFrame (market_ticker) of
    any length is joined."""
    wrong = F.col("_fault").isNotNull()
    if not isinstance(focus, DataFrame):
        return pages.where(wrong | F.col("market_ticker").isin(sorted(set(focus))))
    # a page without a ticker has a fault: its hash as key deals such pages to all tasks, and meets no ticker's
    key = F.when(wrong, F.xxhash64("_file", "_page").cast("string")).otherwise(F.concat(F.lit("="), "market_ticker"))
    named = focus.select(F.concat(F.lit("="), "market_ticker").alias("_key")).distinct().withColumn("_in", F.lit(True))
    return pages.withColumn("_key", key).join(named, "_key", "left").where(wrong | F.col("_in")).select(*pages.columns)


def _books(focus: Iterable[str] | DataFrame) -> Batch:
    def of(pages: DataFrame) -> DataFrame:
        seen = _in_focus(_checked(pages, pages_of.checked_book_pages), focus)
        # pages of one snapshot are told apart only if they cannot be taken
        file = F.when(F.col("_fault").isNotNull(), F.col("_file"))
        taken = F.when(F.col("_fault").isNull(), F.col("orderbook_fp"))
        rows = normalize.book_levels(seen.withColumns({"_file": file, "orderbook_fp": taken}), ordered=True, also=PAGE)
        return rows.where(F.col("_fault").isNotNull() | F.col("side").isNotNull()).withColumn("target", F.lit("orderbook"))

    return of


def _noted(batch: DataFrame, feed: str, root: str, rows_of: Batch, meta: DataFrame | None, run: str) -> tuple[str, dict[tuple[str, str], int]]:
    """Writes the rows of a batch, normalised and judged, with target and verdict (good, bad, page) to a folder, in one pass
    over its pages; returns the folder, and how many there are of each. Folders by target and verdict would make each
    task sort its rows, payloads and all, before it writes them."""
    targets = [t for t in tables() if t == feed or (feed == "candles" and t in PERIODS.values())]
    table = tables()[targets[0]]
    rows = rows_of(batch)
    if "series_ticker" in table.schema.names:
        lookup = meta if meta is not None else batch.sparkSession.createDataFrame([], "market_ticker string, series_ticker string, event_ticker string")
        rows = with_ticker_meta(rows, lookup, SERIES)
    required = tuple(dict.fromkeys((*table.key, "ts_ms", "market_ticker")))
    own = [c for c in rows.columns if c not in (*PAGE, "target", "_seq")]
    told = judged(rows.select(*own, *PAGE, "target", "_seq"), required)
    fault = F.col("_fault").isNotNull()
    verdict = F.when(fault, F.lit("page")).when(F.col("reason").isNotNull(), F.lit("bad")).otherwise(F.lit("good"))
    out = told.select(
        *table.schema.names, "_seq", F.coalesce("_fault", "reason").alias("reason"), F.coalesce("_page", "payload").alias("payload"),
        F.when(verdict != "good", F.col("_file")).alias("file"), F.coalesce("target", F.lit(feed)).alias("target"), verdict.alias("verdict"),
    )
    seen, folder = Observation(), f"{root}/_batches/{feed}/{run}"
    kinds = [(t, v) for t in dict.fromkeys((*targets, feed)) for v in ("good", "bad", "page")]
    counts = [F.count_if((F.col("target") == t) & (F.col("verdict") == v)).alias(f"{t}_{v}") for t, v in kinds]
    out.observe(seen, *counts).write.mode("overwrite").option("compression", "zstd").parquet(folder)
    return folder, {k: seen.get["_".join(k)] for k in kinds}


def ingest(batch: DataFrame, feed: str, root: str, rows_of: Batch, meta: DataFrame | None = None, batch_id: str = "batch", writer: str = "batch") -> dict[str, int]:
    """Raw pages of one batch into the feed's tables; new keys by table.

    The pages are parsed once, into a folder of rows with table and verdict (_noted()); all else is read from there. Pages that
    cannot be taken, rows without key or time, and rows with values that cannot be parsed go to the quarantine, with the
    file that they came in. What the batch had is stored under _runs. Running a batch twice changes nothing, so a restart
    may repeat its last one: the merge keeps the last row of a key, and quarantine and runs have a folder for each writer
    and batch_id."""
    spark, began, run = batch.sparkSession, time.monotonic(), f"{writer}-{batch_id}"
    folder, counts = _noted(batch, feed, root, rows_of, meta, run)
    schema = spark.read.parquet(folder).schema if any(counts.values()) else None
    new: dict[str, int] = {}
    for target in (t for t in tables() if (t, "good") in counts and (t == feed or feed == "candles")):
        table = tables()[target]
        if not counts[target, "good"]:
            recover(spark, root, table, writer)
            new[target] = 0
            continue
        good = spark.read.schema(schema).parquet(folder).where((F.col("target") == target) & (F.col("verdict") == "good"))
        new[target] = upsert(good.select(*table.schema.names, "_seq"), root, table, "_seq", writer, staged=True)
    for target in {t for (t, v), n in counts.items() if v != "good" and n}:
        bad = spark.read.schema(schema).parquet(folder).where((F.col("target") == target) & (F.col("verdict") != "good"))
        bad.select("market_ticker", "reason", "payload", "file").write.mode("overwrite").option("compression", "zstd").parquet(f"{root}/quarantine/dataset={target}/batch={run}")
    metrics = run_metrics(spark.read.schema(schema).parquet(folder) if schema else None, spark, new, time.monotonic() - began)
    metrics.coalesce(1).write.mode("overwrite").option("compression", "zstd").parquet(f"{root}/_runs/dataset={feed}/batch={run}")
    pages_of.delete(spark, folder)
    return new


def merge_batch(batch: DataFrame, feed: str, root: str, rows_of: Batch, meta: DataFrame | None = None, batch_id: str = "batch", writer: str = "batch") -> int:
    """ingest(), as the number of new keys in all."""
    return sum(ingest(batch, feed, root, rows_of, meta, batch_id, writer).values())


def feeds(focus: Iterable[str] | DataFrame = FOCUS) -> dict[str, tuple[str, object, Batch]]:
    """Name of each feed: its landing folder, the pages' schema, and how pages become rows. The feed candles keeps all
    candle tables from one pass over their pages; the three others keep one of them, at its own cadence."""
    return {
        "candles": ("candles", schemas.CANDLE_PAGE, _candles(*WINDOW_DAYS)),
        "minute": ("candles", schemas.CANDLE_PAGE, _candles(1)),
        "hourly": ("candles", schemas.CANDLE_PAGE, _candles(60)),
        "daily": ("candles", schemas.CANDLE_PAGE, _candles(1440)),
        "trades": ("trades", schemas.TRADE_PAGE, _trades),
        "orderbook": ("orderbook", schemas.BOOK_PAGE, _books(focus)),
    }


def start_feed(spark: SparkSession, feed: str, landing: str, root: str, meta: DataFrame | None = None, focus: Iterable[str] | DataFrame = FOCUS, once: bool = False, every_s: int | None = None) -> StreamingQuery:
    """Starts one feed: every file that lands is merged into its table, at the feed's cadence or, with once, until
    what has landed is done. A feed is the only writer of its table. It goes on from its checkpoint after a restart.
    Late and corrected rows are taken at any age, so there is no watermark."""
    folder, schema, rows_of = feeds(focus)[feed]
    pages = spark.readStream.schema(schema).json(f"{landing}/{folder}").select("*", F.col("_metadata.file_path").alias("_file"))

    def each(batch: DataFrame, number: int) -> None:
        ingest(batch, feed, root, rows_of, meta, str(number), "feed")

    writer = pages.writeStream.queryName(f"{feed} of {root}").foreachBatch(each).option("checkpointLocation", f"{root}/_checkpoints/{feed}")
    return (writer.trigger(availableNow=True) if once else writer.trigger(processingTime=f"{every_s or CADENCE[feed]} seconds")).start()


def start_feeds(spark: SparkSession, landing: str, root: str, only: Iterable[str] | None = None, **options) -> Mapping[str, StreamingQuery]:
    """Starts the chosen feeds (each table's own, unless only names some) as queries of their own: if one fails, the rest
    go on."""
    return {feed: start_feed(spark, feed, landing, root, **options) for feed in (only or [f for f in feeds() if f != "candles"])}


def supervise(start: Callable[[], StreamingQuery], restarts: int = 5, first_wait_s: float = 1.0, longest_wait_s: float = 300.0, told: Callable[[str], None] = lambda _: None) -> int:
    """Runs a feed and starts it again when it fails, from its checkpoint, after twice as long each time; returns how often.

    start starts the query. A batch that gets through sets the waiting back; after `restarts` failures without one the last
    error is raised. told gets the text of each. The feed's process has to live: run it in a thread for each feed."""
    failed = again = 0
    while True:
        query = start()
        done = query.lastProgress
        try:
            query.awaitTermination()
            return again
        except Exception as e:
            told(str(e).splitlines()[0])
            got_on = query.lastProgress is not None and query.lastProgress != done and query.lastProgress["numInputRows"] > 0
            failed = 1 if got_on else failed + 1
            if failed > restarts:
                raise
            time.sleep(min(longest_wait_s, first_wait_s * 2 ** (failed - 1)))
            again += 1


def _all_pages(spark: SparkSession, feed: str, landing: str, root: str, meta: DataFrame | None) -> dict[str, int]:
    folder, schema, rows_of = feeds()[feed]
    pages = spark.read.schema(schema).json(f"{landing}/{folder}").select("*", F.col("_metadata.file_path").alias("_file"))
    return ingest(pages, feed, root, rows_of, meta, "all", "backfill")


def backfill_candles(spark: SparkSession, landing: str, root: str, meta: DataFrame | None = None) -> dict[str, int]:
    """All candle pages that have landed into the three candle tables, from one pass over them; new keys by table."""
    return _all_pages(spark, "candles", landing, root, meta)


def backfill(spark: SparkSession, landing: str, root: str, meta: DataFrame | None = None) -> dict[str, int]:
    """All that has landed into daily, hourly, minute and trades tables; new keys by table. Feeds of these tables must not
    run meanwhile: a table has one writer at a time."""
    written = backfill_candles(spark, landing, root, meta) | _all_pages(spark, "trades", landing, root, meta)
    return {t: written[t] for t in ("daily", "hourly", "minute", "trades")}
