"""Where to go on: resume points, work lists of request windows, and what is new on a tape."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marketlake.fixed import FULL_PAGE, WINDOW_DAYS
from marketlake.functions.scalars import ms_to_seconds, seconds_to_ms

DAY = 86_400


def only(rows: DataFrame, tickers: DataFrame) -> DataFrame:
    """Rows of the listed tickers."""
    return rows.join(tickers.select("market_ticker"), "market_ticker", "left_semi")


def last_timestamps(rows: DataFrame) -> DataFrame:
    """The latest ts_ms of each ticker; reads two columns."""
    return rows.groupBy("market_ticker").agg(F.max("ts_ms").alias("last_ts_ms"))


def latest_trades(trades: DataFrame) -> DataFrame:
    """The id of each ticker's latest trade; of trades at one time the largest id."""
    return trades.groupBy("market_ticker").agg(F.max_by("trade_id", F.struct("ts_ms", "trade_id")).alias("last_trade_id"))


def summarised_points(summary: DataFrame) -> DataFrame:
    """market_ticker, ts_ms and last_trade_id of each ticker's last stored row, from what is stored beside a table
    (upsert.read_summary()): for resume_points(), without reading a stored row."""
    last = summary.groupBy("market_ticker").agg(F.max("last_ts_ms").alias("ts_ms"), F.max_by("last_trade_id", F.struct("last_ts_ms", "last_trade_id")).alias("last_trade_id"))
    return last.select("market_ticker", "ts_ms", "last_trade_id")


def resume_points(tickers: DataFrame, stored: DataFrame, meta: DataFrame, as_of_s: int, since_s: int | None = None) -> DataFrame:
    """start_s for each ticker: `since`, else its last stored second (that candle may still change), else its opening.

    reason is NULL for tickers to process; others are current (start_s is not before as_of_s) or have neither rows nor
    an opening time. meta has market_ticker and open_ts_ms, of which the earliest counts; tickers that repeat are one.
    """
    last = last_timestamps(stored).withColumnRenamed("market_ticker", "_t")
    opened = meta.groupBy(F.col("market_ticker").alias("_m")).agg(F.min("open_ts_ms").alias("open_ts_ms"))
    both = tickers.select("market_ticker").distinct().join(last, F.col("market_ticker") == F.col("_t"), "left").join(opened, F.col("market_ticker") == F.col("_m"), "left")
    start = F.coalesce(F.lit(since_s).cast("long"), ms_to_seconds(F.col("last_ts_ms")), ms_to_seconds(F.col("open_ts_ms")))
    reason = F.when(F.col("start_s").isNull(), F.lit("no stored rows and no open time")).when(F.col("start_s") >= as_of_s, F.lit("up to date"))
    return both.select("market_ticker", start.alias("start_s")).withColumn("reason", reason)


def windows(points: DataFrame, as_of_s: int, minutes: int) -> DataFrame:
    """Request windows [window_start_s, window_end_s) that cover each ticker's [start_s, as_of_s), short enough for a page."""
    step = WINDOW_DAYS[minutes] * DAY
    due = points.where(F.col("start_s") < as_of_s)
    each = due.select("market_ticker", F.explode(F.sequence("start_s", F.lit(as_of_s - 1).cast("long"), F.lit(step).cast("long"))).alias("window_start_s"))
    return each.withColumn("window_end_s", F.least(F.col("window_start_s") + step, F.lit(as_of_s).cast("long")))


def truncated_pages(pages: DataFrame) -> DataFrame:
    """Windows to ask for again, from where full pages were cut off: pages of FULL_PAGE candles or more whose end lies
    behind their start. pages has market_ticker, start_ts, adjusted_end_ts and n_candles."""
    return pages.where(_cut()).select("market_ticker", F.col("adjusted_end_ts").alias("window_start_s"))


def _cut() -> Column:
    return (F.col("n_candles") >= FULL_PAGE) & (F.col("adjusted_end_ts") > F.col("start_ts"))


def missing_windows(work: DataFrame, landed: DataFrame) -> DataFrame:
    """Windows of the work list that no page was asked for from their start. not_landed() also sees parts of windows."""
    here = landed.select("market_ticker", F.col("start_ts").alias("window_start_s"))
    return work.join(here, ["market_ticker", "window_start_s"], "left_anti")


def landed_intervals(pages: DataFrame, as_of_s: int, minutes: int) -> DataFrame:
    """market_ticker, start_s and end_s that each page covers: its window, or what it got to if it was cut off."""
    step = WINDOW_DAYS[minutes] * DAY
    end = F.when(_cut(), F.col("adjusted_end_ts")).otherwise(F.least(F.col("start_ts") + step, F.lit(as_of_s)))
    return pages.where(F.col("start_ts").isNotNull()).select("market_ticker", F.col("start_ts").alias("start_s"), end.cast("long").alias("end_s")).where("start_s < end_s")


def coalesced(intervals: DataFrame) -> DataFrame:
    """Intervals [start_s, end_s) of each ticker as the fewest that cover the same: a gap is where an interval starts
    behind the largest end of those that start before."""
    own = Window.partitionBy("market_ticker").orderBy("start_s", "end_s")
    reach = F.max("end_s").over(own.rowsBetween(Window.unboundedPreceding, -1))
    island = F.sum(F.when(reach.isNull() | (F.col("start_s") > reach), 1).otherwise(0)).over(own.rowsBetween(Window.unboundedPreceding, 0))
    return intervals.distinct().withColumn("_island", island).groupBy("market_ticker", "_island").agg(F.min("start_s").alias("start_s"), F.max("end_s").alias("end_s")).drop("_island")


def not_landed(work: DataFrame, landed: DataFrame) -> DataFrame:
    """What is left of the windows of a work list when the intervals that landed (market_ticker, start_s, end_s) are taken
    out. Borders of both are counted along each ticker's time, so no window meets an interval in a join. A piece is never
    larger than its window; windows that touch stay apart."""
    def borders(rows: DataFrame, start: str, end: str, name: str) -> DataFrame:
        both = F.explode(F.array(F.struct(F.col(start).alias("t"), F.lit(1).alias("d")), F.struct(F.col(end).alias("t"), F.lit(-1).alias("d"))))
        return rows.select("market_ticker", both.alias("b")).select("market_ticker", "b.t", *[(F.col("b.d") if n == name else F.lit(0)).alias(n) for n in ("asked", "there")])

    every = borders(work, "window_start_s", "window_end_s", "asked").union(borders(coalesced(landed), "start_s", "end_s", "there"))
    counted = every.groupBy("market_ticker", "t").agg(F.sum("asked").alias("asked"), F.sum("there").alias("there"))
    own = Window.partitionBy("market_ticker").orderBy("t")
    open_ = [F.sum(c).over(own.rowsBetween(Window.unboundedPreceding, 0)).alias(c) for c in ("asked", "there")]
    pieces = counted.select("market_ticker", F.col("t").alias("window_start_s"), F.lead("t").over(own).alias("window_end_s"), *open_)
    return pieces.where("asked > 0 AND there = 0").select("market_ticker", "window_start_s", "window_end_s")


def work_list(points: DataFrame, pages: DataFrame, as_of_s: int, minutes: int) -> DataFrame:
    """Request windows for all that is due (resume_points()) and has not landed: where a page was cut off, the rest of its
    window is a window again. pages are those of sources.candle_page_sizes() of this period."""
    return not_landed(windows(points, as_of_s, minutes), landed_intervals(pages, as_of_s, minutes))


def in_range(rows: DataFrame, start_s: int | Column | None = None, end_s: int | Column | None = None) -> DataFrame:
    """Rows with start_s <= time < end_s, in seconds; literal bounds reach the scan."""
    ms = lambda s: F.lit(s * 1000) if isinstance(s, int) else seconds_to_ms(s.cast("long"))
    out = rows
    if start_s is not None:
        out = out.where(F.col("ts_ms") >= ms(start_s))
    if end_s is not None:
        out = out.where(F.col("ts_ms") < ms(end_s))
    return out


def new_trades(fetched: DataFrame, stored: DataFrame, mode: str = "anti_join", since_ms: int | None = None) -> DataFrame:
    """Fetched trades that are not stored yet.

    anti_join compares trade ids: nothing is lost. strict_ts keeps what is later than the last stored trade (all of a
    ticker whose last trade was not fetched again); trades of the same millisecond, or late ones, are passed over.
    since_ms narrows either further.
    """
    if mode == "anti_join":
        new = fetched.join(stored.select("trade_id"), "trade_id", "left_anti").select(*fetched.columns)
    elif mode == "strict_ts":
        last = latest_trades(stored).select("last_trade_id")
        seen = fetched.join(last, F.col("trade_id") == F.col("last_trade_id"), "left_semi")
        cutoff = seen.groupBy(F.col("market_ticker").alias("_t")).agg(F.max("ts_ms").alias("_cutoff"))
        new = fetched.join(cutoff, F.col("market_ticker") == F.col("_t"), "left").where(F.col("_cutoff").isNull() | (F.col("ts_ms") > F.col("_cutoff"))).drop("_t", "_cutoff")
    else:
        raise ValueError(f"{mode!r} is neither anti_join nor strict_ts")
    return new if since_ms is None else new.where(F.col("ts_ms") >= since_ms)
