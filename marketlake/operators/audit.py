"""Coverage of the stored candles: per ticker, per series and in all, and what is missing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketlake.fixed import HOURLY_RECENT, HOURLY_TOTAL, MINUTE_RECENT

RECENT_MS = 30 * 86_400_000


def coverage(rows: DataFrame, key: str = "market_ticker") -> DataFrame:
    """Rows and time span of each ticker, most rows first."""
    counts = rows.groupBy(key).agg(F.count("*").alias("n_rows"), F.min("ts_ms").alias("first_ts_ms"), F.max("ts_ms").alias("last_ts_ms"))
    return counts.orderBy(F.desc("n_rows"), key)


def density(total: Column, recent: Column) -> dict[str, Column]:
    """Whether finer candles of a market are worth pulling, from its volume in all and of late."""
    say = lambda yes: F.when(yes, F.lit("dense")).otherwise(F.lit("sparse"))
    return {"hourly_expectation": say((total >= HOURLY_TOTAL) | (recent >= HOURLY_RECENT)), "minute_expectation": say(recent >= MINUTE_RECENT)}


def audit_tickers(daily: DataFrame, as_of_ms: int) -> DataFrame:
    """Coverage, volume and density of each ticker of daily candles; volumes that are NULL or no numbers count as zero.
    One scan, one aggregate; recent means the 30 days up to as_of_ms, both ends included."""
    volume = F.coalesce(F.nanvl(F.col("volume").try_cast("double"), F.lit(None)), F.lit(0.0))
    counted = daily.groupBy(F.col("market_ticker").alias("ticker"), F.col("series_ticker").alias("series")).agg(
        F.count("*").alias("daily_rows"),
        F.min("ts_ms").alias("first_ts_ms"),
        F.max("ts_ms").alias("last_ts_ms"),
        F.sum(volume).alias("total_volume"),
        F.sum(F.when(F.col("ts_ms") >= as_of_ms - RECENT_MS, volume).otherwise(0.0)).alias("recent_volume_30d"),
    )
    return counted.withColumns(density(F.col("total_volume"), F.col("recent_volume_30d")))


def audit_summary(summary: DataFrame, as_of_ms: int) -> DataFrame:
    """audit_tickers() from what is stored beside the daily table (upsert.read_summary()), so that an audit reads a row for
    each ticker and month. Only of the months in which the last 30 days begin are single days read."""
    cutoff = as_of_ms - RECENT_MS
    names = ("market_ticker", "series_ticker", "n_rows", "first_ts_ms", "last_ts_ms", "volume")
    months = summary.select(*names, F.when(F.col("first_ts_ms") >= cutoff, F.col("volume")).otherwise(0.0).alias("recent"))
    begun = summary.where((F.col("first_ts_ms") < cutoff) & (F.col("last_ts_ms") >= cutoff))
    days = F.aggregate(F.filter("days", lambda d: d["ts_ms"] >= cutoff), F.lit(0.0), lambda a, d: a + d["volume"])
    parts = begun.select("market_ticker", "series_ticker", *[F.lit(None).cast(t).alias(c) for c, t in zip(names[2:], ("long", "long", "long", "double"))], days.alias("recent"))
    counted = months.union(parts).groupBy(F.col("market_ticker").alias("ticker"), F.col("series_ticker").alias("series")).agg(
        F.sum("n_rows").alias("daily_rows"), F.min("first_ts_ms").alias("first_ts_ms"), F.max("last_ts_ms").alias("last_ts_ms"), F.sum("volume").alias("total_volume"), F.sum("recent").alias("recent_volume_30d")
    )
    return counted.withColumns(density(F.col("total_volume"), F.col("recent_volume_30d")))


def audit_series(tickers: DataFrame) -> DataFrame:
    """Rows of audit_tickers() by series, and a last one over all (series NULL), which has no counts of dense ones."""
    dense = lambda c: F.when(F.grouping("series") == 0, F.count_if(F.col(c) == "dense"))
    return tickers.rollup("series").agg(
        F.grouping("series").cast("boolean").alias("is_total"),
        F.count("*").alias("n_tickers"),
        F.sum("daily_rows").alias("daily_rows"),
        F.sum("total_volume").alias("total_volume"),
        F.sum("recent_volume_30d").alias("recent_volume_30d"),
        dense("hourly_expectation").alias("dense_hourly"),
        dense("minute_expectation").alias("dense_minute"),
    )


def missing_tickers(tickers: DataFrame, stored: DataFrame, show: int | None = None) -> DataFrame:
    """Tickers without a stored row, in order; with show, all of them if they are that many at most, else none."""
    missing = tickers.join(stored.select("market_ticker"), "market_ticker", "left_anti").orderBy("market_ticker")
    if show is None:
        return missing
    few = missing.limit(show + 1)
    return missing.limit(0) if few.count() > show else missing


def write_audit(tickers: DataFrame, folder: str, day: str) -> None:
    """audit_tickers() as CSV under audit_<YYYYMMDD>."""
    tickers.orderBy("series", "ticker").write.mode("overwrite").option("header", True).csv(f"{folder}/audit_{day.replace('-', '')}")
