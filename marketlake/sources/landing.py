"""Scans of landed raw pages, ticker lists, catalogs and stored tables, always with an explicit schema."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import lru_cache

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from marketlake import schemas
from marketlake.fixed import SERIES, WINDOW_DAYS
from marketlake.functions.scalars import stripped, whole


def _json(spark: SparkSession, path: str, schema: StructType, whole: bool = False, **options: str) -> DataFrame:
    return spark.read.schema(schema).option("multiLine", whole).options(**options).json(path)


def faults(*checks: Column, numbers: Iterable[str] = ()) -> Column:
    """Why a page cannot be taken, NULL if it can: its text is no such page, one of the checks says so, or one of the
    numbers in its head is none."""
    broken = F.when(F.col(schemas.BROKEN).isNotNull(), F.lit("broken page"))
    wrong = [F.when(F.col(n).isNotNull() & whole(n).isNull(), F.concat(F.lit(f"cannot parse {n} "), F.col(n))) for n in numbers]
    return F.coalesce(broken, *checks, *wrong)


def whole_pages(pages: DataFrame, *checks: Column, numbers: Iterable[str]) -> DataFrame:
    """pages with these numbers of their heads as bigint, and _fault. A page that is cut off keeps the ticker that its text
    names, as Spark reads nothing of it."""
    seen = pages.withColumn("_fault", faults(*checks, numbers=numbers))
    named = {"market_ticker": F.coalesce("market_ticker", _named_in(schemas.BROKEN))} if "market_ticker" in pages.columns else {}
    return seen.withColumns({n: whole(n) for n in numbers} | named)


def _named_in(text: str) -> Column:
    """The market_ticker in the text of a page that cannot be parsed, NULL if it names none."""
    # up to the first quote that is not escaped; a group for each character would overflow the stack on a long text
    quoted = F.regexp_extract(text, r'(?s)"market_ticker"\s*:\s*(".*?(?<!\\)(?:\\\\)*")', 1)
    return F.get(F.from_json(F.concat(F.lit("["), quoted, F.lit("]")), "array<string>"), F.lit(0))


def checked_candle_pages(pages: DataFrame) -> DataFrame:
    """Raw candle pages with numbers and _fault: also a period that is none of a candle table."""
    period = F.when(F.col("period_minutes").isNull(), F.lit("no period_minutes")).when(~F.coalesce(whole("period_minutes").isin(*WINDOW_DAYS), F.lit(False)), F.concat(F.lit("no such period "), F.col("period_minutes")))
    return whole_pages(pages, period, numbers=("period_minutes", "start_ts", "ingest_ts", "adjustedEndTs"))


def checked_trade_pages(pages: DataFrame) -> DataFrame:
    return whole_pages(pages, numbers=("ingest_ts", "page"))


def checked_book_pages(pages: DataFrame) -> DataFrame:
    """Raw book pages with numbers and _fault. A snapshot is whole or it is not taken: depth that leaves a level out is
    wrong, so one price or quantity that cannot be read makes the page faulty."""
    levels = F.concat(*[F.coalesce(F.col(f"orderbook_fp.{side}_dollars"), F.array().cast("array<array<string>>")) for side in ("yes", "no")])
    bad = lambda at, name: F.filter(F.transform(levels, lambda v: F.when(F.get(v, F.lit(at)).try_cast("double").isNull(), F.concat(F.lit(f"cannot parse {name} "), F.coalesce(F.get(v, F.lit(at)), F.lit("null"))))), lambda x: x.isNotNull())
    head = F.when(F.col("market_ticker").isNull(), F.lit("no market_ticker")).when(F.col("ts_ms").isNull(), F.lit("no ts_ms"))
    return whole_pages(pages, head, F.get(bad(0, "price"), F.lit(0)), F.get(bad(1, "quantity"), F.lit(0)), numbers=("ts_ms", "ingest_ts", "page"))


def _good(pages: DataFrame) -> DataFrame:
    return pages.where(F.col("_fault").isNull()).drop("_fault")


def candle_pages(spark: SparkSession, path: str) -> DataFrame:
    """One row per candle of landed pages of both tapes: page columns, pos and c (the candle). Pages that cannot be taken
    are left out here; feeds send them to the quarantine."""
    pages = _good(checked_candle_pages(_json(spark, path, schemas.CANDLE_PAGE)))
    return pages.select("market_ticker", "tape", "period_minutes", "start_ts", "ingest_ts", F.posexplode("candlesticks").alias("pos", "c"))


def candle_page_sizes(spark: SparkSession, path: str) -> DataFrame:
    """One row per page, without its candles: how many there are and where the exchange ended it."""
    pages = _json(spark, path, schemas.CANDLE_PAGE)
    return pages.select(
        "market_ticker", whole("period_minutes").cast("int").alias("period_minutes"), whole("start_ts").alias("start_ts"), whole("adjustedEndTs").alias("adjusted_end_ts"), F.size("candlesticks").alias("n_candles")
    )


def trade_pages(spark: SparkSession, path: str) -> DataFrame:
    """One row per trade: tape, ingest_ts, page, pos and t (the trade)."""
    pages = _good(checked_trade_pages(_json(spark, path, schemas.TRADE_PAGE)))
    return pages.select("tape", "ingest_ts", "page", F.posexplode("trades").alias("pos", "t"))


def book_pages(spark: SparkSession, path: str) -> DataFrame:
    return _good(checked_book_pages(_json(spark, path, schemas.BOOK_PAGE)))


def market_payloads(spark: SparkSession, path: str) -> DataFrame:
    """tape, ingest_ts and the fields of one market per row."""
    return _json(spark, path, schemas.MARKET_PAYLOAD).select("tape", "ingest_ts", "market.*")


def market_listings(spark: SparkSession, path: str) -> DataFrame:
    """listing, pos and the fields of each listed market."""
    return _json(spark, path, schemas.MARKET_PAGE).select("listing", F.posexplode("markets").alias("pos", "m")).select("listing", "pos", "m.*")


def event_payloads(spark: SparkSession, path: str) -> DataFrame:
    return _json(spark, path, schemas.EVENT_PAYLOAD)


def event_listings(spark: SparkSession, path: str) -> DataFrame:
    """listing, variant (the spelling asked for), pos and the fields of each listed event."""
    pages = _json(spark, path, schemas.EVENT_PAGE)
    return pages.select("listing", "variant", F.posexplode("events").alias("pos", "e")).select("listing", "variant", "pos", "e.*")


def series_listing(spark: SparkSession, path: str) -> DataFrame:
    return _json(spark, path, schemas.SERIES_PAGE).select(F.explode("series").alias("s")).select("s.*")


def catalogs(spark: SparkSession, folder: str) -> DataFrame:
    """The catalog of each series with the name of its file; the combined catalog beside them is left out."""
    files = _json(spark, folder, schemas.CATALOG, whole=True, pathGlobFilter="*_tickers.json")
    return files.withColumn("file_name", F.col("_metadata.file_name")).where(~F.endswith("file_name", F.lit("all_tickers.json")))


def tickers_from_text(spark: SparkSession, path: str) -> DataFrame:
    """One ticker a line, stripped, blank lines skipped."""
    return spark.read.text(path).select(stripped("value").alias("market_ticker")).where(F.length("market_ticker") > 0)


def tickers_from_json(spark: SparkSession, path: str) -> DataFrame:
    return _json(spark, path, schemas.TICKER_LIST, whole=True).select(F.explode("tickers").alias("market_ticker"))


def tickers(spark: SparkSession, source: str | list[str], catalog_folder: str | None = None, limit: int | None = None) -> DataFrame:
    """Distinct market tickers in code-point order, from a list, a .txt or .json file, a series of the catalog or one
    ticker; with a limit, the first ones (0 or None: all)."""
    if not isinstance(source, str):
        found = spark.createDataFrame([(t,) for t in source], "market_ticker string")
    elif source.endswith(".txt"):
        found = tickers_from_text(spark, source)
    elif source.endswith(".json"):
        found = tickers_from_json(spark, source)
    elif source in SERIES and catalog_folder:
        found = tickers_from_json(spark, f"{catalog_folder}/{source}_tickers.json")
    else:
        found = spark.createDataFrame([(source,)], "market_ticker string")
    ordered = found.distinct().orderBy("market_ticker")
    return ordered.limit(limit) if limit else ordered


@lru_cache(maxsize=4)
def _classes(jvm):
    """Hadoop's path and Spark's names of partitions: looking a class up takes longer than using it."""
    return jvm.org.apache.hadoop.fs.Path, jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils


def file_system(spark: SparkSession, path: str):
    """The file system of a path, and the path, as Hadoop's objects."""
    p = _classes(spark._jvm)[0](path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def partition_folder(spark: SparkSession, names: Sequence[str], values: Sequence[object]) -> str:
    """A partition's folder below its table, as Spark names it."""
    of = _classes(spark._jvm)[1].getPartitionPathString
    return "/".join(of(n, None if v is None else str(v)) for n, v in zip(names, values, strict=True))


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small file, as a whole."""
    fs, p = file_system(spark, path)
    out = fs.create(p)
    out.write(bytearray(text.encode()))
    out.close()


def read_text(spark: SparkSession, path: str) -> str:
    fs, p = file_system(spark, path)
    stream = fs.open(p)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = file_system(spark, path)
    return fs.exists(p)


def delete(spark: SparkSession, path: str) -> None:
    fs, p = file_system(spark, path)
    fs.delete(p, True)


def move(spark: SparkSession, source: str, target: str) -> None:
    """Puts a file or folder in place of another. Nothing happens if it has been moved already."""
    fs, a = file_system(spark, source)
    if fs.exists(a):
        b = _classes(spark._jvm)[0](target)
        fs.delete(b, True)
        fs.mkdirs(b.getParent())
        if not fs.rename(a, b):
            raise OSError(f"cannot move {source} to {target}")


def stored(spark: SparkSession, path: str, schema: StructType, layout: str = "hive") -> DataFrame:
    """A stored table; an empty one of the same schema if there is none. layout "files" reads a tree of plain files,
    whose folders mean nothing."""
    if not exists(spark, path):
        return spark.createDataFrame([], schema)
    options = {"recursiveFileLookup": "true"} if layout == "files" else {}
    return spark.read.schema(schema).options(**options).parquet(path)
