"""From wire shapes to the stored tables' columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marketlake.functions.scalars import first_value, iso_to_ms, number, seconds_to_ms, whole

#: Tapes in the order in which later ones win.
TAPES = ("live", "historical")
BARS = ("open", "high", "low", "close")


def tape_rank(tape: Column | str) -> Column:
    t = F.col(tape) if isinstance(tape, str) else tape
    return F.coalesce(F.array_position(F.array(*map(F.lit, TAPES)), t), F.lit(0))


def historical_candle(c: Column) -> list[Column]:
    """Each of open, high, low and close from trades, or by itself from bids where there was no trade; mean has no such
    way out. A price of zero is a price."""
    bars = [first_value(number(c[f"price"][b]), number(c["yes_bid"][b])).alias(b) for b in BARS]
    return [seconds_to_ms(whole(c["end_period_ts"].cast("string"))).alias("ts_ms"), *bars, number(c["price"]["mean"]).alias("mean"), number(c["volume"]).alias("volume"), number(c["open_interest"]).alias("open_interest")]


def live_candle(c: Column) -> list[Column]:
    bars = [number(c["price"][f"{b}_dollars"]).alias(b) for b in (*BARS, "mean")]
    return [seconds_to_ms(whole(c["end_period_ts"].cast("string"))).alias("ts_ms"), *bars, number(c["volume_fp"]).alias("volume"), number(c["open_interest_fp"]).alias("open_interest")]


def unread(**given: Column) -> Column:
    """Names and texts of values that were given but are no numbers. NaN is a number that says nothing."""
    wrong = [F.when((F.trim(c) != "") & c.try_cast("double").isNull(), F.concat(F.lit(f"{name} "), c)) for name, c in given.items()]
    return F.array_compact(F.array(*wrong))


def _unread_candle(c: Column) -> Column:
    old = {"volume": c["volume"], "open_interest": c["open_interest"], **{b: c["price"][b] for b in (*BARS, "mean")}, **{f"bid_{b}": c["yes_bid"][b] for b in BARS}}
    new = {"volume": c["volume_fp"], "open_interest": c["open_interest_fp"], **{b: c["price"][f"{b}_dollars"] for b in (*BARS, "mean")}}
    time = F.when(c["end_period_ts"].isNotNull() & whole(c["end_period_ts"].cast("string")).isNull(), F.concat(F.lit("end_period_ts "), c["end_period_ts"].cast("string")))
    return F.concat(F.array_compact(F.array(time)), F.when(F.col("tape") == "historical", unread(**old)).otherwise(unread(**new)))


def normalize_candles(candles: DataFrame, tell: bool = False, also: Sequence[str] = ()) -> DataFrame:
    """Rows of sources.candle_pages() as candle columns, with market_ticker and _seq, the order in which later rows
    replace earlier ones: ingestion, tape, start of the page, place in it. With tell, _unparsed lists the values that
    were given and became NULL; `also` names columns that are passed on."""
    seq = F.struct("ingest_ts", tape_rank("tape").alias("tape"), "start_ts", "pos")
    c = F.col("c")
    whole = F.when(F.col("tape") == "historical", F.struct(*historical_candle(c))).otherwise(F.struct(*live_candle(c)))
    more = [_unread_candle(c).alias("_unparsed")] if tell else []
    return candles.select(whole.alias("n"), "market_ticker", "period_minutes", seq.alias("_seq"), *more, *also).select("n.*", "market_ticker", "period_minutes", "_seq", *["_unparsed" for _ in more], *also)


TRADE_NAMES = {"ticker": "market_ticker", "yes_price_dollars": "yes_price", "no_price_dollars": "no_price", "count_fp": "count"}
TRADE_COLUMNS = ("trade_id", "market_ticker", "ts_ms", "yes_price", "no_price", "count", "taker_side")


def normalize_trades(trades: DataFrame, tell: bool = False, also: Sequence[str] = ()) -> DataFrame:
    """Trades in wire columns as exactly the seven stored columns (and _seq, if there), numbers and times parsed;
    what cannot be parsed becomes NULL. With tell, _unparsed lists the numbers that were given and became NULL, for
    quality.judged() to find; `also` names columns that are passed on."""
    numbers = ("yes_price", "no_price", "count")
    named = trades.withColumnsRenamed(TRADE_NAMES).withColumn("ts_ms", iso_to_ms("created_time"))
    named = named.withColumn("_unparsed", unread(**{c: F.col(c) for c in numbers})) if tell else named
    named = named.withColumns({c: number(c) for c in numbers})
    return named.select(*TRADE_COLUMNS, *[c for c in ("_seq",) if c in trades.columns], *(["_unparsed"] if tell else []), *also)


def unite_tapes(pages: DataFrame, also: Sequence[str] = ()) -> DataFrame:
    """Rows of sources.trade_pages() in wire columns with _seq: the historical tape beats the live one."""
    return pages.select("t.*", F.struct(tape_rank("tape").alias("tape"), "ingest_ts", "page", "pos").alias("_seq"), *also)


def last_snapshots(pages: DataFrame, also: Sequence[str] = ()) -> DataFrame:
    """Of pages of one snapshot (market_ticker, ts_ms) the last: by ingest_ts, then page, then payload. A snapshot that
    landed twice is one. Pages that differ in `also` are told apart."""
    order = [c for c in ("ingest_ts", "page") if c in pages.columns]
    best = pages.groupBy("market_ticker", "ts_ms", *also).agg(F.max(F.struct(*order, "orderbook_fp")).alias("_p"))
    return best.select("market_ticker", "ts_ms", *also, "_p.*")


def book_levels(pages: DataFrame, ordered: bool = False, also: Sequence[str] = ()) -> DataFrame:
    """One row per price level and side of each snapshot: distance 0 is the best price, cumulative_qty sums from there.

    A payload has bids only, [price, quantity] texts in any order; a missing side has no levels. Equal prices keep
    their order in the payload. With ordered, _seq (ingest_ts, page, pos) says which of them is stored: the last. With
    `also` (columns that are passed on), a snapshot without any level is one row without side.
    """
    names = (("YES", "yes_dollars"), ("NO", "no_dollars"))
    side = lambda name, field: F.transform(F.col(f"orderbook_fp.{field}"), lambda v, i: F.struct(F.lit(name).alias("side"), i.alias("pos"), v.alias("level")))
    none = F.array().cast("array<struct<side:string,pos:int,level:array<string>>>")
    levels = F.concat(*[F.coalesce(side(*n), none) for n in names])
    identity = [c for c in ("ingest_ts", "page") if c in pages.columns]
    explode = F.explode_outer if also else F.explode
    each = last_snapshots(pages, also).select("ts_ms", "market_ticker", *identity, *also, explode(levels).alias("s")).select("ts_ms", "market_ticker", *identity, *also, "s.*")
    rows = each.select(
        "ts_ms", "market_ticker", "side", number(F.get("level", F.lit(0))).alias("price"), number(F.get("level", F.lit(1))).alias("quantity"), "pos",
        *([F.struct(*identity, "pos").alias("_seq")] if ordered else []), *also,
    )
    return ladder(rows, also)


def ladder(levels: DataFrame, also: Sequence[str] = ()) -> DataFrame:
    """Depth and running quantity of levels (ts_ms, market_ticker, side, price, quantity, pos)."""
    best_first = Window.partitionBy("ts_ms", "market_ticker", "side", *also).orderBy(F.desc("price"), "pos")
    return levels.select(
        "ts_ms", "market_ticker", "side", "price", "quantity",
        F.sum("quantity").over(best_first.rowsBetween(Window.unboundedPreceding, 0)).alias("cumulative_qty"),
        (F.row_number().over(best_first) - 1).cast("long").alias("distance_from_top"), *[c for c in ("_seq",) if c in levels.columns], *also,
    )


def top_of_book(levels: DataFrame) -> DataFrame:
    """Best bids of both sides, the asks that they imply (a contract pays one dollar), spread and middle."""
    best = levels.where(F.col("distance_from_top") == 0)
    sides = best.groupBy("ts_ms", "market_ticker").agg(*[F.max(F.when(F.col("side") == s.upper(), F.col("price"))).alias(f"{s}_bid") for s in ("yes", "no")])
    asked = sides.withColumns({"yes_ask": 1 - F.col("no_bid"), "no_ask": 1 - F.col("yes_bid")})
    return asked.withColumns({"spread": F.col("yes_ask") - F.col("yes_bid"), "mid": (F.col("yes_ask") + F.col("yes_bid")) / 2})
