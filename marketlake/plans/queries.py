"""The registered queries: each operator over the driver's tables, and the same in DuckDB's SQL.

The driver's tables are no market data, so columns stand in: users, parts and customers for tickers, event types and
brands for series. Counts and times that may be NULL are shown as -1 there, as not all readers keep NULL integers.
"""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketlake import schemas
from marketlake.functions import scalars as S
from marketlake.operators import audit, catalog, incremental, normalize, quality, upsert
from marketlake.sources import landing
from marketlake.streaming import feeds

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None):
    def register(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def user_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events with market_ticker and ts_ms."""
    events = table(spark, sf_dir, "events")
    return events.withColumns({"ts_ms": F.unix_millis(F.col("ts").cast("timestamp")), "market_ticker": F.concat(F.lit("U"), F.col("user_id").cast("string"))})


def median(rows: DataFrame, column: str) -> float:
    """The exact median of whole numbers: counts in 1024 equal ranges, then in those of the range that holds it. The
    driver sees 1024 counts at a time, and no task all values."""
    low, high, n = rows.agg(F.min(column), F.max(column), F.count(column)).first()

    def nth(k: int) -> int:
        a, b, skip = low, high, k
        while a < b:
            width = -(-(b - a + 1) // 1024)
            inside = rows.where(F.col(column).between(a, b)).groupBy(F.floor((F.col(column) - a) / width).alias("r")).count()
            for r, count in sorted((r["r"], r["count"]) for r in inside.collect()):
                if skip < count:
                    a, b = a + r * width, min(b, a + (r + 1) * width - 1)
                    break
                skip -= count
        return a

    return (nth((n - 1) // 2) + nth(n // 2)) / 2


MS = "(epoch_us(ts) // 1000)"
TICKER = "'U' || user_id"
DAY_MS = 86_400_000


@query(f"SELECT {TICKER} AS market_ticker, count(*) AS n_rows, min({MS}) AS first_ts_ms, max({MS}) AS last_ts_ms FROM events GROUP BY 1")
def coverage_by_ticker(spark, sf_dir):
    return audit.coverage(user_events(spark, sf_dir))


@query(
    """
    SELECT 'E' || event_id AS trade_id, 'U' || user_id AS market_ticker, epoch_us(ts) // 1000 AS ts_ms,
        (event_id % 100) / 100.0::DOUBLE AS yes_price, (100 - event_id % 100) / 100.0::DOUBLE AS no_price,
        value AS count, CASE WHEN event_type IN ('click', 'view') THEN 'yes' ELSE 'no' END AS taker_side
    FROM events
    """
)
def normalize_trades(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    price = lambda c: F.format_string("%d.%02d", (c / 100).cast("int"), (c % 100).cast("int"))
    wire = events.select(
        F.concat(F.lit("E"), F.col("event_id").cast("string")).alias("trade_id"),
        F.concat(F.lit("U"), F.col("user_id").cast("string")).alias("ticker"),
        F.date_format(F.col("ts").cast("timestamp"), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'").alias("created_time"),
        price(F.col("event_id") % 100).alias("yes_price_dollars"),
        price(100 - F.col("event_id") % 100).alias("no_price_dollars"),
        F.col("value").cast("string").alias("count_fp"),
        F.when(F.col("event_type").isin("click", "view"), "yes").otherwise("no").alias("taker_side"),
        F.lit(False).alias("is_block_trade"),
    )
    return normalize.normalize_trades(wire)


@query(
    """
    SELECT l_orderkey, l_linenumber, epoch_us(l_shipdate::TIMESTAMP) // 1000000 * 1000 AS ts_ms,
        coalesce(nullif(l_discount, 0.05), l_tax) AS open, l_tax AS close, nullif(l_discount, 0.05) AS mean, l_quantity AS volume
    FROM lineitem
    """
)
def candle_fallback(spark, sf_dir):
    text = lambda c: c.cast("string")
    price, bid = F.nullif(F.col("l_discount"), F.lit(0.05)), F.col("l_tax")
    none = F.lit(None).cast("string")
    raw = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber",
        F.struct(
            F.unix_seconds(F.col("l_shipdate").cast("timestamp")).alias("end_period_ts"),
            text(F.col("l_quantity")).alias("volume"), none.alias("open_interest"),
            F.struct(text(price).alias("open"), text(price).alias("high"), none.alias("low"), none.alias("close"), text(price).alias("mean")).alias("price"),
            F.struct(*[text(bid).alias(b) for b in normalize.BARS]).alias("yes_bid"),
        ).alias("c"),
    )
    out = raw.select("l_orderkey", "l_linenumber", F.struct(*normalize.historical_candle(F.col("c"))).alias("n"))
    return out.select("l_orderkey", "l_linenumber", "n.ts_ms", "n.open", "n.close", "n.mean", "n.volume")


@query("SELECT event_id, CAST(json_extract_string(props, '$.k') AS DOUBLE) AS k FROM events")
def json_field(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_id", S.number(F.get_json_object("props", "$.k")).alias("k"))


@query(
    """
    SELECT user_id, strftime(ts, '%Y-%m-%d') AS day, arg_max(event_id, event_id) AS event_id, arg_max(value, event_id) AS value
    FROM events GROUP BY ALL
    """
)
def upsert_keep_last(spark, sf_dir):
    rows = user_events(spark, sf_dir).select("user_id", S.day_of("ts_ms").alias("day"), "event_id", "value")
    old, new = rows.where(F.col("event_id") % 3 == 0), rows.where(F.col("event_id") % 3 != 0)
    both = old.unionByName(new).withColumn("_seq", F.col("event_id"))
    return upsert.keep_last(both, ["user_id", "day"])


@query(
    f"""
    WITH e AS (SELECT *, {MS} // {DAY_MS} AS day, median({MS}) OVER () AS cut, {MS} AS ms FROM events)
    SELECT user_id, day FROM e WHERE ms >= cut GROUP BY ALL
    EXCEPT SELECT user_id, day FROM e WHERE ms < cut
    """
)
def upsert_net_new(spark, sf_dir):
    rows = user_events(spark, sf_dir).select("user_id", "ts_ms", F.floor(F.col("ts_ms") / DAY_MS).alias("day"))
    cutoff = median(rows, "ts_ms")
    return upsert.net_new(rows.where(F.col("ts_ms") < cutoff), rows.where(F.col("ts_ms") >= cutoff), ["user_id", "day"])


@query(
    f"""
    SELECT event_id AS trade_id, {TICKER} AS market_ticker, {MS} AS ts_ms,
        CASE WHEN event_id % 5 < 3 THEN 'historical' ELSE 'live' END AS tape FROM events
    """
)
def union_tapes_dedupe(spark, sf_dir):
    events = user_events(spark, sf_dir).select(F.col("event_id").alias("trade_id"), "market_ticker", "ts_ms")
    live = events.where(F.col("trade_id") % 5 >= 2).withColumn("tape", F.lit("live"))
    old = events.where(F.col("trade_id") % 5 < 3).withColumn("tape", F.lit("historical"))
    both = live.unionByName(old).withColumn("_seq", normalize.tape_rank("tape"))
    return upsert.keep_last(both, ["trade_id"])


def _levels(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    return events.select(
        F.lit(0).cast("long").alias("ts_ms"), F.col("user_id").cast("string").alias("market_ticker"), F.col("event_type").alias("side"),
        F.col("value").alias("price"), (F.col("event_id") % 10 + 1).cast("double").alias("quantity"), F.col("event_id").alias("pos"),
    )


@query(
    """
    SELECT CAST(0 AS BIGINT) AS ts_ms, CAST(user_id AS VARCHAR) AS market_ticker, event_type AS side, value AS price,
        CAST(event_id % 10 + 1 AS DOUBLE) AS quantity,
        sum(CAST(event_id % 10 + 1 AS DOUBLE)) OVER (w ROWS UNBOUNDED PRECEDING) AS cumulative_qty,
        row_number() OVER w - 1 AS distance_from_top
    FROM events WINDOW w AS (PARTITION BY user_id, event_type ORDER BY value DESC, event_id)
    """
)
def book_ladder(spark, sf_dir):
    return normalize.ladder(_levels(spark, sf_dir))


@query(
    """
    WITH b AS (
        SELECT CAST(user_id AS VARCHAR) AS market_ticker, max(value) FILTER (WHERE event_type = 'click') / 1000 AS yes_bid,
            max(value) FILTER (WHERE event_type <> 'click') / 1000 AS no_bid
        FROM events GROUP BY 1
    )
    SELECT CAST(0 AS BIGINT) AS ts_ms, market_ticker, yes_bid, no_bid, 1 - no_bid AS yes_ask, 1 - yes_bid AS no_ask,
        1 - no_bid - yes_bid AS spread, (1 - no_bid + yes_bid) / 2 AS mid
    FROM b
    """
)
def top_of_book(spark, sf_dir):
    side = F.when(F.col("side") == "click", "YES").otherwise("NO")
    levels = _levels(spark, sf_dir).withColumns({"side": side, "price": F.col("price") / 1000})
    return normalize.top_of_book(normalize.ladder(levels))


@query(
    """
    SELECT o_orderkey, coalesce(c.c_mktsegment, split_part(o_orderpriority, '-', 1)) AS series_ticker,
        coalesce(c.c_name, o_orderpriority || '/' || o_custkey) AS event_ticker
    FROM orders LEFT JOIN (SELECT * FROM customer WHERE c_custkey % 3 <> 0) c ON o_custkey = c_custkey
    """
)
def ticker_meta_join(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", F.concat_ws("/", "o_orderpriority", F.col("o_custkey").cast("string")).alias("market_ticker"), "o_custkey")
    customers = table(spark, sf_dir, "customer").where(F.col("c_custkey") % 3 != 0)
    named = orders.select("market_ticker", "o_custkey").distinct().join(customers, F.col("o_custkey") == F.col("c_custkey"))
    meta = named.select("market_ticker", F.col("c_mktsegment").alias("series_ticker"), F.col("c_name").alias("event_ticker"))
    return catalog.with_ticker_meta(orders, meta, ()).select("o_orderkey", "series_ticker", "event_ticker")


@query("SELECT c_custkey AS market_ticker FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE year(o_orderdate) = 1995)")
def missing_daily(spark, sf_dir):
    stored = table(spark, sf_dir, "orders").where(F.year("o_orderdate") == 1995).select(F.col("o_custkey").alias("market_ticker"))
    return audit.missing_tickers(table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("market_ticker")), stored)


@query("SELECT event_id, user_id FROM events WHERE user_id IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')")
def focus_semi(spark, sf_dir):
    focus = table(spark, sf_dir, "customer").where(F.col("c_mktsegment") == "BUILDING").select(F.col("c_custkey").alias("market_ticker"))
    return incremental.only(table(spark, sf_dir, "events").withColumn("market_ticker", F.col("user_id")), focus).select("event_id", "user_id")


def _tier_rows(spark, sf_dir, status: str):
    orders = table(spark, sf_dir, "orders").where(F.col("o_orderstatus") == status)
    return orders.select(F.col("o_custkey").alias("event_ticker"), F.col("o_orderkey").cast("string").alias("market_ticker"), F.lit(status).alias("source"))


@query(
    """
    WITH t AS (SELECT o_custkey, o_orderkey, o_orderstatus, CASE o_orderstatus WHEN 'P' THEN 0 WHEN 'F' THEN 1 ELSE 2 END AS tier FROM orders)
    SELECT o_custkey AS event_ticker, CAST(o_orderkey AS VARCHAR) AS market_ticker, o_orderstatus AS source
    FROM t QUALIFY tier = min(tier) OVER (PARTITION BY o_custkey)
    """
)
def market_tiers(spark, sf_dir):
    events = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("event_ticker"))
    return catalog.markets_of_events(events, *[_tier_rows(spark, sf_dir, s) for s in "PFO"])


@query(
    """
    WITH t AS (SELECT o_custkey, o_orderkey, CASE o_orderstatus WHEN 'P' THEN 0 WHEN 'F' THEN 1 ELSE 2 END AS tier FROM orders),
    b AS (SELECT o_custkey, min(struct_pack(tier := tier, pos := o_orderkey)) AS m FROM t GROUP BY 1)
    SELECT CAST(c_custkey AS VARCHAR) AS event_ticker, CAST(coalesce(m.pos, CASE WHEN c_custkey % 2 = 0 THEN c_custkey END) AS VARCHAR) AS market_ticker
    FROM customer LEFT JOIN b ON c_custkey = o_custkey
    """
)
def first_market(spark, sf_dir):
    as_text = lambda df: df.withColumns({"event_ticker": F.col("event_ticker").cast("string"), "pos": F.col("market_ticker").cast("long")})
    events = table(spark, sf_dir, "customer").select(F.col("c_custkey").cast("string").alias("event_ticker"))
    known = events.where(F.col("event_ticker").cast("long") % 2 == 0).select(F.col("event_ticker").alias("market_ticker"))
    return catalog.market_of_event(events, *[as_text(_tier_rows(spark, sf_dir, s)) for s in "PFO"], known_markets=known)


@query(
    """
    WITH l AS (SELECT o_custkey, max(epoch_us(o_orderdate::TIMESTAMP) // 1000) AS ms FROM orders WHERE o_orderstatus = 'P' GROUP BY 1),
    h AS (SELECT o_custkey, max(epoch_us(o_orderdate::TIMESTAMP) // 1000) AS ms FROM orders WHERE o_orderstatus = 'F' GROUP BY 1)
    SELECT c_custkey AS market_ticker, coalesce(l.ms, h.ms, -1) AS open_ts_ms, 'unknown' AS expiration,
        CASE WHEN l.ms IS NOT NULL THEN 'P' WHEN h.ms IS NOT NULL THEN 'F' ELSE 'unknown' END AS status
    FROM customer LEFT JOIN l ON c_custkey = l.o_custkey LEFT JOIN h ON c_custkey = h.o_custkey
    """
)
def meta_tiers(spark, sf_dir):
    """Each order is a payload of its customer's market, so most tickers have several: the last ingested counts."""
    def tier(status):
        payload = table(spark, sf_dir, "orders").where(F.col("o_orderstatus") == status).select(
            F.unix_seconds(F.col("o_orderdate").cast("timestamp")).alias("ingest_ts"),
            F.col("o_custkey").alias("ticker"), F.date_format(F.col("o_orderdate").cast("timestamp"), "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("open_time"),
            F.lit("").alias("expiration_time"), F.lit(None).cast("string").alias("latest_expiration_time"), F.lit(status).alias("status"),
        )
        return catalog.metadata_columns(payload)

    tickers = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("market_ticker"))
    return catalog.market_metadata(tickers, tier("P"), tier("F")).fillna(-1, ["open_ts_ms"])


@query("SELECT CAST(user_id AS VARCHAR) AS event_ticker, arg_min(event_type, event_id) AS title FROM events GROUP BY 1")
def event_first_title(spark, sf_dir):
    rows = table(spark, sf_dir, "events").select(F.col("user_id").cast("string").alias("event_ticker"), "event_id", F.col("event_type").alias("title"))
    return catalog.first_by(rows, "event_ticker", "event_id").drop("event_id")


AS_OF = 904_608_000_000  # 1998-09-01


def _daily(spark, sf_dir):
    parts = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("market_ticker"), F.col("p_brand").alias("series_ticker"))
    lines = table(spark, sf_dir, "lineitem").select(F.col("l_partkey").alias("market_ticker"), F.unix_millis(F.col("l_shipdate").cast("timestamp")).alias("ts_ms"), F.col("l_quantity").alias("volume"))
    return lines.join(parts, "market_ticker")


_AUDIT_SQL = f"""
    SELECT l_partkey AS ticker, p_brand AS series, count(*) AS daily_rows, min(ms) AS first_ts_ms, max(ms) AS last_ts_ms,
        sum(l_quantity) AS total_volume, sum(CASE WHEN ms >= {AS_OF - 30 * DAY_MS} THEN l_quantity ELSE 0 END) AS recent_volume_30d
    FROM (SELECT *, epoch_us(l_shipdate::TIMESTAMP) // 1000 AS ms FROM lineitem) JOIN part ON l_partkey = p_partkey GROUP BY ALL
"""
_DENSE_SQL = f"""
    SELECT *, CASE WHEN total_volume >= 1000 OR recent_volume_30d >= 100 THEN 'dense' ELSE 'sparse' END AS hourly_expectation,
        CASE WHEN recent_volume_30d >= 500 THEN 'dense' ELSE 'sparse' END AS minute_expectation FROM ({_AUDIT_SQL})
"""


@query(_DENSE_SQL)
def audit_ticker(spark, sf_dir):
    return audit.audit_tickers(_daily(spark, sf_dir), AS_OF)


@query(
    f"""
    SELECT series, grouping(series) = 1 AS is_total, count(*) AS n_tickers, CAST(sum(daily_rows) AS BIGINT) AS daily_rows, sum(total_volume) AS total_volume,
        sum(recent_volume_30d) AS recent_volume_30d,
        CASE WHEN grouping(series) = 0 THEN count(*) FILTER (WHERE hourly_expectation = 'dense') ELSE -1 END AS dense_hourly,
        CASE WHEN grouping(series) = 0 THEN count(*) FILTER (WHERE minute_expectation = 'dense') ELSE -1 END AS dense_minute
    FROM ({_DENSE_SQL}) GROUP BY ROLLUP (series)
    """
)
def audit_series(spark, sf_dir):
    return audit.audit_series(audit.audit_tickers(_daily(spark, sf_dir), AS_OF)).fillna(-1, ["dense_hourly", "dense_minute"])


@query("SELECT c_mktsegment AS category, count(*) AS n FROM customer WHERE c_mktsegment IS NOT NULL GROUP BY 1")
def category_counts(spark, sf_dir):
    return catalog.category_counts(table(spark, sf_dir, "customer").select(F.col("c_mktsegment").alias("category")))


@query("SELECT c_custkey, c_mktsegment AS category FROM customer WHERE coalesce(c_mktsegment ILIKE '%build%', false)")
def category_contains(spark, sf_dir):
    return catalog.in_category(table(spark, sf_dir, "customer").select("c_custkey", F.col("c_mktsegment").alias("category")), "Build")


@query(
    """
    WITH m AS (SELECT r_name AS series, n_name, c_custkey FROM region JOIN nation ON r_regionkey = n_regionkey JOIN customer ON c_nationkey = n_nationkey)
    SELECT series, count(DISTINCT n_name) AS n_events, count(*) AS n_markets, count(DISTINCT c_custkey) AS n_tickers FROM m GROUP BY series
    UNION ALL SELECT NULL, count(DISTINCT n_name), count(*), count(DISTINCT c_custkey) FROM m
    """
)
def catalog_counts(spark, sf_dir):
    nations = table(spark, sf_dir, "region").join(table(spark, sf_dir, "nation"), F.col("r_regionkey") == F.col("n_regionkey"))
    text = lambda c: F.col(c).cast("string")
    both = nations.join(table(spark, sf_dir, "customer"), F.col("c_nationkey") == F.col("n_nationkey"))
    markets = both.select(
        F.col("r_name").alias("series"), F.col("n_name").alias("event_ticker"), text("c_custkey").alias("market_ticker"), F.col("c_name").alias("title"),
        F.col("c_mktsegment").alias("status"), F.lit("historical").alias("source"),
    )
    events = both.select(F.col("r_name").alias("series"), F.col("n_name").alias("event_ticker"), F.col("n_name").alias("title"))
    counts = catalog.member_counts(events, markets)
    return counts.select("series", *[F.col(c).cast("long").alias(c) for c in ("n_events", "n_markets", "n_tickers")])


@query(
    """
    SELECT o_orderkey, CASE WHEN o_orderpriority LIKE '1-%' THEN '1' WHEN o_orderpriority LIKE '2-%' THEN '2' ELSE split_part(o_orderpriority, '-', 1) END AS of_market,
        'KX' || regexp_replace(o_orderpriority, '-[^-]*$', '') AS of_event
    FROM orders
    """
)
def prefix_split(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    return orders.select("o_orderkey", S.series_of_market("o_orderpriority", ("1", "2")).alias("of_market"), S.series_of_event("o_orderpriority").alias("of_event"))


@query(
    """
    WITH s AS (SELECT DISTINCT CASE WHEN o_orderkey % 2 = 0 THEN 'KX' ELSE '' END || split_part(o_orderpriority, '-', 1) AS series FROM orders)
    SELECT series, 0 AS variant_pos, CASE WHEN series LIKE 'KX%' THEN series ELSE 'KX' || series END AS variant FROM s
    UNION ALL SELECT series, 1, CASE WHEN series LIKE 'KX%' THEN substr(series, 3) ELSE series END FROM s
    """
)
def variants(spark, sf_dir):
    name = F.concat(F.when(F.col("o_orderkey") % 2 == 0, "KX").otherwise(""), F.split_part(F.col("o_orderpriority"), F.lit("-"), F.lit(1)))
    return catalog.series_variants(table(spark, sf_dir, "orders").select(name.alias("series")).distinct())


@query(
    f"""
    WITH l AS (SELECT user_id, max({MS}) AS ms FROM events GROUP BY 1), o AS (SELECT c_custkey, 725846400000 + c_custkey * 1000 AS open_ms FROM customer WHERE c_custkey % 4 <> 0),
    p AS (SELECT c.c_custkey AS market_ticker, coalesce(ms // 1000, open_ms // 1000) AS start_s FROM customer c LEFT JOIN l ON c.c_custkey = user_id LEFT JOIN o ON c.c_custkey = o.c_custkey),
    m AS (SELECT max(ms) // 1000 - 86400 AS as_of FROM l)
    SELECT market_ticker, coalesce(start_s, -1) AS start_s, CASE WHEN start_s IS NULL THEN 'no stored rows and no open time' WHEN start_s >= as_of THEN 'up to date' END AS reason FROM p, m
    """
)
def resume_points(spark, sf_dir):
    stored = user_events(spark, sf_dir).select(F.col("user_id").alias("market_ticker"), "ts_ms")
    customers = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("market_ticker"))
    meta = customers.where(F.col("market_ticker") % 4 != 0).withColumn("open_ts_ms", F.lit(725_846_400_000) + F.col("market_ticker") * 1000)
    as_of = stored.agg(F.max("ts_ms")).first()[0] // 1000 - incremental.DAY
    return incremental.resume_points(customers, stored, meta, as_of).fillna(-1, ["start_s"])


def _tape(spark, sf_dir):
    return user_events(spark, sf_dir).select(F.col("event_id").alias("trade_id"), "market_ticker", "ts_ms")


@query(
    f"""
    WITH t AS (SELECT event_id AS trade_id, {TICKER} AS market_ticker, {MS} AS ts_ms FROM events),
    c AS (SELECT market_ticker, arg_max(ts_ms, (ts_ms, trade_id)) AS cutoff FROM t WHERE trade_id % 4 = 0 GROUP BY 1)
    SELECT t.* FROM t LEFT JOIN c USING (market_ticker) WHERE cutoff IS NULL OR ts_ms > cutoff
    """
)
def trades_after_cutoff(spark, sf_dir):
    tape = _tape(spark, sf_dir)
    return incremental.new_trades(tape, tape.where(F.col("trade_id") % 4 == 0), "strict_ts")


@query(f"SELECT event_id AS trade_id, {TICKER} AS market_ticker, {MS} AS ts_ms FROM events WHERE event_id % 4 <> 0 AND {MS} >= 1704067200000")
def trades_not_stored(spark, sf_dir):
    tape = _tape(spark, sf_dir)
    return incremental.new_trades(tape, tape.where(F.col("trade_id") % 4 == 0), "anti_join", since_ms=1_704_067_200_000)


@query(f"SELECT {TICKER} AS market_ticker, arg_max(event_id, ({MS}, event_id)) AS last_trade_id FROM events GROUP BY 1")
def latest_trade(spark, sf_dir):
    return incremental.latest_trades(_tape(spark, sf_dir))


@query(
    f"""
    WITH p AS (SELECT o_custkey AS market_ticker, min(epoch_us(o_orderdate::TIMESTAMP)) // 1000000 AS start_s FROM orders GROUP BY 1)
    SELECT market_ticker, start_s + i * 31536000 AS window_start_s, least(start_s + (i + 1) * 31536000, {AS_OF // 1000}) AS window_end_s
    FROM (SELECT *, unnest(range(0, CAST(ceil(({AS_OF // 1000} - start_s) / 31536000.0) AS BIGINT))) AS i FROM p WHERE start_s < {AS_OF // 1000})
    """
)
def backfill_windows(spark, sf_dir):
    first = table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("market_ticker")).agg(F.min(F.unix_seconds(F.col("o_orderdate").cast("timestamp"))).alias("start_s"))
    return incremental.windows(first, AS_OF // 1000, 1440)


@query(
    """
    SELECT l_orderkey AS market_ticker, epoch_us(max(l_shipdate)::TIMESTAMP) // 1000000 AS window_start_s
    FROM lineitem GROUP BY l_orderkey HAVING count(*) >= 5 AND max(l_shipdate) > min(l_shipdate)
    """
)
def truncated_pages(spark, sf_dir):
    seconds = F.unix_seconds(F.col("l_shipdate").cast("timestamp"))
    pages = table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("market_ticker")).agg(
        F.min(seconds).alias("start_ts"), F.max(seconds).alias("adjusted_end_ts"), (F.count("*") * 1000).alias("n_candles")
    )
    return incremental.truncated_pages(pages)


@query("SELECT strftime(o_orderdate, '%Y-%m') AS ym, year(o_orderdate) AS year, month(o_orderdate) AS month, count(*) AS n FROM orders GROUP BY ALL")
def partition_counts(spark, sf_dir):
    ms = F.unix_millis(F.col("o_orderdate").cast("timestamp"))
    return table(spark, sf_dir, "orders").groupBy(S.year_month(ms).alias("ym"), S.year_of(ms).cast("long").alias("year"), S.month_of(ms).cast("long").alias("month")).agg(F.count("*").alias("n"))


@query(
    """
    SELECT l_orderkey, l_linenumber, 'price' AS violated, l_discount AS found FROM lineitem WHERE l_discount < 0.02 OR l_discount > 0.08
    """
)
def dq_violations(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", F.col("l_discount").alias("price"))
    return quality.violations(rows, low=0.02, high=0.08).drop("price")


@query("SELECT p_partkey, p_brand || ' above_below_between ' || p_name AS title FROM part WHERE p_size % 3 = 0")
def template_titles(spark, sf_dir):
    """Titles of which a third still holds the template."""
    middle = F.when(F.col("p_size") % 3 == 0, F.lit(" above_below_between ")).otherwise(F.lit(" above, below or between "))
    return quality.template_titles(table(spark, sf_dir, "part").select("p_partkey", F.concat("p_brand", middle, "p_name").alias("title")))


@query(
    """
    SELECT 'orders' AS dataset, CAST(o_custkey AS VARCHAR) AS market_ticker, 'no price' AS reason, count(*) AS n
    FROM orders WHERE o_orderstatus = 'P' GROUP BY ALL
    """
)
def quarantined(spark, sf_dir):
    price = F.when(F.col("o_orderstatus") == "P", F.lit("n/a")).otherwise(F.col("o_totalprice").cast("string"))
    rows = table(spark, sf_dir, "orders").select(F.col("o_custkey").cast("string").alias("market_ticker"), S.number(price).alias("price"))
    _, bad = quality.split_bad(rows, "orders", ("market_ticker", "price"))
    return bad.groupBy("dataset", "market_ticker", "reason").agg(F.count("*").alias("n"))


@query(
    """
    SELECT count(*) FILTER (WHERE c_acctbal >= 0) AS processed, count(*) FILTER (WHERE c_acctbal < 0) AS skipped,
        CAST(7 AS BIGINT) AS rows_written, CAST(0.5 AS DOUBLE) AS elapsed_sec
    FROM customer
    """
)
def run_counters(spark, sf_dir):
    points = table(spark, sf_dir, "customer").select(F.when(F.col("c_acctbal") < 0, F.lit("in debt")).alias("reason"))
    return quality.run_counters(points, 7, 0.5)


@query("SELECT DISTINCT o_custkey AS market_ticker FROM orders ORDER BY 1 LIMIT 25")
def limit_sorted(spark, sf_dir):
    return table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("market_ticker")).distinct().orderBy("market_ticker").limit(25)


def _candle_rows(spark, sf_dir):
    """events as daily candles: one per user and day and, before merging, several."""
    rows = user_events(spark, sf_dir)
    price = F.round(F.col("value") % 1, 6)
    return rows.select(
        (F.floor(F.col("ts_ms") / DAY_MS) * DAY_MS).alias("ts_ms"), *[price.alias(b) for b in (*normalize.BARS, "mean")], F.col("value").alias("volume"),
        F.col("event_id").cast("double").alias("open_interest"), "market_ticker", F.col("market_ticker").alias("event_ticker"), F.col("event_type").alias("kind"), "event_id",
        F.lit("ALL").alias("series_ticker"),
    )


_STORED_SQL = f"""
    SELECT market_ticker, ts_ms, max(event_id) AS last_event, arg_max(value, event_id) AS volume
    FROM (SELECT *, {TICKER} AS market_ticker, {MS} // {DAY_MS} * {DAY_MS} AS ts_ms FROM events) GROUP BY ALL
"""


@query(_STORED_SQL)
def table_upsert(spark, sf_dir):
    """Two upserts into a stored table, the second with newer and repeated rows, and the table read back."""
    daily = upsert.tables()["daily"]
    rows = _candle_rows(spark, sf_dir)
    root = scratch(spark, "upsert")
    first = rows.where(F.col("event_id") % 2 == 0)
    upsert.upsert(first.select(*daily.schema.names, "event_id"), root, daily, "event_id")
    upsert.upsert(rows.select(*daily.schema.names, "event_id"), root, daily, "event_id")
    return upsert.read_table(spark, root, daily).select("market_ticker", "ts_ms", F.col("open_interest").cast("long").alias("last_event"), "volume")


_SERIES_SQL = """
    WITH l AS (
        SELECT 'P' || l_suppkey AS market_ticker, epoch_us(l_shipdate::TIMESTAMP) // 1000 AS ts_ms, l_orderkey * 8 + l_linenumber AS seq, l_quantity AS volume
        FROM lineitem
    ), k AS (SELECT market_ticker, ts_ms, arg_max(volume, (seq % 16 >= 8, seq)) AS volume FROM l GROUP BY ALL)
    SELECT market_ticker, ts_ms, volume, CASE WHEN bool_or(early) THEN 'OLD' ELSE 'NEW' END AS series_ticker, {more}
    FROM k JOIN (SELECT market_ticker, bool_or(seq % 16 < 8) AS early FROM l GROUP BY 1) USING (market_ticker)
    GROUP BY ALL
"""


def _two_upserts(spark, sf_dir, name: str) -> DataFrame:
    """Two upserts of candles of many years; between them the catalog moves all tickers from series OLD to NEW, but what
    is stored stays in its partition."""
    target, root = upsert.tables()[name], scratch(spark, name)
    lines = table(spark, sf_dir, "lineitem").select(
        F.unix_millis(F.col("l_shipdate").cast("timestamp")).alias("ts_ms"), F.col("l_quantity").alias("volume"),
        F.concat(F.lit("P"), F.col("l_suppkey").cast("string")).alias("market_ticker"), (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("seq"),
    ).withColumn("event_ticker", F.col("market_ticker"))
    none = {c: F.lit(None).cast("double") for c in (*normalize.BARS, "mean", "open_interest")}
    for series, part in (("OLD", F.col("seq") % 16 < 8), ("NEW", F.col("seq") % 16 >= 8)):
        rows = lines.where(part).withColumns(none | {"series_ticker": F.lit(series)})
        upsert.upsert(rows.select(*target.schema.names, "seq"), root, target, "seq")
    return upsert.read_table(spark, root, target).select("market_ticker", "ts_ms", "volume", "series_ticker", *[c for c in target.partition_names if c != "series_ticker"])


@query(_SERIES_SQL.format(more="year(make_timestamp(ts_ms * 1000))::INT AS year"))
def table_upsert_by_year(spark, sf_dir):
    return _two_upserts(spark, sf_dir, "hourly")


@query(_SERIES_SQL.format(more="year(make_timestamp(ts_ms * 1000))::INT AS year, month(make_timestamp(ts_ms * 1000))::INT AS month"))
def table_upsert_by_month(spark, sf_dir):
    return _two_upserts(spark, sf_dir, "minute")


@query(
    f"""
    WITH e AS (SELECT *, {TICKER} AS market_ticker, {MS} // {DAY_MS} * {DAY_MS} AS ts_ms FROM events WHERE event_id % 10 <> 7)
    SELECT market_ticker, ts_ms, arg_max(event_id, (event_id % 2, event_id)) AS last_event, arg_max(value, (event_id % 2, event_id)) AS volume FROM e GROUP BY ALL
    """
)
def stream_upsert(spark, sf_dir):
    """Raw pages land in two goes; the daily feed takes each until all is taken. What lands later replaces, and of
    pages that land together the last ingested stays; a page with a volume that is no number is quarantined."""
    root = scratch(spark, "stream")
    for part in (0, 1):
        _candle_pages(spark, sf_dir).where(F.col("ingest_ts") % 2 == part).write.mode("append").json(f"{root}/landing/candles")
        feeds.start_feed(spark, "daily", f"{root}/landing", f"{root}/lake", meta=_one_series(spark, sf_dir), once=True).awaitTermination()
    stored = upsert.read_table(spark, f"{root}/lake", upsert.tables()["daily"])
    return stored.select("market_ticker", "ts_ms", F.col("open_interest").cast("long").alias("last_event"), "volume")


@query(
    f"""
    SELECT 'U' || user_id AS market_ticker, 'cannot parse volume n/a' AS reason, count(*) AS n FROM events WHERE event_id % 10 = 7 GROUP BY ALL
    """
)
def quarantined_once(spark, sf_dir):
    """The quarantine of a backfill that is run twice."""
    root = scratch(spark, "quarantine")
    _candle_pages(spark, sf_dir).write.json(f"{root}/landing/candles")
    _trade_pages(spark, sf_dir).write.json(f"{root}/landing/trades")
    for _ in range(2):
        feeds.backfill(spark, f"{root}/landing", f"{root}/lake", _one_series(spark, sf_dir))
    return spark.read.parquet(f"{root}/lake/quarantine").where("dataset = 'daily'").groupBy("market_ticker", "reason").agg(F.count("*").alias("n"))


def _one_series(spark, sf_dir) -> DataFrame:
    """A catalog in which all users are tickers of one series; by name each would be a series, and a partition, of its own."""
    tickers = user_events(spark, sf_dir).select("market_ticker").distinct()
    return tickers.withColumns({"series_ticker": F.lit("ALL"), "event_ticker": F.col("market_ticker")})


def _candle_pages(spark, sf_dir) -> DataFrame:
    """Each event as a raw page of one daily candle; every tenth has a volume that is no number."""
    events = user_events(spark, sf_dir)
    volume = F.when(F.col("event_id") % 10 == 7, F.lit("n/a")).otherwise(F.col("value").cast("string"))
    price = F.struct(*[F.lit("0.5").alias(b) for b in (*normalize.BARS, "mean")])
    candle = F.struct((F.floor(F.col("ts_ms") / DAY_MS) * (DAY_MS // 1000)).alias("end_period_ts"), volume.alias("volume"), F.col("event_id").cast("string").alias("open_interest"), price.alias("price"))
    return events.select(
        "market_ticker", F.lit("historical").alias("tape"), F.lit(1440).alias("period_minutes"), F.lit(0).alias("start_ts"), F.col("event_id").alias("ingest_ts"), F.array(candle).alias("candlesticks")
    )


def _trade_pages(spark, sf_dir) -> DataFrame:
    """The events of a user and type as raw pages of trades, most of them on both tapes; counts differ by tape."""
    events = user_events(spark, sf_dir)
    tapes = F.when(F.col("event_id") % 5 == 0, F.array(F.lit("live"))).otherwise(F.array(F.lit("historical"), F.lit("live")))
    each = events.withColumn("tape", F.explode(tapes))
    count = F.col("event_id") + F.when(F.col("tape") == "live", 1_000_000).otherwise(0)
    trade = F.struct(
        F.col("event_id").cast("string").alias("trade_id"), F.col("market_ticker").alias("ticker"),
        F.date_format(F.col("ts").cast("timestamp"), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'").alias("created_time"),
        F.lit("0.25").alias("yes_price_dollars"), F.lit("0.75").alias("no_price_dollars"), count.cast("string").alias("count_fp"), F.lit("yes").alias("taker_side"),
    )
    pages = each.groupBy("tape", "user_id", F.floor(F.col("event_id") / 64).alias("page")).agg(F.collect_list(trade).alias("trades"))
    return pages.select("tape", F.lit(1).alias("ingest_ts"), "page", "trades")


@query(
    """
    SELECT 'O' || l_orderkey AS market_ticker, epoch_us(l_shipdate::TIMESTAMP) // 1000 AS ts_ms,
        CASE WHEN l_orderkey % 2 = 0 THEN coalesce(nullif(l_discount, 0.05), l_tax) ELSE nullif(l_discount, 0.05) END AS open,
        CASE WHEN l_orderkey % 2 = 0 THEN l_tax END AS close, l_quantity AS volume
    FROM lineitem
    """
)
def landed_candles(spark, sf_dir):
    """Orders as landed candle pages, even ones of the historical and odd ones of the live shape, read and united."""
    price, text = F.nullif(F.col("l_discount"), F.lit(0.05)), lambda c: c.cast("string")
    live = F.col("l_orderkey") % 2 == 1
    old = F.struct(F.when(~live, text(price)).alias("open"), F.when(live, text(price)).alias("open_dollars"))
    candle = F.struct(
        F.unix_seconds(F.col("l_shipdate").cast("timestamp")).alias("end_period_ts"), F.when(~live, text(F.col("l_quantity"))).alias("volume"),
        F.when(live, text(F.col("l_quantity"))).alias("volume_fp"), old.alias("price"), F.struct(*[F.when(~live, text(F.col("l_tax"))).alias(b) for b in normalize.BARS]).alias("yes_bid"),
    )
    lines = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.collect_list(candle).alias("candlesticks"))
    pages = lines.select(
        F.concat(F.lit("O"), F.col("l_orderkey").cast("string")).alias("market_ticker"), F.when(live, "live").otherwise("historical").alias("tape"), F.lit(1440).alias("period_minutes"),
        F.lit(0).alias("start_ts"), F.lit(1).alias("ingest_ts"), "candlesticks",
    )
    path = f"{scratch(spark, 'pages')}/candles"
    pages.write.json(path)
    rows = normalize.normalize_candles(landing.candle_pages(spark, path))
    return rows.select("market_ticker", "ts_ms", "open", "close", "volume")


@query(
    """
    SELECT 'O' || l_orderkey AS market_ticker, count(*)::INT AS n_candles, epoch_us(max(l_shipdate)::TIMESTAMP) // 1000000 AS adjusted_end_ts
    FROM lineitem GROUP BY l_orderkey
    """
)
def landed_page_sizes(spark, sf_dir):
    seconds = F.unix_seconds(F.col("l_shipdate").cast("timestamp"))
    pages = table(spark, sf_dir, "lineitem").groupBy(F.concat(F.lit("O"), F.col("l_orderkey").cast("string")).alias("market_ticker")).agg(
        F.max(seconds).alias("adjustedEndTs"), F.collect_list(F.struct(seconds.alias("end_period_ts"))).alias("candlesticks")
    )
    path = f"{scratch(spark, 'pages')}/candles"
    pages.write.json(path)
    return landing.candle_page_sizes(spark, path).select("market_ticker", "n_candles", "adjusted_end_ts")


@query(
    f"""
    SELECT CAST(event_id AS VARCHAR) AS trade_id, {TICKER} AS market_ticker, {MS} AS ts_ms, 0.25 AS yes_price, 0.75 AS no_price,
        CAST(event_id + CASE WHEN event_id % 5 = 0 THEN 1000000 ELSE 0 END AS DOUBLE) AS count, 'yes' AS taker_side
    FROM events
    """
)
def landed_trades(spark, sf_dir):
    """Landed trade pages of both tapes, each trade once: the historical tape wins."""
    path = f"{scratch(spark, 'pages')}/trades"
    _trade_pages(spark, sf_dir).write.json(path)
    return upsert.keep_last(normalize.normalize_trades(normalize.unite_tapes(landing.trade_pages(spark, path))), ["trade_id"])


@query(
    """
    SELECT CAST(0 AS BIGINT) AS ts_ms, CAST(user_id AS VARCHAR) AS market_ticker, CASE WHEN event_type = 'click' THEN 'YES' ELSE 'NO' END AS side,
        value AS price, CAST(event_id AS DOUBLE) AS quantity,
        sum(CAST(event_id AS DOUBLE)) OVER (w ROWS UNBOUNDED PRECEDING) AS cumulative_qty, row_number() OVER w - 1 AS distance_from_top
    FROM events WINDOW w AS (PARTITION BY user_id, event_type = 'click' ORDER BY value DESC, event_id)
    """
)
def landed_books(spark, sf_dir):
    """A landed order book for each user: [price, quantity] texts of both sides."""
    pair = F.array(F.col("value").cast("string"), F.col("event_id").cast("string"))
    entry = F.struct("event_id", pair.alias("level"))
    side = lambda yes: F.transform(F.array_sort(F.collect_list(F.when(yes, entry))), lambda x: x["level"])
    click = F.col("event_type") == "click"
    pages = table(spark, sf_dir, "events").groupBy(F.col("user_id").cast("string").alias("market_ticker")).agg(side(click).alias("yes_dollars"), side(~click).alias("no_dollars"))
    path = f"{scratch(spark, 'pages')}/orderbook"
    pages.select("market_ticker", F.lit(0).alias("ts_ms"), F.struct("yes_dollars", "no_dollars").alias("orderbook_fp")).write.json(path)
    return normalize.book_levels(landing.book_pages(spark, path))


@query(
    """
    WITH o AS (SELECT o_custkey, o_orderstatus AS s, o_orderdate AS d, o_orderpriority AS p, o_orderkey AS k FROM orders WHERE o_orderstatus <> 'P'),
    l AS (SELECT o_custkey, max((d, p)) AS m FROM o WHERE s = 'O' GROUP BY 1), h AS (SELECT o_custkey, max((d, p)) AS m FROM o WHERE s = 'F' GROUP BY 1),
    b AS (SELECT c_custkey, coalesce(l.m, h.m) AS m, l.m IS NOT NULL AS live FROM customer LEFT JOIN l ON c_custkey = l.o_custkey LEFT JOIN h ON c_custkey = h.o_custkey)
    SELECT 'C' || c_custkey AS market_ticker, coalesce(epoch_us(m[1]::TIMESTAMP) // 1000, -1) AS open_ts_ms, coalesce(m[2], 'unknown') AS expiration,
        CASE WHEN m IS NULL THEN 'unknown' WHEN live THEN 'open' ELSE 'closed' END AS status
    FROM b
    """
)
def landed_metadata(spark, sf_dir):
    """Market payloads of both tapes that landed again and again; the last ingested counts."""
    live = F.col("o_orderstatus") == "O"
    market = F.struct(
        F.concat(F.lit("C"), F.col("o_custkey").cast("string")).alias("ticker"), F.when(live, "open").otherwise("closed").alias("status"),
        F.date_format(F.col("o_orderdate").cast("timestamp"), "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("open_time"),
        F.when(live, F.col("o_orderpriority")).otherwise("").alias("expiration_time"), F.col("o_orderpriority").alias("latest_expiration_time"),
    )
    payloads = table(spark, sf_dir, "orders").where("o_orderstatus <> 'P'").select(
        F.when(live, "live").otherwise("historical").alias("tape"), F.unix_seconds(F.col("o_orderdate").cast("timestamp")).alias("ingest_ts"), market.alias("market")
    )
    path = f"{scratch(spark, 'pages')}/markets"
    payloads.write.json(path)
    read = landing.market_payloads(spark, path)
    tickers = table(spark, sf_dir, "customer").select(F.concat(F.lit("C"), F.col("c_custkey").cast("string")).alias("market_ticker"))
    both = [catalog.metadata_columns(read.where(F.col("tape") == t)) for t in ("live", "historical")]
    return catalog.market_metadata(tickers, *both).fillna(-1, ["open_ts_ms"])


@query(
    """
    SELECT n_name AS event_ticker, CAST(c_custkey AS VARCHAR) AS market_ticker, CASE WHEN c_custkey % 3 = 0 THEN '' ELSE c_name END AS title,
        c_mktsegment AS status, 'live_event' AS source
    FROM customer JOIN nation ON c_nationkey = n_nationkey
    """
)
def landed_markets(spark, sf_dir):
    """Listed markets of each nation's event; missing titles are empty."""
    customers = table(spark, sf_dir, "customer").join(table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    market = F.struct(
        F.col("c_custkey").cast("string").alias("ticker"), F.col("n_name").alias("event_ticker"), F.when(F.col("c_custkey") % 3 != 0, F.col("c_name")).alias("title"), F.col("c_mktsegment").alias("status")
    )
    pages = customers.groupBy("n_name", F.floor(F.col("c_custkey") / 100).alias("page")).agg(F.collect_list(market).alias("markets"))
    path = f"{scratch(spark, 'pages')}/listings"
    pages.select(F.lit("live").alias("listing"), "markets").write.json(path)
    return catalog.market_rows(landing.market_listings(spark, path), "live_event")


@query(
    """
    SELECT CASE WHEN r_regionkey % 2 = 0 THEN r_name ELSE 'KX' || r_name END AS series, n_name AS event_ticker, CASE WHEN n_nationkey % 2 = 0 THEN 'first' ELSE 'second' END || n_nationkey AS title
    FROM nation JOIN region ON n_regionkey = r_regionkey WHERE n_nationkey % 7 <> 3
    """
)
def landed_events(spark, sf_dir):
    """Events that two listings show under one spelling or the other; those without ticker are skipped."""
    regions = table(spark, sf_dir, "region").withColumn("series", F.when(F.col("r_regionkey") % 2 == 0, F.col("r_name")).otherwise(F.concat(F.lit("KX"), "r_name")))
    nations = table(spark, sf_dir, "nation").join(regions, F.col("n_regionkey") == F.col("r_regionkey"))
    # the first title is of the newer spelling in the first listing, where even nations are; all are in the last
    shown = F.array(F.struct(F.lit("events").alias("listing"), F.lit("first").alias("t"), F.lit(0).alias("rest")), F.struct(F.lit("live").alias("listing"), F.lit("second").alias("t"), F.lit(1).alias("rest")))
    each = nations.withColumn("x", F.explode(shown)).where((F.col("x.rest") == 1) | (F.col("n_nationkey") % 2 == 0))
    event = F.struct(F.when(F.col("n_nationkey") % 7 != 3, F.col("n_name")).alias("event_ticker"), F.concat(F.col("x.t"), F.col("n_nationkey").cast("string")).alias("title"))
    variant = F.concat(F.when(F.col("x.rest") == 0, "KX").otherwise(""), "r_name")
    pages = each.groupBy(F.col("x.listing").alias("listing"), variant.alias("variant")).agg(F.collect_list(event).alias("events"))
    path = f"{scratch(spark, 'pages')}/events"
    pages.write.json(path)
    return catalog.discovered_events(landing.event_listings(spark, path), regions.select("series"))


@query(
    """
    SELECT n_name AS ticker, n_name || '!' AS title, r_name AS category, 'monthly' AS frequency, CASE WHEN n_nationkey % 3 = 0 THEN '' ELSE n_name || ', ' || r_name END AS tags
    FROM nation JOIN region ON n_regionkey = r_regionkey
    """
)
def landed_series(spark, sf_dir):
    nations = table(spark, sf_dir, "nation").join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    series = F.struct(
        F.col("n_name").alias("ticker"), F.concat("n_name", F.lit("!")).alias("title"), F.col("r_name").alias("category"), F.lit("monthly").alias("frequency"),
        F.when(F.col("n_nationkey") % 3 != 0, F.array("n_name", "r_name")).alias("tags"),
    )
    path = f"{scratch(spark, 'pages')}/series"
    nations.groupBy("r_name").agg(F.collect_list(series).alias("series")).select("series").write.json(path)
    return catalog.series_rows(landing.series_listing(spark, path))


def _catalog(spark, sf_dir) -> DataFrame:
    """The nations of a region as a series' events, their suppliers as markets."""
    nations = table(spark, sf_dir, "region").join(table(spark, sf_dir, "nation"), F.col("r_regionkey") == F.col("n_regionkey"))
    both = nations.join(table(spark, sf_dir, "supplier"), F.col("s_nationkey") == F.col("n_nationkey"))
    markets = both.select(
        F.col("r_name").alias("series"), F.col("n_name").alias("event_ticker"), F.concat(F.lit("S"), F.col("s_suppkey").cast("string")).alias("market_ticker"), F.col("s_name").alias("title"),
        F.lit("open").alias("status"), F.lit("historical").alias("source"),
    )
    return catalog.build_catalog(nations.select(F.col("r_name").alias("series"), F.col("n_name").alias("event_ticker"), F.col("n_name").alias("title")), markets)


_CATALOG_SQL = "SELECT {columns} FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey"


@query(_CATALOG_SQL.format(columns="r_name AS series, n_name AS event_ticker, 'S' || s_suppkey AS market_ticker, s_name AS title, 'open' AS status, 'historical' AS source"))
def catalog_markets(spark, sf_dir):
    """The markets of the catalog as it was written."""
    folder = scratch(spark, "catalog")
    catalog.write_catalog(_catalog(spark, sf_dir), folder)
    return catalog.catalog(spark.read.schema(schemas.CATALOG).json(f"{folder}/json"), "markets")


@query(_CATALOG_SQL.format(columns="DISTINCT 'S' || s_suppkey AS market_ticker"))
def catalog_tickers(spark, sf_dir):
    """The tickers of the combined catalog as it was written."""
    folder = scratch(spark, "catalog")
    catalog.write_combined(_catalog(spark, sf_dir), folder)
    combined = landing.tickers_from_json(spark, f"{folder}/json")
    return combined.join(landing.tickers_from_text(spark, f"{folder}/txt"), "market_ticker", "left_semi")


@query("SELECT 'S' || s_suppkey AS market_ticker FROM supplier ORDER BY 1 LIMIT 7")
def landed_tickers(spark, sf_dir):
    """The first tickers, in code-point order, of a list with blank lines, spaces and repeats."""
    name = F.concat(F.lit("S"), F.col("s_suppkey").cast("string"))
    lines = table(spark, sf_dir, "supplier").select(F.explode(F.array(F.concat(F.lit("  "), name, F.lit("\t")), F.lit(" "), name, F.lit(""))).alias("value"))
    path = f"{scratch(spark, 'list')}/tickers.txt"
    lines.write.text(path)
    return landing.tickers(spark, path, limit=7)


@query(
    """
    SELECT o_orderpriority || '-' || o_custkey AS event_ticker,
        CASE WHEN o_custkey % 4 = 0 THEN max(o_orderstatus) WHEN o_custkey % 4 = 1 THEN 'rest' ELSE 'KX' || o_orderpriority END AS series_ticker,
        CASE WHEN o_custkey % 4 < 2 THEN 1 ELSE 0 END AS n_markets
    FROM orders GROUP BY o_orderpriority, o_custkey
    """
)
def resolved_events(spark, sf_dir):
    """Events from their payloads, which landed several times, else from the other source, else by name."""
    orders = table(spark, sf_dir, "orders").withColumn("event_ticker", F.concat_ws("-", "o_orderpriority", F.col("o_custkey").cast("string")))
    markets = F.array("o_clerk") if "o_clerk" in orders.columns else F.array(F.lit("m"))
    payloads = orders.where("o_custkey % 4 = 0").select("event_ticker", F.col("o_orderstatus").alias("series_ticker"), markets.alias("markets"))
    rest = orders.where("o_custkey % 4 < 2").select("event_ticker", F.lit("rest").alias("series_ticker"), markets.alias("markets"))
    out = catalog.resolved_events(orders.select("event_ticker").distinct(), payloads, rest)
    return out.select("event_ticker", "series_ticker", F.size("markets").alias("n_markets"))


@query(
    """
    SELECT o_orderkey, CASE WHEN o_totalprice = floor(o_totalprice) THEN CAST(CAST(o_totalprice AS BIGINT) AS VARCHAR) ELSE 'fraction' END AS shown
    FROM orders WHERE o_orderdate >= DATE '1994-01-01' AND o_orderdate < DATE '1995-01-01'
    """
)
def ranged_volumes(spark, sf_dir):
    """A year's orders by bounds in seconds, with the volume as reports show it."""
    rows = table(spark, sf_dir, "orders").withColumn("ts_ms", F.unix_millis(F.col("o_orderdate").cast("timestamp")))
    year = incremental.in_range(rows, 757_382_400, S.ms_to_seconds(S.day_to_ms("1995-01-01")))
    shown = F.when(F.col("o_totalprice") == F.floor("o_totalprice"), S.volume_text("o_totalprice")).otherwise("fraction")
    return year.select("o_orderkey", shown.alias("shown"))


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder in the cluster's shared folder (spark.checkpoint.dir), which goes when the application ends; a
    temporary one where that is unset and the master is local (tests)."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        path = spark._jvm.org.apache.hadoop.fs.Path(f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}")
        path.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(path)
        return path.toString()
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
    local = tempfile.mkdtemp(prefix=f"marketlake-{name}-")
    atexit.register(shutil.rmtree, local, ignore_errors=True)
    return local


@query(f"SELECT brand AS series, sum(volume) AS volume, count(*) AS n FROM (SELECT p_brand AS brand, l_quantity AS volume FROM lineitem JOIN part ON l_partkey = p_partkey) GROUP BY 1")
def volume_by_series(spark, sf_dir):
    return _daily(spark, sf_dir).groupBy(F.col("series_ticker").alias("series")).agg(F.sum("volume").alias("volume"), F.count("*").alias("n"))
