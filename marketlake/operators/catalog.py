"""Series, events and markets: discovery from listings, tiered fallbacks, lookups and exports."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marketlake.fixed import SERIES
from marketlake.functions.scalars import first_text, joined, series_of_event, series_of_market, spellings
from marketlake.sources.landing import file_system, move

#: Listings of events and markets in the order in which they are asked.
EVENT_LISTINGS = ("events", "historical", "live")
MARKET_TIERS = ("live_event", "live_markets", "historical")


def place(value: Column | str, order: Iterable[str]) -> Column:
    """Position in a list of texts, those that are not in it last."""
    known = list(order)
    v = F.col(value) if isinstance(value, str) else value
    found = F.array_position(F.array(*map(F.lit, known)), v)
    return F.when(found > 0, found).otherwise(F.lit(len(known) + 1)).cast("int")


def first_tier(rows: DataFrame, key: str, tier: str = "tier") -> DataFrame:
    """For each key all rows of its smallest tier: the first source that has anything is taken whole.

    The tiers' minimum is a small aggregate that is joined back, so a key with very many rows is never gathered.
    """
    least = rows.groupBy(F.col(key).alias("_key")).agg(F.min(tier).alias("_least"))
    return rows.join(least, F.col(key).eqNullSafe(F.col("_key")) & (F.col(tier) == F.col("_least"))).select(*rows.columns)


def first_by(rows: DataFrame, key: str, *order: str) -> DataFrame:
    """For each key the row that comes first by order."""
    others = [c for c in rows.columns if c != key and c not in order]
    best = rows.groupBy(key).agg(F.min(F.struct(*order, *others)).alias("_best"))
    return best.select(*[F.col(c) if c == key else F.col(f"_best.{c}").alias(c) for c in rows.columns])


def last_by(rows: DataFrame, key: str, *columns: str) -> DataFrame:
    """key and columns of one row for each key: the last ingested (ingest_ts, if rows have it), of equals the largest."""
    order = ["ingest_ts"] if "ingest_ts" in rows.columns else []
    best = rows.groupBy(key).agg(F.max(F.struct(*order, *columns)).alias("_best"))
    return best.select(key, *[F.col(f"_best.{c}").alias(c) for c in columns])


def series_variants(series: DataFrame, column: str = "series") -> DataFrame:
    """One row per spelling of each series, with its place: listings are asked for both."""
    return series.select("*", F.posexplode(spellings(column)).alias("variant_pos", "variant"))


def discovered_events(listings: DataFrame, series: DataFrame) -> DataFrame:
    """series, event_ticker and title of each event that any listing shows under any spelling; the title seen first
    (by spelling, listing, place) stays. Rows of listings (listing, variant, pos, event_ticker, title) without event
    ticker are skipped."""
    asked = series_variants(series).select("series", "variant_pos", "variant")
    seen = listings.where(F.coalesce("event_ticker", F.lit("")) != "").join(asked, "variant")
    ranked = seen.select("series", "event_ticker", F.struct("variant_pos", place("listing", EVENT_LISTINGS).alias("listing"), "pos").alias("o"), "title")
    titled = ranked.groupBy("series", "event_ticker").agg(F.min(F.struct("o", "title")).alias("m"))
    return titled.select("series", "event_ticker", F.col("m.title").alias("title")).orderBy("series", "event_ticker")


def market_rows(listings: DataFrame, source: str) -> DataFrame:
    """Listed markets with their source; missing titles and states are ''."""
    text = lambda c: F.coalesce(c, F.lit(""))
    return listings.select("event_ticker", F.col("ticker").alias("market_ticker"), text("title").alias("title"), text("status").alias("status"), F.lit(source).alias("source"))


def markets_of_events(events: DataFrame, *tiers: DataFrame) -> DataFrame:
    """Markets of each event: of the first tier (rows of market_rows()) that has any for it, all of them."""
    found = None
    for i, rows in enumerate(tiers):
        part = rows.withColumn("tier", F.lit(i))
        found = part if found is None else found.unionByName(part)
    own = events.select(F.col("event_ticker").alias("_event")).distinct()
    asked = found.join(own, F.col("event_ticker") == F.col("_event"), "left_semi")
    return first_tier(asked, "event_ticker").drop("tier")


def market_of_event(events: DataFrame, *tiers: DataFrame, known_markets: DataFrame | None = None) -> DataFrame:
    """event_ticker and one market_ticker (or NULL): the first of the first tier that has any (rows with event_ticker,
    market_ticker, pos); last of all the event's own ticker, where known_markets has a market of that name."""
    found = None
    for i, rows in enumerate(tiers):
        part = rows.select("event_ticker", "market_ticker", F.lit(i).alias("tier"), F.col("pos").cast("long").alias("pos"))
        found = part if found is None else found.unionByName(part)
    if known_markets is not None:
        same = known_markets.select(F.col("market_ticker").alias("event_ticker"), "market_ticker", F.lit(len(tiers)).alias("tier"), F.lit(0).cast("long").alias("pos"))
        found = found.unionByName(same)
    best = found.groupBy("event_ticker").agg(F.min(F.struct("tier", "pos", "market_ticker")).alias("m"))
    return events.select("event_ticker").distinct().join(best, "event_ticker", "left").select("event_ticker", F.col("m.market_ticker").alias("market_ticker"))


def event_columns(payloads: DataFrame) -> DataFrame:
    """event_ticker, series_ticker and markets (tickers in their order) of event payloads as they land, for
    resolved_events(); payloads without event ticker are skipped, a missing list of markets is an empty one."""
    tickers = F.filter(F.transform("markets", lambda m: m["ticker"]), lambda t: t.isNotNull())
    named = payloads.where(F.coalesce("event.event_ticker", F.lit("")) != "")
    own = [c for c in ("ingest_ts",) if c in payloads.columns]
    return named.select(*own, "event.event_ticker", F.col("event.series_ticker").alias("series_ticker"), F.coalesce(tickers, F.array().cast("array<string>")).alias("markets"))


def resolved_events(events: DataFrame, payloads: DataFrame, rest: DataFrame) -> DataFrame:
    """event_ticker, series and market tickers of each event: from its payload, else from the other source, else the
    series by its name and no markets. payloads and rest have event_ticker, series_ticker and markets (array); of
    several rows of an event the last counts (last_by())."""
    a = last_by(payloads, "event_ticker", "series_ticker", "markets").select(F.col("event_ticker").alias("_a"), F.struct("series_ticker", "markets").alias("a"))
    b = last_by(rest, "event_ticker", "series_ticker", "markets").select(F.col("event_ticker").alias("_b"), F.struct("series_ticker", "markets").alias("b"))
    both = events.join(a, F.col("event_ticker") == F.col("_a"), "left").join(b, F.col("event_ticker") == F.col("_b"), "left")
    none = F.array().cast("array<string>")
    return both.withColumn("r", F.coalesce("a", "b")).select(
        "event_ticker",
        F.coalesce(first_text("r.series_ticker"), series_of_event("event_ticker")).alias("series_ticker"),
        F.coalesce("r.markets", none).alias("markets"),
    )


def metadata_columns(payload: DataFrame) -> DataFrame:
    """market_ticker, open_ts_ms, expiration, status (and ingest_ts, if there) of market payloads; 'unknown' for what is
    missing."""
    return payload.select(
        *[c for c in ("ingest_ts",) if c in payload.columns],
        F.col("ticker").alias("market_ticker"),
        F.unix_millis(F.try_to_timestamp(F.col("open_time"))).alias("open_ts_ms"),
        F.coalesce(first_text("expiration_time", "latest_expiration_time"), F.lit("unknown")).alias("expiration"),
        F.coalesce(first_text("status"), F.lit("unknown")).alias("status"),
    )


def market_metadata(tickers: DataFrame, live: DataFrame, historical: DataFrame) -> DataFrame:
    """Metadata of each ticker, whole rows by tier: live, else historical, else (NULL, unknown, unknown). Of several rows
    of a ticker in a tier the last counts (last_by())."""
    def tier(rows: DataFrame, name: str) -> DataFrame:
        one = last_by(rows, "market_ticker", "open_ts_ms", "expiration", "status")
        return one.select(F.col("market_ticker").alias(f"_{name}"), F.struct("open_ts_ms", "expiration", "status").alias(name))

    unknown = F.struct(F.lit(None).cast("long").alias("open_ts_ms"), F.lit("unknown").alias("expiration"), F.lit("unknown").alias("status"))
    both = tickers.join(tier(live, "l"), F.col("market_ticker") == F.col("_l"), "left").join(tier(historical, "h"), F.col("market_ticker") == F.col("_h"), "left")
    return both.select("market_ticker", F.coalesce("l", "h", unknown).alias("m")).select("market_ticker", "m.*")


def ticker_meta(catalogs: DataFrame) -> DataFrame:
    """market_ticker, series_ticker, event_ticker of catalog files; of a ticker that is in several, the last file's."""
    rows = catalogs.select("file_name", F.col("series").alias("series_ticker"), F.posexplode("markets").alias("pos", "m"))
    last = rows.groupBy(F.col("m.market_ticker").alias("market_ticker")).agg(F.max(F.struct("file_name", "pos", "series_ticker", F.col("m.event_ticker").alias("event_ticker"))).alias("b"))
    return last.select("market_ticker", "b.series_ticker", "b.event_ticker")


def with_ticker_meta(facts: DataFrame, meta: DataFrame, known: Iterable[str] = SERIES) -> DataFrame:
    """facts with series_ticker and event_ticker by market_ticker; a ticker that meta lacks gets its series by name
    and itself as event. Of several rows of a ticker the last counts (last_by()). Spark broadcasts meta while it is below
    its threshold."""
    m = last_by(meta, "market_ticker", "series_ticker", "event_ticker").select(F.col("market_ticker").alias("_t"), F.col("series_ticker").alias("_s"), F.col("event_ticker").alias("_e"))
    joined_ = facts.join(m, F.col("market_ticker") == F.col("_t"), "left")
    named = joined_.withColumns({"series_ticker": F.coalesce("_s", series_of_market("market_ticker", known)), "event_ticker": F.coalesce("_e", "market_ticker")})
    return named.drop("_t", "_s", "_e")


def series_rows(listing: DataFrame) -> DataFrame:
    return listing.select("ticker", "title", "category", "frequency", joined("tags").alias("tags"))


def category_counts(series: DataFrame) -> DataFrame:
    return series.where(F.col("category").isNotNull()).groupBy("category").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "category")


def in_category(series: DataFrame, part: str = "economic") -> DataFrame:
    return series.where(F.coalesce(F.contains(F.lower("category"), F.lit(part.lower())), F.lit(False)))


def catalog(catalogs: DataFrame, kind: str = "tickers") -> DataFrame:
    """A member of the catalog: tickers, events, markets, or all (a row per series)."""
    members = {
        "tickers": lambda: catalogs.select(F.explode("tickers").alias("market_ticker")).distinct().orderBy("market_ticker"),
        "events": lambda: catalogs.select("series", F.explode("events").alias("e")).select("series", "e.*"),
        "markets": lambda: catalogs.select("series", F.explode("markets").alias("m")).select("series", "m.*"),
        "all": lambda: catalogs.select("series", "events", "markets", "tickers"),
    }
    if kind not in members:
        raise ValueError(f"{kind!r} is none of {', '.join(members)}")
    return members[kind]()


def build_catalog(events: DataFrame, markets: DataFrame) -> DataFrame:
    """A row per series of events (series, event_ticker, title) and markets (series and the columns of market_rows()):
    both as arrays, events by ticker, and the distinct sorted market tickers."""
    e = events.groupBy("series").agg(F.array_sort(F.collect_set(F.struct("event_ticker", "title"))).alias("events"))
    m = markets.groupBy(F.col("series").alias("_s")).agg(
        F.array_sort(F.collect_list(F.struct("event_ticker", "market_ticker", "title", "status", "source"))).alias("markets"),
        F.array_sort(F.collect_set("market_ticker")).alias("tickers"),
    )
    return e.join(m, F.col("series") == F.col("_s"), "left").select(
        "series", "events",
        F.coalesce("markets", F.array().cast("array<struct<event_ticker:string,market_ticker:string,title:string,status:string,source:string>>")).alias("markets"),
        F.coalesce("tickers", F.array().cast("array<string>")).alias("tickers"),
    )


def member_counts(events: DataFrame, markets: DataFrame) -> DataFrame:
    """The same as catalog_counts() of build_catalog(), from flat rows: no series is ever one row."""
    def counted(rows: DataFrame, *names: Column) -> DataFrame:
        return rows.groupBy("series").agg(*names).unionByName(rows.agg(*names).withColumn("series", F.lit(None).cast("string")))

    e = counted(events.select("series", "event_ticker", "title").distinct(), F.count("*").alias("n_events"))
    m = counted(markets, F.count("*").alias("n_markets"), F.count_distinct("market_ticker").alias("n_tickers")).withColumnRenamed("series", "_s")
    both = e.join(m, F.col("series").eqNullSafe(F.col("_s")), "left")
    return both.select("series", "n_events", F.coalesce("n_markets", F.lit(0)).alias("n_markets"), F.coalesce("n_tickers", F.lit(0)).alias("n_tickers"))


def catalog_counts(catalogs: DataFrame) -> DataFrame:
    """Events, markets and tickers of each series, and of all (series NULL). A ticker of two series counts once there."""
    sizes = catalogs.select("series", F.size("events").alias("e"), F.size("markets").alias("m"), F.explode_outer("tickers").alias("t"))
    tickers = sizes.groupBy("series").agg(F.count_distinct("t").alias("n_tickers"))
    counts = catalogs.groupBy("series").agg(F.sum(F.size("events")).alias("n_events"), F.sum(F.size("markets")).alias("n_markets"))
    each = counts.join(tickers, "series")
    total = catalogs.agg(F.sum(F.size("events")).alias("n_events"), F.sum(F.size("markets")).alias("n_markets")).crossJoin(sizes.agg(F.count_distinct("t").alias("n_tickers")))
    return each.select("series", "n_events", "n_markets", "n_tickers").unionByName(total.select(F.lit(None).cast("string").alias("series"), "n_events", "n_markets", "n_tickers"))


def write_catalog(catalogs: DataFrame, folder: str) -> None:
    """A folder of JSON rows per series and the tickers as text, series by series."""
    catalogs.select(F.col("series").alias("of"), "series", "events", "markets", "tickers").write.mode("overwrite").partitionBy("of").json(f"{folder}/json")
    tickers = catalogs.select(F.col("series").alias("of"), F.explode("tickers").alias("value"))
    tickers.repartition("of").sortWithinPartitions("of", "value").write.mode("overwrite").partitionBy("of").text(f"{folder}/txt")


def write_combined(catalogs: DataFrame, folder: str) -> None:
    """All series in one row of JSON: counts, tickers and each series' own; and all tickers as text.

    The catalog is a dimension of thousands of tickers and is meant to be one document.
    """
    per = catalogs.select("series", F.struct(F.size("events").cast("long").alias("events"), F.size("markets").cast("long").alias("markets"), "tickers").alias("v"))
    combined = per.agg(
        F.array_sort(F.collect_set("series")).alias("series"),
        F.sum("v.events").alias("total_events"),
        F.sum("v.markets").alias("total_markets"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("v.tickers")))).alias("tickers"),
        F.map_from_entries(F.array_sort(F.collect_list(F.struct("series", "v")))).alias("by_series"),
    )
    combined.coalesce(1).write.mode("overwrite").json(f"{folder}/json")
    catalog(catalogs, "tickers").select(F.col("market_ticker").alias("value")).coalesce(1).sortWithinPartitions("value").write.mode("overwrite").text(f"{folder}/txt")


def _named(spark: SparkSession, made: str, folder: str, kind: str, name: Callable[[str], str]) -> None:
    """Puts the one file of each of Spark's folders of=<series> in place as a file of its own."""
    fs, top = file_system(spark, made)
    for part in fs.listStatus(top):
        of = part.getPath().getName()
        if of.startswith("of="):
            series = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.unescapePathName(of[3:])
            (file,) = [f.getPath().toString() for f in fs.listStatus(part.getPath()) if f.getPath().getName().startswith("part-")]
            move(spark, file, f"{folder}/{name(series)}.{kind}")
    fs.delete(top, True)


def write_files(catalogs: DataFrame, folder: str) -> None:
    """The catalog as files that sources read back by name: <series>_tickers.json and .txt for each series (without
    tickers no .txt), and all_tickers.json and .txt of all together. A file is replaced as a whole."""
    spark, made = catalogs.sparkSession, f"{folder}/_parts-{uuid.uuid4().hex}"
    each = catalogs.withColumn("of", F.col("series"))
    each.select("of", "series", "events", "markets", "tickers").repartition("of").write.partitionBy("of").json(f"{made}/json")
    lines = each.select("of", F.explode("tickers").alias("value")).repartition("of").sortWithinPartitions("of", "value")
    lines.write.partitionBy("of").text(f"{made}/txt")
    write_combined(catalogs, f"{made}/all")
    for kind in ("json", "txt"):
        _named(spark, f"{made}/{kind}", folder, kind, lambda series: f"{series}_tickers")
        fs, top = file_system(spark, f"{made}/all/{kind}")
        for f in fs.listStatus(top):
            if f.getPath().getName().startswith("part-"):
                move(spark, f.getPath().toString(), f"{folder}/all_tickers.{kind}")
    fs, top = file_system(spark, made)
    fs.delete(top, True)
