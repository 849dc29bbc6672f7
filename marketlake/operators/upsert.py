"""Merging new rows into partitioned Parquet tables: the last row of a key wins."""

from __future__ import annotations

import time
import uuid
from collections.abc import Iterable, Sequence
from dataclasses import dataclass
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StringType, StructField, StructType

from marketlake import schemas
from marketlake.functions.scalars import day_of, month_of, year_month, year_of
from marketlake.sources.landing import delete, exists, file_system, move, partition_folder, read_text, stored, write_text


def keep_last(rows: DataFrame, key: Sequence[str], order: str = "_seq") -> DataFrame:
    """For each key the row with the largest `order`, which is dropped. Of rows equal in it, the one with the largest
    values. An aggregate with a partial step, so a key with very many rows is thinned out before the shuffle."""
    others = [c for c in rows.columns if c not in (*key, order)]
    best = rows.groupBy(*key).agg(F.max(F.struct(order, *others)).alias("_best"))
    return best.select(*[F.col(c) if c in key else F.col(f"_best.{c}").alias(c) for c in rows.columns if c != order])


def keep_last_ranked(rows: DataFrame, key: Sequence[str], *order: Column) -> DataFrame:
    """The same by explicit sort columns, the winner first; needed where columns cannot be compared (maps)."""
    ranked = rows.withColumn("_rank", F.row_number().over(Window.partitionBy(*key).orderBy(*order)))
    return ranked.where(F.col("_rank") == 1).drop("_rank")


def _sides(old: DataFrame, new: DataFrame, order: str | None) -> DataFrame:
    """Both with _merge, by which any new row beats any old one, and new ones each other by `order`."""
    o = F.col(order) if order else F.lit(0)
    none = F.lit(None).cast(new.schema[order].dataType if order else "int")
    a = old.withColumn("_merge", F.struct(F.lit(0).alias("side"), none.alias("o")))
    b = new.withColumn("_merge", F.struct(F.lit(1).alias("side"), o.alias("o")))
    return a.unionByName(b.drop(order) if order and order not in old.columns else b)


def merged(old: DataFrame, new: DataFrame, key: Sequence[str], order: str | None = None) -> DataFrame:
    """old and new under keep-last. Any new row beats any old one, new ones by `order` among themselves; rows of old
    have no order of their own."""
    return keep_last(_sides(old, new, order), key, "_merge")


def net_new(old: DataFrame, new: DataFrame, key: Sequence[str]) -> DataFrame:
    """Keys of new that old lacks, each once."""
    keys = [F.col(k) for k in key]
    return new.select(*keys).distinct().join(old.select(*keys), list(key), "left_anti")


@dataclass(frozen=True)
class Table:
    """A stored table: its columns, its key, and partition columns that follow from them.

    unit names part of the key of which all rows come together: new ones replace all that are stored of it. moves says
    that a key may get into another partition; where each is, is stored beside the table.
    """

    name: str
    schema: StructType
    key: tuple[str, ...]
    partitions: tuple[tuple[str, Column, str], ...]
    order: tuple[str, ...] = ("market_ticker", "ts_ms")
    unit: tuple[str, ...] = ()
    moves: bool = False

    @property
    def partition_names(self) -> list[str]:
        return [p[0] for p in self.partitions]

    @property
    def partition_fields(self) -> list[StructField]:
        kinds = {"int": IntegerType(), "string": StringType()}
        return [StructField(n, kinds[k]) for n, _, k in self.partitions]

    @property
    def stored_schema(self) -> StructType:
        return StructType([*self.schema.fields, *[f for f in self.partition_fields if f.name not in self.schema.names]])

    @property
    def summary_schema(self) -> StructType:
        return StructType([*schemas.SUMMARY.fields, *self.partition_fields])

    @property
    def place_schema(self) -> StructType:
        keys = [self.schema[k] for k in self.key]
        return StructType([*keys, *[StructField(f"at_{f.name}", f.dataType) for f in self.partition_fields], StructField("version", LongType()), StructField("bucket", IntegerType())])


#: Buckets of keys of a table in which keys move.
BUCKETS = 64


def tables() -> dict[str, Table]:
    """The stored tables. Tickers share files: partitions are series (or all) and time, so files stay large."""
    by_series = ("series_ticker", F.col("series_ticker"), "string")
    with_series = StructType([*schemas.TRADES.fields, StructField("series_ticker", StringType())])
    year, month = ("year", year_of("ts_ms"), "int"), ("month", month_of("ts_ms"), "int")
    return {
        "daily": Table("candles/daily", schemas.CANDLES, schemas.CANDLE_KEY, (by_series,)),
        "hourly": Table("candles/hourly", schemas.CANDLES, schemas.CANDLE_KEY, (by_series, year)),
        "minute": Table("candles/minute", schemas.CANDLES, schemas.CANDLE_KEY, (by_series, year, month)),
        "trades": Table("trades", with_series, schemas.TRADE_KEY, (by_series, ("ym", year_month("ts_ms"), "string")), moves=True),
        "orderbook": Table("orderbook", schemas.ORDERBOOK, schemas.BOOK_KEY, (("dt", day_of("ts_ms"), "string"),), unit=("ts_ms", "market_ticker")),
    }


def read_table(spark: SparkSession, root: str, table: Table) -> DataFrame:
    return stored(spark, f"{root}/{table.name}", table.stored_schema)


def read_summary(spark: SparkSession, root: str, table: Table) -> DataFrame:
    """What is stored beside the table: for each partition, ticker and month the number of rows, first and last time, sum
    of volumes, latest trade, and for daily candles each day's volume. It is published with the partition that it sums
    up, so resume points and audits need no stored row."""
    return stored(spark, f"{root}/_summary/{table.name}", table.summary_schema)


def _children(spark: SparkSession, path: str) -> list[str]:
    if not exists(spark, path):
        return []
    fs, p = file_system(spark, path)
    return [s.getPath().toString() for s in fs.listStatus(p)]


def _partitions(spark: SparkSession, root: str, table: Table, folders: Iterable[str]) -> DataFrame:
    """The stored rows of some partitions. Only their folders are listed and read, however many the table has."""
    top = f"{root}/{table.name}"
    here = [f"{top}/{f}" for f in folders if exists(spark, f"{top}/{f}")]
    if not here:
        return spark.createDataFrame([], table.stored_schema)
    return spark.read.schema(table.stored_schema).option("basePath", top).parquet(*here)


def _publish(spark: SparkSession, run: str, root: str, table: Table) -> None:
    """A staged run's partitions, their summaries and the places of their keys over those of the table, folder by folder.
    Running it twice gives the same."""
    if not exists(spark, f"{run}/touched"):
        _publish_rows(spark, run, root, table)
        return
    for line in read_text(spark, f"{run}/touched").splitlines():  # as many as partitions
        kept, folder = line[0] == "+", line[1:]
        for part, top in (("data", f"{root}/{table.name}"), ("summary", f"{root}/_summary/{table.name}")):
            if kept:
                move(spark, f"{run}/{part}/{folder}", f"{top}/{folder}")
            else:
                delete(spark, f"{top}/{folder}")
    for bucket in _children(spark, f"{run}/places"):
        for file in _children(spark, bucket) if "bucket=" in bucket else ():
            move(spark, file, f"{root}/_places/{table.name}/{bucket.rpartition('/')[2]}/{file.rpartition('/')[2]}")
    delete(spark, run)


def _publish_rows(spark: SparkSession, staged: str, root: str, table: Table) -> None:
    """Staged rows, not laid out yet, over the table's partitions: what a version without folders had staged."""
    laid = _laid_out(spark.read.schema(table.stored_schema).parquet(staged), table)
    writer = laid.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("compression", "zstd")
    writer.partitionBy(*table.partition_names).parquet(f"{root}/{table.name}")
    delete(spark, staged)


def _tasks(spark: SparkSession, folders: int) -> list[int]:
    """How many tasks write so many folders: as Spark likes while they are few; else a number of its own, as Spark would
    make one task of many small folders."""
    return [min(folders, int(spark.conf.get("spark.sql.shuffle.partitions")))] if folders > 8 else []


def _laid_out(rows: DataFrame, table: Table, folders: int = 1) -> DataFrame:
    """rows dealt out by ranges of partition, ticker and time, so a partition with very many rows is several tasks' work
    and files."""
    order = [*table.partition_names, *[c for c in table.order if c in rows.columns]]
    tasks = [int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")) for _ in _tasks(rows.sparkSession, folders)]
    return rows.repartitionByRange(*tasks, *order).sortWithinPartitions(*order)


def recover(spark: SparkSession, root: str, table: Table, writer: str | None = None) -> int:
    """Publishes what an upsert had staged completely before it broke off; throws away the rest. With a writer, only
    what this one had staged: another may still be at work."""
    done = 0
    for path in sorted(_children(spark, f"{root}/_staging/{table.name}")):
        if writer is not None and not path.rpartition("/")[2].startswith(f"{writer}-"):
            continue
        if exists(spark, f"{path}/_SUCCESS"):
            _publish(spark, path, root, table)
            done += 1
        else:
            delete(spark, path)
    return done


def _series(rows: DataFrame, root: str, table: Table, run: str) -> DataFrame:
    """_t and _s: each ticker of rows and the series under which it was first stored, so that a key stays in its partition
    when the catalog learns or changes a ticker's series. New tickers are noted, beside the table, before they are stored.
    It is written to the run's folder: rows are read for it once, and a join with it is a broadcast while it is small."""
    spark, folder = rows.sparkSession, f"{root}/_series/{table.name}"
    noted = stored(spark, folder, StructType([StructField("market_ticker", StringType()), StructField("series_ticker", StringType())]))
    known = noted.groupBy(F.col("market_ticker").alias("_t")).agg(F.min("series_ticker").alias("_known"))
    each = rows.select("market_ticker", "series_ticker").distinct()  # hashed; the least of strings alone would sort all rows
    own = each.groupBy(F.col("market_ticker").alias("_t")).agg(F.min("series_ticker").alias("_own")).join(known, "_t", "left")
    own = own.select("_t", F.coalesce("_known", "_own").alias("_s"), F.col("_known").isNull().alias("_new"))
    own.write.option("compression", "zstd").parquet(f"{run}/series")
    own = spark.read.schema(own.schema).parquet(f"{run}/series")
    fresh = own.where(F.col("_new") & F.col("_s").isNotNull()).select(F.col("_t").alias("market_ticker"), F.col("_s").alias("series_ticker"))
    if not fresh.isEmpty():
        fresh.write.mode("append").option("compression", "zstd").parquet(folder)
    return own.select("_t", "_s")


def _in_their_series(rows: DataFrame, series: DataFrame) -> DataFrame:
    """rows with each ticker in its series (_t, _s)."""
    placed = rows.join(series, F.col("market_ticker").eqNullSafe(F.col("_t")), "left")
    return placed.withColumn("series_ticker", F.coalesce("_s", "series_ticker")).select(*rows.columns)


def _bucket(table: Table) -> Column:
    return F.pmod(F.xxhash64(*table.key), F.lit(BUCKETS)).cast("int")


def note_places(spark: SparkSession, root: str, table: Table) -> None:
    """Notes where each stored key is, anew: for a table that has no notes yet, or very many small ones."""
    rows = read_table(spark, root, table).select(*table.key, *[F.col(n).alias(f"at_{n}") for n in table.partition_names])
    noted = rows.withColumns({"version": F.lit(time.time_ns()), "bucket": _bucket(table)})
    made, folder = f"{root}/_staging/_places-{uuid.uuid4().hex}", f"{root}/_places/{table.name}"
    noted.repartition("bucket").sortWithinPartitions("bucket", *table.key).write.option("compression", "zstd").partitionBy("bucket").parquet(made)
    move(spark, made, folder)


def _places(new: DataFrame, root: str, table: Table) -> DataFrame:
    """Of the keys of new those that are stored, and in which partition; reads the buckets that new has keys in."""
    spark, folder = new.sparkSession, f"{root}/_places/{table.name}"
    if not exists(spark, folder) and exists(spark, f"{root}/{table.name}"):
        note_places(spark, root, table)
    keys = new.select(*table.key, _bucket(table).alias("bucket")).distinct()
    buckets = [r.bucket for r in keys.select("bucket").distinct().collect()]  # BUCKETS at most
    at = [f"at_{n}" for n in table.partition_names]
    known = stored(spark, folder, table.place_schema).where(F.col("bucket").isin(buckets)).join(keys.drop("bucket"), list(table.key), "left_semi")
    last = known.groupBy(*table.key).agg(F.max(F.struct("version", *at)).alias("_p"))
    return last.select(*table.key, *[F.col(f"_p.{c}").alias(c) for c in at])


def _moved(new: DataFrame, known: DataFrame, table: Table, order: str | None) -> DataFrame:
    """The keys of new that are new to the table, or to a partition: rows of its places."""
    o = F.col(order) if order else F.lit(0)
    now = new.groupBy(*table.key).agg(F.max(F.struct(o.alias("o"), *table.partition_names)).alias("_n"))
    at = {f"at_{n}": F.col(f"_n.{n}") for n in table.partition_names}
    was = known.withColumnsRenamed({c: f"was_{c}" for c in at})
    both = now.select(*table.key, *[c.alias(n) for n, c in at.items()]).join(was, list(table.key), "left")
    same = reduce(lambda a, b: a & b, (F.col(c).eqNullSafe(F.col(f"was_{c}")) for c in at))
    return both.where(~same).select(*table.key, *at, F.lit(time.time_ns()).alias("version"), _bucket(table).alias("bucket"))


def summarised(rows: DataFrame, table: Table) -> DataFrame:
    """read_summary()'s rows of some partitions of the table."""
    volume = F.coalesce(F.nanvl("volume", F.lit(None)), F.lit(0.0)) if "volume" in table.schema.names else F.lit(None).cast("double")
    trade = F.max_by("trade_id", F.struct("ts_ms", "trade_id")) if "trade_id" in table.schema.names else F.lit(None).cast("string")
    days = F.collect_list(F.struct("ts_ms", volume.alias("volume"))) if table.name == "candles/daily" else F.lit(None).cast("array<struct<ts_ms:bigint,volume:double>>")
    return rows.groupBy(*table.partition_names, "market_ticker", year_month("ts_ms").alias("at_month")).agg(
        F.count("*").alias("n_rows"), F.min("ts_ms").alias("first_ts_ms"), F.max("ts_ms").alias("last_ts_ms"), F.sum(volume).alias("volume"), trade.alias("last_trade_id"), days.alias("days")
    )


def summarise(spark: SparkSession, root: str, table: Table) -> None:
    """Sums up a table anew, for one that was stored without summaries."""
    made = f"{root}/_staging/_summary-{uuid.uuid4().hex}"
    _write_summary(read_table(spark, root, table), table, made)
    move(spark, made, f"{root}/_summary/{table.name}")


def _write_summary(rows: DataFrame, table: Table, path: str, folders: int = 1) -> None:
    names = table.partition_names
    summarised(rows, table).repartition(*_tasks(rows.sparkSession, folders), *names).sortWithinPartitions(*names, "market_ticker").write.option("compression", "zstd").partitionBy(*names).parquet(path)


def _forget(spark: SparkSession, run: str) -> None:
    """Deletes a run, and the folders above it that are empty then."""
    delete(spark, run)
    above = run.rpartition("/")[0]
    while "/_staging" in above and not _children(spark, above):
        delete(spark, above)
        above = above.rpartition("/")[0]


def upsert(new: DataFrame, root: str, table: Table, order: str | None = None, writer: str = "upsert", staged: bool = False) -> int:
    """Merges new into the table under root and returns how many keys it did not hold before.

    new is computed once: it is written to the run's folder first, unless it is staged, that is, cheap to read again.
    Only partitions that new touches are read and rewritten, each once: the merge is written as it will be stored, with
    its summaries, and then put in place folder by folder, so a run that breaks off between is finished by the writer's
    next one, or by recover(). Empty input writes nothing. A key is stored once: its series is that under which its ticker
    was first stored; where a key's time may change its partition (Table.moves), the partition that held it is rewritten
    too. Of a Table.unit (a snapshot) the new rows replace all stored ones.
    """
    spark = new.sparkSession
    recover(spark, root, table, writer)
    run = f"{root}/_staging/{table.name}/{writer}-{uuid.uuid4().hex}"
    dated = new.withColumns({n: c.cast(k) for n, c, k in table.partitions if n not in new.columns or n in table.schema.names})
    dated = dated.select(*table.stored_schema.names, *([order] if order and order not in table.stored_schema.names else []))
    if not staged:
        seen = Observation()
        dated.observe(seen, F.count("*").alias("n")).write.option("compression", "zstd").parquet(f"{run}/new")
        if seen.get["n"] == 0:
            _forget(spark, run)
            return 0
        dated = spark.read.schema(dated.schema).parquet(f"{run}/new")
    names = table.partition_names
    touched = dated.select(*names).distinct()
    if "series_ticker" in names:
        series = _series(dated, root, table, run)
        each = dated.select("market_ticker", *names).distinct()  # before the join, which may be of many tickers
        touched, dated = _in_their_series(each, series).select(*names).distinct(), _in_their_series(dated, series)
    if table.moves:
        known = _places(dated, root, table)
        touched = touched.union(known.select(*[f"at_{n}" for n in names])).distinct()
    folders = sorted(partition_folder(spark, names, r) for r in touched.collect())  # as many as partitions
    if not folders:
        _forget(spark, run)
        return 0

    both = _sides(_partitions(spark, root, table, folders).select(*table.stored_schema.names), dated, order)
    others = [c for c in both.columns if c not in (*table.key, "_merge")]
    best = both.groupBy(*table.key).agg(F.max(F.struct("_merge", *others)).alias("_best"), F.min("_merge.side").alias("_first"))
    if table.unit:
        replaced = dated.select(*table.unit).distinct().withColumn("_replaced", F.lit(True))
        best = best.join(replaced, list(table.unit), "left").where((F.col("_best._merge.side") == 1) | F.col("_replaced").isNull())
    rows = best.select("_first", *[F.col(c) if c in table.key else F.col(f"_best.{c}").alias(c) for c in table.stored_schema.names])
    counts = Observation()  # above the shuffle, whose sample would be counted too
    laid = _laid_out(rows, table, len(folders)).observe(counts, F.count_if(F.col("_first") == 1).alias("net_new")).drop("_first")
    laid.write.option("compression", "zstd").partitionBy(*names).parquet(f"{run}/data")
    _write_summary(spark.read.schema(table.stored_schema).parquet(f"{run}/data"), table, f"{run}/summary", len(folders))
    if table.moves:
        _moved(dated, known, table, order).write.option("compression", "zstd").partitionBy("bucket").parquet(f"{run}/places")
    files = spark.read.schema(table.stored_schema).parquet(f"{run}/data").inputFiles()
    made = {unquote(f).rpartition("/")[0].rpartition("/data/")[2] for f in files}
    write_text(spark, f"{run}/touched", "".join(f"{'+' if f in made else '-'}{f}\n" for f in folders))
    write_text(spark, f"{run}/_SUCCESS", "")
    _publish(spark, run, root, table)
    return counts.get["net_new"]
