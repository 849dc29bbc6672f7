from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from marketlake.operators import upsert as U


def candles(spark, *rows):
    data = [(t, *[c] * 5, v, 1.0, m, m, m.split("-")[0]) for t, m, c, v in rows]
    return spark.createDataFrame(data, U.tables()["daily"].schema)


ROWS = [(1000, "T-1", 0.5, 10.0), (2000, "T-1", 0.6, 11.5), (3000, "T-1", 0.7, 12.0)]


def stored(spark, root, name="daily"):
    return U.read_table(spark, root, U.tables()[name])


def test_idempotent(spark, tmp_path):
    root, daily = str(tmp_path), U.tables()["daily"]
    assert U.upsert(candles(spark, *ROWS), root, daily) == 3
    assert U.upsert(candles(spark, *ROWS), root, daily) == 0
    out = stored(spark, root)
    assert out.count() == 3 and dict(out.dtypes)["volume"] == "double"
    assert sorted(r.ts_ms for r in out.collect()) == [1000, 2000, 3000]


def test_new_rows_win_and_other_partitions_stay(spark, tmp_path):
    root, daily = str(tmp_path), U.tables()["daily"]
    U.upsert(candles(spark, *ROWS, (1000, "S-1", 0.1, 1.0)), root, daily)
    before = {f for f in stored(spark, root).inputFiles() if "series_ticker=S" in f}
    assert U.upsert(candles(spark, (2000, "T-1", 0.9, 99.0), (4000, "T-1", 0.8, 1.0)), root, daily) == 1
    out = {(r.market_ticker, r.ts_ms): r.close for r in stored(spark, root).collect()}
    assert out == {("T-1", 1000): 0.5, ("T-1", 2000): 0.9, ("T-1", 3000): 0.7, ("T-1", 4000): 0.8, ("S-1", 1000): 0.1}
    assert before == {f for f in stored(spark, root).inputFiles() if "series_ticker=S" in f}


def test_empty_input_writes_nothing(spark, tmp_path):
    assert U.upsert(candles(spark, *ROWS).limit(0), str(tmp_path), U.tables()["daily"]) == 0
    assert not list(tmp_path.iterdir())


def test_order_column_decides_among_new_rows(spark, tmp_path):
    root, daily = str(tmp_path), U.tables()["daily"]
    new = candles(spark, (1, "T-1", 0.1, 1.0)).withColumn("seq", F.lit(2)).union(candles(spark, (1, "T-1", 0.2, 1.0)).withColumn("seq", F.lit(1)))
    U.upsert(new, root, daily, "seq")
    assert stored(spark, root).first().close == 0.1


def test_disjoint_batches_in_any_order(spark, tmp_path):
    rows = [(t, f"{s}-{t % 3}", 0.5, float(t)) for t in range(24) for s in "AB"]
    want = sorted((r[0], r[1], r[3]) for r in rows)
    for seed in (1, 2):
        root = str(tmp_path / str(seed))
        random.Random(seed).shuffle(rows)
        for i in range(0, len(rows), 16):
            U.upsert(candles(spark, *rows[i : i + 16]), root, U.tables()["daily"])
        assert sorted((r.ts_ms, r.market_ticker, r.volume) for r in stored(spark, root).collect()) == want


def test_recovers_what_was_staged(spark, tmp_path):
    root, daily = str(tmp_path), U.tables()["daily"]
    U.upsert(candles(spark, *ROWS), root, daily)
    done = U.merged(stored(spark, root), candles(spark, (1000, "T-1", 0.99, 1.0)), daily.key)
    done.write.parquet(f"{root}/_staging/{daily.name}/a")
    (tmp_path / "_staging" / daily.name / "b").mkdir()
    assert U.recover(spark, root, daily) == 1
    assert {r.ts_ms: r.close for r in stored(spark, root).collect()} == {1000: 0.99, 2000: 0.6, 3000: 0.7}
    assert not list((tmp_path / "_staging" / daily.name).iterdir())


@pytest.mark.parametrize(("name", "want"), [("hourly", "series_ticker=T/year=2026"), ("minute", "series_ticker=T/year=2026/month=1")])
def test_layout(spark, tmp_path, name, want):
    midnight = 1_767_225_600_000  # 2026-01-01
    U.upsert(candles(spark, (midnight, "T-1", 0.5, 1.0)), str(tmp_path), U.tables()[name])
    assert list((tmp_path / "candles" / name / want).glob("*.zstd.parquet"))
    assert stored(spark, str(tmp_path), name).first().year == 2026


def test_trades_and_books(spark, tmp_path):
    trades, book = U.tables()["trades"], U.tables()["orderbook"]
    t = spark.createDataFrame([("a", "T-1 >x", 0, 0.5, 0.5, 1.0, "yes", "T"), ("a", "T-1 >x", 0, 0.6, 0.4, 1.0, "yes", "T")], trades.schema)
    assert U.upsert(t, str(tmp_path), trades) == 1
    b = spark.createDataFrame([(0, m, "YES", 0.5, 1.0, 1.0, 0) for m in ("A", "B")], book.schema)
    assert U.upsert(b, str(tmp_path), book) == 2
    assert {r.dt for r in stored(spark, str(tmp_path), "orderbook").collect()} == {"1970-01-01"}


def test_keep_last_ranked(spark):
    rows = spark.createDataFrame([(1, 1, "a"), (1, 2, "b"), (2, 1, "c")], "k int, o int, v string")
    assert {(r.k, r.v) for r in U.keep_last_ranked(rows, ["k"], F.desc("o")).collect()} == {(1, "b"), (2, "c")}


def test_a_ticker_stays_in_the_series_it_was_first_stored_in(spark, tmp_path):
    trades, root = U.tables()["trades"], str(tmp_path)
    row = lambda trade, series, price=0.5: (trade, "CPIYOY-1", 0, price, 0.5, 1.0, "yes", series)
    assert U.upsert(spark.createDataFrame([row("a", "CPIYOY")], trades.schema), root, trades) == 1
    assert U.upsert(spark.createDataFrame([row("a", "KXCPIYOY", 0.7), row("b", "KXCPIYOY")], trades.schema), root, trades) == 1
    assert sorted((r.trade_id, r.yes_price, r.series_ticker) for r in stored(spark, root, "trades").collect()) == [("a", 0.7, "CPIYOY"), ("b", 0.5, "CPIYOY")]


def test_recovery_leaves_other_writers_alone(spark, tmp_path):
    root, daily = str(tmp_path), U.tables()["daily"]
    (tmp_path / "_staging" / daily.name / "backfill-1").mkdir(parents=True)
    (tmp_path / "_staging" / daily.name / "feed-1").mkdir()
    U.upsert(candles(spark, *ROWS), root, daily, writer="feed")
    assert [p.name for p in (tmp_path / "_staging" / daily.name).iterdir()] == ["backfill-1"]


def test_a_large_partition_is_several_files(spark, tmp_path):
    root, daily = str(tmp_path), U.tables()["daily"]
    rows = spark.range(4000).selectExpr("id * 1000 AS ts_ms", *[f"0.5D AS {c}" for c in ("open", "high", "low", "close", "mean", "volume", "open_interest")], "concat('T-', id % 7) AS market_ticker", "'e' AS event_ticker", "'T' AS series_ticker")
    coalesce = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        assert U.upsert(rows, root, daily) == 4000
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", coalesce)
    sizes = [r["count"] for r in stored(spark, root).groupBy(F.input_file_name()).count().collect()]
    assert len(sizes) > 1 and max(sizes) < 3000


def test_series_are_looked_up_once(spark, tmp_path):
    """Rows are not shuffled to learn their tickers' series: what is noted for a run is a small table, and stays as first noted."""
    hourly, root = U.tables()["hourly"], str(tmp_path / "t")
    rows = spark.range(2000).select(F.concat(F.lit("T"), (F.col("id") % 7).cast("string")).alias("market_ticker"), F.when(F.col("id") > 9, "B").otherwise("A").alias("series_ticker"))
    rows.write.parquet(str(tmp_path / "new"))
    rows = spark.read.parquet(str(tmp_path / "new"))
    U._series(rows.where("series_ticker = 'A'"), root, hourly, str(tmp_path / "first"))
    placed = U._in_their_series(rows, U._series(rows, root, hourly, str(tmp_path / "second")))
    plan = placed._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "Aggregate" not in plan and "hashpartitioning" not in plan
    assert placed.count() == 2000 and {r.series_ticker for r in placed.distinct().collect()} == {"A"}
