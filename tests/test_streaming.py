import json
import os
import re

import pytest
from pyspark.sql import functions as F

from conftest import make_ticks, plain, plan_of, random_ticks
from tideline.config import TICKS
from tideline.operators import candles as c
from tideline.operators import lastprice, pairs
from tideline.plans import cagg
from tideline.sources.store import ChunkTable
from tideline.sources.trades import parse_trades
from tideline.streaming import prices, runs
from tideline.streaming.candles import stream_candle_rollup, stream_candles
from tideline.workload.messages import as_trade_messages


def in_time_order(spark, ticks, folder, files=4):
    """The ticks as files that arrive one per batch, oldest first."""
    rows = ticks.orderBy("time", "tick_id").collect()
    size = -(-len(rows) // files)
    for i in range(files):
        part = rows[i * size : (i + 1) * size]
        spark.createDataFrame(part, ticks.schema).coalesce(1).write.mode("append").parquet(folder)
    return runs.parquet_stream(spark, folder, ticks.schema, files_per_batch=1)


def closed(df, ticks, width):
    end = ticks.agg(F.max("time") - F.expr("INTERVAL 3 MINUTES")).first()[0]
    step = F.expr(f"INTERVAL 1 {width}")
    return df.filter(F.col("bucket") + step <= F.lit(end))


def test_trade_messages(spark, folder):
    trades = [
        {"c": None, "p": p, "s": f"VENUE:{s}", "t": 1_700_000_000_000 + t, "v": v}
        for t, s, p, v in ((0, "OAKELM", 2.25, 12.5), (310, "ASHELM", 41.0, 3.0), (990, "OAKELM", 2.3, 7.75))
    ]
    lines = [
        json.dumps({"data": trades, "type": "trade"}),
        json.dumps({"type": "ping"}),
        "not json",
        json.dumps({"data": [], "type": "trade"}),
    ]
    spark.createDataFrame([(x,) for x in lines], "value string").write.text(f"{folder}/in")
    stream = parse_trades(runs.text_stream(spark, f"{folder}/in"))
    runs.append_available(stream, f"{folder}/out", f"{folder}/progress")
    out = spark.read.parquet(f"{folder}/out")
    assert [str(r["time"]) for r in out.collect()] == ["2023-11-14 22:13:20"] * 3
    assert plain(out, "symbol", "price", "volume") == [
        ("ASHELM", 41.0, 3.0),
        ("OAKELM", 2.25, 12.5),
        ("OAKELM", 2.3, 7.75),
    ]


def test_streams_read_tables_of_one_file_and_of_many(spark, folder):
    ticks = random_ticks(spark)
    ticks.coalesce(1).write.parquet(f"{folder}/part")
    (name,) = [n for n in os.listdir(f"{folder}/part") if n.endswith(".parquet")]
    os.makedirs(f"{folder}/one")
    os.rename(f"{folder}/part/{name}", f"{folder}/one/events.parquet")
    in_time_order(spark, ticks, f"{folder}/many/events.parquet", files=3)
    got = []
    for root in ("one", "many"):
        stream = runs.table_stream(spark, f"{folder}/{root}", "events", ticks.schema, files_per_batch=1)
        runs.append_available(stream_candles(stream), f"{folder}/out-{root}", f"{folder}/progress-{root}")
        got.append(plain(c.ohlcv(spark.read.parquet(f"{folder}/out-{root}"))))
    assert got[0] == got[1] and got[0]


def test_equal_times_in_a_batch_go_by_the_tiebreak(spark, folder):
    seeds = spark.createDataFrame([("A", None, None)], prices.SYMBOLS_SCHEMA)
    versions = prices.SymbolVersions(spark, f"{folder}/symbols", seeds)
    handle = prices.last_price_updater(versions, tiebreak="tick_id")
    ticks = make_ticks(spark, [(1, "A", 5 + k % 7, 1) for k in range(40)])
    for parts in (1, 7):
        handle(ticks.repartition(parts), 0)
        assert versions.latest().first()["last_price"] == 5 + 39 % 7


def tick_tables(spark, folder, schema, **options):
    raw = ChunkTable(spark, f"{folder}/raw", schema, series_cols=("symbol",), **options).create()
    return raw, prices.pair_table(raw, f"{folder}/pairs").create()


def test_a_late_tick_counts_past_midnight(spark, folder):
    known = make_ticks(spark, [(0, "A", 10, 1), (90, "B", 5, 1), (870, "B", 5, 1), (8000, "A", 7, 1), (8001, "B", 9, 1)])
    tracked = spark.createDataFrame([("A/B",), ("B/A",)], "symbol_pair string")
    raw, emitted = tick_tables(spark, folder, known.schema)
    raw.append(known)
    emitted.append(pairs.pair_ticks(known, tracked))
    late = make_ticks(spark, [(810, "A", 20, 1)]).withColumn("tick_id", F.lit(99).cast("long"))
    raw.append(late)
    prices.repair_pair_ticks(raw, tracked, emitted, late)
    every = known.unionByName(late)
    assert plain(emitted.read(), "time", "tick_id", "symbol", "price") == plain(pairs.pair_ticks(every, tracked), "time", "tick_id", "symbol", "price")
    assert emitted.read().filter("tick_id = 2 AND symbol = 'A/B'").first()["price"] == 4.0


@pytest.mark.parametrize("seed, max_rows", [(1, 4_000_000), (2, 20)])
def test_random_late_ticks_are_repaired(spark, folder, seed, max_rows):
    ticks = random_ticks(spark, 250, ("A", "B", "C", "D"), seed=seed, hot="A")
    # Equal times, and a price of zero that nothing can be divided by.
    ticks = ticks.withColumn("time", F.when(F.col("tick_id") % 5 == 0, F.date_trunc("hour", "time").cast("timestamp_ntz")).otherwise(F.col("time")))
    ticks = ticks.withColumn("price", F.when(F.col("tick_id") % 41 == 0, 0.0).otherwise(F.col("price"))).persist()
    tracked = pairs.all_symbol_pairs(lastprice.symbol_names(ticks))
    is_late = F.col("tick_id") % 13 == seed
    raw, emitted = tick_tables(spark, folder, ticks.schema, compact_interval="1 week")
    raw.append(ticks.filter(~is_late))
    emitted.append(pairs.pair_ticks(ticks.filter(~is_late), tracked))
    raw.append(ticks.filter(is_late))
    for _ in range(seed):  # again, as after a failure
        prices.repair_pair_ticks(raw, tracked, emitted, ticks.filter(is_late), max_rows=max_rows)
    columns = prices.PAIR_TICK_COLUMNS
    assert plain(emitted.read(), *columns) == plain(pairs.pair_ticks(ticks, tracked), *columns)


def test_repair_leaves_other_chunks_alone(spark, folder):
    rows = [(1440 * d + 60 * h, s, 10 + d + h, 1) for d in range(12) for h, s in enumerate("ABAB")]
    ticks = make_ticks(spark, rows)
    tracked = spark.createDataFrame([("A/B",)], "symbol_pair string")
    raw, emitted = tick_tables(spark, folder, ticks.schema)
    raw.append(ticks)
    emitted.append(pairs.pair_ticks(ticks, tracked))
    files = {c: os.listdir(f"{folder}/pairs/chunk={c}") for c in emitted.chunks()}
    late = make_ticks(spark, [(1440 * 5 + 150, "A", 3, 1)]).withColumn("tick_id", F.lit(500).cast("long"))
    raw.append(late)
    prices.repair_pair_ticks(raw, tracked, emitted, late)
    after = {c: os.listdir(f"{folder}/pairs/chunk={c}") for c in emitted.chunks()}
    assert [c for c in files if files[c] != after[c]] == emitted.chunks()[5:6]
    legs = prices.late_legs(raw, tracked, late).persist()
    rows = prices.affected_pair_ticks(raw, legs)
    # Ticks are read from the late tick's day to that of the next one of its symbol, no further.
    assert set(re.findall(r"chunk#\d+ IN (\([^)]*\))", plan_of(rows))) == {"(2024-03-06,2024-03-07)"}
    assert plain(emitted.read(), "price") == plain(pairs.pair_ticks(ticks.unionByName(late), tracked), "price")


def test_repair_scans_each_pair_of_symbols_once_and_lists_the_ticks_once(spark, folder, monkeypatch):
    ticks = random_ticks(spark, 120, ("A", "B", "C"), seed=4).persist()
    tracked = pairs.all_symbol_pairs(lastprice.symbol_names(ticks))
    is_late = F.col("tick_id") % 10 == 0
    raw, emitted = tick_tables(spark, folder, ticks.schema)
    raw.append(ticks.filter(~is_late))
    emitted.append(pairs.pair_ticks(ticks.filter(~is_late), tracked))
    raw.append(ticks.filter(is_late))
    scanned, listed, rows, of = [], [], ChunkTable._rows, prices.OrderedScan.of

    def watched_rows(self):
        if getattr(self, "listed", None) is None:
            listed.append(self.path)
        return rows(self)

    def watched_of(df, *args, **options):
        scanned.append(df.count())
        return of(df, *args, **options)

    monkeypatch.setattr(ChunkTable, "_rows", watched_rows)
    monkeypatch.setattr(prices.OrderedScan, "of", watched_of)
    prices.repair_pair_ticks(raw, tracked, emitted, ticks.filter(is_late))
    monkeypatch.undo()
    # Ticks of two other symbols and marks for two others each, and a few rows where ranges start.
    assert max(scanned) < 2 * 120 + 2 * 12 + 60
    assert listed.count(raw.path) == 1
    columns = prices.PAIR_TICK_COLUMNS
    assert plain(emitted.read(), *columns) == plain(pairs.pair_ticks(ticks, tracked), *columns)


def test_prices_are_not_carried_over_days_that_repair_leaves_out(spark, folder):
    """Two late ticks days apart: B's price in force at the second one is of a day between."""
    known = make_ticks(spark, [(0, "A", 10, 1), (1, "B", 5, 1), (60, "A", 12, 1), (1440 * 2, "B", 4, 1), (1440 * 4, "A", 6, 1)])
    late = make_ticks(spark, [(30, "A", 20, 1), (1440 * 4 - 60, "A", 8, 1)]).withColumn("tick_id", F.col("tick_id") + 50)
    tracked = spark.createDataFrame([("A/B",), ("B/A",)], "symbol_pair string")
    raw, emitted = tick_tables(spark, folder, known.schema)
    raw.append(known)
    emitted.append(pairs.pair_ticks(known, tracked))
    raw.append(late)
    prices.repair_pair_ticks(raw, tracked, emitted, late)
    columns = prices.PAIR_TICK_COLUMNS
    assert plain(emitted.read(), *columns) == plain(pairs.pair_ticks(known.unionByName(late), tracked), *columns)
    assert emitted.read().filter("tick_id = 51 AND symbol = 'A/B'").first()["price"] == 2.0


def test_batches_in_any_order_give_the_pair_ticks_of_all(spark, folder):
    ticks = random_ticks(spark, 200, hot="H").persist()
    tracked = pairs.all_symbol_pairs(lastprice.symbol_names(ticks)).persist()
    seeds = spark.createDataFrame([(s, 2.5 if s == "A" else None, None) for s in "ABCH"], prices.SYMBOLS_SCHEMA)
    versions = prices.SymbolVersions(spark, f"{folder}/symbols", seeds)
    raw, emitted = tick_tables(spark, folder, ticks.schema)
    handle = prices.exact_pair_updater(versions, tracked, raw, emitted)
    columns = prices.PAIR_TICK_COLUMNS
    for n in (0, 1, 2, 2):
        handle(ticks.filter(F.pmod(F.xxhash64("tick_id"), F.lit(3)) == n), n)
    assert plain(emitted.read(), *columns) == plain(pairs.pair_ticks(ticks, tracked, seeds), *columns)


def test_batches_older_than_the_kept_versions_are_refused(spark, folder):
    seeds = spark.createDataFrame([("A", None, None)], prices.SYMBOLS_SCHEMA)
    versions = prices.SymbolVersions(spark, f"{folder}/symbols", seeds)
    for n in range(6):
        versions.save(n, seeds)
    assert versions.before(4).count() == 1
    with pytest.raises(ValueError):
        versions.before(2)


def test_trade_messages_round_trip(spark):
    ticks = random_ticks(spark, 50)
    back = parse_trades(as_trade_messages(ticks))
    assert plain(back, "symbol", "price", "volume") == plain(ticks, "symbol", "price", "volume")


def test_closed_candles_equal_batch(spark, folder):
    ticks = random_ticks(spark)
    stream = in_time_order(spark, ticks, f"{folder}/in")
    runs.append_available(stream_candles(stream), f"{folder}/out", f"{folder}/progress")
    out = spark.read.parquet(f"{folder}/out")
    want = closed(c.candles(ticks, "1 minute"), ticks, "MINUTE")
    assert plain(c.ohlcv(out)) == plain(c.ohlcv(want))


def test_rolled_up_candles_equal_batch(spark, folder):
    ticks = random_ticks(spark)
    stream = in_time_order(spark, ticks, f"{folder}/in")
    runs.append_available(stream_candle_rollup(stream), f"{folder}/out", f"{folder}/progress")
    out = spark.read.parquet(f"{folder}/out")
    want = closed(c.candles(ticks, "1 hour"), ticks, "HOUR")
    assert plain(c.ohlcv(out)) == plain(c.ohlcv(want))


@pytest.mark.parametrize("tracked", [0, 0.1, 0.5, 1])
def test_last_prices_over_batches(spark, folder, tracked):
    names = [f"SYM-{i}" for i in range(20)]
    ticks = random_ticks(spark, 400, names)
    known = names[: int(tracked * len(names))]
    seeds = spark.createDataFrame([(n, None, None) for n in known], prices.SYMBOLS_SCHEMA)
    versions = prices.SymbolVersions(spark, f"{folder}/symbols", seeds)
    stream = in_time_order(spark, ticks, f"{folder}/in")
    runs.each_batch_available(stream, prices.last_price_updater(versions), f"{folder}/progress")
    want = lastprice.last_values(ticks.filter(F.col("symbol").isin(known)), ["symbol"], "price")
    assert plain(versions.latest()) == plain(want)
    assert len(versions._numbers()) <= prices.KEPT_VERSIONS


def test_pair_ticks_over_batches_equal_batch_and_survive_a_rerun(spark, folder):
    ticks = random_ticks(spark, 300, hot="H")
    tracked = pairs.all_symbol_pairs(lastprice.symbol_names(ticks)).persist()
    seeds = lastprice.symbol_names(ticks).selectExpr(
        "symbol", "cast(null as double) last_price", "cast(null as timestamp_ntz) last_price_at"
    )
    versions = prices.SymbolVersions(spark, f"{folder}/symbols", seeds)
    handle = prices.pair_tick_updater(versions, tracked, f"{folder}/ticks")
    last = []

    def keep(batch, batch_id):
        last[:] = [batch.collect(), batch_id]
        handle(batch, batch_id)

    stream = in_time_order(spark, ticks, f"{folder}/in")
    runs.each_batch_available(stream, keep, f"{folder}/progress")
    columns = ["time", "tick_id", "symbol", "price", "volume"]
    want = plain(pairs.pair_ticks(ticks, tracked), *columns)
    assert plain(spark.read.parquet(f"{folder}/ticks"), *columns) == want
    symbols = plain(versions.latest())
    handle(spark.createDataFrame(last[0], ticks.schema), last[1])
    assert plain(spark.read.parquet(f"{folder}/ticks"), *columns) == want
    assert plain(versions.latest()) == symbols


def test_late_ticks_emit_no_pair_tick(spark, folder):
    seeds = spark.createDataFrame([("A", None, None), ("B", None, None)], prices.SYMBOLS_SCHEMA)
    tracked = spark.createDataFrame([("A/B",)], "symbol_pair string")
    versions = prices.SymbolVersions(spark, f"{folder}/symbols", seeds)
    handle = prices.pair_tick_updater(versions, tracked, f"{folder}/ticks")
    handle(make_ticks(spark, [(5, "A", 4, 1), (6, "B", 2, 1)]), 0)
    handle(make_ticks(spark, [(1, "A", 9, 1), (7, "B", 4, 1)]), 1)
    assert plain(spark.read.parquet(f"{folder}/ticks"), "price") == [(1.0,), (2.0,)]


def test_late_rows_dropped_by_the_stream_are_repaired_by_refresh(spark, folder):
    """A stream loses rows behind its watermark; the stored levels recover them."""
    ticks = random_ticks(spark)
    late = F.col("tick_id") % 10 == 0
    raw = ChunkTable(spark, f"{folder}/ticks", ticks.schema, series_cols=("symbol",)).create()
    chain = cagg.candle_chain(raw, TICKS, folder).define()
    in_time_order(spark, ticks.filter(~late), f"{folder}/in")
    stream = in_time_order(spark, ticks.filter(late), f"{folder}/in", files=1)
    runs.append_available(stream_candles(stream), f"{folder}/out", f"{folder}/progress")
    streamed = spark.read.parquet(f"{folder}/out").agg(F.sum("volume")).first()[0]
    assert streamed < ticks.agg(F.sum("volume")).first()[0]
    runs.each_batch_available(stream, lambda df, i: raw.append(df), f"{folder}/progress2")
    chain.refresh_invalidated()
    for level in TICKS.levels:
        got = chain.materialized(level.name)
        assert plain(got) == plain(c.candles(ticks, level.width), *got.columns)
