"""Headline timings: one JSON line.

BENCH_SF_DIR   folder of Parquet tables (default /root/testdata/sf0.1)
BENCH_CPUS     local cores (default 8)
BENCH_QUERIES  comma-separated names, instead of the headline list
BENCH_REPEATS  timed runs per query after one warm-up; the best counts (default 2)
"""

from __future__ import annotations

import json
import os
import time

from pyspark.sql import functions as F

from tideline.config import SWAPS
from tideline.functions.buckets import floor_time, shift
from tideline.functions.scalars import latest_time
from tideline.operators import lastprice, pairs
from tideline.operators.candles import candles, rollup_candles
from tideline.plans.books import DatedBooks
from tideline.session import build_session, fresh_path, stored
from tideline.sources import bound
from tideline.sources.store import ChunkTable
from tideline.workload.queries import QUERIES

HEADLINE = [
    "ohlcv_1m",
    "ohlcv_1d",
    "rates_2d",
    "stats_1m",
    "stats_monthly",
    "stats2_1d",
    "query_all_caggs",
    "watch_ohlcv_per_symbol",
    "pair_ticks",
    "last_price_init",
    "swap_fifo_pnl",
    "swap_fifo_incremental",
    "swap_events_hourly",
    "mark_to_market",
    "fifo_lot_match",
    "histogram_hourly",
    "percentiles_daily",
    "percentiles_exact",
    "lttb",
    "asap_smooth",
    "cagg_refresh_full",
    "cagg_refresh_invalidated",
    "realtime_view",
    "stream_ohlcv",
    "stream_last_price",
]


def shapes(spark, root):
    """Workload shapes beside the queries: upkeep of last prices, and stored against raw."""
    ticks = stored(
        bound.table(spark, root, "events").select(
            F.col("ts").alias("time"),
            F.concat(F.lit("SYM-"), F.col("user_id").cast("string")).alias("symbol"),
            F.col("value").alias("price"),
        ),
        "bench-ticks",
    )
    names = lastprice.symbol_names(ticks)
    out = {}
    for percent in (0, 10, 50, 100):
        known = stored(
            names.filter(F.pmod(F.xxhash64("symbol"), F.lit(100)) < percent).select(
                "symbol",
                F.lit(None).cast("double").alias("last_price"),
                F.lit(None).cast("timestamp_ntz").alias("last_price_at"),
            ),
            "bench-symbols",
        )
        out[f"last_price_upkeep_{percent}pct"] = (
            lambda k=known: lastprice.merge_last_prices(k, ticks)
        )
    thirty = bound.ticks(spark, root).withColumn(
        "symbol", F.concat(F.lit("SYM-"), (F.col("tick_id") % 30).cast("string"))
    )
    tracked = stored(pairs.all_symbol_pairs(lastprice.symbol_names(thirty)), "bench-pairs")
    out["pair_ticks_870_pairs"] = lambda: pairs.pair_ticks(thirty, tracked)
    raw = bound.ticks(spark, root)
    hourly = stored(candles(raw, "1 hour"), "bench-hourly")
    swaps = bound.swaps(spark, root)
    folder = fresh_path(spark, "bench-books")
    table = ChunkTable(spark, f"{folder}/swaps", swaps.schema, "time", SWAPS.series_cols, "1 day").create()
    table.append(swaps)
    dated = DatedBooks(table, f"{folder}/books", every=10)
    newest = floor_time(latest_time(swaps), "1 day")
    dated.close(newest.date())
    out["swap_pnl_from_dated_books"] = lambda: dated.pnl(shift(newest, "2 days", -1))
    out["candles_1d_from_raw"] = lambda: candles(raw, "1 day")
    out["candles_1d_from_stored_1h"] = lambda: rollup_candles(hourly, "1 day")
    return out


def timed(make) -> float:
    start = time.perf_counter()
    make().write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    root = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    repeats = int(os.environ.get("BENCH_REPEATS", "2"))
    chosen = os.environ.get("BENCH_QUERIES")
    spark = build_session("tideline-bench", cores=cpus, spark__sql__shuffle__partitions=cpus)
    spark.sparkContext.setLogLevel("ERROR")
    jobs = {
        n: (lambda n=n: QUERIES[n](spark, root))
        for n in (chosen.split(",") if chosen else HEADLINE)
    }
    if not chosen:
        jobs |= shapes(spark, root)
    seconds = {}
    for name, make in jobs.items():
        timed(make)
        seconds[name] = round(min(timed(make) for _ in range(repeats)), 4)
    print(
        json.dumps(
            {
                "metric": "total query time",
                "value": round(sum(seconds.values()), 4),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(root.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
