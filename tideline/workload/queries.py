"""One callable per query: (spark, folder of Parquet tables) -> DataFrame."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timedelta
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tideline.config import RATES, SAMPLES, SWAPS, TICKS, SeriesConfig, chain_levels
from tideline.functions.buckets import floor_time, shift, time_bucket
from tideline.operators import (
    candles,
    checks,
    downsample,
    grid,
    histogram,
    keyfilter,
    lastprice,
    pairs,
    quantiles,
    ranges,
    stats,
    swaps,
)
from tideline.functions.scalars import latest_time, round_half_up
from tideline.plans import books, cagg, nearest, reports
from tideline.plans.stages import stored_levels
from tideline.session import fresh_path, stored
from tideline.sources import bound
from tideline.sources.store import ChunkTable
from tideline.sources.trades import parse_trades
from tideline.streaming import deltas, keyed, prices, runs
from tideline.streaming.candles import stream_candle_rollup, stream_candles
from tideline.workload.messages import as_trade_messages

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

# Slopes of this data lie within a thousandth of zero.
SLOPE_DIGITS = {"slope": 9}
QUARTILES = {"y": 0.25, "y_median": 0.5, "y_q3": 0.75, "y_99": 0.99}
SKETCH_BINS = 40
LTTB_POINTS = 10
ASAP_RESOLUTION = 40
BINS = 8
# Sums differ between engines in their last bits, so ties are taken more widely there.
COMPARE_GUARD = 1e-4


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def rounded(df: DataFrame, digits: int = 4, finer: dict[str, int] | None = None) -> DataFrame:
    """Doubles, and decimals as doubles, rounded for comparison with another engine.

    ``finer`` has the digits of columns whose values are small.
    """
    finer = finer or {}

    def column(c: str, t: str):
        if t == "double" or t.startswith("decimal"):
            return round_half_up(F.col(f"`{c}`").cast("double"), finer.get(c, digits), COMPARE_GUARD).alias(c)
        return f"`{c}`"

    return df.select(*(column(c, t) for c, t in df.dtypes))


# -- sources, sinks, table maintenance ---------------------------------------


def _tick_table(spark: SparkSession, root: str, name: str) -> ChunkTable:
    schema = bound.ticks(spark, root).schema
    return ChunkTable(
        spark,
        f"{fresh_path(spark, name)}/ticks",
        schema,
        series_cols=("symbol",),
        chunk_interval=TICKS.chunk_interval,
        compact_interval="1 week",
    ).create()


@query
def scan_ticks(spark, root):
    return bound.ticks(spark, root)


@query
def write_chunked(spark, root):
    table = _tick_table(spark, root, "write")
    table.append(bound.ticks(spark, root))
    return table.read()


@query
def append_rows(spark, root):
    """Two inserts, the second with rows of chunks that are already there."""
    table = _tick_table(spark, root, "append")
    ticks = bound.ticks(spark, root)
    second = F.col("tick_id") % 2 == 1
    table.append(ticks.filter(~second))
    table.append(ticks.filter(second))
    return table.read()


@query
def trade_stream_ingest(spark, root):
    folder = fresh_path(spark, "trades")
    as_trade_messages(bound.ticks(spark, root)).write.text(f"{folder}/in")
    ticks = parse_trades(runs.text_stream(spark, f"{folder}/in"))
    runs.append_available(ticks, f"{folder}/ticks", f"{folder}/progress")
    return spark.read.schema(ticks.schema).parquet(f"{folder}/ticks")


@query
def insert_if_absent(spark, root):
    metrics = bound.metrics(spark, root)
    known = (
        metrics.filter(F.col("metric_name").rlike(":(view|click)$"))
        .groupBy("metric_name")
        .agg(F.max("value").alias("peak"))
    )
    everyone = metrics.select("metric_name", F.lit(None).cast("double").alias("peak"))
    return lastprice.insert_if_absent(known, everyone, ["metric_name"])


@query
def retention_prune(spark, root):
    ticks = bound.long_ticks(spark, root)
    table = ChunkTable(
        spark,
        f"{fresh_path(spark, 'retention')}/ticks",
        ticks.schema,
        series_cols=("symbol",),
        chunk_interval="1 month",
    ).create()
    table.append(ticks)
    table.prune(latest_time(ticks), "6 months")
    return table.read()


@query
def compact_chunks(spark, root):
    ticks = bound.ticks(spark, root)
    table = _tick_table(spark, root, "compact")
    table.append(ticks)
    table.compact(latest_time(ticks), "1 week")
    return table.read()


@query
def update_range(spark, root):
    ticks = bound.ticks(spark, root)
    table = _tick_table(spark, root, "update")
    table.append(ticks)
    start = shift(latest_time(ticks), "2 days", -1) + timedelta(microseconds=1)
    table.update_range(lambda df: df.withColumn("price", F.col("price") + 1), start)
    return rounded(table.read())


@query
def pk_fk_checks(spark, root):
    installations, signals = bound.installations(spark, root), bound.signals(spark, root)
    samples = bound.typed_samples(spark, root)
    return checks.check_report(
        checks.duplicate_keys(installations, ["id"], "installation_pk"),
        checks.duplicate_keys(signals, ["id"], "signal_pk"),
        checks.duplicate_keys(signals, ["name"], "signal_name_unique"),
        checks.duplicate_keys(samples, ["id", "tstamp"], "sample_pk"),
        checks.duplicate_keys(samples, ["id"], "sample_id_alone"),
        checks.missing_values(samples, ["id", "tstamp", "quality"], "sample_not_null"),
        checks.missing_values(samples, ["value_f64"], "sample_without_double"),
        checks.orphans(signals, "id_installation", installations, "id", "signal_fk"),
        checks.orphans(samples, "id", signals, "id", "sample_fk"),
        checks.orphans(samples, "id", installations, "id", "sample_id_not_installation"),
    )


@query
def append_key_check(spark, root):
    """Twice and three times the stored ids as new ones: which are stored, or come twice."""
    ticks = bound.ticks(spark, root)
    table = _tick_table(spark, root, "keys")
    per_chunk = ticks.groupBy(time_bucket(TICKS.chunk_interval, "time")).count().agg(F.max("count")).first()[0]
    keys = keyfilter.KeyFilter(table, ("tick_id",), keyfilter.blocks_for(per_chunk or 0))
    keys.append(ticks)
    new = ticks.withColumn("tick_id", F.explode(F.array(F.col("tick_id") * 2, F.col("tick_id") * 3)))
    return keys.check(new)


@query
def time_grid(spark, root):
    spans = (
        bound.samples(spark, root)
        .groupBy("device_id")
        .agg(F.min("time").alias("start"), F.max("time").alias("stop"))
    )
    return grid.time_grid(spans, "1 hour", ["device_id"])


@query
def assign_ids(spark, root):
    ticks = bound.ticks(spark, root)
    return grid.assign_ids(ticks, ["time", "tick_id"], previous_max=1000).select("tick_id", "id")


# -- projections, filters -----------------------------------------------------


@query
def latest_tick_for_symbol(spark, root):
    ticks = bound.ticks(spark, root)
    return ranges.latest_for_symbol(ticks, "purchase", ["tick_id"]).select(
        "time", "symbol", "volume", "price"
    )


@query
def latest_n_ticks(spark, root):
    return ranges.newest(bound.ticks(spark, root), 5, tiebreak=["tick_id"])


@query
def latest_tick_skip_scan(spark, root):
    """The newest tick of one symbol, from the newest chunks that have any."""
    table = _tick_table(spark, root, "skip")
    table.append(bound.ticks(spark, root))
    found = nearest.newest_rows(table, 1, F.col("symbol") == "purchase", ["tick_id"])
    return found.select("time", "symbol", "volume", "price")


@query
def latest_n_skip_scan(spark, root):
    table = _tick_table(spark, root, "skip")
    table.append(bound.ticks(spark, root))
    return nearest.newest_rows(table, 5, tiebreak=["tick_id"])


@query
def last_price_skip_scan(spark, root):
    """The last price of every symbol, of equal times that of the greatest tick_id."""
    table = _tick_table(spark, root, "skip")
    ticks = bound.ticks(spark, root)
    table.append(ticks)
    found = nearest.newest_per_series(table, lastprice.symbol_names(ticks), ["price"])
    return found.select("symbol", F.col("price").alias("last_price"), F.col("time").alias("last_price_at"))


@query
def recent_window_filter(spark, root):
    ticks = bound.ticks(spark, root)
    return ranges.recent(ticks, latest_time(ticks), "2 weeks")


@query
def older_rows_extent(spark, root):
    ticks = bound.ticks(spark, root)
    return ranges.older(ticks, latest_time(ticks), "2 weeks").agg(
        F.min("time").alias("first_at"), F.max("time").alias("last_at")
    )


@query
def range_between(spark, root):
    samples = bound.samples(spark, root)
    end = latest_time(samples)
    return ranges.between(samples, shift(end, "1 week", -1), end)


@query
def symbol_regex_filter(spark, root):
    return ranges.matching_symbols(bound.ticks(spark, root), "^(view|click)$")


@query
def sample_numeric_view(spark, root):
    return bound.numeric_samples(bound.typed_samples(spark, root))


@query
def metrics_scan(spark, root):
    return bound.metrics(spark, root)


def _typed_table(kind: str) -> Query:
    return lambda spark, root: bound.samples_of_type(spark, root, kind)


QUERIES["float_sample"] = _typed_table("float")
QUERIES["boolean_sample"] = _typed_table("boolean")
QUERIES["text_sample"] = _typed_table("text")


# -- joins --------------------------------------------------------------------


def _candle_levels(spark: SparkSession, root: str) -> list[DataFrame]:
    return stored_levels(
        bound.ticks(spark, root),
        ["1 minute", "1 hour", "1 day"],
        candles.candles,
        candles.rollup_candles,
    )


@query
def watch_ohlcv(spark, root):
    """For the symbol of the newest tick, whose newest candles belong together."""
    levels = _candle_levels(spark, root)
    newest = bound.ticks(spark, root).agg(
        F.max_by("symbol", F.struct("time", "tick_id")).alias("_newest")
    )
    one = F.col("symbol") == F.col("_newest")
    return reports.watch_ohlcv(*(level.join(newest, one).drop("_newest") for level in levels))


@query
def watch_ohlcv_per_symbol(spark, root):
    return reports.watch_ohlcv_per_symbol(*_candle_levels(spark, root))


def _stats_levels(spark: SparkSession, root: str) -> list[DataFrame]:
    return stored_levels(
        bound.samples(spark, root),
        ["1 minute", "1 hour", "1 day", "1 month"],
        stats.stats,
        stats.rollup_stats,
    )


@query
def query_all_caggs(spark, root):
    levels = _stats_levels(spark, root)
    return rounded(reports.level_averages(*levels, latest_time(levels[0], "bucket")))


@query
def all_level_averages(spark, root):
    """The same join without the top ten, over all minutes."""
    levels = _stats_levels(spark, root)
    as_of = latest_time(levels[0], "bucket")
    return rounded(reports.level_averages(*levels, as_of, None, n=None))


@query
def all_symbol_pairs(spark, root):
    return bound.tracked_pairs(spark, root)


def _stored_pairs(spark: SparkSession, root: str) -> DataFrame:
    return stored(bound.tracked_pairs(spark, root), "pairs")


@query
def ticks_by_tracked_pair(spark, root):
    return pairs.ticks_by_pair(bound.ticks(spark, root), _stored_pairs(spark, root))


@query
def pair_ticks(spark, root):
    return pairs.pair_ticks(bound.ticks(spark, root), _stored_pairs(spark, root))


@query
def mark_to_market(spark, root):
    return rounded(swaps.mark_to_market(bound.swaps(spark, root)))


@query
def signal_star_join(spark, root):
    samples = bound.numeric_samples(bound.typed_samples(spark, root))
    signals = bound.signals(spark, root).select(
        F.col("id").alias("signal_id"), F.col("name").alias("signal_name"), "id_installation"
    )
    installations = bound.installations(spark, root).select(
        F.col("id").alias("installation_id"), F.col("name").alias("installation_name")
    )
    return (
        samples.join(signals, samples["id"] == signals["signal_id"])
        .join(installations, F.col("id_installation") == F.col("installation_id"))
        .select("id", "tstamp", "value", "quality", "signal_name", "installation_name")
    )


@query
def fifo_lot_match(spark, root):
    return rounded(swaps.fifo_lots(bound.swaps(spark, root)))


@query
def fifo_sale_pnl(spark, root):
    return rounded(swaps.fifo_pnl(bound.swaps(spark, root)))


# -- aggregations -------------------------------------------------------------

BUCKET_WIDTHS = {
    "b_30s": "30 seconds",
    "b_1m": "1m",
    "b_10m": "10 minutes",
    "b_1h": "1 hour",
    "b_6h": "6 hours",
    "b_1d": "1 day",
    "b_2d": "2 days",
    "b_1w": "1 week",
    "b_1mon": "1 month",
    "b_3mon": "3 months",
}


def _all_buckets(df: DataFrame) -> DataFrame:
    return reduce(
        lambda d, nw: d.withColumn(nw[0], time_bucket(nw[1], "time")), BUCKET_WIDTHS.items(), df
    )


@query
def time_buckets(spark, root):
    return _all_buckets(bound.ticks(spark, root).select("tick_id", "time"))


@query
def time_buckets_long(spark, root):
    return _all_buckets(bound.long_ticks(spark, root).select("tick_id", "time"))


@query
def ohlcv_1m(spark, root):
    return rounded(candles.ohlcv(candles.candles(bound.ticks(spark, root), "1 minute")))


def _candle_rollup(*widths: str) -> Query:
    def run(spark, root):
        state = candles.candles(bound.ticks(spark, root), widths[0])
        for width in widths[1:]:
            state = candles.rollup_candles(state, width)
        return rounded(candles.ohlcv(state))

    return run


QUERIES["ohlcv_1h"] = _candle_rollup("1 minute", "1 hour")
QUERIES["ohlcv_1d"] = _candle_rollup("1 minute", "1 hour", "1 day")
QUERIES["ohlcv_1mon"] = _candle_rollup("1 minute", "1 hour", "1 day", "1 month")


@query
def ohlcv_tiebreak(spark, root):
    """Many ticks share a time here, so open and close are settled by the tick id."""
    state = candles.candles(bound.long_ticks(spark, root), "1 month", tiebreak="tick_id")
    return rounded(candles.ohlcv(state))


@query
def ohlcv_at(spark, root):
    return candles.candle_times(bound.ticks(spark, root), "1 hour")


RATE_WIDTHS = {
    "rates_30s": "30 seconds",
    "rates_10m": "10 minutes",
    "rates_1h": "1 hour",
    "rates_6h": "6 hours",
    "rates_2d": "2 days",
}


def _rate_level(last: str) -> Query:
    names = list(RATE_WIDTHS)
    widths = [RATE_WIDTHS[n] for n in names[: names.index(last) + 1]]

    def run(spark, root):
        state = candles.rate_candles(bound.rates(spark, root), widths[0])
        for width in widths[1:]:
            state = candles.rollup_rates(state, width)
        return rounded(candles.rate_ohlcv(state))

    return run


for _name in RATE_WIDTHS:
    QUERIES[_name] = _rate_level(_name)

STATS_WIDTHS = {
    "stats_1m": "1 minute",
    "stats_1h": "1 hour",
    "stats_1d": "1 day",
    "stats_monthly": "1 month",
}


def _stats_level(last: str) -> Query:
    names = list(STATS_WIDTHS)
    widths = [STATS_WIDTHS[n] for n in names[: names.index(last) + 1]]

    def run(spark, root):
        state = stats.stats(bound.samples(spark, root), widths[0])
        for width in widths[1:]:
            state = stats.rollup_stats(state, width)
        return rounded(stats.stats_values(state))

    return run


for _name in STATS_WIDTHS:
    QUERIES[_name] = _stats_level(_name)


@query
def stats2_1m(spark, root):
    values = stats.stats2_values(stats.stats2(bound.ticks(spark, root), "1 minute"))
    return rounded(values, finer=SLOPE_DIGITS)


@query
def stats2_1d(spark, root):
    state = stats.stats2(bound.ticks(spark, root), "1 minute")
    for width in ("1 hour", "1 day"):
        state = stats.rollup_stats2(state, width)
    return rounded(stats.stats2_values(state), finer=SLOPE_DIGITS)


@query
def basic_aggs(spark, root):
    return rounded(ranges.summary(bound.ticks(spark, root), ["symbol"], "price"))


@query
def rows_by_hour(spark, root):
    return ranges.bucket_counts(bound.ticks(spark, root))


@query
def swap_events_hourly(spark, root):
    return rounded(swaps.swap_activity(bound.swaps(spark, root)))


@query
def swap_daily_volume(spark, root):
    return rounded(swaps.daily_volume(bound.swaps(spark, root)))


@query
def swap_cost_basis(spark, root):
    return rounded(swaps.cost_basis(bound.swaps(spark, root)))


@query
def swap_win_rate(spark, root):
    return rounded(swaps.win_rate(swaps.swap_pnl(bound.swaps(spark, root))))


@query
def histogram_hourly(spark, root):
    samples = bound.samples(spark, root)
    low, high = histogram.value_bounds(samples, "value")
    hourly = samples.withColumn("bucket", time_bucket("1 hour", "time"))
    return histogram.histogram_counts(hourly, ["bucket"], "value", low, high, BINS)


@query
def histogram_day(spark, root):
    """Per day and symbol, bounded by the low and high of the daily candle."""
    ticks = bound.ticks(spark, root).withColumn("bucket", time_bucket("1 day", "time"))
    daily = stored(candles.candles(ticks, "1 day"), "daily")
    bounds = daily.select("bucket", "symbol", "low", "high")
    counts = histogram.histogram_counts(
        ticks.join(bounds, ["bucket", "symbol"]),
        ["bucket", "symbol"],
        "price",
        F.col("low"),
        F.col("high"),
        BINS,
    )
    arrays = histogram.histogram_arrays(counts, ["bucket", "symbol"], BINS)
    return arrays.select(
        "bucket", "symbol", "count", F.array_join(F.col("hist").cast("array<string>"), ",").alias("hist")
    )


@query
def histogram_one_scan(spark, root):
    """Daily histograms of at most BINS cells, merged from hourly ones that need no bounds."""
    hours = bound.samples(spark, root).withColumn("bucket", time_bucket("1 hour", "time"))
    hourly = histogram.grid_states(hours, ["bucket"], "value", BINS)
    days = hourly.withColumn("bucket", time_bucket("1 day", "bucket"))
    return histogram.grid_cells(histogram.merged_grids(days, ["bucket"], BINS), ["bucket"])


@query
def percentiles_daily(spark, root):
    bins = quantiles.value_bins(bound.samples(spark, root), "1 day")
    return rounded(quantiles.bin_percentiles(bins, QUARTILES))


@query
def percentiles_rollup(spark, root):
    """Monthly percentiles merged from stored daily bins."""
    daily = stored(quantiles.value_bins(bound.samples(spark, root), "1 day"), "bins")
    return rounded(quantiles.bin_percentiles(quantiles.rollup_bins(daily, "1 month"), QUARTILES))


@query
def percentiles_bounded(spark, root):
    """Monthly percentiles and their error, of daily states of at most SKETCH_BINS bins a side."""
    bins = quantiles.value_bins(bound.samples(spark, root), "1 day")
    daily = stored(quantiles.bounded_bins(bins, most=SKETCH_BINS), "bounded-bins")
    monthly = quantiles.rollup_bounded(daily, "1 month", most=SKETCH_BINS)
    return rounded(quantiles.bin_percentiles(monthly, QUARTILES))


@query
def percentiles_exact(spark, root):
    days = bound.samples(spark, root).withColumn("bucket", time_bucket("1 day", "time"))
    return rounded(quantiles.exact_percentiles(days, ["bucket"], "value", QUARTILES))


@query
def percentiles_bounds(spark, root):
    """Every sketch percentile has a true rank within two percent of the wanted one."""
    samples = bound.samples(spark, root)
    sketches = quantiles.percentile_sketches(samples, "1 day")
    approximate = stored(quantiles.sketch_percentiles(sketches, QUARTILES), "percentiles")
    days = samples.withColumn("bucket", time_bucket("1 day", "time")).join(approximate, "bucket")
    value = F.col("value")

    def within(name: str, p: float):
        below, upto = F.count_if(value < F.col(name)), F.count_if(value <= F.col(name))
        low, high = (F.count(value) * F.lit(q) for q in (p - 0.02, p + 0.02))
        return ((below <= high) & (upto >= low)).alias(name)

    return days.groupBy("bucket").agg(*(within(n, p) for n, p in QUARTILES.items()))


@query
def last_value(spark, root):
    return lastprice.last_values(bound.samples(spark, root), ["device_id"], "value")


@query
def lttb(spark, root):
    return downsample.lttb(bound.samples(spark, root), ["device_id"], LTTB_POINTS)


@query
def asap_smooth(spark, root):
    return rounded(
        downsample.asap_smooth(bound.samples(spark, root), ["device_id"], ASAP_RESOLUTION)
    )


@query
def distinct_symbols(spark, root):
    return lastprice.symbol_names(bound.ticks(spark, root))


@query
def last_price_per_token(spark, root):
    return rounded(swaps.last_sale_prices(bound.swaps(spark, root)))


# -- window functions ---------------------------------------------------------


@query
def swap_fifo_pnl(spark, root):
    return rounded(swaps.swap_pnl(bound.swaps(spark, root)))


@query
def swap_fifo_incremental(spark, root):
    """The last three days of PnL, continued from totals stored at the day before."""
    rows = bound.swaps(spark, root)
    cut = floor_time(shift(latest_time(rows), "3 days", -1), "1 day")
    moment = F.lit(cut).cast("timestamp_ntz")
    totals = stored(
        swaps.close_books(swaps.swap_pnl(rows.filter(F.col("time") < moment))), "books"
    )
    return rounded(swaps.swap_pnl_from_books(rows.filter(F.col("time") >= moment), totals))


@query
def swap_pnl_dated_books(spark, root):
    """PnL of two days in the past, from the books at their start; nothing older is read."""
    folder = fresh_path(spark, "dated")
    rows = bound.swaps(spark, root)
    table = ChunkTable(spark, f"{folder}/swaps", rows.schema, "time", SWAPS.series_cols, "1 day").create()
    table.append(rows)
    dated = books.DatedBooks(table, f"{folder}/books", every=10)
    newest = floor_time(latest_time(rows), "1 day")
    dated.close(newest.date())
    start = shift(newest, "9 days", -1) + timedelta(hours=5)
    return rounded(dated.pnl(start, shift(start, "2 days")))


@query
def last_price_init(spark, root):
    return lastprice.initial_last_prices(bound.ticks(spark, root))


@query
def last_price_init_ties(spark, root):
    return lastprice.initial_last_prices(bound.long_ticks(spark, root))


# -- continuous aggregates ----------------------------------------------------


def _tick_chain(spark: SparkSession, root: str, name: str) -> cagg.CaggChain:
    table = _tick_table(spark, root, name)
    return cagg.candle_chain(table, TICKS, table.path.removesuffix("/ticks")).define()


def _sample_chain(
    spark: SparkSession, root: str, name: str, config: SeriesConfig = SAMPLES
) -> cagg.CaggChain:
    folder = fresh_path(spark, name)
    table = ChunkTable(
        spark,
        f"{folder}/sample",
        bound.samples(spark, root).schema,
        series_cols=config.series_cols,
        chunk_interval=config.chunk_interval,
    ).create()
    return cagg.stats_chain(table, config, folder).define()


def _candles_of(frame: DataFrame) -> DataFrame:
    return rounded(candles.ohlcv(frame))


@query
def cagg_refresh_full(spark, root):
    chain = _tick_chain(spark, root, "full")
    chain.raw.append(bound.ticks(spark, root))
    chain.refresh_full()
    return _candles_of(chain.materialized("1d"))


@query
def cagg_refresh_window(spark, root):
    chain = _tick_chain(spark, root, "window")
    ticks = bound.ticks(spark, root)
    chain.raw.append(ticks)
    as_of = latest_time(ticks)
    chain.refresh_window("1m", shift(as_of, "3 weeks", -1), shift(as_of, "1 hour", -1))
    return _candles_of(chain.materialized("1m"))


@query
def cagg_refresh_invalidated(spark, root):
    """Late inserts and an update after a full refresh, repaired by a partial one."""
    chain = _tick_chain(spark, root, "invalidated")
    ticks = bound.ticks(spark, root)
    late = F.col("tick_id") % 10 == 3
    chain.raw.append(ticks.filter(~late))
    chain.refresh_full()
    chain.raw.append(ticks.filter(late))
    start = shift(latest_time(ticks), "3 days", -1) + timedelta(microseconds=1)
    chain.raw.update_range(lambda df: df.withColumn("price", F.col("price") + 1), start)
    chain.refresh_invalidated()
    return _candles_of(chain.materialized("1h"))


@query
def cagg_hierarchy_refresh(spark, root):
    chain = _sample_chain(spark, root, "hierarchy")
    chain.raw.append(bound.samples(spark, root))
    chain.refresh_full()
    return rounded(stats.stats_values(chain.materialized("monthly")))


WEEKLY = SeriesConfig(
    table="sample",
    chunk_interval="1 week",
    levels=chain_levels(
        ["1 minute", "1 hour", "1 day", "1 week"],
        ["1m", "1h", "1d", "1w"],
        ["1 day", "1 week", "1 month", "1 month"],
    ),
)


@query
def build_cagg_chain(spark, root):
    chain = _sample_chain(spark, root, "weekly", WEEKLY)
    chain.raw.append(bound.samples(spark, root))
    chain.refresh_full()
    return rounded(stats.stats_values(chain.materialized("1w")))


@query
def cagg_rates(spark, root):
    """The five stored rate levels, refreshed in full; the coarsest is read."""
    folder = fresh_path(spark, "rates")
    rates = bound.rates(spark, root)
    table = ChunkTable(
        spark, f"{folder}/rates", rates.schema, "timestamp", RATES.series_cols
    ).create()
    chain = cagg.rate_chain(table, RATES, folder).define()
    table.append(rates)
    chain.refresh_full()
    return rounded(candles.rate_ohlcv(chain.materialized("2d")))


@query
def cagg_swap_policy(spark, root):
    """Hourly swap activity after one scheduled run: the day before the newest hour."""
    folder = fresh_path(spark, "swaps")
    rows = bound.swaps(spark, root)
    table = ChunkTable(
        spark, f"{folder}/swaps", rows.schema, "time", SWAPS.series_cols, SWAPS.chunk_interval
    ).create()
    chain = cagg.swap_chain(table, SWAPS, folder).define()
    table.append(rows)
    chain.refresh_policy(latest_time(rows))
    return rounded(chain.materialized("1h"))


def _partly_refreshed(spark: SparkSession, root: str, name: str) -> cagg.CaggChain:
    """All ticks stored, levels refreshed only up to five days before the newest tick."""
    chain = _tick_chain(spark, root, name)
    ticks = bound.ticks(spark, root)
    chain.raw.append(ticks)
    until = shift(latest_time(ticks), "5 days", -1)
    for level in TICKS.levels:
        chain.refresh_window(level.name, None, until)
    return chain


@query
def realtime_view(spark, root):
    return _candles_of(_partly_refreshed(spark, root, "realtime").realtime("1d"))


@query
def watch_ohlcv_stored(spark, root):
    """The watch report from stored levels and, behind them, live ones."""
    chain = _partly_refreshed(spark, root, "watch")
    symbol = nearest.newest_rows(chain.raw, 1, tiebreak=["tick_id"]).first()["symbol"]
    return reports.watch_stored(chain, symbol)


@query
def query_all_caggs_stored(spark, root):
    chain = _sample_chain(spark, root, "averages")
    chain.raw.append(bound.samples(spark, root))
    chain.refresh_full()
    return rounded(reports.averages_stored(chain))


@query
def materialized_view(spark, root):
    return _candles_of(_partly_refreshed(spark, root, "materialized").materialized("1h"))


ROUTED_RANGES = ("1 hour", "5 days", "3 weeks", "1 year")


@query
def route_by_range(spark, root):
    """Average per bucket for ranges of four lengths, each served by its own level."""
    chain = _sample_chain(spark, root, "route")
    samples = bound.samples(spark, root)
    chain.raw.append(samples)
    chain.refresh_full()
    end = latest_time(samples)
    parts = []
    for length in ROUTED_RANGES:
        start = shift(end, length, -1)
        rows = stats.stats_values(chain.query_range(start, end, live=False))
        parts.append(
            rows.select(
                F.lit(chain.route(start, end)).alias("level"), "bucket", "device_id", "average"
            )
        )
    return rounded(reduce(DataFrame.unionByName, parts))


# -- streams ------------------------------------------------------------------


def _tick_stream(spark: SparkSession, root: str) -> DataFrame:
    events = bound.table(spark, root, "events")
    return bound.ticks_from_events(runs.table_stream(spark, root, "events", events.schema))


def _run_to_table(stream: DataFrame, name: str) -> DataFrame:
    spark = stream.sparkSession
    folder = fresh_path(spark, name)
    runs.append_available(stream, f"{folder}/out", f"{folder}/progress")
    return spark.read.schema(stream.schema).parquet(f"{folder}/out")


@query
def stream_ohlcv(spark, root):
    """Minute candles of all buckets closed by the end of the stream."""
    return _candles_of(_run_to_table(stream_candles(_tick_stream(spark, root)), "ohlcv"))


@query
def stream_rollup(spark, root):
    """Hour candles merged from minute candles within the stream."""
    return _candles_of(_run_to_table(stream_candle_rollup(_tick_stream(spark, root)), "rollup"))


@query
def stream_upsert(spark, root):
    """Hourly candles of a stream whose batches overlap in time: no tick is too late."""
    folder = fresh_path(spark, "deltas")
    ticks = bound.ticks(spark, root)
    # A file per micro-batch, each with ticks of the whole time.
    ticks.repartition(4, "tick_id").write.parquet(f"{folder}/in")
    levels = deltas.DeltaLevels(spark, f"{folder}/levels", TICKS, ticks.schema, fold_every=3, most_files=1).create()
    stream = runs.parquet_stream(spark, f"{folder}/in", ticks.schema, files_per_batch=1)
    runs.each_batch_available(stream, levels.add, f"{folder}/progress")
    return _candles_of(levels.read("1h"))


def _seeds(spark: SparkSession, root: str) -> DataFrame:
    return lastprice.symbol_names(bound.ticks(spark, root)).select(
        "symbol",
        F.lit(None).cast("double").alias("last_price"),
        F.lit(None).cast("timestamp_ntz").alias("last_price_at"),
    )


@query
def stream_last_price(spark, root):
    folder = fresh_path(spark, "lastprice")
    versions = prices.SymbolVersions(spark, f"{folder}/symbols", _seeds(spark, root))
    runs.each_batch_available(
        _tick_stream(spark, root), prices.last_price_updater(versions, tiebreak="tick_id"), f"{folder}/progress"
    )
    return versions.latest()


@query
def stream_last_price_state(spark, root):
    """Last prices by keyed state: batches emit only symbols that moved."""
    folder = fresh_path(spark, "lastprice-state")
    keyed.keep_changes(keyed.price_changes(_tick_stream(spark, root)), f"{folder}/changes", f"{folder}/progress")
    return keyed.last_prices(spark, f"{folder}/changes", _seeds(spark, root))


@query
def stream_pair_ticks(spark, root):
    folder = fresh_path(spark, "pairticks")
    versions = prices.SymbolVersions(spark, f"{folder}/symbols", _seeds(spark, root))
    handler = prices.pair_tick_updater(
        versions, _stored_pairs(spark, root), f"{folder}/ticks"
    )
    runs.each_batch_available(_tick_stream(spark, root), handler, f"{folder}/progress")
    return prices.emitted_ticks(spark, f"{folder}/ticks", bound.ticks(spark, root).schema)


@query
def repair_pair_ticks(spark, root):
    """Pair ticks emitted without every tenth tick, corrected when those arrive."""
    ticks, tracked = bound.ticks(spark, root), _stored_pairs(spark, root)
    late = F.col("tick_id") % 10 == 0
    raw = _tick_table(spark, root, "repair")
    emitted = prices.pair_table(raw, f"{raw.path}__pairs").create()
    raw.append(ticks.filter(~late))
    emitted.append(pairs.pair_ticks(ticks.filter(~late), tracked))
    raw.append(ticks.filter(late))
    prices.repair_pair_ticks(raw, tracked, emitted, ticks.filter(late))
    return emitted.read()
