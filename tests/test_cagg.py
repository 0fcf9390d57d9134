import os
import random
from dataclasses import replace
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from conftest import make_ticks, minutes, plain, plan_of, random_ticks
from tideline.config import SAMPLES, TICKS, chain_levels
from tideline.functions.buckets import floor_time, shift
from tideline.operators.candles import candles
from tideline.operators.ranges import bucket_counts
from tideline.operators.stats import stats, stats_values
from tideline.plans import cagg, coverage, reports
from tideline.sources.store import ChunkTable


def tick_table(spark, folder):
    return ChunkTable(
        spark, f"{folder}/ticks", make_ticks(spark, []).schema, series_cols=("symbol",)
    ).create()


def tick_chain(spark, folder, rows=None):
    chain = cagg.candle_chain(tick_table(spark, folder), TICKS, folder).define()
    if rows is not None:
        chain.raw.append(rows)
    return chain


def levels_match(chain, reader="materialized"):
    rows = chain.raw.read()
    for level in chain.config.levels:
        got = getattr(chain, reader)(level.name)
        assert plain(got) == plain(candles(rows, level.width), *got.columns), level.name


def test_defined_without_data(spark, folder):
    chain = tick_chain(spark, folder)
    assert chain.materialized("1d").isEmpty() and chain.realtime("1d").isEmpty()
    assert chain.refreshed_until("1m") is None


def test_full_refresh(spark, folder):
    chain = tick_chain(spark, folder, random_ticks(spark))
    chain.refresh_full()
    levels_match(chain)
    chain.refresh_full()
    levels_match(chain)


def test_window_refresh_takes_whole_buckets_inside(spark, folder):
    chain = tick_chain(spark, folder, random_ticks(spark))
    start, end = minutes(100.5), minutes(900.5)
    chain.refresh_window("1h", start, end)
    assert chain.materialized("1h").isEmpty()  # nothing in the finer level yet
    chain.refresh_window("1m", start, end)
    got = chain.materialized("1m")
    want = candles(chain.raw.read(), "1 minute").filter(
        (F.col("bucket") >= F.lit(minutes(101))) & (F.col("bucket") < F.lit(minutes(900)))
    )
    assert plain(got) == plain(want, *got.columns) and not got.isEmpty()


def test_invalidated_refresh_equals_full_refresh(spark, folder):
    rows = random_ticks(spark, hot="H")
    late = F.col("tick_id") % 9 == 0
    chain = tick_chain(spark, folder, rows.filter(~late))
    chain.refresh_full()
    assert chain.refresh_invalidated() == []
    chain.raw.append(rows.filter(late))
    chain.raw.update_range(lambda d: d.withColumn("price", F.col("price") + 1), minutes(2000))
    assert chain.refresh_invalidated()
    levels_match(chain)
    assert chain.refresh_invalidated() == []


def test_invalidated_refresh_leaves_other_buckets_alone(spark, folder):
    chain = tick_chain(spark, folder, random_ticks(spark))
    chain.refresh_full()
    before = chain.materialized("1m").filter(F.col("bucket") < F.lit(minutes(60))).count()
    # Not logged: these rows must stay invisible, their bucket was not touched.
    quiet = make_ticks(spark, [(5, "quiet", 1, 1)])
    quiet.withColumn("chunk", F.lit("2024-03-01")).write.mode("append").partitionBy("chunk").parquet(
        chain.raw.path
    )
    chain.raw.append(make_ticks(spark, [(3000.2, "Z", 1, 1)]))
    touched = chain.refresh_invalidated()
    assert touched == [(minutes(3000), minutes(3001))]
    assert chain.materialized("1m").filter("symbol = 'quiet'").isEmpty()
    assert chain.materialized("1m").filter(F.col("bucket") < F.lit(minutes(60))).count() == before


def test_realtime_view_adds_the_tail_of_every_level(spark, folder):
    chain = tick_chain(spark, folder, random_ticks(spark))
    for level in TICKS.levels:
        chain.refresh_window(level.name, datetime(2000, 1, 3), minutes(2200))
    levels_match(chain, "realtime")
    stored, live = chain.materialized("1h").count(), chain.realtime("1h").count()
    assert 0 < stored < live


def test_ranges_never_refreshed_are_aggregated_live(spark, folder):
    rows = random_ticks(spark)
    old = rows.withColumn("time", F.col("time") - F.expr("INTERVAL 30 YEARS"))
    both = rows.unionByName(old)
    chain = tick_chain(spark, folder, both)
    for level in TICKS.levels:
        chain.refresh_window(level.name, minutes(300), minutes(2200))
    levels_match(chain, "realtime")
    assert chain.refreshed("1m") == [(minutes(300), minutes(2200))]
    assert all(a >= minutes(300) and b <= minutes(2200) for lv in TICKS.levels for a, b in chain.refreshed(lv.name))
    chain.refresh_window("1m", None, None)
    assert plain(chain.materialized("1m")) == plain(candles(both, "1 minute"))


def test_reads_and_refreshes_open_only_chunks_of_their_time(spark, folder):
    rows = spark.range(400).select(
        "id", (F.lit(minutes(0)) + F.make_dt_interval(F.col("id").cast("int"))).alias("time"),
        F.lit("A").alias("symbol"), F.col("id").cast("double").alias("price"), F.lit(1.0).alias("volume"),
    ).withColumnRenamed("id", "tick_id")
    chain = tick_chain(spark, folder, rows)
    chain.refresh_full()
    plan = plan_of(chain.query_range(minutes(0), minutes(60), live=False))
    filters = next(line for line in plan.splitlines() if "PartitionFilters" in line)
    assert ">=" in filters and "<=" in filters
    live = plan_of(chain.realtime("1h", minutes(0), minutes(120)))
    assert all("PartitionFilters: []" not in line for line in live.splitlines())

    def files(level):
        base = chain.table(level).path
        return {f"{d}/{n}" for d, _, names in os.walk(base) for n in names if n.endswith(".parquet")}

    before = {lv.name: files(lv.name) for lv in TICKS.levels}
    late = [(100 * 1440 + 5, "A", 1, 1), (300 * 1440 + 5, "A", 1, 1)]
    chain.raw.append(make_ticks(spark, late))
    chain.refresh_invalidated()
    levels_match(chain)
    assert len(files("1m") - before["1m"]) == 2 and len(before["1m"] - files("1m")) == 2
    assert len(files("1h") - before["1h"]) == 2


def test_named_views_of_the_levels(spark, folder):
    chain = tick_chain(spark, folder, random_ticks(spark))
    chain.refresh_full()
    assert chain.register_views() == ["ticks_1m", "ticks_1h", "ticks_1d"]
    assert plain(spark.table("ticks_1h")) == plain(chain.materialized("1h"))


def test_policy_run(spark, folder):
    rows = random_ticks(spark)
    as_of = rows.agg(F.max("time")).first()[0]
    chain = tick_chain(spark, folder, rows)
    chain.refresh_policy(as_of)
    got = chain.materialized("1m").agg(F.min("bucket"), F.max("bucket")).first()
    if got[0] is not None:
        assert got[0] >= as_of - timedelta(minutes=6) and got[1] <= as_of - timedelta(minutes=3)
    empty = replace(TICKS, levels=(replace(TICKS.levels[0], refresh_start="3 minutes"),))
    with pytest.raises(ValueError):
        replace(chain, config=empty).refresh_policy(as_of)


def test_emptied_buckets_disappear(spark, folder):
    chain = tick_chain(spark, folder, random_ticks(spark))
    chain.refresh_full()
    chain.raw.truncate()
    chain.refresh_window("1m", minutes(-600), minutes(6000))
    assert chain.materialized("1m").isEmpty()
    assert not chain.materialized("1h").isEmpty()


@pytest.mark.parametrize("kind", ["finance", "sensors"])
def test_invalidation_demonstration(spark, folder, kind):
    """Hourly counts through inserts, later inserts and an update."""
    chain = cagg.count_chain(
        tick_table(spark, folder), replace(TICKS, levels=chain_levels(["1 hour"], ["1h"])), folder
    ).define()

    def check():
        got = chain.materialized("1h").withColumnRenamed("total", "total_hourly")
        assert plain(got) == plain(bucket_counts(chain.raw.read()))

    first = [(m, "OAK", p, 40) for m, p in ((-95, 7.1), (-48, 7.35), (-41, 7.2), (3, 6.9))]
    chain.raw.append(make_ticks(spark, first))
    chain.refresh_full()
    check()
    chain.raw.append(make_ticks(spark, [(5, "OAK", 7.3, 40), (44, "OAK", 7.05, 40), (70, "OAK", 7.7, 40)]))
    # Buckets of 9:00, 10:00 in one piece.
    assert chain.refresh_invalidated() == [(minutes(-30), minutes(90))]
    check()
    start, end = (minutes(40), None) if kind == "finance" else (minutes(-50), minutes(0))
    chain.raw.update_range(lambda d: d.withColumn("price", F.col("price") + 1), start, end)
    assert chain.refresh_invalidated()
    check()
    raised = chain.raw.read().agg(F.sum("price")).first()[0]
    assert round(raised - 50.6, 6) == 2


def test_statistics_chain_with_weeks_and_months(spark, folder):
    samples = random_ticks(spark).selectExpr("time", "symbol as device_id", "price as value")
    for name, config in (
        ("months", SAMPLES),
        ("weeks", replace(SAMPLES, levels=chain_levels(["1 minute", "1 hour", "1 week"], ["1m", "1h", "1w"]))),
    ):
        raw = ChunkTable(
            spark, f"{folder}/{name}/sample", samples.schema, series_cols=("device_id",), chunk_interval="1 week"
        ).create()
        chain = cagg.stats_chain(raw, config, f"{folder}/{name}").define()
        raw.append(samples)
        chain.refresh_full()
        last = config.levels[-1]
        assert plain(stats_values(chain.materialized(last.name))) == plain(
            stats_values(stats(samples, last.width))
        )


def test_levels_must_nest(spark, folder):
    config = replace(TICKS, levels=chain_levels(["1 week", "1 month"], ["1w", "1mon"]))
    with pytest.raises(ValueError):
        cagg.candle_chain(tick_table(spark, folder), config, folder).define()


def test_routing():
    names = ["1m", "1h", "1d", "monthly"]
    start = datetime(2024, 1, 1)
    for length, level in (
        (timedelta(minutes=1), "1m"),
        (timedelta(days=1), "1m"),
        (timedelta(days=1, seconds=1), "1h"),
        (timedelta(days=7), "1h"),
        (timedelta(days=8), "1d"),
        (timedelta(days=180), "1d"),
        (timedelta(days=181), "monthly"),
    ):
        assert cagg.route_by_range(names, start, start + length) == level


def test_range_query_reads_the_routed_level(spark, folder):
    chain = tick_chain(spark, folder, random_ticks(spark))
    chain.refresh_full()
    out = chain.query_range(minutes(0), minutes(3 * 1440))
    assert plain(out) == plain(
        chain.materialized("1h").filter(F.col("bucket") >= F.lit(minutes(0))), *out.columns
    )


def test_merging_ranges():
    def r(a, b):
        return (minutes(a), minutes(b))

    assert cagg.merge_ranges([r(5, 6), r(0, 2), r(1, 3), r(3, 4), r(9, 9)]) == [r(0, 4), r(5, 6)]
    many = [r(10 * i, 10 * i + 1) for i in range(500)]
    assert cagg.merge_ranges(many[::-1]) == many
    assert cagg.without([r(0, 2), r(3, 4)], *r(1, 6)) == [r(2, 3), r(4, 6)]
    assert cagg.without([r(0, 9)], *r(1, 6)) == [] and cagg.without([], *r(1, 6)) == [r(1, 6)]


def test_common_and_outside():
    rng = random.Random(5)
    for _ in range(200):
        a, b = ({m for m in range(30) if rng.random() < share} for share in (0.6, 0.4))
        ranges = [cagg.merge_ranges([(minutes(m), minutes(m + 1)) for m in x]) for x in (a, b)]
        for found, want in ((cagg.common(*ranges), a & b), (cagg.outside(*ranges), a - b)):
            assert found == cagg.merge_ranges([(minutes(m), minutes(m + 1)) for m in want])


@pytest.mark.parametrize("width, step", [("1 minute", timedelta(minutes=1)), ("30 seconds", timedelta(seconds=30)), ("1 week", timedelta(days=7)), ("3 months", None)])
def test_rows_inside_any_number_of_ranges(spark, width, step):
    rng = random.Random(2)
    start = floor_time(datetime(1999, 11, 3), width)
    edges = [start]
    for _ in range(coverage.BLOCK * 3 if step and step < timedelta(days=1) else 60):
        edges.append(shift(edges[-1], width))
    # A block covered in full, single buckets, and long gaps.
    picked = sorted(rng.sample(range(len(edges) - 1), 40)) + list(range(len(edges) // 3, len(edges) - 1 - 20))
    ranges = cagg.merge_ranges([(edges[i], edges[i + 1]) for i in picked])
    assert len(ranges) > 1
    moments = [e + timedelta(microseconds=rng.choice((0, 1, 999_999))) for e in rng.sample(edges, min(400, len(edges)))]
    rows = spark.createDataFrame([(m, i) for i, m in enumerate(moments)], "time timestamp_ntz, i long")
    want = {i for i, m in enumerate(moments) if any(a <= m < b for a, b in ranges)}
    assert {r.i for r in coverage.inside(rows, ranges, width, "time").collect()} == want
    assert {r.i for r in coverage.inside(rows, ranges, width, "time", covered=False).collect()} == set(range(len(moments))) - want


def test_live_plan_does_not_grow_with_gaps(spark, folder):
    days = 40
    rows = [(1440 * d + 30 * k, "AB"[k % 2], d + k, 1) for d in range(days) for k in range(6)]
    chain = tick_chain(spark, folder, make_ticks(spark, rows))
    seen = []
    for gap in (1, 3):
        wanted = [(datetime(2024, 3, 1) + timedelta(days=d), datetime(2024, 3, 1) + timedelta(days=d + gap)) for d in range(0, days, 2 * gap)]
        for level in TICKS.levels:
            chain._recompute(level.name, wanted)
            chain._ranges(level.name).write(wanted)
        live = chain.realtime("1d")
        plan = plan_of(live)
        seen.append(plan.count("Scan parquet"))
        assert " OR " not in plan
        levels_match(chain, "realtime")
    assert seen[0] == seen[1]


def test_noting_ranges_runs_no_job(spark, folder):
    chain = tick_chain(spark, folder, make_ticks(spark, [(0, "A", 1, 1)]))
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("noting", "")
    ranges = [(minutes(10 * k - 30), minutes(10 * k - 25)) for k in range(300)]
    chain._note("1m", ranges)
    assert chain.refreshed("1m") == ranges
    chain._note("1h", ranges)
    assert chain.refreshed("1h") == []
    assert list(tracker.getJobIdsForGroup("noting")) == []
    spark.sparkContext.setJobGroup("", "")


def test_reports_from_stored_levels(spark, folder):
    rows = [(1440 * d + 7 * k, "AB"[k % 2], d + k, 1) for d in range(30) for k in range(9)]
    ticks = make_ticks(spark, rows)
    chain = tick_chain(spark, folder, ticks)
    assert reports.watch_stored(cagg.candle_chain(tick_table(spark, f"{folder}/none"), TICKS, f"{folder}/none").define()) is None
    chain.refresh_window("1m", None, minutes(1440 * 20))
    levels = [candles(ticks, lv.width) for lv in TICKS.levels]
    # Refreshed in part, and then in full.
    for _ in range(2):
        for symbol in (None, "B"):
            own = [lv if symbol is None else lv.filter(F.col("symbol") == symbol) for lv in levels]
            assert plain(reports.watch_stored(chain, symbol)) == plain(reports.watch_ohlcv(*own)) != []
        chain.refresh_full()
    scans = [line for line in plan_of(reports.watch_stored(chain)).splitlines() if "PartitionFilters" in line]
    assert len(scans) == 3 and all("chunk#" in line for line in scans)
    assert not any("/ticks]" in line for line in plan_of(reports.watch_stored(chain)).splitlines() if "Location" in line)


def test_averages_from_stored_levels(spark, folder):
    samples = random_ticks(spark).selectExpr("time", "symbol as device_id", "price as value")
    raw = ChunkTable(spark, f"{folder}/sample", samples.schema, series_cols=("device_id",), chunk_interval="1 week").create()
    chain = cagg.stats_chain(raw, SAMPLES, folder).define()
    assert reports.averages_stored(chain) is None
    raw.append(samples)
    chain.refresh_full()
    levels = [stats(samples, lv.width) for lv in SAMPLES.levels]
    as_of = levels[0].agg(F.max("bucket")).first()[0]
    assert plain(reports.averages_stored(chain)) == plain(reports.level_averages(*levels, as_of))
