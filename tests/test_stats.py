import random
import statistics

from conftest import minutes, plain, random_ticks
from tideline.operators import stats as s

SCHEMA = "time timestamp_ntz, device_id string, value double"


def test_rollup_equals_direct(spark):
    samples = random_ticks(spark).selectExpr("time", "symbol as device_id", "price as value")
    state = s.stats(samples, "1 minute")
    for width in ("1 hour", "1 day", "1 month"):
        state = s.rollup_stats(state, width)
        direct = s.stats(samples, width)
        assert plain(s.stats_values(state)) == plain(s.stats_values(direct))


def test_large_offset_keeps_its_variance(spark):
    rng = random.Random(1)
    values = [1e9 + rng.random() for _ in range(500)]
    rows = [(minutes(i), "d", v) for i, v in enumerate(values)]
    state = s.stats(spark.createDataFrame(rows, SCHEMA), "1 minute")
    state = s.rollup_stats(s.rollup_stats(state, "1 hour"), "1 day")
    got = s.stats_values(state).first()
    assert abs(got["variance_pop"] - statistics.pvariance(values)) < 1e-6


def test_nulls_and_single_values(spark):
    rows = [(minutes(0), "a", None), (minutes(70), "a", 3.0), (minutes(0), "b", None)]
    state = s.rollup_stats(s.stats(spark.createDataFrame(rows, SCHEMA), "1 minute"), "1 day")
    out = {r["device_id"]: r for r in s.stats_values(state).collect()}
    assert (out["a"]["num_vals"], out["a"]["average"], out["a"]["variance"]) == (1, 3.0, None)
    assert (out["b"]["num_vals"], out["b"]["average"]) == (0, None)


def test_two_variable_rollup_equals_direct(spark):
    ticks = random_ticks(spark, n=400)
    state = s.stats2(ticks, "1 minute")
    for width in ("1 hour", "1 day"):
        state = s.rollup_stats2(state, width)
        assert plain(s.stats2_values(state)) == plain(s.stats2_values(s.stats2(ticks, width)))


def test_exact_line_is_recovered(spark):
    rows = [(i, minutes(i), "A", 10 + 0.5 * 60 * i, 1.0) for i in range(20)]
    ticks = spark.createDataFrame(
        rows, "tick_id long, time timestamp_ntz, symbol string, price double, volume double"
    )
    row = s.stats2_values(s.rollup_stats2(s.stats2(ticks, "1 minute"), "1 hour")).first()
    # The hour starts 30 minutes before the first tick.
    assert abs(row["slope"] - 0.5) < 1e-9 and abs(row["r2"] - 1) < 1e-9
    assert abs(row["intercept"] - (10 - 0.5 * 1800)) < 1e-6
