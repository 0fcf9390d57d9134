from pyspark.sql import functions as F

from conftest import make_ticks, minutes, plain, plan_of, random_ticks
from tideline.operators import candles as c


def test_rollup_equals_direct(spark):
    ticks = random_ticks(spark, hot="H")
    state = c.candles(ticks, "1 minute")
    for width in ("1 hour", "1 day"):
        state = c.rollup_candles(state, width)
        assert plain(state) == plain(c.candles(ticks, width), *state.columns)


def test_values_zero_volume_and_one_row(spark):
    ticks = make_ticks(
        spark, [(0, "A", 5, 2), (0.5, "A", 9, 1), (0.9, "A", 4, 1), (0.1, "B", 7, 0)]
    )
    out = {r["symbol"]: r for r in c.ohlcv(c.candles(ticks, "1 minute")).collect()}
    a = out["A"]
    assert (a["open"], a["high"], a["low"], a["close"], a["volume"]) == (5, 9, 4, 4, 4)
    assert a["vwap"] == (10 + 9 + 4) / 4
    assert out["B"]["vwap"] is None and out["B"]["open"] == out["B"]["close"] == 7


def test_tiebreak_settles_equal_times(spark):
    ticks = make_ticks(spark, [(0, "A", 5, 1), (0, "A", 6, 1), (0, "A", 4, 1)])
    row = c.candles(ticks, "1 minute", tiebreak="tick_id").first()
    assert (row["open"], row["close"]) == (5, 4)


def test_times_of_extremes_take_the_earliest(spark):
    ticks = make_ticks(spark, [(0, "A", 5, 1), (1, "A", 9, 1), (2, "A", 9, 1), (3, "A", 5, 1)])
    row = c.candle_times(ticks, "1 hour").first()
    assert (row["open_at"], row["high_at"]) == (minutes(0), minutes(1))
    assert (row["low_at"], row["close_at"]) == (minutes(0), minutes(3))


def test_rates_roll_up(spark):
    rates = random_ticks(spark).select(
        F.col("time").alias("timestamp"),
        F.col("symbol").alias("from"),
        F.lit("USD").alias("to"),
        (F.col("price") * 1.001).alias("ask"),
        (F.col("price") * 0.999).alias("bid"),
    )
    state = c.rate_candles(rates, "30 seconds")
    for width in ("10 minutes", "1 hour", "6 hours", "2 days"):
        state = c.rollup_rates(state, width)
    direct = c.rate_candles(rates, "2 days")
    assert plain(c.rate_ohlcv(state)) == plain(c.rate_ohlcv(direct))


def test_plan_is_hash_aggregation_with_pruned_scan(spark, folder):
    random_ticks(spark).write.parquet(f"{folder}/t")
    ticks = spark.read.parquet(f"{folder}/t").filter(F.col("symbol") == "A")
    state = c.rollup_candles(c.candles(ticks, "1 minute"), "1 hour")
    plan = plan_of(state)
    assert "SortAggregate" not in plan and "ObjectHashAggregate" not in plan
    assert "EqualTo(symbol,A)" in plan and "tick_id" not in plan.split("ReadSchema:")[1].split("\n")[0]


def test_empty(spark):
    assert c.ohlcv(c.candles(make_ticks(spark, []), "1 minute")).count() == 0
