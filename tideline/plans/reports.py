"""Report queries over stored or computed levels."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tideline.functions.buckets import floor_time, shift, time_bucket
from tideline.functions.scalars import ratio
from tideline.operators.ranges import recent
from tideline.plans.cagg import CaggChain
from tideline.plans.nearest import newest_rows

PRICES = ("high", "low", "open", "close")


def _join_levels(minute: DataFrame, hour: DataFrame, day: DataFrame) -> DataFrame:
    def named(df: DataFrame, short: str, long: str) -> DataFrame:
        return df.select(
            F.col("symbol").alias(f"{short}_symbol"),
            F.col("bucket").alias(f"{short}_bucket"),
            *(F.col(p).alias(f"{p}_{long}") for p in PRICES),
        )

    m = (
        named(minute, "min", "minute")
        .withColumn("_hour", time_bucket("1 hour", "min_bucket"))
        .withColumn("_day", time_bucket("1 day", "min_bucket"))
    )
    h, d = named(hour, "hour", "hour"), named(day, "day", "day")
    return (
        m.join(h, (h["hour_bucket"] == m["_hour"]) & (h["hour_symbol"] == m["min_symbol"]))
        .join(d, (d["day_bucket"] == m["_day"]) & (d["day_symbol"] == m["min_symbol"]))
        .select(
            F.col("min_symbol").alias("symbol"),
            "min_bucket",
            "hour_bucket",
            "day_bucket",
            *(f"{p}_{level}" for level in ("minute", "hour", "day") for p in PRICES),
        )
    )


def watch_ohlcv(minute: DataFrame, hour: DataFrame, day: DataFrame) -> DataFrame:
    """The newest candle of each level, joined if all three belong together."""

    def newest(df: DataFrame) -> DataFrame:
        return df.orderBy(F.col("bucket").desc(), "symbol").limit(1)

    return _join_levels(newest(minute), newest(hour), newest(day))


def watch_ohlcv_per_symbol(minute: DataFrame, hour: DataFrame, day: DataFrame) -> DataFrame:
    """The newest candles of each symbol. Aggregation, not ranking: no symbol is gathered."""

    def newest(df: DataFrame) -> DataFrame:
        return df.groupBy("symbol").agg(
            F.max("bucket").alias("_bucket"), *(F.max_by(p, "bucket").alias(p) for p in PRICES)
        ).withColumnRenamed("_bucket", "bucket")

    return _join_levels(newest(minute), newest(hour), newest(day))


def level_averages(
    minute: DataFrame,
    hour: DataFrame,
    day: DataFrame,
    month: DataFrame,
    as_of: datetime,
    width: str | None = "1 month",
    n: int | None = 10,
) -> DataFrame:
    """Averages of all levels side by side, newest first; ``width`` None takes all minutes."""

    def average(df: DataFrame, name: str) -> DataFrame:
        return df.select(
            F.col("bucket").alias(f"_b_{name}"),
            F.col("device_id").alias(f"_d_{name}"),
            ratio(F.col("sx"), F.col("n")).alias(f"avg_{name}"),
        )

    wanted = minute if width is None else recent(minute, as_of, width, "bucket")
    out = wanted.select(
        F.col("bucket").alias("time"),
        "device_id",
        ratio(F.col("sx"), F.col("n")).alias("avg_1m"),
    )
    for name, span, level in (
        ("1h", "1 hour", hour),
        ("1d", "1 day", day),
        ("mon", "1 month", month),
    ):
        out = out.withColumn(f"_k_{name}", time_bucket(span, "time"))
        coarse = average(level, name)
        out = out.join(
            coarse,
            (out[f"_k_{name}"] == coarse[f"_b_{name}"])
            & (out["device_id"] == coarse[f"_d_{name}"]),
        )
    out = out.select("time", "device_id", "avg_1m", "avg_1h", "avg_1d", "avg_mon")
    return out if n is None else out.orderBy(F.col("time").desc(), "device_id").limit(n)


def watch_stored(chain: CaggChain, symbol: str | None = None) -> DataFrame | None:
    """``watch_ohlcv`` from the stored levels of a chain, live where they aren't refreshed.

    Each level is read from its bucket of the newest tick on, so the report opens the newest chunks
    only. ``symbol`` takes one symbol's newest tick instead; None if there is no tick.
    """
    own = None if symbol is None else F.col("symbol") == symbol
    newest = newest_rows(chain.raw, 1, own).first()
    if newest is None:
        return None
    moment = newest[chain.raw.time_col]
    levels = [chain.realtime(lv.name, floor_time(moment, lv.width)) for lv in chain.config.levels]
    return watch_ohlcv(*(level if own is None else level.filter(own) for level in levels))


def averages_stored(chain: CaggChain, width: str = "1 month", n: int | None = 10) -> DataFrame | None:
    """``level_averages`` of the last ``width`` before the newest minute, from the levels of a chain."""
    latest = chain.raw.latest()
    if latest is None:
        return None
    as_of = floor_time(latest, chain.config.levels[0].width)
    start = shift(as_of, width, -1)
    levels = [chain.realtime(lv.name, floor_time(start, lv.width)) for lv in chain.config.levels]
    return level_averages(*levels, as_of, width, n)
