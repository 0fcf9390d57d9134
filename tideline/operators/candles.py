"""Open/high/low/close/volume candles as flat, mergeable state columns.

State per bucket and series: ``open, high, low, close, volume, pv, open_at, close_at``
where ``pv`` is the sum of price * volume. All of them are fixed-width, so both the
first aggregation and the roll-up stay hash aggregations with map-side partials; a
series or bucket that holds a large share of the rows is reduced before the shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tideline.functions.buckets import time_bucket
from tideline.functions.scalars import ratio

STATE = ("open", "high", "low", "close", "volume", "pv", "open_at", "close_at")


def _first_last(time: str, tiebreak: str | None) -> Column:
    """Ordering that decides open and close; with a tiebreak equal times are settled by it.

    A struct ordering costs a sort, so it is used only on request.
    """
    return F.col(time) if tiebreak is None else F.struct(time, tiebreak)


def candle_aggregates(
    price: Column, volume: Column, time: str = "time", tiebreak: str | None = None
) -> list[Column]:
    order = _first_last(time, tiebreak)
    columns = {
        "open": F.min_by(price, order),
        "high": F.max(price),
        "low": F.min(price),
        "close": F.max_by(price, order),
        "volume": F.sum(volume),
        "pv": F.sum(price * volume),
        "open_at": F.min(time),
        "close_at": F.max(time),
    }
    return [c.alias(n) for n, c in columns.items()]


def merge_aggregates() -> list[Column]:
    """The same state again from finer states. Child buckets never overlap in time."""
    columns = {
        "open": F.min_by("open", "open_at"),
        "high": F.max("high"),
        "low": F.min("low"),
        "close": F.max_by("close", "close_at"),
        "volume": F.sum("volume"),
        "pv": F.sum("pv"),
        "open_at": F.min("open_at"),
        "close_at": F.max("close_at"),
    }
    return [c.alias(n) for n, c in columns.items()]


def candles(
    ticks: DataFrame,
    width: str,
    series: Sequence[str] = ("symbol",),
    time: str = "time",
    price: str = "price",
    volume: str = "volume",
    tiebreak: str | None = None,
) -> DataFrame:
    """Candle state per bucket and series, from raw ticks."""
    return ticks.groupBy(time_bucket(width, time).alias("bucket"), *series).agg(
        *candle_aggregates(F.col(price), F.col(volume), time, tiebreak)
    )


def rollup_candles(
    state: DataFrame, width: str, series: Sequence[str] = ("symbol",)
) -> DataFrame:
    """Merge candle states into wider buckets; equal to aggregating the raw ticks."""
    return _rollup(state, width, series, merge_aggregates())


def _rollup(
    state: DataFrame, width: str, series: Sequence[str], aggregates: Sequence[Column]
) -> DataFrame:
    return (
        state.withColumn("_parent", time_bucket(width, "bucket"))
        .groupBy(F.col("_parent").alias("bucket"), *series)
        .agg(*aggregates)
    )


def ohlcv(state: DataFrame, series: Sequence[str] = ("symbol",)) -> DataFrame:
    """What a reader sees: prices, volume and vwap (NULL when nothing was traded)."""
    return state.select(
        "bucket",
        *series,
        "open",
        "high",
        "low",
        "close",
        "volume",
        ratio(F.col("pv"), F.col("volume")).alias("vwap"),
    )


def candle_times(
    ticks: DataFrame,
    width: str,
    series: Sequence[str] = ("symbol",),
    time: str = "time",
    price: str = "price",
) -> DataFrame:
    """When each candle opened, peaked, bottomed and closed; the earliest time wins.

    Two hash aggregations: the extremes of each bucket, then the earliest times among the
    rows that reach them. Both and the join between them share one set of keys.
    """
    keys = ["bucket", *series]
    rows = ticks.select(
        time_bucket(width, time).alias("bucket"), *series, F.col(time).alias("_t"), F.col(price).alias("_p")
    )
    ends = rows.groupBy(*keys).agg(
        F.min("_t").alias("open_at"), F.max("_t").alias("close_at"), F.max("_p").alias("_high"), F.min("_p").alias("_low")
    )
    named = ends.select(*(F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)), "open_at", "close_at", "_high", "_low")
    same = reduce(lambda a, b: a & b, (F.col(k).eqNullSafe(F.col(f"_k{i}")) for i, k in enumerate(keys)))
    return (
        rows.join(named, same)
        .groupBy(*keys, "open_at", "close_at")
        .agg(
            F.min(F.when(F.col("_p") == F.col("_high"), F.col("_t"))).alias("high_at"),
            F.min(F.when(F.col("_p") == F.col("_low"), F.col("_t"))).alias("low_at"),
        )
        .select(*keys, "open_at", "high_at", "low_at", "close_at")
    )


RATE_SERIES = ("from", "to")


def rate_candles(rates: DataFrame, width: str, time: str = "timestamp") -> DataFrame:
    """Ask, bid and mid candles of exchange rates in one aggregation, each quote volume 1.

    The three candles share their volume and times. The mid price lies halfway between ask
    and bid of the same quote, so its open, close and sum follow from theirs; only its
    high and low need columns of their own.
    """
    ask, bid = F.col("ask"), F.col("bid")
    mid = (ask + bid) / F.lit(2.0)
    columns = {
        "ask_open": F.min_by(ask, time),
        "ask_high": F.max(ask),
        "ask_low": F.min(ask),
        "ask_close": F.max_by(ask, time),
        "ask_sum": F.sum(ask),
        "bid_open": F.min_by(bid, time),
        "bid_high": F.max(bid),
        "bid_low": F.min(bid),
        "bid_close": F.max_by(bid, time),
        "bid_sum": F.sum(bid),
        "mid_high": F.max(mid),
        "mid_low": F.min(mid),
        "volume": F.count(F.lit(1)),
        "open_at": F.min(time),
        "close_at": F.max(time),
    }
    return rates.groupBy(time_bucket(width, time).alias("bucket"), *RATE_SERIES).agg(
        *(c.alias(n) for n, c in columns.items())
    )


def rollup_rates(state: DataFrame, width: str) -> DataFrame:
    merge = {
        "open": lambda c: F.min_by(c, "open_at"),
        "high": F.max,
        "low": F.min,
        "close": lambda c: F.max_by(c, "close_at"),
        "sum": F.sum,
        "volume": F.sum,
        "open_at": F.min,
        "close_at": F.max,
    }
    names = [c for c in state.columns if c not in ("bucket", *RATE_SERIES)]
    plain_name = {n: n.removeprefix("ask_").removeprefix("bid_").removeprefix("mid_") for n in names}
    return _rollup(state, width, RATE_SERIES, [merge[plain_name[n]](n).alias(n) for n in names])


def rate_ohlcv(state: DataFrame) -> DataFrame:
    def mid(name: str) -> Column:
        return (F.col(f"ask_{name}") + F.col(f"bid_{name}")) / F.lit(2.0)

    columns = state.withColumns({f"mid_{n}": mid(n) for n in ("open", "close", "sum")})
    volume = F.col("volume").cast("double")
    out: list[Column] = []
    for p in ("ask", "bid", "mid"):
        out += [F.col(f"{p}_{n}") for n in ("open", "high", "low", "close")]
        out.append(volume.alias(f"{p}_volume"))
        out.append((F.col(f"{p}_sum") / volume).alias(f"{p}_vwap"))
    return columns.select("bucket", *RATE_SERIES, *out)
