"""Candles kept current while ticks arrive."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tideline.operators.candles import STATE, candle_aggregates, merge_aggregates

# How late a tick may be, as in the refresh policy of the minute level.
LATENESS = "3 minutes"


def _windowed(ticks: DataFrame, width: str, lateness: str) -> DataFrame:
    """Candles per event-time window. Watermarks exist for TIMESTAMP only, hence the cast."""
    return (
        ticks.withColumn("event_time", F.col("time").cast("timestamp"))
        .withWatermark("event_time", lateness)
        .groupBy(F.window("event_time", width).alias("window"), "symbol")
        .agg(*candle_aggregates(F.col("price"), F.col("volume")))
    )


def stream_candles(
    ticks: DataFrame, width: str = "1 minute", lateness: str = LATENESS
) -> DataFrame:
    """Candle state of a tick stream. In append mode a bucket appears once it is closed."""
    return _windowed(ticks, width, lateness).select(
        F.col("window.start").cast("timestamp_ntz").alias("bucket"), "symbol", *STATE
    )


def stream_candle_rollup(
    ticks: DataFrame,
    fine: str = "1 minute",
    coarse: str = "1 hour",
    lateness: str = LATENESS,
) -> DataFrame:
    """Coarse candles merged from fine ones within one stream."""
    return (
        _windowed(ticks, fine, lateness)
        .groupBy(F.window(F.window_time("window"), coarse).alias("wide"), "symbol")
        .agg(*merge_aggregates())
        .select(F.col("wide.start").cast("timestamp_ntz").alias("bucket"), "symbol", *STATE)
    )
