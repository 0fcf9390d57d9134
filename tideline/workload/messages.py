"""Trade messages made of given ticks, as input of the ingest query and of tests."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def as_trade_messages(ticks: DataFrame, exchange: str = "SIM") -> DataFrame:
    """One single-trade JSON message per tick, the inverse of ``sources.trades.parse_trades``."""
    millis = F.floor(
        F.timestamp_diff(
            "MICROSECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), F.col("time")
        )
        / F.lit(1000)
    )
    trade = F.struct(
        F.lit(None).cast("string").alias("c"),
        F.col("price").alias("p"),
        F.concat(F.lit(f"{exchange}:"), "symbol").alias("s"),
        millis.alias("t"),
        F.col("volume").alias("v"),
    )
    return ticks.select(
        F.to_json(F.struct(F.lit("trade").alias("type"), F.array(trade).alias("data"))).alias(
            "value"
        )
    )
