"""Trade messages (JSON text) to ticks; the same function serves batch and stream."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TRADE_SCHEMA = (
    "type STRING, data ARRAY<STRUCT<c: STRING, p: DOUBLE, s: STRING, t: BIGINT, v: DOUBLE>>"
)


def parse_trades(messages: DataFrame, text: str = "value") -> DataFrame:
    """Ticks of all trade messages; other messages are skipped.

    Times are cut to whole seconds; ``EXCHANGE:SYMBOL`` gives SYMBOL.
    """
    parsed = messages.select(F.from_json(F.col(text), TRADE_SCHEMA).alias("m"))
    trades = parsed.filter(F.col("m.type") == "trade").select(F.explode("m.data").alias("d"))
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    seconds = F.floor(F.col("d.t") / F.lit(1000))
    return trades.select(
        (epoch + seconds * F.expr("INTERVAL '1' SECOND")).alias("time"),
        F.split_part(F.col("d.s"), F.lit(":"), F.lit(2)).alias("symbol"),
        F.col("d.p").alias("price"),
        F.col("d.v").alias("volume"),
    )
