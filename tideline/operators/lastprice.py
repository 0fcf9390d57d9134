"""Latest value per series, and the table of known symbols."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def initial_last_prices(ticks: DataFrame) -> DataFrame:
    """Per symbol the highest price at its newest time, and that time.

    Two hash aggregations with map-side partials: the newest time per symbol, which is a
    small table to join back with, then the highest price among its ticks. No symbol's
    history is ever ranked or gathered in one place.
    """
    newest = ticks.groupBy(F.col("symbol").alias("_symbol")).agg(F.max("time").alias("last_price_at"))
    return (
        ticks.select("symbol", "time", "price")
        .join(newest, F.col("symbol").eqNullSafe(F.col("_symbol")) & F.col("time").eqNullSafe(F.col("last_price_at")))
        .groupBy("symbol", "last_price_at")
        .agg(F.max("price").alias("last_price"))
        .select("symbol", "last_price", "last_price_at")
    )


def last_values(
    df: DataFrame, series: Sequence[str], value: str, time: str = "time"
) -> DataFrame:
    """Value at the newest time of each series."""
    return df.groupBy(*series).agg(
        F.max_by(value, time).alias("last_value"), F.max(time).alias("last_at")
    )


def merge_last_prices(
    known: DataFrame, ticks: DataFrame, seeded_only: bool = True, tiebreak: str | None = None
) -> DataFrame:
    """Symbol table after new ticks: the newest time wins.

    With ``seeded_only`` ticks of symbols that are not in the table change nothing. Of new ticks
    of one time the greatest ``tiebreak`` wins, or any of them without.
    """
    place = F.col("time") if tiebreak is None else F.struct("time", tiebreak)
    news = ticks.groupBy("symbol").agg(
        F.max_by("price", place).alias("_price"), F.max("time").alias("_time")
    )
    newer = F.col("_time").isNotNull() & (
        F.col("last_price_at").isNull() | (F.col("_time") >= F.col("last_price_at"))
    )
    return known.join(news, "symbol", "left" if seeded_only else "full").select(
        "symbol",
        F.when(newer, F.col("_price")).otherwise(F.col("last_price")).alias("last_price"),
        F.when(newer, F.col("_time")).otherwise(F.col("last_price_at")).alias("last_price_at"),
    )


def insert_if_absent(existing: DataFrame, candidates: DataFrame, key: Sequence[str]) -> DataFrame:
    """Existing rows plus those candidates whose key is not there yet."""
    fresh = candidates.dropDuplicates(list(key)).join(existing.select(*key), list(key), "left_anti")
    return existing.unionByName(fresh)


def symbol_names(ticks: DataFrame) -> DataFrame:
    return ticks.select("symbol").distinct()
