"""Row selection: time ranges, newest rows, symbol patterns, counts and extents."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tideline.functions.buckets import floor_time, shift, time_bucket


def _moment(value: datetime):
    return F.lit(value).cast("timestamp_ntz")


def recent(df: DataFrame, as_of: datetime, width: str, time: str = "time") -> DataFrame:
    """Rows newer than ``as_of - width``. The literal bound is pushed into the scan."""
    return df.filter(F.col(time) > _moment(shift(as_of, width, -1)))


def older(df: DataFrame, as_of: datetime, width: str, time: str = "time") -> DataFrame:
    """Rows older than ``as_of - width``."""
    return df.filter(F.col(time) < _moment(shift(as_of, width, -1)))


def between(df: DataFrame, start: datetime, end: datetime, time: str = "time") -> DataFrame:
    """Rows from start to end, both included."""
    return df.filter(F.col(time).between(_moment(start), _moment(end)))


def retained(
    df: DataFrame, as_of: datetime, keep: str, chunk_interval: str, time: str = "time"
) -> DataFrame:
    """What a retention run leaves: whole chunks go once they end at or before the cutoff."""
    first_kept = floor_time(shift(as_of, keep, -1), chunk_interval)
    return df.filter(F.col(time) >= _moment(first_kept))


def matching_symbols(df: DataFrame, pattern: str, symbol: str = "symbol") -> DataFrame:
    """Rows whose symbol matches a regular expression, unanchored unless written so."""
    return df.filter(F.col(symbol).rlike(pattern))


def newest(
    df: DataFrame,
    n: int,
    time: str = "time",
    tiebreak: Sequence[str] = (),
) -> DataFrame:
    """The n newest rows: a top-k per task and a merge, not a full sort."""
    return df.orderBy(F.col(time).desc(), *(F.col(c).desc() for c in tiebreak)).limit(n)


def latest_for_symbol(
    ticks: DataFrame, symbol: str, tiebreak: Sequence[str] = ()
) -> DataFrame:
    return newest(ticks.filter(F.col("symbol") == symbol), 1, tiebreak=tiebreak)


def raised_after(
    df: DataFrame, start: datetime, amount: float, time: str = "time", value: str = "price"
) -> DataFrame:
    """The table as an update would leave it: ``value + amount`` after ``start``."""
    return df.withColumn(
        value,
        F.when(F.col(time) > _moment(start), F.col(value) + F.lit(amount)).otherwise(F.col(value)),
    )


def summary(
    df: DataFrame, series: Sequence[str], value: str, time: str = "time"
) -> DataFrame:
    """Plain aggregates per series: counts, sum, extremes and time extent."""
    return df.groupBy(*series).agg(
        F.count("*").alias("row_count"),
        F.count(value).alias("value_count"),
        F.sum(value).alias("value_sum"),
        F.min(value).alias("value_min"),
        F.max(value).alias("value_max"),
        F.min(time).alias("first_at"),
        F.max(time).alias("last_at"),
    )


def bucket_counts(df: DataFrame, width: str = "1 hour", time: str = "time") -> DataFrame:
    return df.groupBy(time_bucket(width, time).alias("bucket")).agg(
        F.count("*").alias("total_hourly")
    )
