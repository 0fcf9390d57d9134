"""Small column expressions shared by the operators."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


# What counts as a tie when rounding, in units of the last digit.
ROUND_GUARD = 1e-6


def ratio(numerator: Column, denominator: Column) -> Column:
    """Division that gives NULL instead of an error when the divisor is zero."""
    return F.try_divide(numerator, denominator)


def add_nullable(left: Column, right: Column) -> Column:
    """Sum of two partial sums, where NULL means "nothing summed yet"."""
    return F.coalesce(left + right, left, right)


def pair_leg(pair: Column | str, leg: int) -> Column:
    """First or second symbol of an ``A/B`` pair."""
    return F.split_part(F.col(pair) if isinstance(pair, str) else pair, F.lit("/"), F.lit(leg))


def numeric_value(f64: str, i64: str, flag: str) -> Column:
    """One double out of three typed columns: double, then integer, then boolean as 0/1."""
    return F.coalesce(
        F.col(f64), F.col(i64).cast("double"), F.col(flag).cast("int").cast("double")
    )


def round_half_up(value: Column, digits: int, guard: float = ROUND_GUARD) -> Column:
    """Decimal rounding, half away from zero, of a value held as a double.

    ``guard`` (in units of the last digit) lifts values that sit below a tie only by
    binary error, such as 0.353125. Plain arithmetic, much cheaper than a decimal cast.
    A value so large that a double holds no such digit is returned as it is.
    """
    unit = F.lit(10.0**digits)
    near = F.signum(value) * F.floor(F.abs(value) * unit + F.lit(0.5 + guard)) / unit
    return F.when(F.abs(value) * unit < F.lit(2.0**52), near).otherwise(value)


def latest_time(df: DataFrame, time_col: str = "time") -> datetime | None:
    """Newest time of a table (one row on the driver).

    Used as ``as_of``: a literal bound reaches the scan as a pushed filter and prunes
    chunks, and results stay repeatable, unlike a clock reading.
    """
    return df.agg(F.max(time_col).alias("t")).first()["t"]
