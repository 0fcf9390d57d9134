"""Time buckets as Spark expressions.

Fixed widths use Spark's own tumbling ``window`` expression: integer arithmetic on
microseconds, inside code generation, with no session time zone involved, and the same
expression works on streams. Buckets are aligned to Monday 2000-01-03; calendar
widths (months, years) are aligned to 2000-01-01.
"""

from __future__ import annotations

import re
from datetime import date, datetime, timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F

# Bucket origins and unit lengths in microseconds.
FIXED_ORIGIN = datetime(2000, 1, 3)
MONTH_ORIGIN = date(2000, 1, 1)
UNIT_MICROS = {
    "microsecond": 1,
    "millisecond": 1_000,
    "second": 1_000_000,
    "minute": 60_000_000,
    "hour": 3_600_000_000,
    "day": 86_400_000_000,
    "week": 604_800_000_000,
}
UNIT_MONTHS = {"month": 1, "year": 12}
# Short unit names; a bare "m" is a minute.
UNIT_ALIASES = {
    "us": "microsecond",
    "ms": "millisecond",
    "s": "second",
    "sec": "second",
    "m": "minute",
    "min": "minute",
    "h": "hour",
    "d": "day",
    "w": "week",
    "mon": "month",
    "y": "year",
}
# Length of a month when intervals are compared with each other.
DAYS_PER_MONTH = 30


def _parse(width: str) -> tuple[int, str]:
    match = re.fullmatch(r"\s*(\d+)\s*([a-zA-Z]+)\s*", width)
    if not match:
        raise ValueError(f"cannot read interval {width!r}")
    unit = match.group(2).lower()
    for name in (unit, unit.rstrip("s")):
        name = UNIT_ALIASES.get(name, name)
        if name in UNIT_MICROS or name in UNIT_MONTHS:
            count = int(match.group(1))
            if count <= 0:
                raise ValueError(f"interval must be positive: {width!r}")
            return count, name
    raise ValueError(f"unknown unit in interval {width!r}")


def is_calendar(width: str) -> bool:
    """True when the width is counted in months, whose length varies."""
    return _parse(width)[1] in UNIT_MONTHS


def width_months(width: str) -> int:
    count, unit = _parse(width)
    return count * UNIT_MONTHS[unit]


def width_micros(width: str) -> int:
    count, unit = _parse(width)
    return count * UNIT_MICROS[unit]


def as_timedelta(width: str) -> timedelta:
    """Interval length for comparing intervals; a month counts as 30 days."""
    if is_calendar(width):
        return timedelta(days=DAYS_PER_MONTH * width_months(width))
    return timedelta(microseconds=width_micros(width))


def time_bucket(width: str, time: Column | str) -> Column:
    """Start of the bucket that holds ``time``, as TIMESTAMP_NTZ.

    Spark allows one fixed-width bucket per select list; add further ones in
    further ``withColumn`` steps.
    """
    col = F.col(time) if isinstance(time, str) else time
    if is_calendar(width):
        return _month_bucket(width_months(width), col)
    micros = width_micros(width)
    origin = int((FIXED_ORIGIN - datetime(1970, 1, 1)) / timedelta(microseconds=1))
    length = f"{micros} microseconds"
    return F.window(col, length, length, f"{origin % micros} microseconds")["start"]


def _month_bucket(months: int, col: Column) -> Column:
    day = F.to_date(col)
    if months == 1:
        return F.trunc(day, "month").cast("timestamp_ntz")
    since = (F.year(day) - MONTH_ORIGIN.year) * 12 + F.month(day) - MONTH_ORIGIN.month
    start = since - F.pmod(since, F.lit(months))
    return F.add_months(F.lit(MONTH_ORIGIN), start).cast("timestamp_ntz")


def interval(width: str) -> Column:
    """The width as a Spark interval, for adding to a timestamp."""
    if is_calendar(width):
        return F.make_ym_interval(F.lit(0), F.lit(width_months(width)))
    whole, rest = divmod(width_micros(width), 1_000_000)
    return F.expr(f"INTERVAL '{whole}.{rest:06d}' SECOND")


def bucket_end(width: str, bucket: Column | str) -> Column:
    col = F.col(bucket) if isinstance(bucket, str) else bucket
    return col + interval(width)


def shift(moment: datetime, width: str, sign: int = 1) -> datetime:
    """``moment`` plus or minus an interval, calendar months clipped to month end."""
    if not is_calendar(width):
        return moment + sign * timedelta(microseconds=width_micros(width))
    index = moment.year * 12 + moment.month - 1 + sign * width_months(width)
    year, month = divmod(index, 12)
    first = datetime(year, month + 1, 1)
    following = datetime(year + (month == 11), (month + 1) % 12 + 1, 1)
    last_day = (following - first).days
    return moment.replace(year=year, month=month + 1, day=min(moment.day, last_day))


def floor_time(moment: datetime, width: str) -> datetime:
    """The bucket start of one literal time, with the same alignment as time_bucket."""
    if is_calendar(width):
        months = width_months(width)
        index = (moment.year - MONTH_ORIGIN.year) * 12 + moment.month - MONTH_ORIGIN.month
        index -= index % months
        return datetime(MONTH_ORIGIN.year + index // 12, index % 12 + 1, 1)
    step = timedelta(microseconds=width_micros(width))
    return FIXED_ORIGIN + ((moment - FIXED_ORIGIN) // step) * step


def ceil_time(moment: datetime, width: str) -> datetime:
    start = floor_time(moment, width)
    return start if start == moment else shift(start, width)
