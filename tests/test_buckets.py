from datetime import datetime, timedelta

import duckdb
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tideline.functions.buckets import (
    as_timedelta,
    bucket_end,
    ceil_time,
    floor_time,
    shift,
    time_bucket,
)

WIDTHS = ["100 ms", "30 seconds", "1m", "1 hour", "6h", "1 day", "2 days", "1 week", "1 month",
          "3 months", "1 year"]
TIMES = [
    datetime(1969, 12, 31, 23, 59, 59, 999999),
    datetime(1970, 1, 1),
    datetime(1999, 12, 31, 12),
    datetime(2000, 1, 2, 23, 59, 59),
    datetime(2000, 1, 3),
    datetime(2024, 2, 29, 13, 14, 15, 161718),
]


@pytest.mark.parametrize("width", WIDTHS)
def test_bucket_agrees_with_literal_floor_and_oracle(spark, width):
    df = spark.createDataFrame([(t,) for t in TIMES], "time timestamp_ntz")
    rows = df.withColumn("b", time_bucket(width, "time")).collect()
    sql_width = {"1m": "1 minute", "6h": "6 hours", "100 ms": "100 milliseconds"}.get(width, width)
    for r in rows:
        expected = duckdb.execute(
            f"SELECT time_bucket(INTERVAL '{sql_width}', ?::TIMESTAMP)", [r["time"]]
        ).fetchone()[0]
        assert r["b"] == expected == floor_time(r["time"], width)


def test_bucket_end_and_months(spark):
    df = spark.createDataFrame([(datetime(2024, 1, 31),)], "time timestamp_ntz")
    r = df.select(
        bucket_end("1 hour", "time").alias("h"), bucket_end("1 month", "time").alias("m")
    ).first()
    assert r["h"] == datetime(2024, 1, 31, 1)
    assert r["m"] == datetime(2024, 2, 29)
    assert shift(datetime(2024, 1, 31), "1 month") == datetime(2024, 2, 29)
    assert shift(datetime(2024, 8, 31), "6 months", -1) == datetime(2024, 2, 29)
    assert as_timedelta("6 months") == timedelta(days=180)


@settings(max_examples=50, deadline=None)
@given(st.datetimes(datetime(1950, 1, 1), datetime(2100, 1, 1)), st.sampled_from(WIDTHS))
def test_floor_and_ceil(moment, width):
    low, high = floor_time(moment, width), ceil_time(moment, width)
    assert low <= moment <= high
    assert floor_time(low, width) == low and ceil_time(low, width) == low
    assert high in (low, shift(low, width))


@pytest.mark.parametrize("bad", ["", "1 parsec", "-1 day", "0 hours"])
def test_bad_widths(bad):
    with pytest.raises(ValueError):
        as_timedelta(bad)
