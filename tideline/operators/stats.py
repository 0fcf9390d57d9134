"""Statistical summaries as mergeable state.

One variable: ``n, sx, m2`` (count, sum, sum of squared deviations from the mean).
Two variables (y on x): ``n, sx, sy, cxx, cyy, cxy``. Second moments are kept centred and
merged by the parallel update of Chan, Golub and LeVeque (1979): every child adds its own
moment plus ``n * (child mean - merged mean)^2``. That keeps its precision for values with
a large offset, where a difference of raw sums of squares would not.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tideline.functions.buckets import time_bucket
from tideline.functions.scalars import ratio


def stats(
    samples: DataFrame,
    width: str,
    series: Sequence[str] = ("device_id",),
    time: str = "time",
    value: str = "value",
) -> DataFrame:
    """One-variable state per bucket and series, from raw samples."""
    return samples.groupBy(time_bucket(width, time).alias("bucket"), *series).agg(
        F.count(value).alias("n"),
        F.sum(value).alias("sx"),
        (F.var_pop(value) * F.count(value)).alias("m2"),
    )


def rollup_stats(
    state: DataFrame, width: str, series: Sequence[str] = ("device_id",)
) -> DataFrame:
    """Merge states into wider buckets.

    The merged mean comes from a window over the children of one bucket: their number
    is bounded by the width ratio of the two levels, and window and aggregation share
    one shuffle.
    """
    children = Window.partitionBy("_parent", *series)
    mean = ratio(F.sum("sx").over(children), F.sum("n").over(children))
    return (
        state.withColumn("_parent", time_bucket(width, "bucket"))
        .withColumn("_shift", ratio(F.col("sx"), F.col("n")) - mean)
        .groupBy(F.col("_parent").alias("bucket"), *series)
        .agg(
            F.sum("n").alias("n"),
            F.sum("sx").alias("sx"),
            F.sum(F.col("m2") + F.col("n") * F.col("_shift") * F.col("_shift")).alias("m2"),
        )
    )


def stats_values(state: DataFrame, series: Sequence[str] = ("device_id",)) -> DataFrame:
    """Accessors: count, sum, mean, population and sample variance, standard deviation."""
    n, sx, m2 = F.col("n"), F.col("sx"), F.col("m2")
    return state.select(
        "bucket",
        *series,
        n.alias("num_vals"),
        sx.alias("sum"),
        ratio(sx, n).alias("average"),
        ratio(m2, n).alias("variance_pop"),
        ratio(m2, F.when(n > 1, n - 1)).alias("variance"),
        F.sqrt(ratio(m2, F.when(n > 1, n - 1))).alias("stddev"),
    )


def _elapsed_seconds(time: str, start: str):
    return F.timestamp_diff("MICROSECOND", F.col(start), F.col(time)) / F.lit(1e6)


def stats2(
    ticks: DataFrame,
    width: str,
    series: Sequence[str] = ("symbol",),
    time: str = "time",
    value: str = "price",
) -> DataFrame:
    """Two-variable state: value against seconds since the bucket start."""
    x, y = F.col("_x"), F.col(value)
    return (
        ticks.withColumn("bucket", time_bucket(width, time))
        .withColumn("_x", F.when(y.isNotNull(), _elapsed_seconds(time, "bucket")))
        .groupBy("bucket", *series)
        .agg(
            F.count(y).alias("n"),
            F.sum(x).alias("sx"),
            F.sum(y).alias("sy"),
            (F.var_pop(x) * F.count(y)).alias("cxx"),
            (F.var_pop(y) * F.count(y)).alias("cyy"),
            (F.covar_pop(y, x) * F.count(y)).alias("cxy"),
        )
    )


def rollup_stats2(
    state: DataFrame, width: str, series: Sequence[str] = ("symbol",)
) -> DataFrame:
    """Merge two-variable states; x is re-based to the start of the wider bucket."""
    children = Window.partitionBy("_parent", *series)
    n = F.col("n")
    shifted = state.withColumn("_parent", time_bucket(width, "bucket")).withColumn(
        "sx", F.col("sx") + n * _elapsed_seconds("bucket", "_parent")
    )
    mean_x = ratio(F.sum("sx").over(children), F.sum("n").over(children))
    mean_y = ratio(F.sum("sy").over(children), F.sum("n").over(children))
    dx, dy = F.col("_dx"), F.col("_dy")
    return (
        shifted.withColumns(
            {
                "_dx": ratio(F.col("sx"), n) - mean_x,
                "_dy": ratio(F.col("sy"), n) - mean_y,
            }
        )
        .groupBy(F.col("_parent").alias("bucket"), *series)
        .agg(
            F.sum("n").alias("n"),
            F.sum("sx").alias("sx"),
            F.sum("sy").alias("sy"),
            F.sum(F.col("cxx") + n * dx * dx).alias("cxx"),
            F.sum(F.col("cyy") + n * dy * dy).alias("cyy"),
            F.sum(F.col("cxy") + n * dx * dy).alias("cxy"),
        )
    )


def stats2_values(state: DataFrame, series: Sequence[str] = ("symbol",)) -> DataFrame:
    """Least-squares line and fit of value on elapsed seconds."""
    cxx, cyy, cxy = F.col("cxx"), F.col("cyy"), F.col("cxy")
    slope = F.when(cxx > 0, ratio(cxy, cxx))
    return state.select(
        "bucket",
        *series,
        F.col("n").alias("num_vals"),
        slope.alias("slope"),
        ratio(F.col("sy") - slope * F.col("sx"), F.col("n")).alias("intercept"),
        F.when(cxx > 0, F.when(cyy > 0, ratio(cxy * cxy, cxx * cyy)).otherwise(1.0)).alias("r2"),
    )
