"""Downsampling for charts: largest-triangle-three-buckets and ASAP smoothing.

Positions, bucket means and group averages are computed by Spark; the two steps that
depend on the previous choice run per series on Arrow tables of few rows.
"""

from __future__ import annotations

import sys
from collections.abc import Sequence
from math import comb

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tideline.operators.ordered import MAX_ROWS, OrderedScan, row_index
from tideline.session import stored

# Functions of this module travel to the executors with the job, which then need only
# numpy and pyarrow, not this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# A series of at most this many rows is handled by one task as it is.
SERIES_ROWS = 200_000
# Rows per cell of the first hull reduction, and cells merged per later one.
CELL_ROWS = 50_000
CELL_FAN = 500
# Rows of one task in the stages that run in Python.
TASK_ROWS = 1_000_000


def _positions(
    df: DataFrame,
    series: Sequence[str],
    time: str,
    value: str,
    tiebreak: str | None,
    max_rows: int,
) -> tuple[DataFrame, DataFrame]:
    """Rows with a value plus ``_pos`` (rank within the series) and series totals.

    Also the totals themselves: rows (``count``) and first time per series.
    """
    rows = df.filter(F.col(value).isNotNull()).select(
        *series, F.col(time).alias("time"), F.col(value).cast("double").alias("value"),
        *([] if tiebreak is None else [F.col(tiebreak).alias("_tie")]),
    )
    order = ["time", "value" if tiebreak is None else "_tie"]
    sizes = stored(
        rows.groupBy(*series).agg(F.count("*").alias("count"), F.min("time").alias("_t0")),
        "series-sizes",
    )
    scan = OrderedScan.of(rows, series, order, max_rows, sizes).running({"_pos": row_index()})
    totals = sizes.withColumnRenamed("count", "_n")
    return scan.frame().join(totals, list(series)), sizes


def _python_partitions(df: DataFrame, total_rows: int) -> int:
    """Partitions for a Python stage: at least one per core, at most TASK_ROWS rows each.

    Adaptive execution merges small partitions by bytes, which would leave work that is
    heavy per row to a few tasks; a fixed number is left alone.
    """
    return max(df.sparkSession.sparkContext.defaultParallelism, -(-total_rows // TASK_ROWS))


def hull(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Indexes of the corners of the convex hull of points sorted by x (quickhull)."""
    if len(x) <= 3:
        return np.arange(len(x))
    # Points sharing an x can only matter as the lowest or highest of them.
    order = np.lexsort((y, x))
    keep = {int(order[0]), int(order[-1])}
    same_left = order[x[order] == x[order[0]]]
    same_right = order[x[order] == x[order[-1]]]
    keep.update((int(same_left[-1]), int(same_right[0])))
    for sign in (1.0, -1.0):
        stack = [(order[0], order[-1], order)]
        while stack:
            a, b, idx = stack.pop()
            height = sign * ((x[b] - x[a]) * (y[idx] - y[a]) - (x[idx] - x[a]) * (y[b] - y[a]))
            outside = height > 0
            if not outside.any():
                continue
            idx, height = idx[outside], height[outside]
            top = idx[int(np.argmax(height))]
            keep.add(int(top))
            stack.append((a, top, idx[x[idx] <= x[top]]))
            stack.append((top, b, idx[x[idx] >= x[top]]))
    return np.array(sorted(keep))


def _column(table: pa.Table, name: str) -> np.ndarray:
    return table.column(name).to_numpy()


def _hull_rows(table: pa.Table) -> pa.Table:
    order = np.argsort(_column(table, "_pos"), kind="stable")
    corners = hull(_column(table, "_x")[order], _column(table, "value")[order])
    return table.take(pa.array(order[corners]))


def _reduce_to_hulls(points: DataFrame, keys: Sequence[str], largest_bucket: int) -> DataFrame:
    """Keep only the hull corners of every bucket, in bounded groups, round by round.

    The triangle area is the absolute value of a function linear in the candidate point,
    so its maximum over a bucket lies on a corner of the bucket's convex hull: dropping
    all other points changes no result. A hull of hulls is the hull of the whole.
    """
    cells = -(-largest_bucket // CELL_ROWS) + 1
    cell: Column = F.floor(F.col("_pos") / CELL_ROWS)
    while True:
        grouped = points.withColumn("_cell", cell if cells > 1 else F.lit(0).cast("long"))
        points = (
            grouped.groupBy(*keys, "_bucket", "_cell")
            .applyInArrow(_hull_rows, grouped.schema)
            .drop("_cell")
        )
        if cells == 1:
            return points
        cells = -(-cells // CELL_FAN)
        cell = F.floor(cell / CELL_FAN)


def _pick_points(table: pa.Table) -> pa.Table:
    """One point per bucket: the largest triangle with the point chosen before."""
    order = np.argsort(_column(table, "_pos"), kind="stable")
    bucket = _column(table, "_bucket")[order]
    x, y = _column(table, "_x")[order], _column(table, "value")[order]
    next_x, next_y = _column(table, "_next_x")[order], _column(table, "_next_y")[order]
    starts = np.flatnonzero(np.r_[True, np.diff(bucket) != 0])
    ends = np.r_[starts[1:], len(order)]
    chosen = [0]
    for lo, hi in zip(starts[1:-1], ends[1:-1]):
        ax, ay = x[chosen[-1]], y[chosen[-1]]
        cx, cy = next_x[lo], next_y[lo]
        area = np.abs((ax - cx) * (y[lo:hi] - ay) - (ax - x[lo:hi]) * (cy - ay))
        chosen.append(lo + int(np.argmax(area)))
    chosen.append(len(order) - 1)
    return table.take(pa.array(order[chosen]))


def lttb(
    df: DataFrame,
    series: Sequence[str],
    points: int,
    time: str = "time",
    value: str = "value",
    tiebreak: str | None = None,
    max_rows: int = MAX_ROWS,
    series_rows: int = SERIES_ROWS,
) -> DataFrame:
    """At most ``points`` rows per series that keep its visual shape (Steinarsson 2013).

    First and last row stay; the rest is cut into ``points - 2`` buckets of equal count.
    """
    if points < 3:
        raise ValueError("points must be at least 3")
    inner = points - 2
    rows, sizes = _positions(df, series, time, value, tiebreak, max_rows)
    n, pos = F.col("_n"), F.col("_pos")
    bucket = (
        F.when(n <= points, pos)
        .when(pos == 0, F.lit(0))
        .when(pos == n - 1, F.lit(points - 1))
        .otherwise(F.floor((pos * inner - 1) / (n - 2)) + 1)
        .cast("long")
    )
    # Stored: ranks are needed for the means and again for the candidates.
    ranked = stored(
        rows.select(
            *series,
            "time",
            "value",
            "_n",
            "_pos",
            bucket.alias("_bucket"),
            F.timestamp_diff("MICROSECOND", "_t0", "time").cast("double").alias("_x"),
        ),
        "ranked",
    )
    whole, placed = ranked.filter(n <= points), ranked.filter(n > points)
    means = placed.groupBy(*series, (F.col("_bucket") - 1).alias("_bucket")).agg(
        F.avg("_x").alias("_next_x"), F.avg("value").alias("_next_y")
    )
    columns = (*series, "time", "value", "_pos", "_bucket", "_x")
    small = placed.filter(n <= series_rows).select(*columns)
    found = sizes.agg(F.max("count").alias("largest"), F.sum("count").alias("rows")).first()
    largest = found["largest"] or 0
    candidates = small
    if largest > series_rows:
        large = placed.filter(n > series_rows).select(*columns)
        candidates = small.unionByName(
            _reduce_to_hulls(large, series, -(-largest // inner))
        )
    out = T.StructType(
        [f for f in placed.schema.fields if f.name in (*series, "time", "value")]
    )
    names = out.fieldNames()
    picked = (
        candidates.join(means, [*series, "_bucket"], "left")
        .repartition(_python_partitions(df, found["rows"] or 0), *series)
        .groupBy(*series)
        .applyInArrow(lambda table: _pick_points(table).select(names), out)
    )
    return picked.unionByName(whole.select(*names))


def _kurtosis(v: np.ndarray) -> float:
    d = v - v.mean()
    m2 = (d * d).mean()
    return (d**4).mean() / (m2 * m2) if m2 > 0 else np.nan


def quality(values: np.ndarray, width: int) -> tuple[float, float]:
    """Roughness and kurtosis of a series averaged over ``width`` points."""
    smooth = moving_average(values, width)
    return np.diff(smooth).std(), _kurtosis(smooth)


def _lagged_sums(left: np.ndarray, right: np.ndarray, longest: int) -> np.ndarray:
    """Sums over i of left[i + w] * right[i] for every w up to ``longest``, by one FFT."""
    size = 1 << (2 * len(left) - 1).bit_length()
    return np.fft.irfft(np.fft.rfft(left, size) * np.conj(np.fft.rfft(right, size)), size)[: longest + 1]


def _difference_moments(s: np.ndarray, most: int, longest: int) -> list[np.ndarray]:
    """Means over i of (s[i + w] - s[i]) ** k for k = 1..most and w = 0..longest.

    The binomial expansion leaves sums of products at a lag (autocorrelations of powers).
    """
    w = np.arange(longest + 1)
    powers = [s**k for k in range(most + 1)]
    sums = [np.r_[0.0, np.cumsum(p)] for p in powers]
    out = []
    for k in range(1, most + 1):
        total = sums[k][-1] - sums[k][w] + (-1) ** k * sums[k][len(s) - w]
        for j in range(1, k):
            total = total + (-1) ** j * comb(k, j) * _lagged_sums(powers[k - j], powers[j], longest)
        out.append(total / (len(s) - w))
    return out


# Rounding of the sums by FFT, as a multiple of the float's epsilon and of all that is summed.
FFT_NOISE = 256 * np.finfo(float).eps


def _screened(values: np.ndarray, longest: int) -> tuple[np.ndarray, np.ndarray]:
    """Least roughness and greatest kurtosis that each window up to ``longest`` can have.

    A step of the averaged series is (v[i + w] - v[i]) / w, so the autocorrelation of the
    series gives the roughness of all windows at once. An average is a difference of running sums,
    so its moments come from autocorrelations of powers of these in the same way.
    """
    centred = values - values.mean()
    centred = centred / centred.std()
    w = np.arange(longest + 1)
    share = np.maximum(w, 1)
    mean, square = _difference_moments(centred, 2, longest)
    noise = FFT_NOISE * (centred**2).sum() / (len(centred) - w)
    rough = np.sqrt(np.maximum(square - mean**2 - noise, 0.0)) / share * values.std()

    running = np.r_[0.0, np.cumsum(centred)]
    running -= running.mean()
    m1, m2, m3, m4 = _difference_moments(running, 4, longest)
    count = len(running) - w
    second = m2 - m1**2 - FFT_NOISE * (running**2).sum() / count
    fourth = m4 - 4 * m3 * m1 + 6 * m2 * m1**2 - 3 * m1**4 + FFT_NOISE * (running**4).sum() / count
    with np.errstate(divide="ignore", invalid="ignore"):
        peaked = np.where(second > 0, fourth / second**2, np.inf)
    return rough, peaked


def smoothing_window(values: np.ndarray, longest: float = 0.1) -> int:
    """Moving-average length that is smoothest while keeping the outliers (Rong & Bailis 2017).

    Smoothest: least standard deviation of first differences. Outliers are kept while
    the kurtosis is not below that of the input. Lengths up to the share ``longest`` of the
    series count; the shortest wins a tie.

    Bounds of both figures come for all lengths at once from autocorrelations. Lengths that may
    keep the outliers are then measured from the smoothest on, until none left can be as smooth
    as one found: the result is that of trying all, mostly after one or two.
    """
    most = max(1, int(len(values) * longest))
    base = _kurtosis(values)
    if most < 2 or not base > 0:
        return 1
    rough, peaked = _screened(values, most)
    # A little below the base, as equal figures may differ in their last bits.
    able = 2 + np.flatnonzero(peaked[2:] >= base * (1 - 1e-9))
    best = (np.diff(values).std(), 1)
    for w in able[np.argsort(rough[able], kind="stable")].tolist():
        if rough[w] > best[0]:
            break
        roughness, kurtosis = quality(values, w)
        if kurtosis >= base:
            best = min(best, (roughness, w))
    return best[1]


def moving_average(values: np.ndarray, width: int) -> np.ndarray:
    """Means of ``width`` neighbours, as differences of running sums about the mean."""
    if width == 1:
        return values
    mean = values.mean()
    running = np.r_[0.0, np.cumsum(values - mean)]
    return mean + (running[width:] - running[:-width]) / width


def asap_smooth(
    df: DataFrame,
    series: Sequence[str],
    resolution: int,
    time: str = "time",
    value: str = "value",
    tiebreak: str | None = None,
    max_rows: int = MAX_ROWS,
    longest: float = 0.1,
) -> DataFrame:
    """About ``resolution`` smoothed points per series.

    Windows up to the share ``longest`` of a series' points count, all of them.

    Spark averages runs of ``ceil(rows / resolution)`` rows, so a task receives at most
    ``resolution`` rows of a series; a point carries the first time of its run.
    """
    rows, sizes = _positions(df, series, time, value, tiebreak, max_rows)
    run = F.ceil(F.col("_n") / F.lit(resolution))
    runs = rows.groupBy(*series, F.floor(F.col("_pos") / run).alias("_run")).agg(
        F.min("time").alias("time"), F.avg("value").alias("value")
    )
    out = T.StructType([f for f in runs.schema.fields if f.name != "_run"])
    names = out.fieldNames()

    def smooth(table: pa.Table) -> pa.Table:
        order = np.argsort(_column(table, "_run"), kind="stable")
        values = _column(table, "value")[order]
        averages = moving_average(values, smoothing_window(values, longest))
        points = table.take(pa.array(order[: len(averages)]))
        at = points.schema.get_field_index("value")
        return points.set_column(at, "value", pa.array(averages)).select(names)

    count = F.least(F.col("count"), F.lit(resolution))
    total = sizes.agg(F.sum(count).alias("rows")).first()["rows"] or 0
    return (
        runs.repartition(_python_partitions(df, total), *series)
        .groupBy(*series)
        .applyInArrow(smooth, out)
    )
