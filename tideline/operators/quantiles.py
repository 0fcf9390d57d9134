"""Percentiles: mergeable counts per value bin, KLL sketches, and an exact form."""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tideline.functions.buckets import time_bucket
from tideline.operators.ordered import MAX_ROWS, OrderedScan, running_sum
from tideline.session import stored

SKETCH_K = 400
# A percentile out of bins is off by at most this share of the true value.
BIN_ERROR = 0.01
# Bins a side that a bounded state may have.
BIN_BUDGET = 200
# Levels of bounded bins; enough for bins of an error of 0.0001 over all doubles.
LEVELS = 24


def bin_growth(error: float = BIN_ERROR) -> float:
    """Ratio of the bounds of a bin."""
    return (1 + error) / (1 - error)


def value_bins(
    df: DataFrame,
    width: str,
    value: str = "value",
    series: Sequence[str] = (),
    time: str = "time",
    error: float = BIN_ERROR,
) -> DataFrame:
    """Counts per bucket and logarithmic value bin; deterministic, and merged by adding up.

    Bin i of side 1 holds values above growth^(i-1) and up to growth^i, side -1 their
    negatives, side 0 zeros. NULL and NaN are left out. Doubles span at most a few ten
    thousand bins a side, so a bucket's state is bounded whatever its rows.
    """
    v = F.col(value)
    number = F.ceil(F.ln(F.abs(v)) / F.lit(math.log(bin_growth(error)))).cast("long")
    return (
        df.filter(v.isNotNull() & ~F.isnan(v))
        .groupBy(
            time_bucket(width, time).alias("bucket"),
            *series,
            F.signum(v).cast("int").alias("side"),
            F.when(v == 0, F.lit(0).cast("long")).otherwise(number).alias("bin"),
        )
        .agg(F.count("*").alias("n"))
    )


def rollup_bins(bins: DataFrame, width: str, series: Sequence[str] = ()) -> DataFrame:
    parent = time_bucket(width, "bucket")
    return bins.groupBy(parent.alias("bucket"), *series, "side", "bin").agg(F.sum("n").alias("n"))


def bin_percentiles(
    bins: DataFrame,
    percentiles: dict[str, float],
    series: Sequence[str] = (),
    error: float = BIN_ERROR,
) -> DataFrame:
    """Percentiles out of stored bins, one named column each: the middle of the bin of the rank.

    The rank of a percentile p among n values is floor(p (n - 1)), counted from zero. Bins
    with levels give the share that a percentile may be off by as the column ``error``.
    """
    growth = F.lit(bin_growth(error))
    leveled = "level" in bins.columns
    if leveled:
        growth = F.pow(growth, F.pow(F.lit(2.0), F.col("level")))
    keys = ["bucket", *series]
    ordered = Window.partitionBy(*keys).orderBy("side", F.col("side") * F.col("bin"))
    counted = bins.withColumns(
        {"_upto": F.sum("n").over(ordered), "_n": F.sum("n").over(Window.partitionBy(*keys))}
    )
    middle = F.col("side") * (F.lit(2.0) / (growth + 1)) * F.pow(growth, F.col("bin"))

    def at(p: float) -> Column:
        rank = F.floor(F.lit(float(p)) * (F.col("_n") - 1))
        inside = (F.col("_upto") - F.col("n") <= rank) & (rank < F.col("_upto"))
        return F.max(F.when(inside, middle))

    off = [F.max((growth - 1) / (growth + 1)).alias("error")] if leveled else []
    return counted.groupBy(*keys).agg(*(at(p).alias(name) for name, p in percentiles.items()), *off)


def bounded_bins(bins: DataFrame, series: Sequence[str] = (), most: int = BIN_BUDGET) -> DataFrame:
    """Bins of which no bucket has more than ``most`` a side; merges bins bounded before.

    At level k every bin is 2^k of the first ones, so growth is squared k times. A bucket
    takes the lowest level, the same for both sides, that holds the budget. As the number
    of bins only falls with the level, no part of a bucket is above the level of the whole:
    states merged in any order and grouping are those of all values at once. ``bins`` are
    those of ``value_bins`` (level 0) or of this function, for the same buckets; brought to
    one level they are written once, and the result reads them twice.
    """
    if most < 2:
        raise ValueError("a side needs two bins at least")
    keys = ["bucket", *series]
    def raised(rows: DataFrame, to: DataFrame) -> DataFrame:
        """Rows at their bucket's level ``_to``."""
        named = to.select(*(F.col(k).alias(f"_{k}") for k in keys), "_to")
        same = reduce(lambda a, b: a & b, (F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys))
        up = F.expr("-shiftright(-bin, _to - level)")
        return rows.join(named, same).groupBy(*keys, "side", up.alias("bin"), F.col("_to").alias("level")).agg(F.sum("n").alias("n"))

    if "level" in bins.columns:
        level = raised(bins, bins.groupBy(*keys).agg(F.max("level").alias("_to")))
    else:
        level = bins.select(*keys, "side", "bin", F.lit(0).alias("level"), "n")
    level = stored(level, "leveled-bins")
    # Two neighbours share a bin from the level on that is the bit length of how they differ.
    shifted = F.col("bin") - 1 + (1 << LEVELS)
    before = F.lag(shifted).over(Window.partitionBy(*keys, "side").orderBy("bin"))
    apart = F.coalesce(F.length(F.bin(shifted.bitwiseXOR(before))), F.lit(LEVELS + 1))
    of_side = level.withColumn("_apart", apart).groupBy(*keys, "side", "level").agg(
        F.array(*(F.count_if(F.col("_apart") > k) for k in range(LEVELS + 1))).alias("_counts")
    )
    steps = F.array_position(F.transform("_counts", lambda c: c <= most), True) - 1
    return raised(level, of_side.groupBy(*keys).agg(F.max(F.col("level") + steps).cast("int").alias("_to")))


def rollup_bounded(bins: DataFrame, width: str, series: Sequence[str] = (), most: int = BIN_BUDGET) -> DataFrame:
    """Bounded bins of wider buckets out of those of narrower ones."""
    return bounded_bins(bins.withColumn("bucket", time_bucket(width, "bucket")), series, most)


def percentile_sketches(
    df: DataFrame,
    width: str,
    value: str = "value",
    series: Sequence[str] = (),
    time: str = "time",
    k: int = SKETCH_K,
) -> DataFrame:
    """One sketch (binary, bounded size) per bucket; can be stored and merged later."""
    return df.groupBy(time_bucket(width, time).alias("bucket"), *series).agg(
        F.expr(f"kll_sketch_agg_double(`{value}`, {int(k)})").alias("sketch"),
        F.count(value).alias("n"),
    )


def rollup_sketches(
    sketches: DataFrame, width: str, series: Sequence[str] = (), k: int = SKETCH_K
) -> DataFrame:
    return (
        sketches.withColumn("_parent", time_bucket(width, "bucket"))
        .groupBy(F.col("_parent").alias("bucket"), *series)
        .agg(
            F.expr(f"kll_merge_agg_double(sketch, {int(k)})").alias("sketch"),
            F.sum("n").alias("n"),
        )
    )


def sketch_percentiles(
    sketches: DataFrame, percentiles: dict[str, float], series: Sequence[str] = ()
) -> DataFrame:
    """Approximate percentiles out of stored sketches, one named column each."""
    return sketches.select(
        "bucket",
        *series,
        *(
            F.expr(f"kll_sketch_get_quantile_double(sketch, {float(p)}D)").alias(name)
            for name, p in percentiles.items()
        ),
    )


def exact_percentiles(
    df: DataFrame,
    by: Sequence[str],
    value: str,
    percentiles: dict[str, float],
    max_rows: int = MAX_ROWS,
) -> DataFrame:
    """Exact interpolated percentiles per group.

    Equal values are counted first; a running count over the ordered values then gives
    each value its span of ranks, from which the ranks around a percentile are picked.
    Spark's ``percentile`` keeps all values of a group in one task, this does not.
    """
    counts = stored(
        df.filter(F.col(value).isNotNull())
        .groupBy(*by, F.col(value).alias("_v"))
        .agg(F.count("*").alias("_c")),
        "value-counts",
    )
    sizes = stored(
        counts.groupBy(*by).agg(F.count("*").alias("count"), F.sum("_c").alias("_n")), "sizes"
    )
    ranked = (
        OrderedScan.of(counts, by, ["_v"], max_rows, sizes)
        .running({"_end": running_sum(F.col("_c"))})
        .frame()
        .join(sizes.drop("count"), list(by))
    )

    def at(rank: Column) -> Column:
        start = F.col("_end") - F.col("_c")
        return F.max(F.when((start <= rank) & (rank < F.col("_end")), F.col("_v")))

    picks: list[Column] = []
    for name, p in percentiles.items():
        position = F.lit(float(p)) * (F.col("_n") - 1)
        picks += [
            at(F.floor(position)).alias(f"_lo_{name}"),
            at(F.ceil(position)).alias(f"_hi_{name}"),
            F.max(position - F.floor(position)).alias(f"_part_{name}"),
        ]
    return (
        ranked.groupBy(*by)
        .agg(*picks)
        .select(
            *by,
            *(
                (
                    F.col(f"_lo_{n}")
                    + (F.col(f"_hi_{n}") - F.col(f"_lo_{n}")) * F.col(f"_part_{n}")
                ).alias(n)
                for n in percentiles
            ),
        )
    )
