"""Histograms of equal width.

Between given bounds bin 0 is below the range and bin n + 1 at or above its end. Grids need no
bounds: their cells double in width until a group's values fit, so one scan is enough.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator, Sequence
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tideline.session import stored

# Functions of this module travel to the executors with the job.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Cells of a grid are at least 2 ** FINEST wide.
FINEST = -20
#: Rows of grids that a task gathers before it merges them, and hands on what stays.
STATE_ROWS = 200_000


def bin_number(value: Column, low: Column, high: Column, bins: int) -> Column:
    """Bin of a value; an empty range (low = high) leaves only the two outer bins."""
    inside = F.floor((value - low) * F.lit(bins) / F.nullif(high - low, F.lit(0.0))) + 1
    return (
        F.when(value < low, F.lit(0))
        .when(value >= high, F.lit(bins + 1))
        .otherwise(F.least(inside, F.lit(bins)))
        .cast("int")
    )


def histogram_counts(
    df: DataFrame, by: Sequence[Column | str], value: str, low: Column, high: Column, bins: int
) -> DataFrame:
    """Long form: one row per group and non-empty bin."""
    return (
        df.filter(F.col(value).isNotNull())
        .withColumn("bin", bin_number(F.col(value), low, high, bins))
        .groupBy(*by, "bin")
        .agg(F.count("*").alias("cnt"))
    )


def histogram_arrays(counts: DataFrame, by: Sequence[str], bins: int) -> DataFrame:
    """Array form: ``hist[i]`` is the count of bin i. At most bins + 2 rows per group."""
    per_bin = F.map_from_entries(F.collect_list(F.struct("bin", "cnt")))
    return (
        counts.groupBy(*by)
        .agg(F.sum("cnt").alias("count"), per_bin.alias("_cnt"))
        .select(
            *by,
            "count",
            F.transform(
                F.sequence(F.lit(0), F.lit(bins + 1)),
                lambda i: F.coalesce(F.try_element_at("_cnt", i), F.lit(0)).cast("long"),
            ).alias("hist"),
        )
    )


def value_bounds(df: DataFrame, value: str) -> tuple[Column, Column]:
    """Lowest and highest value as scalar subqueries: one row, and no join."""
    bounds = df.agg(F.min(value).alias("low"), F.max(value).alias("high"))
    return bounds.select("low").scalar(), bounds.select("high").scalar()


def _levels(low: np.ndarray, high: np.ndarray, bins: int, finest: int) -> np.ndarray:
    """Least level at which the cells of width 2 ** level from low to high are at most ``bins``."""
    with np.errstate(divide="ignore"):
        guess = np.log2(high / bins - low / bins)
    level = np.maximum(np.where(np.isfinite(guess), np.floor(guess) - 1, finest), finest).astype(np.int64)
    while True:
        wide = _cells(high, level) - _cells(low, level) >= bins
        if not wide.any():
            return level
        level[wide] += 1


def _cells(value: np.ndarray, level: np.ndarray) -> np.ndarray:
    return np.floor(np.ldexp(value, -level))


def _gather(keys: list[str], bins: int, finest: int):
    """Grids of a task's rows: of each batch first, merged and handed on when there are many."""

    def merged(rows: pd.DataFrame) -> pd.DataFrame:
        group = rows.groupby(keys, dropna=False, sort=False)["_low"]
        low, high = group.transform("min").to_numpy(), group.transform("max").to_numpy()
        level = _levels(low, high, bins, finest)
        if "_level" in rows:
            # Edges know less than the values did: no grid goes below those it is made of.
            known = rows.groupby(keys, dropna=False, sort=False)["_level"].transform("max").to_numpy()
            level = np.maximum(level, known)
        edge = np.ldexp(_cells(rows["_low"].to_numpy(), level), level) + 0.0
        placed = rows.assign(_level=level, _low=edge)
        return placed.groupby([*keys, "_level", "_low"], dropna=False, sort=False, as_index=False)["_n"].sum()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema, held, rows = None, [], 0
        for batch in batches:
            frame = pa.table(batch).to_pandas(types_mapper=pd.ArrowDtype)
            frame["_low"] = frame["_low"].to_numpy(dtype=float)
            schema = schema or pa.schema([*(batch.schema.field(k) for k in keys), ("_level", pa.int32()), ("_low", pa.float64()), ("_n", pa.int64())])
            held.append(merged(frame.assign(_n=1)))
            rows += len(held[-1])
            if rows > STATE_ROWS:
                held = [merged(pd.concat(held))]
                rows = len(held[0])
                if rows > STATE_ROWS // 2:
                    yield from pa.Table.from_pandas(held[0], schema, preserve_index=False).to_batches()
                    held, rows = [], 0
        if held:
            yield from pa.Table.from_pandas(merged(pd.concat(held)), schema, preserve_index=False).to_batches()

    return run


def grid_states(df: DataFrame, by: Sequence[str], value: str, bins: int, finest: int = FINEST) -> DataFrame:
    """Mergeable histograms per group: columns ``by``, _level, _low, _n.

    A grid has cells of width 2 ** _level from multiples of that width on, and the lowest level
    (``finest`` at least) at which a group's values lie in at most ``bins`` neighbouring cells. No bounds
    are needed beforehand: the table is read once, each task hands on at most ``bins`` rows
    per group (more often than once where it has very many groups), and these are merged.

    NULL and NaN are in no cell, nor are infinite values and those of 2^1000 and beyond.
    NULLs in ``by`` are a group.
    """
    if bins < 2:
        raise ValueError("a grid needs two cells at least")
    number = F.col(value).cast("double")
    rows = df.filter(~F.isnan(number) & (F.abs(number) < F.lit(2.0**1000))).select(*by, number.alias("_low"))
    keys = [*by]
    if not keys:
        rows, keys = rows.withColumn("_all", F.lit(0)), ["_all"]
    schema = T.StructType(
        [*(rows.schema[k] for k in keys), T.StructField("_level", T.IntegerType()), T.StructField("_low", T.DoubleType()), T.StructField("_n", T.LongType())]
    )
    return merged_grids(rows.mapInArrow(_gather(keys, bins, finest), schema).select(*by, "_level", "_low", "_n"), by, bins)


def merged_grids(states: DataFrame, by: Sequence[str], bins: int) -> DataFrame:
    """One grid per group out of any number of them, of at most ``bins`` cells.

    A part's range lies in that of the whole, so its level is never above that of the whole, and
    a cell lies in one cell of every higher level: the result is that of all values at once,
    whatever the parts and their order. States are written once, and read twice.
    """
    states = stored(states, "grid-states")
    spans = states.groupBy(*by).agg(
        F.max("_level").alias("_from"), F.min("_low").alias("_first"), F.max("_low").alias("_last")
    )

    def cell(edge: Column, level: Column) -> Column:
        number = edge / F.pow(F.lit(2.0), level)
        # From 2^53 on every double is a whole number.
        return F.when(F.abs(number) < F.lit(2.0**53), F.floor(number).cast("double")).otherwise(number)

    guess = F.floor(F.log2(F.nullif((F.col("_last") - F.col("_first")) / bins, F.lit(0.0)))) - 1
    start = F.greatest("_from", F.coalesce(guess.cast("int"), F.col("_from")))
    enough = F.filter(
        F.sequence(start, start + 6), lambda l: cell(F.col("_last"), l) - cell(F.col("_first"), l) < F.lit(float(bins))
    )
    to = spans.select(*(F.col(k).alias(f"_of_{k}") for k in by), F.element_at(enough, 1).alias("_to"))
    same = reduce(lambda a, b: a & b, (F.col(k).eqNullSafe(F.col(f"_of_{k}")) for k in by), F.lit(True))
    edge = cell(F.col("_low"), F.col("_to")) * F.pow(F.lit(2.0), F.col("_to"))
    return (
        states.join(to, same)
        .groupBy(*by, F.col("_to").alias("_level"), (edge + F.lit(0.0)).alias("_low"))
        .agg(F.sum("_n").alias("_n"))
    )


def grid_cells(states: DataFrame, by: Sequence[str]) -> DataFrame:
    """Rows (by, cell_from, cell_to, cnt) of the cells that hold a value."""
    width = F.pow(F.lit(2.0), F.col("_level"))
    return states.select(*by, F.col("_low").alias("cell_from"), (F.col("_low") + width).alias("cell_to"), F.col("_n").alias("cnt"))
