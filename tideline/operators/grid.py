"""Regular time grids per series, both ends included, and row numbering."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tideline.functions.buckets import interval, width_micros
from tideline.operators.ordered import OrderedScan, row_index

# Grid points made from one row at a time.
BLOCK = 100_000

# Rows numbered in one task at most.
ID_ROWS = 100_000


def time_grid(
    spans: DataFrame,
    step: str,
    series: Sequence[str],
    start: str = "start",
    stop: str = "stop",
) -> DataFrame:
    """A row per series and time from ``start`` to ``stop`` in steps.

    Every series is first cut into blocks of bounded length, which spread over the
    tasks before they are expanded; no join with the series list is needed.
    """
    micros = width_micros(step)
    steps = F.floor(F.timestamp_diff("MICROSECOND", start, stop) / F.lit(micros))
    blocks = (
        spans.withColumn("_steps", steps)
        .filter(F.col("_steps") >= 0)
        .select(
            *series,
            start,
            "_steps",
            F.explode(F.sequence(F.lit(0), F.floor(F.col("_steps") / BLOCK))).alias("_block"),
        )
        .hint("rebalance")
    )
    first = F.col("_block") * BLOCK
    last = F.least(first + (BLOCK - 1), F.col("_steps"))
    return blocks.select(
        *series, start, F.explode(F.sequence(first, last)).alias("step_no")
    ).select(*series, "step_no", (F.col(start) + F.col("step_no") * interval(step)).alias("time"))


def assign_ids(
    batch: DataFrame,
    order: Sequence[str],
    previous_max: int = 0,
    name: str = "id",
    max_rows: int = ID_ROWS,
) -> DataFrame:
    """Consecutive ids after ``previous_max`` in a total order.

    A batch over ``max_rows``, a small part of a task's worth, is numbered in range-partitioned segments with offsets,
    so no single task sorts it all.
    """
    scan = OrderedScan.of(batch, (), order, max_rows).running({name: row_index()})
    return scan.frame().withColumn(name, F.col(name) + F.lit(previous_max + 1))
