"""Running aggregates per key that hold when one key has a large share of all rows.

A plain window sends every row of a key to one task. ``OrderedScan`` counts rows per
key first (a small, map-side combined job). Keys under ``max_rows`` take the plain
window. Rows of larger keys are range-partitioned by (key, order), so one key spreads
over many segments of about equal size, however its rows are spread over time; each
segment runs the same window, and the totals of the earlier segments of its key are
added as a carry. All running aggregates offered here can be combined that way, so
both routes give the same result.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from tideline.functions.scalars import add_nullable
from tideline.session import stored

SEGMENT = "_segment"
# Rows one window task may hold; Spark spills below that size without trouble.
MAX_ROWS = 4_000_000


@dataclass(frozen=True)
class Running:
    """One running aggregate: ``sum``, ``max``, ``last`` (non-null) or ``count``.

    ``exclusive`` leaves the current row out.
    """

    kind: str
    value: Column | None = None
    exclusive: bool = False

    def over(self, window: WindowSpec) -> Column:
        if self.kind == "count":
            number = F.row_number().over(window).cast("long")
            return number - 1 if self.exclusive else number
        end = -1 if self.exclusive else Window.currentRow
        return self._aggregate(self.value, window.rowsBetween(Window.unboundedPreceding, end))

    def _aggregate(self, value: Column, frame: WindowSpec) -> Column:
        if self.kind == "sum":
            return F.sum(value).over(frame)
        if self.kind == "max":
            return F.max(value).over(frame)
        if self.kind == "last":
            return F.last(value, ignorenulls=True).over(frame)
        raise ValueError(f"unknown running aggregate {self.kind!r}")

    def total(self, order: Sequence[str]) -> Column:
        """The aggregate of a whole segment."""
        if self.kind == "count":
            return F.count(F.lit(1))
        if self.kind == "sum":
            return F.sum(self.value)
        if self.kind == "max":
            return F.max(self.value)
        return F.max_by(self.value, F.when(self.value.isNotNull(), F.struct(*order)))

    def before(self, total: Column, window: WindowSpec) -> Column:
        """The aggregate of all earlier segments, from their totals."""
        frame = window.rowsBetween(Window.unboundedPreceding, -1)
        if self.kind == "count":
            return F.sum(total).over(frame)
        return self._aggregate(total, frame)

    def combine(self, carry: Column, local: Column) -> Column:
        if self.kind in ("sum", "count"):
            return add_nullable(carry, local)
        if self.kind == "max":
            return F.greatest(carry, local)
        return F.coalesce(local, carry)


def running_sum(value: Column, exclusive: bool = False) -> Running:
    return Running("sum", value, exclusive)


def running_max(value: Column, exclusive: bool = False) -> Running:
    return Running("max", value, exclusive)


def running_last(value: Column, exclusive: bool = False) -> Running:
    return Running("last", value, exclusive)


def row_index() -> Running:
    """Zero-based position of the row within its key."""
    return Running("count", exclusive=True)


def same_keys(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> Column:
    """Null-safe equality on every key; always true without keys."""
    return reduce(
        lambda a, b: a & b, (left[k].eqNullSafe(right[k]) for k in keys), F.lit(True)
    )


@dataclass(frozen=True)
class OrderedScan:
    """Rows of one table, ready for running aggregates per key in a total order."""

    keys: tuple[str, ...]
    order: tuple[str, ...]
    plain: DataFrame | None
    split: DataFrame | None

    @classmethod
    def of(
        cls,
        df: DataFrame,
        keys: Sequence[str],
        order: Sequence[str],
        max_rows: int = MAX_ROWS,
        sizes: DataFrame | None = None,
    ) -> OrderedScan:
        """``sizes`` may give the rows per key (column ``count``) where they are known."""
        keys, order = tuple(keys), tuple(order)
        sizes = df.groupBy(*keys).count() if sizes is None else sizes
        large = sizes.filter(F.col("count") > max_rows)
        found = large.agg(F.count("*").alias("keys"), F.sum("count").alias("rows")).first()
        if not found["keys"]:
            return cls(keys, order, df, None)
        if keys:
            # At most (all rows / max_rows) keys; stored once so both joins agree.
            large = stored(large.select(*keys), "large-keys")
            match = same_keys(df, large, keys)
            plain = df.join(large, match, "left_anti")
            rows = df.join(large, match, "left_semi")
        else:
            plain, rows = None, df
        segments = 2 * math.ceil(found["rows"] / max_rows)
        # Stored, so that every later read sees one fixed set of segments.
        split = stored(
            rows.repartitionByRange(segments, *keys, *order).withColumn(
                SEGMENT, F.spark_partition_id()
            ),
            "segments",
        )
        return cls(keys, order, plain, split)

    def running(self, aggregates: dict[str, Running]) -> OrderedScan:
        """Add one column per running aggregate."""
        plain, split = self.plain, self.split
        if plain is not None:
            window = Window.partitionBy(*self.keys).orderBy(*self.order)
            plain = plain.withColumns({n: a.over(window) for n, a in aggregates.items()})
        if split is not None:
            split = self._running_split(split, aggregates)
        return replace(self, plain=plain, split=split)

    def _running_split(self, rows: DataFrame, aggregates: dict[str, Running]) -> DataFrame:
        cells = (*self.keys, SEGMENT)
        carries = {n: f"_carry_{n}" for n in aggregates}
        totals = rows.groupBy(*cells).agg(
            *(a.total(self.order).alias(carries[n]) for n, a in aggregates.items())
        )
        across = Window.partitionBy(*self.keys).orderBy(SEGMENT)
        before = totals.select(
            *cells,
            *(a.before(F.col(carries[n]), across).alias(carries[n]) for n, a in aggregates.items()),
        )
        within = Window.partitionBy(*cells).orderBy(*self.order)
        local = rows.withColumns({n: a.over(within) for n, a in aggregates.items()})
        joined = local.join(before, same_keys(local, before, cells), "left").select(
            *(local[c] for c in rows.columns if c not in aggregates),
            *(
                a.combine(before[carries[n]], local[n]).alias(n)
                for n, a in aggregates.items()
            ),
        )
        return joined

    def with_columns(self, columns: dict[str, Column]) -> OrderedScan:
        return replace(
            self,
            plain=None if self.plain is None else self.plain.withColumns(columns),
            split=None if self.split is None else self.split.withColumns(columns),
        )

    def frame(self) -> DataFrame:
        if self.split is None:
            return self.plain
        split = self.split.drop(SEGMENT)
        return split if self.plain is None else self.plain.unionByName(split)
