"""Continuous aggregates: stored levels of buckets, refreshed in part, read as one view.

A chain aggregates a raw table into its first level and every level into the next.
Only mergeable state is stored, so a level equals the aggregate of the raw rows.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, replace
from datetime import date, datetime
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tideline.config import Level, SeriesConfig
from tideline.functions.buckets import (
    as_timedelta,
    ceil_time,
    floor_time,
    is_calendar,
    shift,
    time_bucket,
    width_micros,
    width_months,
)
from tideline.operators.candles import candles, rate_candles, rollup_candles, rollup_rates
from tideline.operators.ranges import between
from tideline.operators.stats import rollup_stats, stats
from tideline.operators.swaps import rollup_swap_activity, swap_activity
from tideline.plans.coverage import Range, RangeList, inside
from tideline.sources.store import ChunkTable, list_dir, make_dir, remove_dir

Builder = Callable[[DataFrame, str], DataFrame]

# Longest range each level serves; the coarsest level serves everything longer.
ROUTE_LIMITS = ("1 day", "1 week", "6 months")


def merge_ranges(ranges: Sequence[Range]) -> list[Range]:
    """Sorted, disjoint ranges covering the given ones."""
    out: list[Range] = []
    for start, end in sorted(ranges):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], end))
        elif start < end:
            out.append((start, end))
    return out


def without(ranges: Sequence[Range], start: datetime, end: datetime) -> list[Range]:
    """What of ``[start, end)`` is in none of the sorted, disjoint ranges."""
    return outside([(start, end)], ranges)


def common(a: Sequence[Range], b: Sequence[Range]) -> list[Range]:
    """What lies in both of two lists of sorted, disjoint ranges, in one pass over them."""
    out, i, j = [], 0, 0
    while i < len(a) and j < len(b):
        low, high = max(a[i][0], b[j][0]), min(a[i][1], b[j][1])
        if low < high:
            out.append((low, high))
        if a[i][1] <= b[j][1]:
            i += 1
        else:
            j += 1
    return out


def outside(a: Sequence[Range], b: Sequence[Range]) -> list[Range]:
    """What of ``a`` is not in ``b``; both are sorted and disjoint."""
    gaps = [datetime.min, *(m for r in b for m in r), datetime.max]
    return common(a, [(low, high) for low, high in zip(gaps[::2], gaps[1::2]) if low < high])


@dataclass(frozen=True)
class CaggChain:
    """The levels of one series table, finest first."""

    raw: ChunkTable
    config: SeriesConfig
    root: str
    build: Builder
    merge: Builder

    @property
    def spark(self):
        return self.raw.spark

    # -- definition ---------------------------------------------------------

    def define(self) -> CaggChain:
        """Create all levels empty, to be filled by a refresh."""
        for fine, coarse in zip(self.config.levels, self.config.levels[1:]):
            if not nests(fine.width, coarse.width):
                raise ValueError(f"buckets of {coarse.width} do not end where {fine.width} ones do")
        for level in self.config.levels:
            self.table(level.name).create()
        make_dir(self.spark, self._marks)
        return self

    def table(self, name: str) -> ChunkTable:
        level = self.config.level(name)
        state = self.build(self.raw.read().limit(0), level.width)
        return ChunkTable(
            self.spark,
            f"{self.root}/{level.name}",
            state.schema,
            time_col="bucket",
            series_cols=tuple(self.config.series_cols),
            chunk_interval=level.chunk_width,
        )

    def drop(self) -> None:
        for level in self.config.levels:
            self.table(level.name).drop()
        remove_dir(self.spark, f"{self._marks}__ranges")

    def _finer(self, name: str) -> Level | None:
        names = [lv.name for lv in self.config.levels]
        i = names.index(name)
        return self.config.levels[i - 1] if i else None

    def _source(self, name: str) -> ChunkTable:
        finer = self._finer(name)
        return self.raw if finer is None else self.table(finer.name)

    def _aggregate(self, name: str, source: DataFrame) -> DataFrame:
        width = self.config.level(name).width
        step = self.build if self._finer(name) is None else self.merge
        return step(source, width)

    def apply_retention(self, as_of: datetime) -> list[date]:
        """Drop raw chunks older than the configured retention; the levels keep their buckets."""
        return [] if self.config.retention is None else self.raw.prune(as_of, self.config.retention)

    # -- refreshing ---------------------------------------------------------

    def refresh_full(self) -> None:
        """Recompute every level from the one below."""
        seen = self.raw.last_change()
        for level in self.config.levels:
            table = self.table(level.name)
            rows = self._aggregate(level.name, self._source(level.name).read())
            table.replace_chunks(rows, table.chunks())
            self._note_all(level.name)
        self._mark(seen)

    def refresh_window(self, name: str, start: datetime | None, end: datetime | None) -> None:
        """Recompute the buckets of one level that lie wholly in ``[start, end)``.

        An open start or end reaches as far as there are stored rows.
        """
        width = self.config.level(name).width
        first, last = self._extent(name)
        if first is None:
            return
        low = floor_time(first, width) if start is None else ceil_time(start, width)
        high = self._past(last, width) if end is None else floor_time(end, width)
        self._recompute(name, [(low, high)])
        self._note(name, [(low, high)])

    def _extent(self, name: str) -> tuple[datetime | None, datetime | None]:
        """From where to where there are chunks of the raw table, of a level or of finer ones."""
        names = [lv.name for lv in self.config.levels]
        tables = [self.raw, *map(self.table, names[: names.index(name) + 1])]
        moments = [m for t in tables for m in t.extent()]
        return (min(moments), max(moments)) if moments else (None, None)

    def refresh_policy(self, as_of: datetime) -> None:
        """One scheduled run: every level over its window behind ``as_of``, finest first."""
        for level in self.config.levels:
            if level.refresh_start is None or level.refresh_end is None:
                continue
            if as_timedelta(level.refresh_start) <= as_timedelta(level.refresh_end):
                raise ValueError(f"level {level.name}: the refresh window is empty")
            self.refresh_window(
                level.name,
                shift(as_of, level.refresh_start, -1),
                shift(as_of, level.refresh_end, -1),
            )

    def refresh_invalidated(self) -> list[Range]:
        """Recompute only buckets whose raw rows changed since the last refresh.

        One row per changed raw chunk reaches the driver. Every touched bucket is
        rebuilt completely, and its parents from all of their children.
        """
        seen = self.raw.last_change()
        changed = (
            self.raw.changes(after=self._seen())
            .groupBy("chunk")
            .agg(F.min("min_time").alias("low"), F.max("max_time").alias("high"))
            .collect()
        )
        ranges = [(r["low"], r["high"]) for r in changed]
        first: list[Range] = []
        for level in self.config.levels:
            ranges = merge_ranges(
                [
                    (floor_time(low, level.width), self._past(high, level.width))
                    for low, high in ranges
                ]
            )
            first = first or ranges
            self._recompute(level.name, ranges)
            self._note(level.name, ranges)
            # The last touched instant, not the open end, decides the parent bucket.
            ranges = [(low, shift(high, "1 microsecond", -1)) for low, high in ranges]
        self._mark(seen)
        return first

    @staticmethod
    def _past(moment: datetime, width: str) -> datetime:
        return shift(floor_time(moment, width), width)

    def _recompute(self, name: str, ranges: Sequence[Range]) -> None:
        ranges = merge_ranges(ranges)
        if not ranges:
            return
        table = self.table(name)
        source, width = self._source(name), self.config.level(name).width
        touched = table.touched(ranges)
        rows = source.read(chunks=source.touched(ranges))
        fresh = self._aggregate(name, inside(rows, ranges, width, source.time_col))
        kept = inside(table.read(chunks=touched), ranges, width, "bucket", covered=False)
        table.replace_chunks(kept.unionByName(fresh.select(kept.columns)), touched)

    # -- what is up to date -------------------------------------------------

    def _ranges(self, name: str) -> RangeList:
        return RangeList(self.spark, f"{self._marks}__ranges/{name}")

    def _note(self, name: str, ranges: Sequence[Range]) -> None:
        """Remember refreshed ranges, as far as the finer level was up to date there.

        Ranges are joined when noted, so the list of them stays short. No Spark job is run.
        """
        finer, width = self._finer(name), self.config.level(name).width
        ranges = merge_ranges(ranges)
        covered = ranges if finer is None else common(ranges, self.refreshed(finer.name))
        new = [(ceil_time(a, width), floor_time(b, width)) for a, b in covered]
        new = [(a, b) for a, b in new if a < b]
        if new:
            self._ranges(name).write(merge_ranges([*self.refreshed(name), *new]))

    def _note_all(self, name: str) -> None:
        first, last = self._extent(name)
        if first is not None:
            width = self.config.level(name).width
            self._ranges(name).write([(floor_time(first, width), self._past(last, width))])

    def refreshed(self, name: str) -> list[Range]:
        """Sorted, disjoint ranges of a level that were refreshed."""
        return self._ranges(name).read()

    # -- progress of the change log -----------------------------------------

    @property
    def _marks(self) -> str:
        return f"{self.root}/refreshed"

    def _seen(self) -> int:
        return max((int(n) for n in list_dir(self.spark, self._marks)), default=0)

    def _mark(self, change: int) -> None:
        """Note the last change seen; one mark stays."""
        make_dir(self.spark, f"{self._marks}/{change}")
        for old in list_dir(self.spark, self._marks):
            if int(old) < change:
                remove_dir(self.spark, f"{self._marks}/{old}")

    # -- reading ------------------------------------------------------------

    def refreshed_until(self, name: str) -> datetime | None:
        newest = self.table(name).latest()
        return None if newest is None else shift(newest, self.config.level(name).width)

    def materialized(self, name: str) -> DataFrame:
        """Stored buckets only."""
        return self.table(name).read()

    def realtime(
        self, name: str, start: datetime | None = None, end: datetime | None = None
    ) -> DataFrame:
        """Buckets of ``[start, end)``: stored where refreshed, else aggregated on the fly.

        Ranges that were never refreshed, wherever they lie, come from the finer level.
        Bounds reach every scan, so only chunks of the wanted time are opened.
        """
        width = self.config.level(name).width
        first, last = self._extent(name)
        if first is None:
            return self.materialized(name)
        low = floor_time(first if start is None else start, width)
        high = self._past(last, width) if end is None else ceil_time(end, width)
        if low >= high:
            return self.table(name).read(start=low, end=low)
        return self._live(name, [(low, high)])

    def _live(self, name: str, wanted: Sequence[Range]) -> DataFrame:
        """Buckets of the wanted ranges: those refreshed as stored, all others from the finer level.

        Two branches a level, however many gaps there are: each takes all of its ranges at once
        and reads the chunks they touch.
        """
        width, table = self.config.level(name).width, self.table(name)
        refreshed = self.refreshed(name)
        done, gaps = common(wanted, refreshed), outside(wanted, refreshed)
        parts = []
        if done:
            parts.append(inside(table.read(chunks=table.touched(done)), done, width, "bucket"))
        if gaps:
            finer = self._finer(name)
            if finer is None:
                rows = inside(self.raw.read(chunks=self.raw.touched(gaps)), gaps, width, self.raw.time_col)
            else:
                rows = self._live(finer.name, gaps)
            parts.append(self._aggregate(name, rows))
        return reduce(DataFrame.unionByName, parts)

    def register_views(self, live: bool = True, prefix: str = "") -> list[str]:
        """A named view per level, such as ``ticks_1h``; returns the names."""
        names = []
        for level in self.config.levels:
            names.append(f"{prefix or self.config.table}_{level.name}")
            view = self.realtime(level.name) if live else self.materialized(level.name)
            view.createOrReplaceTempView(names[-1])
        return names

    def route(self, start: datetime, end: datetime) -> str:
        """Name of the level that serves a range of this length."""
        return route_by_range([lv.name for lv in self.config.levels], start, end)

    def query_range(self, start: datetime, end: datetime, live: bool = True) -> DataFrame:
        """Buckets from start to end (both included) of the level chosen by length."""
        name = self.route(start, end)
        past = shift(end, "1 microsecond")
        if live:
            return between(self.realtime(name, start, past), start, end, "bucket")
        return self.table(name).read(start=start, end=past)


def nests(fine: str, coarse: str) -> bool:
    """True when every coarse bucket is made of whole fine ones."""
    if is_calendar(coarse):
        if is_calendar(fine):
            return width_months(coarse) % width_months(fine) == 0
        return width_micros("1 day") % width_micros(fine) == 0
    return not is_calendar(fine) and width_micros(coarse) % width_micros(fine) == 0


def route_by_range(names: Sequence[str], start: datetime, end: datetime) -> str:
    for name, limit in zip(names[:-1], ROUTE_LIMITS):
        if end - start <= as_timedelta(limit):
            return name
    return names[-1]


def candle_chain(raw: ChunkTable, config: SeriesConfig, root: str) -> CaggChain:
    """Candles of a tick table, first from raw ticks and then from finer candles."""
    return CaggChain(
        raw,
        config,
        root,
        lambda df, width: candles(
            df,
            width,
            config.series_cols,
            config.time_col,
            config.value_col,
            config.volume_col,
            config.tiebreak,
        ),
        lambda df, width: rollup_candles(df, width, config.series_cols),
    )


def stats_chain(raw: ChunkTable, config: SeriesConfig, root: str) -> CaggChain:
    """Statistical summaries of a sample table."""
    return CaggChain(
        raw,
        config,
        root,
        lambda df, width: stats(
            df, width, config.series_cols, config.time_col, config.value_col
        ),
        lambda df, width: rollup_stats(df, width, config.series_cols),
    )


def rate_chain(raw: ChunkTable, config: SeriesConfig, root: str) -> CaggChain:
    """Ask, bid and mid candles of an exchange rate table."""
    return CaggChain(
        raw,
        config,
        root,
        lambda df, width: rate_candles(df, width, config.time_col),
        rollup_rates,
    )


def swap_chain(raw: ChunkTable, config: SeriesConfig, root: str) -> CaggChain:
    """Sums and counts of swaps per bucket, wallet and token."""
    return CaggChain(raw, config, root, swap_activity, rollup_swap_activity)


def count_chain(raw: ChunkTable, config: SeriesConfig, root: str) -> CaggChain:
    """Row counts per bucket over all series."""
    def build(df: DataFrame, width: str) -> DataFrame:
        return df.groupBy(time_bucket(width, config.time_col).alias("bucket")).agg(
            F.count("*").alias("total")
        )

    def merge(df: DataFrame, width: str) -> DataFrame:
        parent = df.withColumn("_parent", time_bucket(width, "bucket"))
        return parent.groupBy(F.col("_parent").alias("bucket")).agg(F.sum("total").alias("total"))

    return CaggChain(raw, replace(config, series_cols=()), root, build, merge)
