"""Candle levels that every micro-batch adds to, late ticks included.

A batch appends its own partial candles to each level; a reader merges what it finds for a
bucket. So a tick that comes days late changes its closed bucket in all levels by one more small
row, without a watermark that drops it and without rebuilding anything. Folding replaces
the partial candles of a chunk by one row per bucket, which bounds what a reader merges.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tideline.config import SeriesConfig
from tideline.operators.candles import candles, rollup_candles
from tideline.session import stored
from tideline.sources.store import ChunkTable, list_dir, make_dir, remove_dir

_FILE = "batch-"


@dataclass(frozen=True)
class DeltaLevels:
    """The candle levels of one tick stream, finest first; one writer at a time.

    Ticks have the time, series, value and volume columns of ``config``. ``fold_every`` so many
    batches the chunks that have more than ``most_files`` files are folded.
    """

    spark: SparkSession
    root: str
    config: SeriesConfig
    ticks: T.StructType
    fold_every: int = 16
    most_files: int = 8

    def _build(self, ticks: DataFrame, width: str) -> DataFrame:
        c = self.config
        return candles(ticks, width, c.series_cols, c.time_col, c.value_col, c.volume_col)

    def table(self, name: str) -> ChunkTable:
        level = self.config.level(name)
        state = self._build(self.spark.createDataFrame([], self.ticks), level.width)
        return ChunkTable(
            self.spark, f"{self.root}/{name}", state.schema, "bucket", tuple(self.config.series_cols), level.chunk_width
        )

    def create(self) -> DeltaLevels:
        for level in self.config.levels:
            self.table(level.name).create()
        make_dir(self.spark, f"{self.root}/applied")
        return self

    def applied(self) -> int:
        """The last batch that is in all levels; -1 before the first."""
        return max((int(n) for n in list_dir(self.spark, f"{self.root}/applied")), default=-1)

    def add(self, batch: DataFrame, batch_id: int) -> None:
        """Batch handler: append the batch's candles to every level.

        A batch that was applied is skipped, also after its rows were folded; one that failed in
        between replaces what it had appended.
        """
        done = self.applied()
        if batch_id <= done:
            return
        partial = None
        for level in self.config.levels:
            if partial is None:
                partial = stored(self._build(batch, level.width), "delta")
            else:
                partial = rollup_candles(partial, level.width, self.config.series_cols)
            self.table(level.name).append(partial, batch_id)
        make_dir(self.spark, f"{self.root}/applied/{batch_id}")
        if done >= 0:
            remove_dir(self.spark, f"{self.root}/applied/{done}")
        if self.fold_every and (batch_id + 1) % self.fold_every == 0:
            self.fold()

    def _crowded(self, table: ChunkTable) -> list[date]:
        files = {c: list_dir(self.spark, f"{table.path}/chunk={c.isoformat()}") for c in table.chunks()}
        return [c for c, names in files.items() if sum(n.startswith(_FILE) for n in names) > self.most_files]

    def fold(self, chunks: Sequence[date] | None = None) -> dict[str, list[date]]:
        """Leave one row per bucket in the crowded chunks, or in those named; what was folded, by level.

        To be called between batches only.
        """
        folded = {}
        for level in self.config.levels:
            table = self.table(level.name)
            wanted = self._crowded(table) if chunks is None else [c for c in table.chunks() if c in set(chunks)]
            if wanted:
                rows = table.read(chunks=wanted)
                table.replace_chunks(rollup_candles(rows, level.width, self.config.series_cols), wanted)
                folded[level.name] = wanted
        return folded

    def read(self, name: str, start: datetime | None = None, end: datetime | None = None) -> DataFrame:
        """Candle state of the buckets of ``[start, end)``, merged from what the batches left."""
        rows = self.table(name).read(start, end)
        return rollup_candles(rows, self.config.level(name).width, self.config.series_cols)
