"""Series tables stored as Parquet, one partition directory per time chunk.

Writers are expected one at a time per table. Every change of rows is first noted in a
change log (lowest and greatest time per chunk), which aggregate refreshes read.
"""

from __future__ import annotations

import uuid
from bisect import bisect_left
from collections.abc import Callable, Iterable, Sequence
from dataclasses import dataclass, field, replace
from datetime import date, datetime, timedelta
from hashlib import md5

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tideline.functions.buckets import as_timedelta, floor_time, is_calendar, shift, time_bucket

CHUNK = "chunk"
CHANGES_SCHEMA = "seq BIGINT, chunk DATE, min_time TIMESTAMP_NTZ, max_time TIMESTAMP_NTZ"


def _fs(spark: SparkSession, path: str):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop_path


def make_dir(spark: SparkSession, path: str) -> None:
    fs, p = _fs(spark, path)
    fs.mkdirs(p)


def remove_dir(spark: SparkSession, path: str) -> None:
    fs, p = _fs(spark, path)
    fs.delete(p, True)


def move_dir(spark: SparkSession, source: str, target: str) -> None:
    fs, p = _fs(spark, source)
    if not fs.rename(p, _fs(spark, target)[1]):
        raise OSError(f"could not move {source} to {target}")


def list_dir(spark: SparkSession, path: str) -> list[str]:
    fs, p = _fs(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []


def is_dir(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return fs.exists(p) and fs.getFileStatus(p).isDirectory()


class Folders:
    """Calls on many paths of one file system, whose handle is looked up once."""

    def __init__(self, spark: SparkSession, path: str):
        self.fs, _ = _fs(spark, path)
        self.place = spark._jvm.org.apache.hadoop.fs.Path

    def names(self, path: str) -> list[str]:
        p = self.place(path)
        return sorted(s.getPath().getName() for s in self.fs.listStatus(p)) if self.fs.exists(p) else []

    def make(self, path: str) -> None:
        self.fs.mkdirs(self.place(path))

    def remove(self, path: str) -> None:
        self.fs.delete(self.place(path), True)

    def move(self, source: str, target: str) -> None:
        if not self.fs.rename(self.place(source), self.place(target)):
            raise OSError(f"could not move {source} to {target}")


def _midnight(day: date) -> datetime:
    return datetime.combine(day, datetime.min.time())


def spread(df: DataFrame, *columns: str) -> DataFrame:
    """Bring equal values together for writing, at sizes adaptive execution balances.

    Small partitions are merged, and one value with too many rows is split over tasks.
    """
    return df.hint("rebalance", *(F.col(c) for c in columns))


@dataclass(frozen=True)
class ChunkTable:
    """A Parquet table partitioned by ``chunk``, the start date of the time chunk."""

    spark: SparkSession
    path: str
    schema: T.StructType
    time_col: str = "time"
    series_cols: tuple[str, ...] = ()
    chunk_interval: str = "1 day"
    compact_interval: str | None = None
    # Rows and chunks of a snapshot.
    listed: tuple[DataFrame, tuple[date, ...]] | None = field(default=None, compare=False, repr=False)

    def __post_init__(self) -> None:
        if as_timedelta(self.chunk_interval) % timedelta(days=1):
            raise ValueError("chunks must be whole days, weeks, months or years")
        if self.compact_interval is None:
            return
        fixed = not (is_calendar(self.chunk_interval) or is_calendar(self.compact_interval))
        if not fixed or as_timedelta(self.compact_interval) % as_timedelta(self.chunk_interval):
            raise ValueError("the compacted width must be a multiple of the chunk width")

    @property
    def _widest(self) -> str:
        return self.compact_interval or self.chunk_interval

    # -- reading ------------------------------------------------------------

    def exists(self) -> bool:
        fs, p = _fs(self.spark, self.path)
        return fs.exists(p)

    def snapshot(self) -> ChunkTable:
        """The table for many reads with no write between them: its files are listed once."""
        return replace(self, listed=(self._rows(), tuple(self.chunks())))

    def chunks(self) -> list[date]:
        if self.listed is not None:
            return list(self.listed[1])
        return [
            date.fromisoformat(n.split("=", 1)[1])
            for n in list_dir(self.spark, self.path)
            if n.startswith(f"{CHUNK}=")
        ]

    def _rows(self) -> DataFrame:
        if self.listed is not None:
            return self.listed[0]
        stored = T.StructType([*self.schema.fields, T.StructField(CHUNK, T.DateType())])
        return self.spark.read.schema(stored).parquet(self.path)

    def read(
        self,
        start: datetime | None = None,
        end: datetime | None = None,
        chunks: Sequence[date] | None = None,
    ) -> DataFrame:
        """Rows with ``start <= time < end``; only chunks that can hold them are scanned."""
        rows = self._rows()
        if chunks is not None:
            rows = rows.filter(F.col(CHUNK).isin(list(chunks)))
        return self._select(rows, start, end).drop(CHUNK)

    def _select(
        self, rows: DataFrame, start: datetime | None, end: datetime | None
    ) -> DataFrame:
        time = F.col(self.time_col)
        if start is not None:
            # A compacted chunk may start earlier than the plain one would.
            first = floor_time(start, self._widest).date()
            moment = F.lit(start).cast("timestamp_ntz")
            rows = rows.filter((F.col(CHUNK) >= F.lit(first)) & (time >= moment))
        if end is not None:
            moment = F.lit(end).cast("timestamp_ntz")
            rows = rows.filter((F.col(CHUNK) <= F.lit(end.date())) & (time < moment))
        return rows

    def read_ranges(self, ranges: Sequence[tuple[datetime, datetime]]) -> DataFrame:
        """Rows in any of the half-open, disjoint time ranges."""
        if not ranges:
            return self.read().limit(0)
        rows = self._rows().filter(F.col(CHUNK).isin(self.touched(ranges)))
        return rows.filter(self.in_ranges(ranges)).drop(CHUNK)

    def touched(self, ranges: Sequence[tuple[datetime, datetime]]) -> list[date]:
        """Stored chunks that may hold rows of the disjoint, sorted time ranges."""
        starts = [start for start, _ in ranges]

        def holds(chunk: date) -> bool:
            # The last range that starts before the chunk's end decides.
            at = bisect_left(starts, shift(_midnight(chunk), self._widest))
            return at > 0 and ranges[at - 1][1] > _midnight(chunk)

        return [c for c in self.chunks() if holds(c)]

    def in_ranges(self, ranges: Sequence[tuple[datetime, datetime]]):
        time = F.col(self.time_col)
        inside = F.lit(False)
        for start, end in ranges:
            low, high = (F.lit(m).cast("timestamp_ntz") for m in (start, end))
            inside = inside | ((time >= low) & (time < high))
        return inside

    def extent(self) -> list[datetime]:
        """Start of the first chunk and the last moment of the last one; nothing if there is none."""
        chunks = self.chunks()
        if not chunks:
            return []
        ends = max(shift(_midnight(c), self._widest) for c in chunks[-1:])
        return [_midnight(chunks[0]), shift(ends, "1 microsecond", -1)]

    def latest(self) -> datetime | None:
        """Newest time, looked up in the newest chunks only."""
        chunks = self.chunks()
        if not chunks:
            return None
        first = floor_time(_midnight(chunks[-1]), self._widest).date()
        newest = F.col(CHUNK) >= F.lit(first)
        return self._rows().filter(newest).agg(F.max(self.time_col).alias("t")).first()["t"]

    # -- writing ------------------------------------------------------------

    def create(self) -> ChunkTable:
        """Make the empty table, ready to be read."""
        make_dir(self.spark, self.path)
        make_dir(self.spark, self._log_path)
        return self

    def _chunked(self, df: DataFrame, interval: str) -> DataFrame:
        rows = df.select(*(F.col(f.name).cast(f.dataType) for f in self.schema.fields))
        return rows.withColumn(CHUNK, time_bucket(interval, self.time_col).cast("date"))

    def append(self, df: DataFrame, batch_id: int | None = None) -> None:
        """Insert rows; usable as a batch handler of a stream.

        The frame is read once: rows go to staging, the change log is taken from what was
        written, and files move into place under the batch's name. With ``batch_id`` a
        batch that runs again replaces what it had moved, so no row is stored twice.
        """
        name = uuid.uuid4().hex[:12] if batch_id is None else f"batch-{batch_id}"
        staging = f"{self.path.rstrip('/')}__staging-{uuid.uuid4().hex[:12]}"
        spread(self._chunked(df, self.chunk_interval), CHUNK).write.partitionBy(CHUNK).parquet(staging)
        folders = Folders(self.spark, self.path)
        folders.make(self.path)
        chunks = [n for n in folders.names(staging) if n.startswith(f"{CHUNK}=")]
        present = {n for n in folders.names(self.path) if n.startswith(f"{CHUNK}=")}
        if batch_id is not None:
            for chunk in present:
                for file in folders.names(f"{self.path}/{chunk}"):
                    if file.startswith(f"{name}-"):
                        folders.remove(f"{self.path}/{chunk}/{file}")
        if chunks:
            written = T.StructType([*self.schema.fields, T.StructField(CHUNK, T.DateType())])
            self._log(self.spark.read.schema(written).parquet(staging))
        for chunk in chunks:
            # A new chunk moves whole; files of a batch need its name.
            if batch_id is None and chunk not in present:
                folders.move(f"{staging}/{chunk}", f"{self.path}/{chunk}")
                continue
            if chunk not in present:
                folders.make(f"{self.path}/{chunk}")
            for file in folders.names(f"{staging}/{chunk}"):
                folders.move(f"{staging}/{chunk}/{file}", f"{self.path}/{chunk}/{name}-{file}")
        folders.remove(staging)

    def replace_chunks(self, df: DataFrame, chunks: Iterable[date]) -> None:
        """Exchange the content of whole chunks; chunks without new rows disappear."""
        chunked = self._chunked(df, self.chunk_interval)
        ordered = [CHUNK, *self.series_cols, self.time_col]
        self._swap(spread(chunked, CHUNK).sortWithinPartitions(*ordered), chunks)

    def replace_rows(self, df: DataFrame, keys: Sequence[str], chunks: Iterable[date], where: Column) -> None:
        """Put rows in the place of those of the same keys, and add those of new keys.

        ``keys`` hold the series columns and the time; each key remains once, and only with a row
        that meets ``where``. Whole ``chunks`` are rewritten, which must hold all stored rows of
        these keys. One shuffle by ranges of time puts rows of a key together, spreads a crowded
        chunk and leaves few files per chunk.
        """
        stored = self.read(chunks=chunks).withColumn("_new", F.lit(False))
        rows = stored.unionByName(df.select(*self.schema.names).withColumn("_new", F.lit(True)))
        first = [*self.series_cols, self.time_col]
        ordered = [CHUNK, *first, *(k for k in keys if k not in first)]
        chunk = time_bucket(self.chunk_interval, self.time_col).cast("date")
        values = [n for n in self.schema.names if n not in keys]
        merged = (
            rows.withColumn(CHUNK, chunk)
            .repartitionByRange(self.time_col)
            .groupBy(*ordered)
            .agg(F.max_by(F.struct(*values), "_new").alias("_row"))
            .select(*ordered, *(F.col(f"_row.{v}").alias(v) for v in values))
            .filter(where)
            .select(*self.schema.names, CHUNK)
        )
        self._swap(merged.sortWithinPartitions(*ordered), chunks)

    def _swap(
        self, chunked: DataFrame, chunks: Iterable[date], rows: int | None = None
    ) -> None:
        """Write new chunks beside the table, then swap directories.

        A failing job leaves the table as it was, and rows may be read from the chunks
        they replace. ``rows`` is the number expected, where it is known.
        """
        staging = f"{self.path.rstrip('/')}__staging-{uuid.uuid4().hex[:12]}"
        chunked.write.partitionBy(CHUNK).parquet(staging)
        if rows is not None:
            found = self.spark.read.parquet(staging).count()
            if found != rows:
                raise RuntimeError(f"{found} rows written instead of {rows}, table unchanged")
        folders = Folders(self.spark, self.path)
        written = [n for n in folders.names(staging) if n.startswith(f"{CHUNK}=")]
        for name in {f"{CHUNK}={c.isoformat()}" for c in chunks} | set(written):
            folders.remove(f"{self.path}/{name}")
        for name in written:
            folders.move(f"{staging}/{name}", f"{self.path}/{name}")
        folders.remove(staging)

    def update_range(
        self,
        change: Callable[[DataFrame], DataFrame],
        start: datetime,
        end: datetime | None = None,
    ) -> None:
        """Apply ``change`` to rows with ``start <= time < end``; only their chunks are rewritten.

        ``change`` may set any column but the time.
        """
        touched = self._select(self._rows(), start, end)
        chunks = [r[CHUNK] for r in touched.select(CHUNK).distinct().collect()]
        if not chunks:
            return
        self._log(touched)
        # Rows keep the chunk they are stored in, so compacted chunks stay compacted.
        whole = self._rows().filter(F.col(CHUNK).isin(chunks))
        inside = self.in_ranges([(start, end or datetime.max)])
        rows = change(whole.filter(inside)).unionByName(whole.filter(~inside))
        ordered = [CHUNK, *self.series_cols, self.time_col]
        self._swap(spread(rows, CHUNK).sortWithinPartitions(*ordered), chunks, whole.count())

    def prune(self, as_of: datetime, keep: str) -> list[date]:
        """Drop chunks that end at or before ``as_of - keep``; returns their start dates."""
        cutoff = shift(as_of, keep, -1)
        gone = [c for c in self.chunks() if self._latest_end(c) <= cutoff]
        for c in gone:
            remove_dir(self.spark, f"{self.path}/{CHUNK}={c.isoformat()}")
        return gone

    def _latest_end(self, chunk: date) -> datetime:
        """End of a stored chunk, taken as compacted where its start allows it."""
        start = _midnight(chunk)
        wide = floor_time(start, self._widest) == start
        return shift(start, self._widest if wide else self.chunk_interval)

    def compact(self, as_of: datetime, older_than: str = "1 week") -> list[date]:
        """Merge chunks that ended before ``as_of - older_than`` into wider, clustered ones.

        Rows are range-partitioned by (chunk, series, time) and sorted, so a large series
        spreads over several files and row groups have narrow ranges. Content is unchanged.
        """
        if self.compact_interval is None:
            raise ValueError("the table has no compacted width")
        cutoff = floor_time(shift(as_of, older_than, -1), self.compact_interval)
        marks = f"{self._log_path}__compacted"
        done = set(list_dir(self.spark, marks))
        weeks: dict[date, list[date]] = {}
        for c in self.chunks():
            if _midnight(c) < cutoff:
                weeks.setdefault(floor_time(_midnight(c), self.compact_interval).date(), []).append(c)
        # A week that is one chunk, merged before and not changed since, stays as it is.
        open_ = [w for w, parts in weeks.items() if parts != [w] or f"{w}.{self._files(w)}" not in done]
        old = sorted(c for w in open_ for c in weeks[w])
        if not old:
            return []
        rows = self._rows().filter(F.col(CHUNK).isin(old)).drop(CHUNK)
        ordered = [CHUNK, *self.series_cols, self.time_col]
        clustered = self._chunked(rows, self.compact_interval).repartitionByRange(*ordered)
        self._swap(clustered.sortWithinPartitions(*ordered), old, rows.count())
        for w in open_:
            make_dir(self.spark, f"{marks}/{w}.{self._files(w)}")
        return old

    def _files(self, chunk: date) -> str:
        """A name for the set of files of a chunk."""
        names = list_dir(self.spark, f"{self.path}/{CHUNK}={chunk.isoformat()}")
        return md5(",".join(names).encode()).hexdigest()[:16]

    def truncate(self) -> None:
        for c in self.chunks():
            remove_dir(self.spark, f"{self.path}/{CHUNK}={c.isoformat()}")

    def drop(self) -> None:
        remove_dir(self.spark, self.path)
        remove_dir(self.spark, self._log_path)
        remove_dir(self.spark, f"{self._log_path}__compacted")

    # -- change log ---------------------------------------------------------

    @property
    def _log_path(self) -> str:
        return f"{self.path.rstrip('/')}__changes"

    def last_change(self) -> int:
        numbers = [
            int(n.split("=", 1)[1])
            for n in list_dir(self.spark, self._log_path)
            if n.startswith("seq=")
        ]
        return max(numbers, default=0)

    def _log(self, chunked: DataFrame) -> None:
        seq = self.last_change() + 1
        chunked.groupBy(CHUNK).agg(
            F.min(self.time_col).alias("min_time"), F.max(self.time_col).alias("max_time")
        ).write.parquet(f"{self._log_path}/seq={seq}")

    def changes(self, after: int = 0) -> DataFrame:
        """Logged changes with a number above ``after``: lowest and greatest time per chunk."""
        return (
            self.spark.read.schema(CHANGES_SCHEMA)
            .parquet(self._log_path)
            .filter(F.col("seq") > after)
        )

    def trim_log(self, upto: int) -> None:
        """Forget changes that every reader has seen; the newest stays, as numbers go on from it."""
        for number in range(1, min(upto + 1, self.last_change())):
            remove_dir(self.spark, f"{self._log_path}/seq={number}")


def create_namespace(spark: SparkSession, name: str) -> None:
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{name}`")
    spark.catalog.setCurrentDatabase(name)


def drop_namespace(spark: SparkSession, name: str) -> None:
    spark.catalog.setCurrentDatabase("default")
    spark.sql(f"DROP DATABASE IF EXISTS `{name}` CASCADE")


def drop_views(spark: SparkSession, names: Iterable[str]) -> None:
    for name in names:
        spark.sql(f"DROP VIEW IF EXISTS `{name}`")
