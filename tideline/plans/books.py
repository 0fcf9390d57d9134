"""Books of closed days: profit of any range of swaps without reading what lies before it.

Each closed day keeps its own totals per wallet and token, and every few days there is a
snapshot of all totals so far. The books at a day's start are the last snapshot before it and the
days since, so a range reads one snapshot, a few days of totals and its own swaps.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date, datetime, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tideline.operators.ordered import MAX_ROWS
from tideline.operators.swaps import BOOK_SCHEMA, KEYS, add_books, close_books, swap_pnl_from_books
from tideline.sources.store import ChunkTable, list_dir, make_dir, move_dir, remove_dir, spread

DAY = timedelta(days=1)


def _midnight(day: date) -> datetime:
    return datetime.combine(day, datetime.min.time())


@dataclass(frozen=True)
class DatedBooks:
    """Totals per closed day of a table of swaps, and snapshots ``every`` so many days."""

    swaps: ChunkTable
    path: str
    every: int = 7
    max_rows: int = MAX_ROWS

    @property
    def spark(self):
        return self.swaps.spark

    def _days(self, kind: str) -> list[date]:
        names = list_dir(self.spark, f"{self.path}/{kind}")
        return [date.fromisoformat(n.split("=", 1)[1]) for n in names if n.startswith("day=")]

    def closed_until(self) -> date | None:
        """The first day that isn't closed; None before anything is."""
        return max(self._days("snapshots"), default=None)

    def _stored(self, kind: str, days: list[date]) -> DataFrame:
        if not days:
            return self.spark.createDataFrame([], BOOK_SCHEMA)
        return self.spark.read.schema(BOOK_SCHEMA).parquet(*(f"{self.path}/{kind}/day={d.isoformat()}" for d in days))

    def at(self, day: date) -> DataFrame:
        """Totals of all swaps before a day, which must not lie beyond the closed ones."""
        snapshots = self._days("snapshots")
        if not snapshots or day > max(snapshots):
            raise ValueError(f"{day} is not closed yet")
        base = max((d for d in snapshots if d <= day), default=None)
        since = [d for d in self._days("totals") if (base is None or d >= base) and d < day]
        return add_books(self._stored("snapshots", [base] if base else []).unionByName(self._stored("totals", since)))

    def close(self, until: date) -> None:
        """Close all days before ``until``, ``every`` days at a time.

        A run reads the swaps of its own days once. Days that are closed stay as they are; a run
        that fails leaves none of its days and is done again.
        """
        extent = self.swaps.extent()
        if not extent:
            return
        start = self.closed_until() or extent[0].date()
        while start < until:
            end = min(start + self.every * DAY, until)
            self._close(start, end)
            start = end

    def _close(self, start: date, end: date) -> None:
        rows = self.swaps.read(start=_midnight(start), end=_midnight(end))
        before = self.at(start) if self.closed_until() else self.spark.createDataFrame([], BOOK_SCHEMA)
        pnl = swap_pnl_from_books(rows, before, self.max_rows).withColumn("day", F.to_date("time"))
        staging = f"{self.path}/staging"
        remove_dir(self.spark, staging)
        spread(close_books(pnl, by=("day", *KEYS)), "day").write.partitionBy("day").parquet(f"{staging}/totals")
        new = self.spark.read.schema(BOOK_SCHEMA).option("basePath", f"{staging}/totals").parquet(f"{staging}/totals").drop("day")
        add_books(before.unionByName(new)).write.parquet(f"{staging}/snapshot")
        make_dir(self.spark, f"{self.path}/totals")
        make_dir(self.spark, f"{self.path}/snapshots")
        for name in list_dir(self.spark, f"{staging}/totals"):
            if name.startswith("day="):
                remove_dir(self.spark, f"{self.path}/totals/{name}")
                move_dir(self.spark, f"{staging}/totals/{name}", f"{self.path}/totals/{name}")
        # The snapshot comes last: it is what makes the days count as closed.
        move_dir(self.spark, f"{staging}/snapshot", f"{self.path}/snapshots/day={end.isoformat()}")
        remove_dir(self.spark, staging)

    def reopen(self, day: date) -> None:
        """Forget all closings from a day on, as after a late swap; ``close`` then does them again."""
        for d in sorted((d for d in self._days("snapshots") if d > day), reverse=True):
            remove_dir(self.spark, f"{self.path}/snapshots/day={d.isoformat()}")
        # Days between the last snapshot left and this one are closed again as well.
        kept = self.closed_until()
        for d in self._days("totals"):
            if kept is None or d >= kept:
                remove_dir(self.spark, f"{self.path}/totals/day={d.isoformat()}")

    def pnl(self, start: datetime, end: datetime | None = None) -> DataFrame:
        """Profit rows of ``start <= time < end``, as ``swap_pnl`` of all swaps gives them."""
        closed = self.closed_until()
        if closed is None:
            base, books = None, self.spark.createDataFrame([], BOOK_SCHEMA)
        else:
            base = min(start.date(), closed)
            first = self.swaps.extent()[0].date()
            books = self.at(base) if base > first else self.spark.createDataFrame([], BOOK_SCHEMA)
            base = base if base > first else None
        rows = self.swaps.read(start=None if base is None else _midnight(base), end=end)
        return swap_pnl_from_books(rows, books, self.max_rows).filter(F.col("time") >= F.lit(start).cast("timestamp_ntz"))
