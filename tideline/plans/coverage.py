"""Which buckets a set of time ranges covers, as data that is joined.

Buckets of one width are numbered from the origin and kept in blocks of ``BLOCK`` of them. A block
that is covered in full is a bare number, one covered in part has a bitmap. Testing rows
against any number of ranges is then one equi-join on the block, and the query plan is
the same for one range as for thousands.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime, timedelta

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tideline.functions.buckets import FIXED_ORIGIN, MONTH_ORIGIN, is_calendar, width_micros, width_months
from tideline.sources.store import _fs, list_dir, remove_dir

Range = tuple[datetime, datetime]
BLOCK = 4096


def ordinal(moment: datetime, width: str) -> int:
    """The number of the bucket that holds a moment."""
    if is_calendar(width):
        return ((moment.year - MONTH_ORIGIN.year) * 12 + moment.month - MONTH_ORIGIN.month) // width_months(width)
    return (moment - FIXED_ORIGIN) // timedelta(microseconds=width_micros(width))


def bucket_number(width: str, time: str) -> Column:
    """The same for a column."""
    col = F.col(time)
    if is_calendar(width):
        months = (F.year(col) - MONTH_ORIGIN.year) * 12 + F.month(col) - MONTH_ORIGIN.month
        return F.floor(months / width_months(width))
    # Days, and microseconds of the day from its parts, so that no time zone comes in.
    days = F.datediff(col, F.lit(FIXED_ORIGIN.date())).cast("long")
    seconds = (F.hour(col) * 3600 + F.minute(col) * 60).cast("long")
    clock = seconds * 1_000_000 + (F.extract(F.lit("SECOND"), col) * 1_000_000).cast("long")
    return F.floor((days * 86_400_000_000 + clock) / width_micros(width))


def blocks(ranges: Sequence[Range], width: str) -> list[tuple[int, bytearray | None]]:
    """Numbers of the blocks that disjoint ranges of whole buckets cover; bits of those covered in part."""
    partial: dict[int, np.ndarray] = {}
    full: set[int] = set()
    for low, high in ranges:
        at, end = ordinal(low, width), ordinal(high, width)
        while at < end:
            number, first = divmod(at, BLOCK)
            upto = min(end, (number + 1) * BLOCK)
            if upto - at == BLOCK:
                full.add(number)
            else:
                partial.setdefault(number, np.zeros(BLOCK, np.uint8))[first : upto - number * BLOCK] = 1
            at = upto
    return [(n, None) for n in sorted(full)] + [(n, bytearray(np.packbits(b, bitorder="little").tobytes())) for n, b in sorted(partial.items())]


def inside(rows: DataFrame, ranges: Sequence[Range], width: str, time: str, covered: bool = True) -> DataFrame:
    """Rows whose time lies in one of the ranges, or in none of them.

    Ranges are disjoint and made of whole buckets of ``width``. One range is a pair of bounds, which
    reach the scan; of several only their chunks should be read in the first place.
    """
    if not ranges:
        return rows.limit(0) if covered else rows
    if len(ranges) == 1:
        low, high = (F.lit(m).cast("timestamp_ntz") for m in ranges[0])
        within = (F.col(time) >= low) & (F.col(time) < high)
        return rows.filter(within if covered else ~within)
    found = rows.sparkSession.createDataFrame(blocks(ranges, width), "_block long, _bits binary")
    numbered = rows.withColumn("_number", bucket_number(width, time))
    numbered = numbered.withColumn("_block", F.floor(F.col("_number") / BLOCK)).withColumn("_at", (F.col("_number") - F.col("_block") * BLOCK).cast("int"))
    joined = numbered.join(found.withColumn("_found", F.lit(True)), "_block", "left")
    byte = F.conv(F.hex(F.expr("substring(_bits, _at div 8 + 1, 1)")), 16, 10).cast("int")
    bit = F.expr("_at % 8")
    is_set = F.when(F.col("_found").isNull(), False).when(F.col("_bits").isNull(), True).otherwise(F.call_function("getbit", byte, bit) == 1)
    return joined.filter(is_set if covered else ~is_set).select(*rows.columns)


class RangeList:
    """Sorted, disjoint ranges, kept as a small text file and written without a Spark job.

    A new file is written before the one it replaces goes, so a list is never half there.
    """

    def __init__(self, spark, folder: str):
        self.spark, self.folder = spark, folder

    def _numbers(self) -> list[int]:
        return sorted(int(n) for n in list_dir(self.spark, self.folder) if n.isdigit())

    def read(self) -> list[Range]:
        numbers = self._numbers()
        if not numbers:
            return []
        fs, path = _fs(self.spark, f"{self.folder}/{numbers[-1]}")
        stream = fs.open(path)
        try:
            text = self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()
        moments = [datetime.fromisoformat(m) for m in text.split()]
        return list(zip(moments[::2], moments[1::2]))

    def write(self, ranges: Sequence[Range]) -> None:
        numbers = self._numbers()
        number = max(numbers, default=0) + 1
        fs, partial = _fs(self.spark, f"{self.folder}/.{number}")
        stream = fs.create(partial, True)
        try:
            stream.write(bytearray("\n".join(m.isoformat() for r in ranges for m in r).encode()))
        finally:
            stream.close()
        if not fs.rename(partial, _fs(self.spark, f"{self.folder}/{number}")[1]):
            raise OSError(f"could not write the ranges in {self.folder}")
        for old in numbers:
            remove_dir(self.spark, f"{self.folder}/{old}")
