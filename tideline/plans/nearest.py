"""Rows next to given moments, found by opening chunks in growing steps.

The newest tick of a symbol, or the last one before and the first one after a moment, lie in
the nearest chunk that has any tick of the symbol. So chunks are opened from the moment
outwards, one, two, four and so on at a time, and only while something is still wanted. What a
search opens is at most about twice what it needs, however long the history is.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections.abc import Iterator, Sequence
from datetime import date, datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tideline.functions.buckets import floor_time, shift, time_bucket
from tideline.operators.ordered import MAX_ROWS, OrderedScan, running_last
from tideline.session import stored
from tideline.sources.store import ChunkTable

UNIT = "_unit"


def units(table: ChunkTable) -> list[tuple[datetime, list[date]]]:
    """Stored chunks by the widest interval that a chunk may cover, oldest first.

    Rows of different units never overlap in time, while a compacted chunk and a plain one may.
    """
    found: dict[datetime, list[date]] = {}
    for chunk in table.chunks():
        start = floor_time(datetime.combine(chunk, datetime.min.time()), table._widest)
        found.setdefault(start, []).append(chunk)
    return sorted(found.items())


def steps(count: int) -> Iterator[tuple[int, int]]:
    """Half-open runs of 1, 2, 4, ... positions that cover ``count`` of them."""
    low = 0
    while low < count:
        yield low, min(2 * low + 1, count)
        low = 2 * low + 1


def newest_rows(
    table: ChunkTable, n: int, where: Column | None = None, tiebreak: Sequence[str] = ()
) -> DataFrame:
    """The n newest rows that meet a condition, newest first.

    Older chunks are opened only while fewer than n rows were found. Rows equal in time and
    ``tiebreak`` are in no order of their own.
    """
    found = units(table)[::-1]
    opened: list[date] = []
    for low, high in steps(len(found)):
        opened += [c for _, chunks in found[low:high] for c in chunks]
        rows = table.read(chunks=opened)
        rows = rows if where is None else rows.filter(where)
        if high == len(found) or rows.limit(n).count() == n:
            return rows.orderBy(F.col(table.time_col).desc(), *(F.col(c).desc() for c in tiebreak)).limit(n)
    return table.read().limit(0)


def _signed(table: ChunkTable, tiebreak: str, forward: bool) -> list[Column]:
    """Time and tiebreak as numbers that grow away from later rows, or from earlier ones."""
    sign = F.lit(-1 if forward else 1)
    return [(sign * F.unix_micros(F.col(table.time_col).cast("timestamp"))).alias("_t"), (sign * F.col(tiebreak)).alias("_i")]


def nearest_rows(
    table: ChunkTable,
    points: DataFrame,
    values: Sequence[str],
    forward: bool = False,
    tiebreak: str = "tick_id",
    max_rows: int = MAX_ROWS,
) -> DataFrame:
    """Points with ``found``: the nearest row of their series strictly before them, or after them.

    ``points`` has the table's series columns (not null), its time and the tiebreak, a whole number that
    tells rows of one time apart. ``found`` has time, tiebreak and ``values``, and is null where
    the table has no such row. A moment's own chunk is searched with one ordered scan; beyond it
    the outermost row of a series in each chunk is enough, an aggregate with map-side partials.
    """
    spark, time, series = table.spark, table.time_col, list(table.series_cols)
    columns = [*series, time, tiebreak]
    place = time_bucket(table._widest, time).alias(UNIT)
    row = F.struct(F.col(time).alias("time"), F.col(tiebreak).alias(tiebreak), *values)
    points = stored(points.select(*columns).distinct().withColumn(UNIT, place), "points")
    stored_units = units(table)
    starts = [start for start, _ in stored_units]
    # One row per chunk that has a point.
    places = sorted(r[UNIT] for r in points.select(UNIT).distinct().collect())
    wanted = points.select(*series).distinct()

    def opened(numbers: Sequence[int]) -> DataFrame:
        chunks = [c for n in numbers for c in stored_units[n][1]]
        return table.read(chunks=chunks).join(wanted, series, "left_semi").withColumn(UNIT, place)

    own = [bisect_left(starts, p) for p in places if p in set(starts)]
    rows = opened(own).select(*columns, UNIT, row.alias("_row"), F.lit(1).alias("_kind"))
    marks = points.select(*columns, UNIT, F.lit(None).cast(rows.schema["_row"].dataType).alias("_row"), F.lit(0).alias("_kind"))
    both = marks.unionByName(rows).select("*", *_signed(table, tiebreak, forward))
    # A point stands before its own row, so it finds neither that nor anything beyond.
    scan = OrderedScan.of(both, [*series, UNIT], ["_t", "_i", "_kind"], max_rows).running({"found": running_last(F.col("_row"))})
    near = stored(scan.frame().filter("_kind = 0").select(*columns, UNIT, "found"), "near")

    pieces = [near.filter("found IS NOT NULL")]
    open_ = stored(near.filter("found IS NULL").select(*series, UNIT).distinct(), "open")
    bases = {p: bisect_right(starts, p) if forward else bisect_left(starts, p) - 1 for p in places}
    far = None
    for low, high in steps(len(starts)):
        left = {r[UNIT] for r in open_.select(UNIT).distinct().collect()}
        spans = []
        for p in left:
            first, last = (bases[p] + low, bases[p] + high - 1) if forward else (bases[p] - high + 1, bases[p] - low)
            if first < len(starts) and last >= 0:
                spans.append((p, max(first, 0), min(last, len(starts) - 1)))
        if not spans:
            break
        numbers = sorted({n for _, first, last in spans for n in range(first, last + 1)})
        ranked = F.struct(*_signed(table, tiebreak, forward), row.alias("row"))
        edge = opened(numbers).join(open_.select(*series).distinct(), series, "left_semi").groupBy(*series, F.col(UNIT).alias("_there")).agg(F.max(ranked).alias("best"))
        numbered = spark.createDataFrame([(starts[n], n) for n in numbers], "_there timestamp_ntz, _number long")
        spanned = spark.createDataFrame(spans, f"{UNIT} timestamp_ntz, _first long, _last long")
        met = open_.join(spanned, UNIT).join(edge.join(numbered, "_there"), series).filter("_number BETWEEN _first AND _last")
        hits = stored(met.groupBy(*series, UNIT).agg(F.max("best").alias("best")).select(*series, UNIT, F.col("best.row").alias("found")), "hits")
        far = hits if far is None else far.unionByName(hits)
        open_ = stored(open_.join(hits, [*series, UNIT], "left_anti"), "open")
    rest = near.filter("found IS NULL").drop("found")
    if far is None:
        pieces.append(near.filter("found IS NULL"))
    else:
        pieces.append(rest.join(far, [*series, UNIT], "left").select(*columns, UNIT, "found"))
    return pieces[0].unionByName(pieces[1]).drop(UNIT)


def newest_per_series(
    table: ChunkTable, wanted: DataFrame, values: Sequence[str], tiebreak: str = "tick_id"
) -> DataFrame:
    """The newest row of each wanted series: its columns, time, tiebreak and values.

    Series without any row are left out.
    """
    extent = table.extent()
    past = shift(extent[1], "1 microsecond") if extent else datetime(1970, 1, 1)
    kind = table.schema[tiebreak].dataType
    points = wanted.select(
        *table.series_cols, F.lit(past).cast("timestamp_ntz").alias(table.time_col), F.lit(0).cast(kind).alias(tiebreak)
    )
    found = nearest_rows(table, points, values, tiebreak=tiebreak).filter("found IS NOT NULL")
    return found.select(*table.series_cols, F.col("found.time").alias(table.time_col), *(F.col(f"found.{c}").alias(c) for c in (tiebreak, *values)))
