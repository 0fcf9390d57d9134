"""Last prices and pair ticks, updated with every micro-batch.

The symbol table is small and versioned by batch: batch ``n`` reads version ``n - 1`` and
writes version ``n``, so a batch that is run again after a failure gives the same result.
Within a batch the work is the ordinary batch operator, which spreads a symbol or pair
that dominates the batch; no key's rows are fed through one stateful task.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tideline.functions.buckets import shift
from tideline.functions.scalars import pair_leg, ratio, round_half_up
from tideline.operators.lastprice import merge_last_prices
from tideline.operators.ordered import MAX_ROWS, OrderedScan, running_last
from tideline.operators.pairs import PAIR_DECIMALS, pair_legs, pair_ticks
from tideline.plans.cagg import merge_ranges
from tideline.plans.nearest import nearest_rows
from tideline.session import stored
from tideline.sources.store import ChunkTable, list_dir, make_dir, remove_dir

SYMBOLS_SCHEMA = "symbol STRING, last_price DOUBLE, last_price_at TIMESTAMP_NTZ"
KEPT_VERSIONS = 3
PAIR_TICK_COLUMNS = ("time", "tick_id", "symbol", "price", "volume")


class SymbolVersions:
    """The symbol table after each batch, one folder per version."""

    def __init__(self, spark: SparkSession, path: str, seeds: DataFrame):
        self.spark, self.path, self.seeds = spark, path, seeds

    def _numbers(self) -> list[int]:
        names = list_dir(self.spark, self.path)
        numbers = [int(n.split("=", 1)[1]) for n in names if n.startswith("version=")]
        return [n for n in numbers if "_SUCCESS" in list_dir(self.spark, self._folder(n))]

    def _folder(self, number: int) -> str:
        return f"{self.path}/version={number}"

    def before(self, batch_id: int) -> DataFrame:
        """The symbols as they stood before a batch; those of a batch too old to know are refused."""
        numbers = self._numbers()
        earlier = [n for n in numbers if n < batch_id]
        if not earlier and numbers and batch_id > 0:
            raise ValueError(f"the symbols before batch {batch_id} are no longer kept")
        if not earlier:
            return self.seeds.select("symbol", "last_price", "last_price_at")
        return self.spark.read.schema(SYMBOLS_SCHEMA).parquet(self._folder(max(earlier)))

    def latest(self) -> DataFrame:
        return self.before(max(self._numbers(), default=-1) + 1)

    def save(self, batch_id: int, symbols: DataFrame) -> None:
        symbols.write.mode("overwrite").parquet(self._folder(batch_id))
        for n in self._numbers():
            if n <= batch_id - KEPT_VERSIONS:
                remove_dir(self.spark, self._folder(n))


def last_price_updater(
    versions: SymbolVersions, seeded_only: bool = True, tiebreak: str | None = None
) -> Callable[[DataFrame, int], None]:
    """A batch handler that keeps the symbol table current; the newest time wins.

    Of a batch's ticks of one time the greatest ``tiebreak`` wins, so a batch that runs again
    stores the same price; without one it may be any of them.
    """

    def handle(batch: DataFrame, batch_id: int) -> None:
        known = versions.before(batch_id)
        versions.save(batch_id, merge_last_prices(known, batch, seeded_only, tiebreak))

    return handle


def fresh_ticks(ticks: DataFrame, known: DataFrame) -> DataFrame:
    """Ticks of known symbols that are not older than the symbol's last price."""
    seen = known.select(F.col("symbol").alias("_symbol"), F.col("last_price_at").alias("_seen"))
    return (
        ticks.join(seen, F.col("symbol") == F.col("_symbol"))
        .filter(F.col("_seen").isNull() | (F.col("time") >= F.col("_seen")))
        .select(*ticks.columns)
    )


def pair_tick_updater(
    versions: SymbolVersions, pairs: DataFrame, target: str
) -> Callable[[DataFrame, int], None]:
    """A batch handler that emits pair ticks and keeps the symbol table current.

    Pair ticks go to their own table, one folder per batch that is overwritten when the
    batch is run again. Ticks older than their symbol's last price emit nothing.
    """

    def handle(batch: DataFrame, batch_id: int) -> None:
        batch.persist(StorageLevel.MEMORY_AND_DISK)
        known = versions.before(batch_id)
        emitted = pair_ticks(fresh_ticks(batch, known), pairs, known)
        emitted.write.mode("overwrite").parquet(f"{target}/batch={batch_id}")
        versions.save(batch_id, merge_last_prices(known, batch))
        batch.unpersist()

    return handle


def emitted_ticks(spark: SparkSession, target: str, schema: T.StructType) -> DataFrame:
    """All pair ticks written so far; none before the first batch."""
    make_dir(spark, target)
    columns = PAIR_TICK_COLUMNS
    return spark.read.schema(T.StructType([schema[c] for c in columns])).parquet(target).select(*columns)


def pair_table(raw: ChunkTable, path: str) -> ChunkTable:
    """A table for the pair ticks of a tick table, in chunks of the same width."""
    columns = T.StructType([raw.schema[c] for c in PAIR_TICK_COLUMNS])
    return ChunkTable(raw.spark, path, columns, raw.time_col, ("symbol",), raw.chunk_interval, raw.compact_interval)


def late_legs(raw: ChunkTable, pairs: DataFrame, late: DataFrame) -> DataFrame:
    """One row per late tick and tracked pair of its symbol: which pair ticks it affects.

    A tick counts from its own place in the order (time, tick_id) to the next tick of its
    symbol, which may be days later. Columns: symbol_pair, leg, other (the other leg's symbol),
    time, tick_id, price and until, the place of the next tick (null: none yet).
    """
    ticks = stored(late.select("symbol", "time", "tick_id", "price").distinct(), "late")
    after = nearest_rows(raw, ticks, ["price"], forward=True)
    until = after.select("symbol", "time", "tick_id", F.struct("found.time", "found.tick_id").alias("_until"), F.col("found").isNotNull().alias("_ends"))
    bounded = ticks.join(until, ["symbol", "time", "tick_id"])
    legs = pair_legs(pairs.select("symbol_pair"))
    other = pair_leg("symbol_pair", 1)
    return bounded.join(legs, bounded["symbol"] == legs["leg_symbol"]).select(
        "symbol_pair", "leg", F.when(F.col("leg") == 2, other).otherwise(pair_leg("symbol_pair", 2)).alias("other"),
        "time", "tick_id", "price", F.when(F.col("_ends"), F.col("_until")).alias("until"),
    )


def _touched(raw: ChunkTable, legs: DataFrame) -> list[tuple[datetime, datetime]]:
    """The time ranges of the affected intervals, joined where they meet; one row per pair of days at most reaches the driver."""
    extent = raw.extent()
    day = lambda c: F.date_trunc("day", c).cast("timestamp_ntz")
    last = F.coalesce(day(F.col("until.time")), F.lit(extent[1]).cast("timestamp_ntz"))
    days = legs.select(day(F.col("time")).alias("low"), last.alias("high")).distinct().collect()
    return merge_ranges([(r["low"], shift(r["high"], "1 day")) for r in days])


def affected_pair_ticks(
    raw: ChunkTable, legs: DataFrame, symbols: DataFrame | None = None, max_rows: int = MAX_ROWS
) -> DataFrame:
    """Pair ticks inside the affected intervals, worked out anew; price is null where none is due.

    Inside an interval the late leg's price doesn't change, so the other leg's ticks are all it
    takes; the late tick's own row needs the other leg's last price before it. Two late ticks, one
    of each leg, give the same row twice.
    """
    ranges = _touched(raw, legs)
    mine = F.when(F.col("leg") == 1, pair_leg("symbol_pair", 1)).otherwise(pair_leg("symbol_pair", 2))
    ways = stored(legs.select(mine.alias("mine"), "other", "symbol_pair", "leg").distinct(), "ways")
    # Both pairs of two symbols share one scan; either has all marks.
    either = ways.groupBy("mine", "other").agg(F.min(F.struct("symbol_pair", "leg")).alias("_way"))
    keys = either.select("mine", "other")
    nothing = F.lit(None).cast("double")
    marks = legs.join(either.select("mine", "_way.*"), ["symbol_pair", "leg"]).select(
        "mine", "other", "time", "tick_id", F.struct("price", "until").alias("_late"), nothing.alias("_price"), F.lit(0).alias("_kind")
    )
    never = F.lit(None).cast(marks.schema["_late"].dataType).alias("_late")

    def theirs(rows: DataFrame, kind: int) -> DataFrame:
        return rows.join(keys, F.col("symbol") == F.col("other")).select(
            "mine", "other", "time", "tick_id", never, F.col("price").cast("double").alias("_price"), F.lit(kind).alias("_kind")
        )

    # Every range begins with the last prices before it, so none is carried over what isn't read.
    least = F.lit(-(2**63) if raw.schema["tick_id"].dataType == T.LongType() else -(2**31)).alias("tick_id")
    starts = raw.spark.createDataFrame([(low,) for low, _ in ranges], "time timestamp_ntz")
    points = starts.crossJoin(keys.select(F.col("other").alias("symbol")).distinct()).select("symbol", "time", least)
    before = nearest_rows(raw, points, ["price"], max_rows=max_rows).select("symbol", "time", "tick_id", F.col("found.price").alias("price"))
    within = raw.read_ranges(ranges)
    rows = marks.unionByName(theirs(before, -1)).unionByName(theirs(within, 1))
    # Rows per key follow from the ticks per symbol, before the fan-out over symbols.
    counts = within.groupBy("symbol").count().join(keys, F.col("symbol") == F.col("other")).select("mine", "other", "count")
    sizes = counts.unionByName(marks.groupBy("mine", "other").count()).groupBy("mine", "other").agg(F.sum("count").alias("count"))
    scan = OrderedScan.of(rows, ["mine", "other"], ["time", "tick_id", "_kind"], max_rows, sizes).running(
        {"_in": running_last(F.col("_late")), "_seen": running_last(F.col("_price"))}
    )
    inside = F.col("_in.until").isNull() | (F.struct("time", "tick_id") < F.col("_in.until"))
    wanted = (F.col("_kind") == 0) | ((F.col("_kind") == 1) & F.col("_in").isNotNull() & inside)
    found = scan.frame().filter(wanted).select(
        "mine", "other", "time", "tick_id",
        F.when(F.col("_kind") == 0, F.col("_late.price")).otherwise(F.col("_in.price")).alias("_late"),
        F.when(F.col("_kind") == 0, F.col("_seen")).otherwise(F.col("_price")).alias("_other"), "_kind",
    )
    if symbols is not None:
        seeds = symbols.select(F.col("symbol").alias("other"), F.col("last_price").alias("_seed"))
        other = F.when(F.col("_kind") == 0, F.coalesce("_other", "_seed")).otherwise(F.col("_other"))
        found = found.join(seeds, "other", "left").withColumn("_other", other)
    rows = found.join(ways, ["mine", "other"])
    first = F.when(F.col("leg") == 1, F.col("_late")).otherwise(F.col("_other"))
    second = F.when(F.col("leg") == 1, F.col("_other")).otherwise(F.col("_late"))
    price = round_half_up(ratio(first, second), PAIR_DECIMALS)
    return rows.select("time", "tick_id", F.col("symbol_pair").alias("symbol"), price.alias("price"), F.lit(1.0).alias("volume"))


def repair_pair_ticks(
    raw: ChunkTable,
    pairs: DataFrame,
    emitted: ChunkTable,
    late: DataFrame,
    symbols: DataFrame | None = None,
    max_rows: int = MAX_ROWS,
) -> None:
    """Correct the pair ticks that late ticks change, and add those they cause.

    ``late`` are ticks that ``raw`` holds by now and that ``emitted`` doesn't reflect; afterwards it equals
    ``pair_ticks`` of all ticks. Only chunks between a late tick and the next tick of its
    symbol are read and written, and those needed to find that tick and the other leg's last price.
    ``symbols`` are prices known before the first tick. May run again after a failure.
    """
    raw = raw.snapshot()
    legs = stored(late_legs(raw, pairs, late), "late-legs")
    if legs.isEmpty():
        return
    fresh = stored(affected_pair_ticks(raw, legs, symbols, max_rows), "repaired")
    days = sorted(r["day"] for r in fresh.select(F.to_date("time").alias("day")).distinct().collect())
    ranges = merge_ranges([(start, shift(start, "1 day")) for start in (datetime.combine(d, datetime.min.time()) for d in days)])
    emitted.replace_rows(fresh, ["symbol", "time", "tick_id"], emitted.touched(ranges), F.col("price").isNotNull())


def newest_partner(known: DataFrame, pairs: DataFrame) -> DataFrame:
    """Per symbol the newest time of any symbol it is paired with, its own included."""
    legs = pair_legs(pairs.select("symbol_pair"))
    seen = known.select(F.col("symbol").alias("leg_symbol"), "last_price_at")
    of_pair = legs.join(seen, "leg_symbol").groupBy("symbol_pair").agg(F.max("last_price_at").alias("_newest"))
    return legs.join(of_pair, "symbol_pair").groupBy(F.col("leg_symbol").alias("symbol")).agg(F.max("_newest").alias("_newest"))


def exact_pair_updater(
    versions: SymbolVersions, pairs: DataFrame, raw: ChunkTable, emitted: ChunkTable
) -> Callable[[DataFrame, int], None]:
    """A batch handler after which ``emitted`` equals ``pair_ticks`` of all ticks so far, late ones included.

    Ticks newer than all that was seen of their symbol and its partners are appended; all others
    correct what is stored.
    """

    def handle(batch: DataFrame, batch_id: int) -> None:
        batch.persist(StorageLevel.MEMORY_AND_DISK)
        known = versions.before(batch_id)
        raw.append(batch, batch_id)
        split = batch.join(newest_partner(known, pairs), "symbol", "left")
        on_time = F.col("_newest").isNull() | (F.col("time") > F.col("_newest"))
        news = split.filter(on_time).select(*batch.columns)
        emitted.append(pair_ticks(news, pairs, known), batch_id)
        repair_pair_ticks(raw, pairs, emitted, split.filter(~on_time).select(*batch.columns), versions.seeds)
        versions.save(batch_id, merge_last_prices(known, batch, tiebreak="tick_id"))
        batch.unpersist()

    return handle
