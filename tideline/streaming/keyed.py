"""Last prices in keyed state: a batch touches the symbols that it brings, not the whole table.

Every task first reduces its ticks to the newest of each symbol, so a symbol that dominates
a batch reaches its state as one row per task. The state holds the place of the newest tick
seen; a batch emits the symbols whose place moved, and the table of last prices is the
newest row of each symbol among all that was emitted.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from tideline.operators.lastprice import merge_last_prices
from tideline.sources.store import make_dir

PROVIDER_KEY = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
CHANGES_SCHEMA = "symbol STRING, time TIMESTAMP_NTZ, tie LONG, price DOUBLE"
_NARROW = "symbol STRING, micros LONG, tie LONG, price DOUBLE"
#: Symbols that a task holds before it passes them on.
HELD = 200_000


def _newest(table: pa.Table) -> pa.Table:
    """The newest row of each symbol; of equal places the highest price."""
    ordered = table.sort_by([("symbol", "ascending"), ("micros", "descending"), ("tie", "descending"), ("price", "descending")])
    symbols = ordered["symbol"].combine_chunks()
    if len(symbols) < 2:
        return ordered
    new = pc.not_equal(symbols[1:], symbols[:-1])
    return ordered.filter(pa.concat_arrays([pa.array([True]), new]))


def newest_per_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: pa.Table | None = None
    for batch in batches:
        rows = pa.Table.from_batches([batch])
        held = _newest(rows if held is None else pa.concat_tables([held, rows]))
        if held.num_rows > HELD:
            yield from held.to_batches()
            held = None
    if held is not None:
        yield from held.to_batches()


class NewestPrice(StatefulProcessor):
    """Lets a symbol's row through if it is newer than all before, and keeps its place."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.seen = handle.getValueState("seen", "micros LONG, tie LONG")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        best = max((tuple(r) for frame in rows for r in frame[["micros", "tie", "price"]].itertuples(index=False)), default=None)
        if best is None:
            return
        place = (int(best[0]), int(best[1]))
        if self.seen.exists() and place <= tuple(self.seen.get()):
            return
        self.seen.update(place)
        yield pd.DataFrame({"symbol": [key[0]], "micros": [place[0]], "tie": [place[1]], "price": [float(best[2])]})

    def close(self) -> None:
        pass


def price_changes(ticks: DataFrame, tiebreak: str = "tick_id") -> DataFrame:
    """A stream of (symbol, time, tie, price): per batch the symbols with a newer tick.

    Ticks without symbol, time or price change nothing. The state is one place per symbol and
    doesn't expire: clock time would keep a stream that ends with its input from ending.
    """
    micros = F.unix_micros(F.col("time").cast("timestamp"))
    narrow = ticks.filter("symbol IS NOT NULL AND time IS NOT NULL AND price IS NOT NULL").select(
        "symbol", micros.alias("micros"), F.coalesce(F.col(tiebreak).cast("long"), F.lit(-(1 << 63)).cast("long")).alias("tie"), F.col("price").cast("double").alias("price")
    )
    changed = (
        narrow.mapInArrow(newest_per_task, _NARROW)
        .groupBy("symbol")
        .transformWithStateInPandas(NewestPrice(), _NARROW, outputMode="Update", timeMode="None")
    )
    return changed.select("symbol", F.timestamp_micros("micros").cast("timestamp_ntz").alias("time"), "tie", "price")


@contextmanager
def rocksdb(spark: SparkSession) -> Iterator[None]:
    """Streams started inside keep their state in RocksDB, which keyed processors need."""
    before = spark.conf.get(PROVIDER_KEY, None)
    spark.conf.set(PROVIDER_KEY, ROCKSDB)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(PROVIDER_KEY)
        else:
            spark.conf.set(PROVIDER_KEY, before)


def keep_changes(changes: DataFrame, target: str, checkpoint: str) -> None:
    """Write the changes of everything that has arrived, a folder per batch, then stop.

    A batch that runs again replaces its folder. Continues where it left off.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{target}/batch={batch_id}")

    with rocksdb(changes.sparkSession):
        query = (
            changes.writeStream.foreachBatch(write)
            .option("checkpointLocation", checkpoint)
            .outputMode("update")
            .trigger(availableNow=True)
            .start()
        )
        query.awaitTermination()


def last_prices(spark: SparkSession, target: str, seeds: DataFrame, seeded_only: bool = True) -> DataFrame:
    """The symbol table: the newest change of each symbol, and seeds that saw none."""
    make_dir(spark, target)
    changes = spark.read.schema(CHANGES_SCHEMA).parquet(target)
    return merge_last_prices(seeds.select("symbol", "last_price", "last_price_at"), changes, seeded_only, "tie")
