"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager
from typing import Any

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tideline.session import stored

#: ASCII white space as the contracts define it: blank and \x09 to \x0D.
SPACE = r"\x20\x09-\x0D"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_of(column: str = "text") -> Column:
    """The text, with null read as empty."""
    return F.coalesce(F.col(column), F.lit(""))


def fold_of(key: str, folds: int) -> Column:
    """crc32 of the key as text, modulo ``folds``; a null key counts as an empty one."""
    return F.crc32(F.coalesce(F.col(key).cast("string"), F.lit("")).cast("binary")) % folds


def shuffle_parts(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def numbered_parts(rows: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Rows in range partitions by key and order, stored with the partition's number."""
    parts = shuffle_parts(rows.sparkSession)
    return stored(
        rows.repartitionByRange(parts, *keys, *order).withColumn("_part", F.spark_partition_id()),
        "ordered",
    )


def running_total(
    rows: DataFrame, keys: Sequence[str], order: Sequence[str], weight: Column, name: str
) -> DataFrame:
    """Add the sum of ``weight`` over all earlier rows of the same key.

    A key may hold most rows: its rows are spread over range partitions, each adds up
    its own, and the sums of the partitions before are a window over few rows.
    ``order`` must tell any two rows of a key apart; keys are not null.
    """
    placed = numbered_parts(rows, keys, order)
    cells = [*keys, "_part"]
    earlier = Window.partitionBy(*keys).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    carries = (
        placed.groupBy(*cells)
        .agg(F.sum(weight).alias("_sum"))
        .select(*cells, F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias("_carry"))
    )
    within = Window.partitionBy(*cells).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    local = F.coalesce(F.sum(weight).over(within), F.lit(0))
    return (
        placed.withColumn("_local", local)
        .join(carries, cells)
        .withColumn(name, F.col("_carry") + F.col("_local"))
        .drop("_part", "_local", "_carry")
    )


def slices(batches: Iterator[pa.RecordBatch], column: str = "text", most: int = 2 << 20) -> Iterator[pa.RecordBatch]:
    """Batches cut so that each holds about ``most`` bytes of text, one row at least.

    A worker's lists of words take many times the memory of the text.
    """
    for batch in batches:
        ends = pc.cumulative_sum(pc.binary_length(batch.column(column)).cast(pa.int64())).to_pylist()
        start = done = 0
        for i, end in enumerate(ends):
            if end - done > most and i > start:
                yield batch.slice(start, i - start)
                start, done = i, ends[i - 1]
        if start < len(ends):
            yield batch.slice(start)


BATCH_KEY = "spark.sql.execution.arrow.maxRecordsPerBatch"
#: Rows that go to a worker at once. By default a task's texts all went in one batch, which
#: the executor holds outside its heap, twice while it grows, and the worker once more.
BATCH_ROWS = 1000


@contextmanager
def small_batches(spark: SparkSession) -> Iterator[None]:
    """Have what runs inside send few rows to workers at once; what is lazy must be written before the block ends."""
    before = spark.conf.get(BATCH_KEY)
    spark.conf.set(BATCH_KEY, min(BATCH_ROWS, int(before)) if int(before) > 0 else BATCH_ROWS)
    try:
        yield
    finally:
        spark.conf.set(BATCH_KEY, before)


#: Most bytes of keys that are sent to all workers; more are joined by shuffling.
BROADCAST_BYTES = 32 << 20


def text_key(column: str = "text") -> Column:
    return F.xxhash64(column)


def keyed(docs: DataFrame) -> DataFrame:
    """Documents as (row, doc_id, text_key): what names a document beside columns of any name."""
    return docs.select(F.struct("*").alias("row"), "doc_id", text_key().alias("text_key"))


def join_keys(rows: DataFrame, keys: DataFrame, how: str, size: int | None = None) -> DataFrame:
    """Join on (doc_id, text_key), null equal to null; ``keys`` is stored and goes to all workers if small.

    ``size`` is its bytes where it has columns of any length; without it has 24 a row.
    """
    if (keys.count() * 24 if size is None else size) <= BROADCAST_BYTES:
        keys = F.broadcast(keys)
    same = rows["doc_id"].eqNullSafe(keys["doc_id"]) & rows["text_key"].eqNullSafe(keys["text_key"])
    found = rows.join(keys, same, how)
    return found if how in ("left_semi", "left_anti") else found.drop(keys["doc_id"], keys["text_key"])


def give_back() -> None:
    """Return the memory that this worker no longer uses."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):
        pass  # only the GNU C library gives memory back this way


_held: dict[Any, Any] = {}


def worker_state(key: Any, make: Callable[[], Any]) -> Any:
    """What a worker keeps between tasks, such as a model and its cache; one thing at a time.

    Workers outlive stages. Dropping what an earlier stage left keeps a pipeline's memory
    at that of its largest stage.
    """
    if key not in _held:
        drop_state()
        _held[key] = make()
    return _held[key]


def drop_state() -> None:
    """Drop what earlier tasks of this worker kept; for tasks that keep nothing themselves."""
    if _held:
        _held.clear()
        give_back()
