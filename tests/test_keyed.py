import random

import pyarrow as pa
from pyspark.sql import functions as F

from conftest import make_ticks, plain, random_ticks
from tideline.operators.lastprice import merge_last_prices
from tideline.streaming import keyed, runs


def seeds_of(spark, *symbols):
    return spark.createDataFrame([(s, None, None) for s in symbols], "symbol string, last_price double, last_price_at timestamp_ntz")


def arrive(ticks, folder):
    ticks.coalesce(1).write.mode("append").parquet(folder)


def test_state_equals_batch_over_batches_late_ticks_and_a_restart(spark, folder):
    ticks = random_ticks(spark, 300, hot="A")
    rows = ticks.collect()
    random.Random(3).shuffle(rows)  # late ticks in every batch
    seeds = seeds_of(spark, "A", "B", "Z")
    for part in (rows[:100], rows[100:200], rows[200:]):
        for half in (part[:50], part[50:]):
            arrive(spark.createDataFrame(half, ticks.schema), f"{folder}/in")
        stream = runs.parquet_stream(spark, f"{folder}/in", ticks.schema, files_per_batch=1)
        keyed.keep_changes(keyed.price_changes(stream), f"{folder}/out", f"{folder}/progress")
    got = keyed.last_prices(spark, f"{folder}/out", seeds)
    assert plain(got, "symbol", "last_price", "last_price_at") == plain(merge_last_prices(seeds, ticks, True, "tick_id"), "symbol", "last_price", "last_price_at")
    open_table = keyed.last_prices(spark, f"{folder}/out", seeds, seeded_only=False)
    assert {r["symbol"] for r in open_table.collect()} == {"A", "B", "C", "Z"}
    # Six batches emit each of three symbols at most once; what is older than the state emits nothing.
    emitted = spark.read.schema(keyed.CHANGES_SCHEMA + ", batch INT").parquet(f"{folder}/out").orderBy("batch").collect()
    assert len(emitted) < 18
    for s in "ABC":
        places = [(r["time"], r["tie"]) for r in emitted if r["symbol"] == s]
        assert places == sorted(set(places))


def test_ties_and_ticks_without_a_price_leave_the_table_right(spark, folder):
    seeds = seeds_of(spark, "A", "B")
    parts = [[(5, "A", 1, 0), (5, "A", 2, 0), (1, "B", 7, 0)], [(3, "A", 9, 0), (2, "B", 8, 0)]]
    for part in parts:
        arrive(make_ticks(spark, part), f"{folder}/in")
    arrive(make_ticks(spark, [(9, "A", 1, 0)]).withColumn("price", F.lit(None).cast("double")), f"{folder}/in")
    stream = runs.parquet_stream(spark, f"{folder}/in", make_ticks(spark, parts[0]).schema, files_per_batch=1)
    keyed.keep_changes(keyed.price_changes(stream), f"{folder}/out", f"{folder}/progress")
    got = {r["symbol"]: r["last_price"] for r in keyed.last_prices(spark, f"{folder}/out", seeds).collect()}
    assert got == {"A": 2.0, "B": 8.0}


def test_a_task_passes_on_one_row_per_symbol():
    schema = pa.schema([("symbol", pa.string()), ("micros", pa.int64()), ("tie", pa.int64()), ("price", pa.float64())])
    batch = pa.RecordBatch.from_pylist([{"symbol": "AB"[i % 2], "micros": i // 4, "tie": i, "price": float(i)} for i in range(1000)], schema)
    out = [r for b in keyed.newest_per_task(iter([batch, batch])) for r in b.to_pylist()]
    assert out == [{"symbol": "A", "micros": 249, "tie": 998, "price": 998.0}, {"symbol": "B", "micros": 249, "tie": 999, "price": 999.0}]
