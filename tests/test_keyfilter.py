import random
from datetime import datetime, timedelta


from pyspark.sql import functions as F

from tideline.operators.keyfilter import KeyFilter, blocks_for
from tideline.sources.store import ChunkTable

START = datetime(2024, 1, 1)
SCHEMA = "time timestamp_ntz, symbol string, price double"


def rows_of(spark, days, per_day, seed):
    rng = random.Random(seed)
    rows = [(START + timedelta(days=d, seconds=rng.randrange(86_400)), rng.choice(["A", "B", None]), float(d))
            for d in range(days) for _ in range(per_day)]
    return rows, spark.createDataFrame(rows, SCHEMA)


def made(spark, folder, key=("symbol", "time"), blocks=1, **options):
    df = spark.createDataFrame([], SCHEMA)
    table = ChunkTable(spark, f"{folder}/t", df.schema, series_cols=("symbol",), **options).create()
    return KeyFilter(table, key, blocks)


def got(df):
    return sorted(map(tuple, df.collect()), key=str)


def by_hand(old, new, key):
    stored = {tuple(r[i] for i in key) for r in old}
    counts = {}
    for r in new:
        k = tuple(r[i] for i in key)
        counts[k] = counts.get(k, 0) + 1
    return sorted(((*k, n, k in stored) for k, n in counts.items() if n > 1 or k in stored), key=str)


def test_broken_keys_are_those_of_regrouping_everything(spark, folder):
    keys = made(spark, folder, blocks=3, compact_interval="1 week")
    old, df = rows_of(spark, 12, 30, 1)
    early, late = old[:200], old[200:]
    keys.append(spark.createDataFrame(early, SCHEMA))
    keys.append(spark.createDataFrame(late, SCHEMA))
    rng = random.Random(2)
    fresh, _ = rows_of(spark, 12, 10, 3)
    new = fresh + fresh[:5] + rng.sample(old, 25) + [r for r in old if r[1] is None][:3]
    want = by_hand(old, new, (1, 0))
    assert any(r[0] is None and r[-1] for r in want)
    frame = spark.createDataFrame(new, SCHEMA)
    assert got(keys.check(frame)) == want
    # Chunks merged since are found under their new dates.
    keys.table.compact(START + timedelta(days=30), "1 day")
    assert got(keys.check(frame)) == want


def test_new_keys_open_no_chunks_and_old_ones_only_theirs(spark, folder):
    keys = made(spark, folder, blocks=blocks_for(40))
    old, df = rows_of(spark, 40, 40, 4)
    keys.append(df)
    fresh = spark.createDataFrame([(START + timedelta(days=50, seconds=i), "C", 0.0) for i in range(300)], SCHEMA)
    assert keys.candidates(fresh).count() <= 300 * 40 / 200
    again = spark.createDataFrame([r for r in old if r[2] == 7.0 and r[1]][:5], SCHEMA)
    chunks = {str(r["chunk"]) for r in keys.candidates(again).select("chunk").distinct().collect()}
    assert "2024-01-08" in chunks and len(chunks) <= 3
    opened = keys._open([START.date() + timedelta(days=7)]).select(F.input_file_name()).distinct().collect()
    assert opened and all("chunk=2024-01-08" in f[0] for f in opened)


def test_empty_history_and_empty_appends(spark, folder):
    keys = made(spark, folder, key=("symbol",))
    none = spark.createDataFrame([], SCHEMA)
    keys.append(none)
    assert got(keys.check(none)) == []
    new = spark.createDataFrame([(START, "A", 1.0), (START, "A", 2.0), (START, "B", 1.0)], SCHEMA)
    assert got(keys.check(new)) == [("A", 2, False)]
