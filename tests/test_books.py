import os
import random
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from conftest import plain
from tideline.operators import swaps
from tideline.plans.books import DatedBooks
from tideline.sources.store import ChunkTable

SCHEMA = (
    "id long, time timestamp_ntz, token_address string, token_in double, token_out double, "
    "usd_in double, usd_out double, wallet_address string"
)
START = datetime(2025, 1, 1)


def random_swaps(spark, days=25, n=300, first=0, seed=4):
    rng = random.Random(seed)
    rows = []
    for i in range(first, first + n):
        buy = rng.random() < 0.6
        tokens, usd = rng.randrange(1, 90) / 10, rng.randrange(1, 900) / 10
        time = START + timedelta(seconds=rng.randrange(days * 86400))
        wallet = "hot" if rng.random() < 0.5 else f"w{rng.randrange(6)}"
        rows.append((i, time, rng.choice("xyz"), *((tokens, 0.0, usd, 0.0) if buy else (0.0, tokens, 0.0, usd)), wallet))
    return spark.createDataFrame(rows, SCHEMA)


def books_of(spark, folder, rows, **options):
    table = ChunkTable(spark, f"{folder}/swaps", rows.schema, "time", swaps.KEYS, "1 day").create()
    table.append(rows)
    return DatedBooks(table, f"{folder}/books", **options)


def between(df, start, end):
    return df.filter((F.col("time") >= F.lit(start)) & (F.col("time") < F.lit(end)))


@pytest.mark.parametrize("every, max_rows", [(4, 4_000_000), (10, 25)])
def test_any_range_equals_the_full_query(spark, folder, every, max_rows):
    rows = random_swaps(spark).persist()
    full = swaps.swap_pnl(rows).persist()
    dated = books_of(spark, folder, rows, every=every, max_rows=max_rows)
    # Nothing is closed yet.
    assert plain(dated.pnl(START + timedelta(days=23)), digits=4) == plain(full.filter(F.col("time") >= F.lit(START + timedelta(days=23))), digits=4)
    dated.close(date(2025, 1, 10))
    dated.close(date(2025, 1, 21))
    assert dated.closed_until() == date(2025, 1, 21)
    for low, high in ((0, 3), (7.5, 9), (19.9, 30), (22, 24)):
        start, end = START + timedelta(days=low), START + timedelta(days=high)
        assert plain(dated.pnl(start, end), digits=4) == plain(between(full, start, end), digits=4), (low, high)
    with pytest.raises(ValueError):
        dated.at(date(2025, 1, 22))


def test_a_range_reads_one_snapshot_and_its_days(spark, folder):
    dated = books_of(spark, folder, random_swaps(spark), every=6)
    dated.close(date(2025, 1, 25))
    assert sorted(os.listdir(f"{folder}/books/snapshots")) == [f"day=2025-01-{d:02}" for d in (7, 13, 19, 25)]
    books = dated.at(date(2025, 1, 16))
    used = {f.split("/books/")[1].rsplit("/", 1)[0] for f in books.inputFiles()}
    assert used == {"snapshots/day=2025-01-13", *(f"totals/day=2025-01-{d}" for d in (13, 14, 15))}


def test_a_late_swap_reopens_its_days(spark, folder):
    rows = random_swaps(spark)
    dated = books_of(spark, folder, rows, every=5)
    dated.close(date(2025, 1, 25))
    kept = os.listdir(f"{folder}/books/snapshots/day=2025-01-06")
    late = random_swaps(spark, days=1, n=5, first=900, seed=9).withColumn("time", F.col("time") + F.expr("INTERVAL 7 DAYS"))
    dated.swaps.append(late)
    dated.reopen(date(2025, 1, 8))
    assert dated.closed_until() == date(2025, 1, 6)
    dated.close(date(2025, 1, 25))
    full = swaps.swap_pnl(rows.unionByName(late))
    start = START + timedelta(days=12)
    assert plain(dated.pnl(start), digits=4) == plain(full.filter(F.col("time") >= F.lit(start)), digits=4)
    assert os.listdir(f"{folder}/books/snapshots/day=2025-01-06") == kept


def test_empty_table(spark, folder):
    dated = books_of(spark, folder, random_swaps(spark).limit(0))
    dated.close(date(2025, 1, 5))
    assert dated.closed_until() is None and dated.pnl(START).isEmpty()
