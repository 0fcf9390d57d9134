import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from conftest import make_ticks, plain, plan_of, random_ticks
from tideline.operators import lastprice, ranges
from tideline.plans import nearest
from tideline.sources.store import ChunkTable


def year_of_ticks(spark, folder):
    """A tick of A and B each day of a year, and one of R in the first week."""
    rows = [(1440 * d + k, s, d + k, 1) for d in range(365) for k, s in enumerate("AB")]
    rows += [(1440 * 3 + 5, "R", 1, 1)]
    ticks = make_ticks(spark, rows)
    table = ChunkTable(spark, f"{folder}/ticks", ticks.schema, series_cols=("symbol",)).create()
    table.append(ticks.coalesce(1))
    return table, ticks


def opened(monkeypatch):
    """Chunk names that reads ask for, in order."""
    asked = []
    read = ChunkTable.read

    def watched(self, start=None, end=None, chunks=None):
        asked.append(sorted(set(chunks)) if chunks is not None else None)
        return read(self, start, end, chunks)

    monkeypatch.setattr(ChunkTable, "read", watched)
    return asked


def test_steps():
    assert list(nearest.steps(0)) == []
    for n in (1, 2, 3, 7, 8, 100):
        runs = list(nearest.steps(n))
        assert [low for low, _ in runs[1:]] == [high for _, high in runs[:-1]]
        assert runs[0][0] == 0 and runs[-1][1] == n


def test_one_chunk_of_a_year_is_opened(spark, folder, monkeypatch):
    table, ticks = year_of_ticks(spark, folder)
    asked = opened(monkeypatch)
    out = nearest.newest_rows(table, 1, F.col("symbol") == "B", ["tick_id"])
    assert plain(out) == plain(ranges.latest_for_symbol(ticks, "B", ["tick_id"]))
    assert [len(a) for a in asked] == [1]
    assert "PartitionFilters: [isnotnull(chunk#" in plan_of(out) and "= 2025-02-28)" in plan_of(out)
    asked.clear()
    wanted = spark.createDataFrame([("A",), ("B",)], "symbol string")
    out = nearest.newest_per_series(table, wanted, ["price"])
    assert max(len(a) for a in asked) == 1
    assert plain(out, "symbol", "price") == [("A", 364.0), ("B", 365.0)]


def test_rare_series_and_absent_ones(spark, folder, monkeypatch):
    table, ticks = year_of_ticks(spark, folder)
    asked = opened(monkeypatch)
    wanted = spark.createDataFrame([("A",), ("R",), ("absent",)], "symbol string")
    out = nearest.newest_per_series(table, wanted, ["price"])
    assert plain(out, "symbol", "price") == [("A", 364.0), ("R", 1.0)]
    assert len(asked) <= 11
    assert plain(nearest.newest_rows(table, 3, F.col("symbol") == "R"), "price") == [(1.0,)]
    assert nearest.newest_rows(table, 3, F.col("symbol") == "absent").isEmpty()
    assert plain(nearest.newest_rows(table, 1000, None, ["tick_id"])) == plain(ticks)


def test_empty_table(spark, folder):
    table = ChunkTable(spark, f"{folder}/ticks", make_ticks(spark, [(0, "A", 1, 1)]).schema, series_cols=("symbol",)).create()
    assert nearest.newest_rows(table, 3).isEmpty()
    wanted = spark.createDataFrame([("A",)], "symbol string")
    assert nearest.newest_per_series(table, wanted, ["price"]).isEmpty()


@pytest.mark.parametrize("forward, max_rows", [(False, 15), (True, 4_000_000)])
def test_neighbours_against_all_rows(spark, folder, forward, max_rows):
    rng = random.Random(3)
    ticks = random_ticks(spark, 150, ("A", "B", "RARE"), seed=5, hot="A")
    ticks = ticks.filter((F.col("symbol") != "RARE") | (F.col("tick_id") % 20 == 0)).persist()
    table = ChunkTable(spark, f"{folder}/ticks", ticks.schema, series_cols=("symbol",), compact_interval="1 week").create()
    table.append(ticks)
    table.compact(datetime(2024, 3, 12))
    late = ticks.filter("tick_id % 7 = 0").withColumn("tick_id", F.col("tick_id") + 1000).withColumn("time", F.col("time") + F.expr("INTERVAL 1 HOUR"))
    table.append(late)
    rows = [(r.symbol, r.time, r.tick_id, r.price) for r in ticks.unionByName(late).collect()]
    points = rng.sample([r[:3] for r in rows], 30) + [(s, datetime(2024, 1, 1) + timedelta(days=d), 5) for s in ("A", "RARE", "absent") for d in (0, 200)]
    found = nearest.nearest_rows(table, spark.createDataFrame(points, "symbol string, time timestamp_ntz, tick_id long"), ["price"], forward, max_rows=max_rows)
    got = {(r.symbol, r.time, r.tick_id): r.found and tuple(r.found) for r in found.collect()}
    for p in points:
        near = [r for r in rows if r[0] == p[0] and ((r[1:3] > p[1:3]) if forward else (r[1:3] < p[1:3]))]
        want = (min(near, key=lambda r: r[1:3]) if forward else max(near, key=lambda r: r[1:3]))[1:] if near else None
        assert got[p] == want, p
    assert len(got) == len(set(points))


def test_last_prices_from_chunks(spark, folder):
    ticks = random_ticks(spark, 300)
    table = ChunkTable(spark, f"{folder}/ticks", ticks.schema, series_cols=("symbol",)).create()
    table.append(ticks)
    out = nearest.newest_per_series(table, lastprice.symbol_names(ticks), ["price"])
    assert plain(out, "symbol", "price", "time") == plain(lastprice.last_values(ticks, ["symbol"], "price"), "symbol", "last_value", "last_at")
