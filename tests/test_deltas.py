import pytest
from pyspark.sql import functions as F

from conftest import minutes, plain, random_ticks
from tideline.config import TICKS
from tideline.operators.candles import candles
from tideline.sources.store import ChunkTable
from tideline.streaming import runs
from tideline.streaming.deltas import DeltaLevels


def levels_of(spark, folder, ticks, **options):
    return DeltaLevels(spark, f"{folder}/levels", TICKS, ticks.schema, **options).create()


def part(ticks, n, of=3):
    return ticks.filter(F.pmod(F.xxhash64("tick_id"), F.lit(of)) == n)


def levels_match(levels, ticks):
    for level in TICKS.levels:
        got = levels.read(level.name)
        assert plain(got) == plain(candles(ticks, level.width), *got.columns), level.name


def test_batches_in_any_order_equal_all_ticks(spark, folder):
    ticks = random_ticks(spark, 300, hot="A").persist()
    levels = levels_of(spark, folder, ticks, fold_every=2, most_files=1)
    for n in range(3):
        levels.add(part(ticks, n), n)
        levels.add(part(ticks, n), n)  # again, after folding too
    levels_match(levels, ticks)
    assert levels.applied() == 2
    assert levels.read("1h", minutes(0), minutes(120)).agg(F.max("bucket")).first()[0] < minutes(120)
    levels.fold(levels.table("1m").chunks())
    levels_match(levels, ticks)
    assert levels.table("1m").read().count() == candles(ticks, "1 minute").count()


def test_a_failed_batch_replaces_what_it_left(spark, folder, monkeypatch):
    ticks = random_ticks(spark, 120).persist()
    levels = levels_of(spark, folder, ticks, fold_every=0)
    levels.add(part(ticks, 0, 2), 0)
    append, calls = ChunkTable.append, []

    def failing(self, df, batch_id=None):
        calls.append(self.path)
        if len(calls) == 2:
            raise OSError("lost")
        return append(self, df, batch_id)

    monkeypatch.setattr(ChunkTable, "append", failing)
    with pytest.raises(OSError):
        levels.add(part(ticks, 1, 2), 1)
    assert levels.applied() == 0
    levels.add(part(ticks, 1, 2), 1)
    levels_match(levels, ticks)


def test_stream_of_files(spark, folder):
    ticks = random_ticks(spark, 200).persist()
    ticks.repartition(3, "tick_id").write.parquet(f"{folder}/in")
    levels = levels_of(spark, folder, ticks)
    stream = runs.parquet_stream(spark, f"{folder}/in", ticks.schema, files_per_batch=1)
    runs.each_batch_available(stream, levels.add, f"{folder}/progress")
    assert levels.applied() == 2
    levels_match(levels, ticks)
