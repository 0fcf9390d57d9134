import os
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from conftest import make_ticks, plain, plan_of, random_ticks
from tideline.sources.store import (
    ChunkTable,
    create_namespace,
    drop_namespace,
    drop_views,
)

DAY = datetime(2024, 3, 1)


def table(spark, folder, interval="1 day", compact="1 week"):
    schema = make_ticks(spark, []).schema
    return ChunkTable(
        spark, f"{folder}/ticks", schema, series_cols=("symbol",), chunk_interval=interval,
        compact_interval=compact,
    ).create()


def days(spark, n=30):
    rows = [(i, DAY + timedelta(hours=8 * i), "A" if i % 3 else "B", float(i), 1.0) for i in range(3 * n)]
    return spark.createDataFrame(rows, make_ticks(spark, []).schema)


def test_empty_table_reads(spark, folder):
    t = table(spark, folder)
    assert t.read().isEmpty() and t.chunks() == [] and t.latest() is None
    assert t.changes().isEmpty()


def test_append_read_and_pruning(spark, folder):
    t = table(spark, folder)
    t.append(days(spark).filter("tick_id < 50"))
    t.append(days(spark).filter("tick_id >= 50"))
    assert plain(t.read()) == plain(days(spark))
    assert len(t.chunks()) == 30
    some = t.read(DAY + timedelta(days=10), DAY + timedelta(days=12))
    assert some.count() == 6
    plan = plan_of(some)
    assert "PartitionFilters: [isnotnull(chunk" in plan and "GreaterThanOrEqual(time" in plan
    assert t.latest() == days(spark).agg(F.max("time")).first()[0]
    assert t.changes().filter("seq = 2").count() == 14


def test_prune_drops_whole_chunks_only(spark, folder):
    t = table(spark, folder, compact=None)
    t.append(days(spark))
    gone = t.prune(DAY + timedelta(days=30), "10 days")
    assert gone == [date(2024, 3, 1) + timedelta(days=i) for i in range(20)]
    assert t.read().agg(F.min("time")).first()[0] == DAY + timedelta(days=20)


def test_compaction_keeps_content_and_later_writes(spark, folder):
    t = table(spark, folder)
    rows = days(spark)
    t.append(rows.filter("tick_id % 7 != 0"))
    t.compact(DAY + timedelta(days=30), "1 week")
    assert len(t.chunks()) == 16
    t.append(rows.filter("tick_id % 7 = 0"))
    assert plain(t.read()) == plain(rows)
    some = t.read(DAY + timedelta(days=5), DAY + timedelta(days=6))
    assert plain(some) == plain(rows.filter(F.col("tick_id").between(15, 17)))
    t.update_range(
        lambda d: d.withColumn("price", F.col("price") + 1), DAY + timedelta(days=4), DAY + timedelta(days=6)
    )
    raised = F.col("tick_id").between(12, 17)
    want = rows.withColumn("price", F.when(raised, F.col("price") + 1).otherwise(F.col("price")))
    assert plain(t.read()) == plain(want)
    t.compact(DAY + timedelta(days=30), "1 week")
    assert plain(t.read()) == plain(want)
    assert t.prune(DAY + timedelta(days=30), "2 weeks")
    assert t.read().filter(F.col("time") >= F.lit(DAY + timedelta(days=16))).count() == 42


def files_of(t):
    return {f"{d}/{n}" for d, _, names in os.walk(t.path) for n in names if n.endswith(".parquet")}


def test_a_second_compaction_changes_no_file(spark, folder):
    t = table(spark, folder)
    t.append(days(spark))
    assert len(t.compact(DAY + timedelta(days=30), "1 week")) > 7
    before = files_of(t)
    assert t.compact(DAY + timedelta(days=30), "1 week") == [] and files_of(t) == before
    # A late row opens its own week again, and no other.
    t.append(days(spark).filter("tick_id = 20"))
    assert t.compact(DAY + timedelta(days=30), "1 week") and len(before - files_of(t)) == 1
    assert t.read().count() == 91


def test_a_batch_that_runs_again_adds_no_rows(spark, folder):
    t = table(spark, folder)
    t.append(days(spark).filter("tick_id < 50"), 0)
    for _ in range(2):
        t.append(days(spark).filter("tick_id >= 50"), 1)
    assert plain(t.read()) == plain(days(spark))
    # Frames that give other rows each time are stored as they were written.
    t.append(days(spark).limit(5).withColumn("price", F.rand()))
    assert t.read().count() == 95 and t.changes().filter("seq = 4").count() >= 1
    t.trim_log(3)
    assert t.last_change() == 4 and t.changes().select("seq").distinct().count() == 1


def test_update_logs_the_touched_range(spark, folder):
    t = table(spark, folder)
    t.append(days(spark))
    start = DAY + timedelta(days=28)
    t.update_range(lambda d: d.withColumn("price", F.col("price") + 1), start)
    changed = t.changes(after=1).orderBy("chunk").collect()
    assert [c["chunk"] for c in changed] == [date(2024, 3, 29), date(2024, 3, 30)]
    assert changed[0]["min_time"] == start
    t.update_range(lambda d: d, DAY + timedelta(days=90))
    assert t.last_change() == 2


def test_failed_rewrite_leaves_the_table(spark, folder):
    t = table(spark, folder)
    t.append(days(spark))
    with pytest.raises(Exception):
        t.update_range(lambda d: d.withColumn("price", F.raise_error(F.lit("no")).cast("double")), DAY)
    assert plain(t.read()) == plain(days(spark))


def test_truncate_and_drop(spark, folder):
    t = table(spark, folder)
    t.append(random_ticks(spark, 50))
    t.truncate()
    assert t.read().isEmpty() and t.exists()
    t.drop()
    assert not t.exists()


def test_bad_intervals(spark, folder):
    with pytest.raises(ValueError):
        table(spark, folder, interval="1 hour")
    with pytest.raises(ValueError):
        table(spark, folder, interval="1 month", compact="1 week")


def test_namespaces_and_views(spark):
    create_namespace(spark, "sensors_test")
    assert spark.catalog.currentDatabase() == "sensors_test"
    spark.range(1).createOrReplaceTempView("some_view")
    drop_views(spark, ["some_view", "never_there"])
    assert not spark.catalog.tableExists("some_view")
    drop_namespace(spark, "sensors_test")
    assert not spark.catalog.databaseExists("sensors_test")
