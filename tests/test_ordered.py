import random

from pyspark.sql import functions as F

from conftest import plain
from tideline.operators.grid import assign_ids
from tideline.operators.ordered import (
    OrderedScan,
    row_index,
    running_last,
    running_max,
    running_sum,
)


def rows(n=400, seed=3):
    """Half of the rows have key ``hot``; every fifth value is missing."""
    rng = random.Random(seed)
    out = []
    for i in range(n):
        key = "hot" if rng.random() < 0.5 else rng.choice(["a", "b", None])
        out.append((key, i // 3, i, None if i % 5 == 0 else rng.randrange(-50, 50) * 1.0))
    rng.shuffle(out)
    return out


def by_hand(data):
    result = []
    for key in {r[0] for r in data}:
        total = best = last = None
        ordered = sorted((r for r in data if r[0] == key), key=lambda r: (r[1], r[2]))
        for i, (_, t, n, v) in enumerate(ordered):
            before = total
            if v is not None:
                total = v if total is None else total + v
                best = v if best is None else max(best, v)
                last = v
            result.append((key, n, total, before, best, last, i))
    return result


def scanned(df, max_rows):
    scan = OrderedScan.of(df, ["k"], ["t", "n"], max_rows).running(
        {
            "total": running_sum(F.col("v")),
            "before": running_sum(F.col("v"), exclusive=True),
            "best": running_max(F.col("v")),
            "last": running_last(F.col("v")),
            "i": row_index(),
        }
    )
    return scan, scan.frame().select("k", "n", "total", "before", "best", "last", "i")


def test_both_routes_agree_with_brute_force(spark):
    data = rows()
    df = spark.createDataFrame(data, "k string, t int, n int, v double")
    expected = sorted(by_hand(data), key=str)
    for max_rows in (10_000, 100, 7):
        scan, out = scanned(df, max_rows)
        assert (scan.split is not None) == (max_rows < 10_000)
        assert sorted((tuple(r) for r in out.collect()), key=str) == expected


def test_only_large_keys_are_split(spark):
    df = spark.createDataFrame(rows(), "k string, t int, n int, v double")
    scan, _ = scanned(df, 150)
    assert [r["k"] for r in scan.split.select("k").distinct().collect()] == ["hot"]
    assert scan.plain.filter("k = 'hot'").isEmpty()
    largest = scan.split.groupBy("_segment").count().agg(F.max("count")).first()[0]
    assert largest < 150


def test_chained_runs_see_earlier_columns(spark):
    df = spark.createDataFrame(rows(), "k string, t int, n int, v double")

    def twice(max_rows):
        scan = OrderedScan.of(df, ["k"], ["t", "n"], max_rows)
        scan = scan.running({"a": running_sum(F.coalesce("v", F.lit(0.0)))})
        scan = scan.with_columns({"a2": F.col("a") * 2}).running({"b": running_sum(F.col("a2"))})
        return plain(scan.frame(), "k", "n", "a", "b")

    assert twice(10_000) == twice(20)


def test_ids_without_keys_are_dense_in_both_routes(spark):
    df = spark.createDataFrame(rows(), "k string, t int, n int, v double")
    for max_rows in (10_000, 30):
        out = assign_ids(df, ["t", "n"], previous_max=5, max_rows=max_rows)
        assert plain(out, "n", "id") == [(n, n + 6) for n in range(400)]


def test_empty_input(spark):
    df = spark.createDataFrame([], "k string, t int, n int, v double")
    assert scanned(df, 10)[1].count() == 0
    assert assign_ids(df, ["t", "n"]).count() == 0
