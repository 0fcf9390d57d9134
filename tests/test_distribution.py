import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import minutes, plain
from tideline.operators import checks, grid, histogram, quantiles, ranges

SCHEMA = "time timestamp_ntz, device_id string, value double"


def samples(spark, values, device="d"):
    rows = [(minutes(i), device, v) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, SCHEMA)


def test_histogram_edges(spark):
    df = samples(spark, [-1.0, 0.0, 9.9, 10.0, 79.9, 80.0, 81.0, None])
    counts = histogram.histogram_counts(df, ["device_id"], "value", F.lit(0.0), F.lit(80.0), 8)
    assert plain(counts, "bin", "cnt") == [(0, 1), (1, 2), (2, 1), (8, 1), (9, 2)]
    row = histogram.histogram_arrays(counts, ["device_id"], 8).first()
    assert row["hist"] == [1, 2, 1, 0, 0, 0, 0, 0, 1, 2] and row["count"] == 7


def test_histogram_of_a_constant(spark):
    df = samples(spark, [5.0] * 3)
    low, high = histogram.value_bounds(df, "value")
    counts = histogram.histogram_counts(df, ["device_id"], "value", low, high, 8)
    assert plain(counts, "bin", "cnt") == [(9, 3)]


@pytest.mark.parametrize("max_rows", [10_000, 13])
def test_exact_percentiles(spark, max_rows):
    rng = random.Random(5)
    a = [rng.randrange(0, 40) / 2 for _ in range(300)]
    b = [rng.random() for _ in range(7)]
    df = samples(spark, a, "a").unionByName(samples(spark, b, "b")).unionByName(samples(spark, [None], "c"))
    wanted = {"p0": 0.0, "p25": 0.25, "p50": 0.5, "p99": 0.99, "p100": 1.0}
    out = quantiles.exact_percentiles(df, ["device_id"], "value", wanted, max_rows)
    got = {r["device_id"]: r for r in out.collect()}
    assert set(got) == {"a", "b"}
    for name, values in (("a", a), ("b", b)):
        for p, q in wanted.items():
            assert abs(got[name][p] - np.quantile(values, q)) < 1e-9


def test_sketches_are_close_and_merge(spark):
    rng = random.Random(9)
    values = [rng.gauss(0, 1) for _ in range(4000)]
    df = samples(spark, values)
    daily = quantiles.percentile_sketches(df, "1 hour")
    merged = quantiles.rollup_sketches(daily, "1 month")
    assert merged.first()["n"] == 4000
    ordered = np.sort(values)
    out = quantiles.sketch_percentiles(merged, {"a": 0.25, "b": 0.5, "c": 0.99}).first()
    for name, p in (("a", 0.25), ("b", 0.5), ("c", 0.99)):
        rank = np.searchsorted(ordered, out[name], side="right") / len(values)
        assert abs(rank - p) < 0.02


def test_checks(spark):
    df = spark.createDataFrame([(1, 1), (1, 1), (2, None), (3, 9)], "id int, ref int")
    parent = spark.createDataFrame([(1,)], "key int")
    report = checks.check_report(
        checks.duplicate_keys(df, ["id"], "pk"),
        checks.missing_values(df, ["ref"], "null"),
        checks.orphans(df, "ref", parent, "key", "fk"),
    )
    assert plain(report) == [("fk", 1), ("null", 1), ("pk", 1)]


def test_grid_includes_both_ends_and_crosses_blocks(spark, monkeypatch):
    monkeypatch.setattr(grid, "BLOCK", 7)
    spans = spark.createDataFrame(
        [("a", minutes(0), minutes(1)), ("b", minutes(0), minutes(0)), ("c", minutes(1), minutes(0))],
        "s string, start timestamp_ntz, stop timestamp_ntz",
    )
    out = grid.time_grid(spans, "100 ms", ["s"])
    assert out.filter("s = 'a'").count() == 601
    assert plain(out.filter("s = 'b'"), "step_no", "time") == [(0, minutes(0))]
    assert out.filter("s = 'c'").isEmpty()
    ends = out.filter("s = 'a'").agg(F.min("time"), F.max("time"), F.countDistinct("time")).first()
    assert tuple(ends) == (minutes(0), minutes(1), 601)


def test_ranges(spark):
    df = samples(spark, [float(i) for i in range(11)])
    as_of = minutes(10)
    assert ranges.recent(df, as_of, "3 minutes").count() == 3
    assert ranges.older(df, as_of, "3 minutes").count() == 7
    assert ranges.between(df, minutes(2), minutes(4)).count() == 3
    assert [r["value"] for r in ranges.newest(df, 2).collect()] == [10, 9]
    raised = ranges.raised_after(df, minutes(8), 1, value="value")
    assert raised.agg(F.sum("value")).first()[0] == 57
    kept = ranges.retained(df, as_of, "5 minutes", "3 minutes")
    assert kept.agg(F.min("time")).first()[0] == minutes(3)


def test_bins_are_within_their_error_and_merge_exactly(spark):
    import random

    rng = random.Random(3)
    values = [0.0] * 40 + [rng.choice([-1, 1]) * 10 ** rng.uniform(-9, 12) for _ in range(2000)] + [None, float("nan")]
    rows = [(minutes(i), v) for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, "time timestamp_ntz, value double")
    hourly = quantiles.value_bins(df, "1 hour")
    merged = quantiles.rollup_bins(hourly, "1 month")
    assert plain(merged) == plain(quantiles.value_bins(df, "1 month"))
    names = {f"p{i}": i / 20 for i in range(21)}
    got = quantiles.bin_percentiles(merged, names).first()
    real = sorted(v for v in values if v is not None and v == v)
    for name, p in names.items():
        want = real[int(p * (len(real) - 1))]
        assert abs(got[name] - want) <= 0.0101 * abs(want)


def test_bounded_bins_hold_their_budget_in_any_merge_order(spark):
    rng = random.Random(11)
    values = [0.0] * 9 + [rng.choice([-1, 1]) * 10 ** rng.uniform(-9, 12) for _ in range(1500)] + [1.0, 1e300, -5e-324, None, float("nan")]
    df = spark.createDataFrame([(minutes(i), rng.choice(["a", None]), v) for i, v in enumerate(values)], "time timestamp_ntz, s string, value double")
    for most in (2, 200):
        whole = quantiles.bounded_bins(quantiles.value_bins(df, "1 month", series=["s"]), ["s"], most)
        assert whole.groupBy("bucket", "s", "side").count().agg(F.max("count")).first()[0] <= most
        parts = [quantiles.value_bins(df.filter(F.minute("time") % 3 == k), "1 month", series=["s"]) for k in range(3)]
        small = [quantiles.bounded_bins(p, ["s"], most) for p in parts]
        left = quantiles.bounded_bins(quantiles.bounded_bins(small[0].unionByName(small[1]), ["s"], most).unionByName(small[2]), ["s"], most)
        assert plain(left) == plain(whole)
    days = quantiles.bounded_bins(quantiles.value_bins(df, "1 day", series=["s"]), ["s"])
    assert plain(quantiles.rollup_bounded(days, "1 month", ["s"])) == plain(whole)
    with pytest.raises(ValueError):
        quantiles.bounded_bins(days, ["s"], 1)


def test_bounded_percentiles_are_within_the_error_they_state(spark):
    rng = random.Random(12)
    values = [rng.choice([-1, 1]) * 10 ** rng.uniform(-6, 9) for _ in range(1500)]
    df = spark.createDataFrame([(minutes(i / 60), v) for i, v in enumerate(values)], "time timestamp_ntz, value double")
    names = {f"p{i}": i / 20 for i in range(21)}
    for most in (25,):
        got = quantiles.bin_percentiles(quantiles.bounded_bins(quantiles.value_bins(df, "1 month"), most=most), names).first()
        assert 0.01 < got["error"] < 1
        for name, p in names.items():
            want = sorted(values)[int(p * (len(values) - 1))]
            assert abs(got[name] - want) <= (got["error"] + 1e-9) * abs(want)
    exact = quantiles.bin_percentiles(quantiles.bounded_bins(quantiles.value_bins(df.limit(20), "1 month")), names).first()
    assert abs(exact["error"] - quantiles.BIN_ERROR) < 1e-12


def test_rounding_keeps_values_beyond_a_doubles_digits(spark):
    from tideline.functions.scalars import round_half_up

    row = spark.createDataFrame([(5e15, 2e14, -1.5, None)], "a double, b double, c double, d double").select(
        *(round_half_up(F.col(c), 4).alias(c) for c in "abcd"), round_half_up(F.col("b"), 5).alias("e")
    ).first()
    assert tuple(row) == (5e15, 2e14, -1.5, None, 2e14)


def grids_by_hand(rows, bins):
    """Cells by trying every width from the finest on."""
    groups, out = {}, {}
    for key, v in rows:
        if v is not None and abs(v) < 2.0**1000:
            groups.setdefault(key, []).append(v)
    for key, values in groups.items():
        level = -20
        while math.floor(max(values) / 2.0**level) - math.floor(min(values) / 2.0**level) >= bins:
            level += 1
        for v in values:
            cell = (key, level, math.floor(v / 2.0**level) * 2.0**level + 0.0)
            out[cell] = out.get(cell, 0) + 1
    return sorted(((*cell, n) for cell, n in out.items()), key=str)


def grid_rows(states):
    return sorted(((r["g"], r["_level"], r["_low"], r["_n"]) for r in states.collect()), key=str)


def grid_values():
    rng = random.Random(8)
    rows = [("normal", rng.gauss(0, 50)) for _ in range(900)]
    rows += [("narrow", 1e6 + rng.random() / 64) for _ in range(300)]
    rows += [("tails", rng.choice([-1, 1]) * 10 ** rng.uniform(-9, 30)) for _ in range(300)]
    rows += [("same", 7.25)] * 40 + [("zeros", -0.0), ("zeros", 0.0), (None, 3.0), (None, -3.0)]
    rows += [("huge", 1e30), ("huge", 1e30), ("odd", None), ("odd", math.nan), ("odd", math.inf), ("odd", 1.0)]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("bins", [2, 8, 37])
def test_grids_are_the_same_however_merged(spark, bins, monkeypatch):
    rows = grid_values()
    df = spark.createDataFrame(rows, "g string, v double")
    want = grids_by_hand(rows, bins)
    for parts in (1, 5):
        assert grid_rows(histogram.grid_states(df.repartition(parts), ["g"], "v", bins)) == want
    # Tasks that merge and hand on early, batch by batch.
    monkeypatch.setattr(histogram, "STATE_ROWS", 20)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "30")
    try:
        assert grid_rows(histogram.grid_states(df, ["g"], "v", bins)) == want
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    halves = [histogram.grid_states(df.filter(F.crc32(F.col("v").cast("string")) % 3 == k), ["g"], "v", bins) for k in range(3)]
    parts = halves[2].unionByName(halves[0]).unionByName(halves[1])
    assert grid_rows(histogram.merged_grids(parts, ["g"], bins)) == want


def test_grids_of_nothing_and_of_everything(spark):
    none = spark.createDataFrame([], "g string, v double")
    assert histogram.grid_states(none, ["g"], "v", 4).count() == 0
    whole = spark.createDataFrame([(v,) for v in (0.0, 1.0, 5.0)], "v double")
    got = histogram.grid_cells(histogram.grid_states(whole, [], "v", 4), []).orderBy("cell_from").collect()
    assert [tuple(r) for r in got] == [(0.0, 2.0, 2), (4.0, 6.0, 1)]
    with pytest.raises(ValueError):
        histogram.grid_states(whole, [], "v", 1)
