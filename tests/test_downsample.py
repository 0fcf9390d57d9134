import math
import random

import numpy as np
import pytest

from conftest import minutes, plain
from tideline.operators import downsample as d

SCHEMA = "time timestamp_ntz, device_id string, value double"


def series(spark, values, device="d"):
    return spark.createDataFrame(
        [(minutes(i * 7 % 3 / 10 + i), device, v) for i, v in enumerate(values)], SCHEMA
    )


def lttb_by_hand(points, n):
    """Textbook version on (x, y) points."""
    if len(points) <= n:
        return points
    every = (len(points) - 2) / (n - 2)
    edges = [1 + math.floor(round(k * every, 9)) for k in range(n - 1)]
    chosen = [points[0]]
    for k in range(n - 2):
        bucket = points[edges[k] : edges[k + 1]]
        after = points[edges[k + 1] : edges[k + 2]] if k < n - 3 else [points[-1]]
        cx = sum(p[0] for p in after) / len(after)
        cy = sum(p[1] for p in after) / len(after)
        ax, ay = chosen[-1]
        chosen.append(
            max(bucket, key=lambda p: abs((ax - cx) * (p[1] - ay) - (ax - p[0]) * (cy - ay)))
        )
    return [*chosen, points[-1]]


def expected(df, n):
    out = []
    for device in sorted({r["device_id"] for r in df.select("device_id").collect()}):
        rows = sorted((r["time"], r["value"]) for r in df.filter(f"device_id = '{device}'").collect())
        start = rows[0][0]
        points = [((t - start).total_seconds() * 1e6, v) for t, v in rows]
        times = dict(zip((p[0] for p in points), (r[0] for r in rows)))
        out += [(device, times[x], round(v, 6)) for x, v in lttb_by_hand(points, n)]
    return sorted(out)


@pytest.mark.parametrize("n", [3, 4, 10, 33])
def test_lttb_matches_the_textbook_on_every_route(spark, n, monkeypatch):
    rng = random.Random(n)
    df = series(spark, [rng.gauss(0, 5) + math.sin(i / 9) * 20 for i in range(700)], "long")
    df = df.unionByName(series(spark, [rng.random() for _ in range(40)], "mid"))
    df = df.unionByName(series(spark, [1.0, 2.0], "tiny"))
    want = expected(df, n)
    assert plain(d.lttb(df, ["device_id"], n), "device_id", "time", "value") == want
    monkeypatch.setattr(d, "CELL_ROWS", 16)
    monkeypatch.setattr(d, "CELL_FAN", 3)
    split = d.lttb(df, ["device_id"], n, max_rows=50, series_rows=60)
    assert plain(split, "device_id", "time", "value") == want


def test_lttb_of_a_constant_keeps_its_ends(spark):
    df = series(spark, [4.0] * 50)
    times = [r["time"] for r in d.lttb(df, ["device_id"], 5).orderBy("time").collect()]
    assert len(times) == 5 and times[0] == minutes(0)
    assert times[-1] == df.agg({"time": "max"}).first()[0]


def test_hull_keeps_every_maximum_of_a_linear_function():
    rng = np.random.default_rng(0)
    for size in (1, 2, 3, 10, 500):
        x = np.sort(rng.integers(0, 60, size)).astype(float)
        y = rng.integers(0, 40, size).astype(float)
        corners = d.hull(x, y)
        for angle in np.linspace(0, 2 * np.pi, 37):
            f = np.cos(angle) * x + np.sin(angle) * y
            assert abs(f[corners].max() - f.max()) < 1e-9


def test_hull_shrinks_large_groups():
    rng = np.random.default_rng(1)
    x = np.arange(50_000.0)
    assert len(d.hull(x, rng.normal(size=50_000))) < 200


def test_asap_reduces_roughness_and_size(spark):
    rng = random.Random(4)
    # Every run of ten swings up or down, apart from one lasting shift.
    swing = [5 if i // 10 % 2 else -5 for i in range(1000)]
    values = [s + rng.gauss(0, 1) + (30 if 500 <= i < 560 else 0) for i, s in enumerate(swing)]
    df = series(spark, values)
    out = d.asap_smooth(df, ["device_id"], 100).orderBy("time").collect()
    smooth = np.array([r["value"] for r in out])
    means = np.array(values).reshape(100, 10).mean(axis=1)
    window = d.smoothing_window(means)
    assert window > 1 and len(smooth) == 100 - window + 1
    assert np.allclose(smooth, d.moving_average(means, window))
    assert np.diff(smooth).std() < np.diff(means).std()


def test_asap_routes_agree(spark):
    rng = random.Random(4)
    df = series(spark, [rng.random() for _ in range(400)])
    whole = plain(d.asap_smooth(df, ["device_id"], 50))
    assert whole == plain(d.asap_smooth(df, ["device_id"], 50, max_rows=30))


def test_asap_of_short_and_constant_series(spark):
    df = series(spark, [2.0] * 60, "flat").unionByName(series(spark, [1.0], "one"))
    out = d.asap_smooth(df, ["device_id"], 30)
    assert {r["value"] for r in out.filter("device_id = 'flat'").collect()} == {2.0}
    assert out.filter("device_id = 'one'").count() == 1


def test_scratch_removes_intermediate_copies(spark):
    import os

    from tideline.session import scratch, shared_dir

    base = f"{shared_dir(spark).removeprefix('file:')}/tideline"
    before = set(os.listdir(base)) if os.path.isdir(base) else set()
    df = spark.range(500).selectExpr("'d' as device_id", "timestamp_ntz'2024-01-01' + make_dt_interval(0, 0, cast(id as int)) as time", "double(id % 17) as value")
    with scratch(spark):
        rows = d.lttb(df, ["device_id"], 20).count()
    assert rows == 20 and set(os.listdir(base)) == before


def window_by_trying_all(values, longest=0.1):
    def figures(v):
        d = v - v.mean()
        m2 = (d * d).mean()
        return np.diff(v).std(), (d**4).mean() / (m2 * m2) if m2 > 0 else math.nan

    best = (np.diff(values).std(), 1)
    base = figures(values)[1]
    for w in range(2, max(1, int(len(values) * longest)) + 1):
        rough, kurtosis = figures(np.convolve(values, np.full(w, 1.0 / w), mode="valid"))
        if kurtosis >= base and rough < best[0]:
            best = (rough, w)
    return best[1]


SHAPES = {
    "noise": lambda rng, i: rng.normal(size=len(i)),
    "walk": lambda rng, i: np.cumsum(rng.normal(size=len(i))),
    "season": lambda rng, i: np.sin(i / 7) * 9 + rng.normal(size=len(i)) + 1e4,
    "spikes": lambda rng, i: rng.normal(size=len(i)) + 40 * (rng.random(len(i)) < 0.01),
    "shift": lambda rng, i: np.sin(i / 3) + 30 * ((i > len(i) // 2) & (i < len(i) // 2 + 9)) + rng.normal(size=len(i)) / 9,
    "trend": lambda rng, i: i * 0.01 + rng.standard_cauchy(size=len(i)),
}


@pytest.mark.parametrize("shape", sorted(SHAPES))
def test_window_is_that_of_trying_all(shape):
    rng = np.random.default_rng(3)
    for n in (1, 2, 5, 19, 21, 60, 333, 1200):
        for share in (0.1, 0.5):
            values = np.asarray(SHAPES[shape](rng, np.arange(n)), float)
            assert d.smoothing_window(values, share) == window_by_trying_all(values, share), (n, share)


def test_few_windows_are_measured(monkeypatch):
    rng = np.random.default_rng(5)
    tried, real = [], d.quality
    monkeypatch.setattr(d, "quality", lambda v, w: tried.append(w) or real(v, w))
    for n in (500, 5000, 50_000):
        for shape in SHAPES.values():
            tried.clear()
            d.smoothing_window(np.asarray(shape(rng, np.arange(n)), float))
            assert len(tried) <= 8, (n, len(tried))


def test_moving_average_of_large_values():
    values = 1e9 + np.random.default_rng(1).normal(size=400)
    for w in (1, 2, 7, 400):
        want = np.convolve(values, np.full(w, 1.0 / w), mode="valid")
        assert np.allclose(d.moving_average(values, w), want, rtol=0, atol=1e-5)
