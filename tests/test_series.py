"""Neighbours in ranges of long series, and rules over series, against plain loops."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from sessionloom.operators import ordered as O
from sessionloom.plans import sessions as P


def series(rng, n, keys=("a", "b"), span=40):
    return [(str(rng.choice(keys, p=[0.9, 0.1])), k, float(rng.integers(0, span)) / 2) for k in range(n)]


def plain_nearest(left, right):
    out = {}
    for g, i, t in left:
        fit = [(abs(t - x), x, j) for h, j, x in right if h == g]
        out[i] = (min(fit)[2], min(fit)[0]) if fit else (None, None)
    return out


@pytest.mark.parametrize("most", [5, 11, 10**6])
def test_nearest_in_ranges(spark, most):
    """A key with nine tenths of all rows, many equal times, ranges without rows of a side."""
    rng = np.random.default_rng(most)
    for n, m, span in ((80, 40, 40), (60, 3, 200), (3, 60, 200), (50, 50, 3)):
        left, right = series(rng, n, span=span), series(rng, m, keys=("a", "c"), span=span)
        got = O.nearest(spark.createDataFrame(left, "g string, l long, t double"), spark.createDataFrame(right, "g string, r long, t double"), ["g"], "t", "l", "r", most).collect()
        assert len(got) == n and {r["l"]: (r["r"], r["gap"]) for r in got} == plain_nearest(left, right)


@pytest.mark.parametrize("most", [5, 10**6])
@pytest.mark.parametrize("held", [True, False])
def test_interpolated_in_ranges(spark, most, held):
    rng = np.random.default_rng(7)
    points = series(rng, 70, span=100)
    known = {(g, t): (float(rng.normal()), float(rng.normal())) for g, _, t in series(rng, 30, span=90)}
    df = spark.createDataFrame([(g, t, *v) for (g, t), v in known.items()], "g string, t double, x double, y double")
    got = {r["k"]: (r["x"], r["y"]) for r in O.interpolated(spark.createDataFrame(points, "g string, k long, t double"), df, ["g"], "t", ["x", "y"], "k", most, held).collect()}
    for g, k, t in points:
        own = sorted((at, v) for (h, at), v in known.items() if h == g)
        if not own or not held and not own[0][0] <= t <= own[-1][0]:
            assert got[k] == (None, None)
        else:
            assert np.allclose(got[k], [np.interp(t, [o[0] for o in own], [o[1][j] for o in own]) for j in (0, 1)])


def test_one_key_is_spread(spark):
    """Ranges have about as many rows each, and each has one row handed on either side at most."""
    rows = spark.range(50_000).select(F.lit("a").alias("g"), F.pow(F.col("id").cast("double"), 1.5).alias("t"), F.col("id").alias("v"))
    left, right = O.in_ranges(rows, rows, ["g"], "v", 5_000)
    sizes = [r["count"] for r in left.groupBy("_range").count().collect()]
    assert len(sizes) >= 18 and max(sizes) <= 5_000
    assert right.count() == 50_000 + 2 * (len(sizes) - 1)


def test_drift_of_sparse_streams(spark):
    """Rates are of the points; a stream without a full window has deviation and trend 0; short ones are left out."""
    rows = [("steady", float(t)) for t in range(0, 31)] + [("short", t / 10) for t in range(15)] + [("few", float(t)) for t in range(0, 90, 10)] + [("gap", float(t)) for t in [*range(0, 10), *range(20, 41, 2)]]
    got = {r["s"]: r for r in O.drift(spark.createDataFrame(rows, "s string, t double"), ["s"], "t", 1.0, 10.0, 5.0, least_span=1.0).collect()}
    assert set(got) == {"steady", "short", "gap"}
    assert (got["steady"]["rate"], got["steady"]["windows"], got["steady"]["std_rate"], got["steady"]["trend"]) == (1.0, 5, 0.0, 0.0)
    assert (got["short"]["windows"], got["short"]["rate"], got["short"]["delta"], got["short"]["std_rate"]) == (0, 10.0, 9.0, 0.0)
    # windows from 0 and, of the others, none with more than 5 points of the second part: 5 points in 10 seconds
    assert got["gap"]["windows"] == 1 and got["gap"]["trend"] == 0.0
    one = O.sliding_rate(spark.createDataFrame([("x", float(t)) for t in [*range(7), 12]], "s string, t double"), ["s"], "t", 10.0, 5.0).collect()
    assert [(r["k"], r["n"], r["rate"]) for r in one] == [(0, 7, 1.0)]


def test_label_inversion_by_signed_values(spark):
    rows = [("fine", 0.2, -0.6, 0.3, -0.7), ("one side", -0.5, 0.5, 0.5, 0.1), ("both", 0.1, 0.3, 0.0, 0.4), ("weak", 0.1, 0.15, 0.0, 0.4), ("faint", 0.1, 0.15, 0.0, 0.1), ("tie", 0.3, 0.3, 0.1, 0.5), ("half", None, 0.9, 0.1, 0.5), ("none", None, None, 0.1, None)]
    flat = [(s, side, own, other) for s, a, b, c, d in rows for side, own, other in (("left", a, b), ("right", c, d))]
    got = {r["session"]: r["verdict"] for r in P.label_inversion(spark.createDataFrame(flat, "session string, side string, own double, other double")).collect()}
    assert got == {"fine": "ok", "one side": "ok", "both": "inverted", "weak": "suspect", "faint": "ok", "tie": "suspect", "half": "inverted"}


POSES = "session string, pose_id long, ts_ms double, x_mm double, y_mm double, z_mm double"


def test_cross_validation_skips_what_lies_outside(spark):
    head = spark.createDataFrame([("s", k, 100.0 * k, 100.0 * k, 0.0, 0.0) for k in range(3)] + [("few", k, 100.0 * k, 0.0, 0.0, 0.0) for k in range(2)], POSES)
    stereo = spark.createDataFrame([("s", k, t, x, 0.0, 0.0) for k, (t, x) in enumerate([(-500.0, 0.0), (50.0, 50.0), (150.0, 250.0), (900.0, 200.0)])] + [("few", k, 50.0, 0.0, 0.0, 0.0) for k in range(3)] + [("alone", k, 0.0, 0.0, 0.0, 0.0) for k in range(3)], POSES)
    got = {r["session"]: (r["compared"], r["agreed"], r["rate"], r["mean_mm"]) for r in P.cross_validation(head, stereo).collect()}
    assert got == {"s": (2, 1, 0.5, 50.0), "few": (0, 0, 0.0, None), "alone": (0, 0, 0.0, None)}
    # cameras that face each other: half a turn about y and 1 m apart, so 400 mm before one is 600 mm before the other
    turn = [0.0, float(np.pi), 0.0]
    poses = spark.createDataFrame([("s", [0.0] * 3, [0.0] * 3, turn, [0.0, 0.0, 1.0]), ("t", None, [0.0] * 3, turn, None)], "session string, stereo_rotation array<double>, stereo_shift array<double>, head_rotation array<double>, head_shift array<double>")
    head = spark.createDataFrame([(s, k, 100.0 * k, 10.0, 20.0, 600.0) for s in "st" for k in range(3)], POSES)
    stereo = spark.createDataFrame([(s, k, 50.0 * k, -10.0, 20.0, 400.0) for s in "st" for k in range(3)], POSES)
    got = {r["session"]: r["mean_mm"] for r in P.cross_validation(head, stereo, poses=poses).collect()}
    assert got["s"] == 0.0 and got["t"] > 200


def test_camera_sync_without_times(spark):
    grid = spark.createDataFrame([(s, "left", k, None if k == 3 else 100.0 * k, None) for s in ("empty", "fine", "none") for k in range(4)], "session string, camera string, idx long, ts_ms double, file string")
    frames = spark.createDataFrame([("fine", "left", k, 100.0 * k) for k in range(4)] + [("empty", "left", 0, None)], "session string, camera string, frame_id long, ts_ms double")
    got = {r["session"]: (r["total"], r["bad"], r["median_bad_ms"], r["ok"]) for r in P.camera_sync(grid, frames, cameras=frames).collect()}
    assert got == {"empty": (4, 4, float("inf"), False), "fine": (4, 1, float("inf"), False)}


@pytest.mark.parametrize("most", [4, 30, 10**6])
def test_neighbours_and_sums_in_ranges(spark, most):
    """A key with nine tenths of all rows, a null key, null values: as the plain loop, however the key is cut."""
    rng = np.random.default_rng(most)
    rows = [(None if k % 40 == 0 else "a" if k % 10 else "b", k, float(t), None if k % 13 == 0 else float(rng.integers(0, 9))) for k, t in enumerate(rng.permutation(200) / 2)]
    df = spark.createDataFrame(rows, "g string, k long, t double, v double")
    want, sums, last, total = {}, {}, {}, {}
    for g, k, t, v in sorted(rows, key=lambda r: r[2]):
        want[k] = last.get(g)
        last[g] = (t, v)
        total[g] = total.get(g) if v is None else (total.get(g) or 0) + v
        sums[k] = total[g]
    got = O.with_previous(df, ["g"], ["t", "k"], ["t", "v"], most).collect()
    assert len(got) == 200 and {r["k"]: None if r["_prev"] is None else tuple(r["_prev"]) for r in got} == want
    got = {r["k"]: r["total"] for r in O.running_sums(df, ["g"], ["t", "k"], "v", "total", most).collect()}
    assert all((got[k] or 0) == (sums[k] or 0) for k in sums) and len(got) == 200
    steps = O.displacement(df, ["g"], ["t", "k"], ["t"], most)
    assert steps.count() == 200 and steps.columns == ["g", "k", "t", "v", "d_t", "step"]
