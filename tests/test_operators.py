"""Boundary cases of the operators against small hand-made answers."""

import numpy as np
from pyspark.sql import functions as F

from sessionloom.functions import scalars as X
from sessionloom.operators import aggregates as A
from sessionloom.operators import grouped as G
from sessionloom.operators import ledger as L
from sessionloom.operators import ordered as O
from sessionloom.plans import sessions as P
from sessionloom.streaming import watch


def one(spark, column, **values):
    names = list(values)
    return spark.createDataFrame([tuple(values.values())], names).select(column).first()[0]


def test_grades(spark):
    df = spark.createDataFrame([(85.0,), (84.9,), (70.0,), (55.0,), (40.0,), (39.9,), (None,)], "x double")
    assert [r[0] for r in df.select(X.grade(F.col("x"))).collect()] == ["A", "B", "B", "C", "D", "F", None]
    assert one(spark, X.round1(F.col("x")), x=29.349999999999998) == 29.4


def test_names(spark):
    df = spark.createDataFrame([("left",), ("LEFT",), ("wall",), ("rigth",), ("fix_head",), ("lefft",), ("lft",), ("zzzzz",), (None,)], "n string")
    got = [r[0] for r in df.select(X.resolve_name(F.col("n"), prefixes=("fix_",))).collect()]
    assert got == ["left", "left", "head", "right", "head", "left", "left", None, None]
    arrays = spark.createDataFrame([(["a", "b"], ["b", "a"], ["a", "b"]), (["a"], ["b"], ["a", "b"]), (["a", "b"], ["c", "c"], ["a", "b"])], "s array<string>, t array<string>, p array<string>")
    assert [r[0] for r in arrays.select(X.rename_map_ok(F.col("t"), F.col("s"), F.col("p"))).collect()] == [True, False, False]


def test_times_and_rigs(spark):
    df = spark.createDataFrame([("session_20240229_235959_x",), ("session_20230229_000000",), ("run 2024-01-02_03-04-05",), ("none",)], "n string")
    assert [str(r[0]) for r in df.select(X.name_timestamp(F.col("n"))).collect()] == ["2024-02-29 23:59:59", "None", "2024-01-02 03:04:05", "None"]
    ops = spark.createDataFrame([("op 30",), ("op 31",), ("nobody",)], "o string")
    assert [r[0] for r in ops.select(X.rig_number(F.col("o"))).collect()] == [30, 1, None]


def test_geometry(spark):
    e = one(spark, X.euler_angles(F.array(*[F.lit(v) for v in (0.0, 0.0, 0.0, 0.0)])), x=1)
    assert tuple(e) == (0.0, 0.0, 0.0)
    e = one(spark, X.euler_angles(F.array(*[F.lit(v) for v in (1.0, 0.0, 1.0, 0.0)])), x=1)
    assert abs(e["pitch"] - 90) < 1e-5
    got = one(spark, X.camera_to_world(F.array(F.lit(0.0), F.lit(0.0), F.lit(np.pi / 2)), F.array(*[F.lit(1.0)] * 3), F.array(F.lit(1.0), F.lit(2.0), F.lit(1.0))), x=1)
    assert np.allclose(got, [1.0, 0.0, 0.0])


def test_gaps_are_strict(spark):
    df = spark.createDataFrame([("a", k, t) for k, t in enumerate((0.0, 25.0, 125.0, 226.0))] + [("b", 9, 0.0)], "s string, k int, t double")
    got = {r["s"]: r for r in O.frame_gaps(df, ["s"], "t", "k", 10.0).collect()}
    assert (got["a"]["drops"], got["a"]["severe"], got["a"]["max_gap"]) == (2, 1, 101.0)
    assert (got["b"]["frames"], got["b"]["drops"], got["b"]["drop_pct"]) == (1, 0, 0.0)


def test_sliding_needs_more_than_five(spark):
    df = spark.createDataFrame([("a", float(t)) for t in (0, 2, 4, 6, 8, 10, 12, 14, 16, 18, 20)], "s string, t double")
    assert O.sliding_rate(df, ["s"], "t", 10.0, 5.0).count() == 0
    more = df.union(df.where("t > 0").withColumn("t", F.col("t") - 0.5))
    assert sorted(r["k"] for r in O.sliding_rate(more, ["s"], "t", 10.0, 5.0).collect()) == [0, 1, 2]


def test_pearson_never_raises(spark):
    df = spark.createDataFrame([("c", 1.0, 2.0), ("c", 1.0, 3.0), ("l", 1.0, 2.0), ("l", 2.0, 4.0)], "g string, x double, y double")
    got = {r["g"]: r["r"] for r in df.groupBy("g").agg(A.pearson("x", "y").alias("r")).collect()}
    assert got["c"] == 0.0 and abs(got["l"] - 1) < 1e-12


def test_overlap(spark):
    df = spark.createDataFrame([("a", "x", 0.0), ("a", "x", 10.0), ("a", "y", 5.0), ("a", "y", 15.0), ("b", "x", 0.0), ("c", "x", 0.0), ("c", "x", 1.0), ("c", "y", 2.0), ("c", "y", 3.0)], "g string, s string, t double")
    got = {r["g"]: r["overlap"] for r in A.overlap_ratio(df, ["g"], "s", "t").collect()}
    assert got == {"a": round(5 / 15, 6), "b": None, "c": 0.0}


def test_fdr_later_rank_rescues(spark):
    p = [0.01, 0.04, 0.045, 0.9]
    got = A.benjamini_hochberg(spark.createDataFrame(list(enumerate(p)), "k int, p double"), "k", "p", 0.061).orderBy("k").collect()
    assert [r["passes"] for r in got] == [True, True, True, False]
    assert A.benjamini_hochberg(spark.createDataFrame([], "k int, p double"), "k", "p", 0.05).count() == 0


def test_nearest_and_interpolation(spark):
    left = spark.createDataFrame([("a", 1, 10.0), ("a", 2, 3.0), ("b", 3, 1.0)], "g string, l long, t double")
    right = spark.createDataFrame([("a", 7, 8.0), ("a", 8, 12.0), ("a", 9, 8.0)], "g string, r long, t double")
    got = {r["l"]: (r["r"], r["gap"]) for r in O.nearest(left, right, ["g"], "t", "l", "r").collect()}
    assert got == {1: (7, 2.0), 2: (7, 5.0), 3: (None, None)}
    series = spark.createDataFrame([("a", 0.0, 0.0), ("a", 10.0, 20.0)], "g string, t double, v double")
    at = spark.createDataFrame([("a", k, t) for k, t in enumerate((-5.0, 0.0, 2.5, 10.0, 99.0))], "g string, k long, t double")
    assert [r["v"] for r in O.interpolated(at, series, ["g"], "t", "v", "k").orderBy("k").collect()] == [0.0, 0.0, 5.0, 20.0, 20.0]


def test_capacity(spark):
    df = spark.createDataFrame([("g", "a", 60), ("g", "b", 50), ("g", "c", 40), ("h", "a", 100), ("i", "a", 101)], "g string, n string, s int")
    assert sorted((r["g"], r["n"]) for r in O.capacity_prefix(df, ["g"], ["n"], "s", 100).collect()) == [("g", "a"), ("h", "a")]
    assert sorted((r["g"], r["n"]) for r in G.skip_capacity(df, "g", "n", "s", 100).collect()) == [("g", "a"), ("g", "c"), ("h", "a")]


def test_best_lag_finds_a_shift(spark):
    t = np.arange(0, 10, 0.05)
    rows = [("s", n, float(x), float(np.sin(3 * x) + (0 if n == "a" else 0))) for n in "a" for x in t] + [("s", "b", float(x + 0.4), float(np.sin(3 * x))) for x in t]
    got = G.best_lag(spark.createDataFrame(rows, "g string, series string, t double, v double"), "g", "a", "b", 0.02, 1.0).first()
    assert abs(got["lag"] + 0.4) < 0.021 and got["r"] > 0.99  # a(t) with b(t - lag)


def paired(name, rng, span=30.0, step=0.5, swap=False):
    """Openings of two sensors, and videos whose flow is the speed of their own sensor, or of the other one."""
    t = np.arange(0, span, step)
    sensors = {side: rng.normal(size=t.size).cumsum() for side in ("left", "right")}
    flow = {side: (lambda x: ((t[1:] + t[:-1]) / 2, np.abs(np.diff(x)) / step))(sensors[other]) for side, other in (("left", "right"), ("right", "left")) for other in [other if swap else side]}
    series = {f"sensor_{k}": (t, v) for k, v in sensors.items()} | {f"video_{k}": v for k, v in flow.items()}
    return [(name, n, float(a), float(b)) for n, (x, y) in series.items() for a, b in zip(x, y, strict=True)]


SERIES = "g string, series string, t double, v double"


def test_permutation_test(spark):
    df = spark.createDataFrame(paired("s", np.random.default_rng(1)), SERIES)
    a, b = (G.permutation_test(df, "g", 30).first() for _ in range(2))
    assert a == b and a["vote"] == "same" and a["margin"] > 0


def test_permutation_test_is_a_plain_loop(spark):
    """One interpolation for each draw, pair and lag."""
    from hashlib import md5

    rows = paired("s", np.random.default_rng(4), span=12.0)
    s = {n: tuple(np.array([r[k] for r in rows if r[1] == n]) for k in (2, 3)) for n in G.SIDES}

    def r(a, b):
        lo, hi = max(a[0][0], b[0][0]), min(a[0][-1], b[0][-1])
        grid = [lo + 0.25 * i for i in range(int(np.ceil((hi - lo) / 0.25)))]
        x, best = np.interp(grid, *a), 0.0
        for k in range(-2, 3):
            y = np.interp([t - 0.25 * k for t in grid], *b)
            c = np.corrcoef(x, y)[0, 1] if y.std() > 1e-9 else 0.0
            best = c if abs(c) > abs(best) else best
        return abs(best)

    def margin(m):
        return r(s["video_left"], m["left"]) + r(s["video_right"], m["right"]) - r(s["video_left"], m["right"]) - r(s["video_right"], m["left"])

    speed = {k: ((s[f"sensor_{k}"][0][1:] + s[f"sensor_{k}"][0][:-1]) / 2, np.abs(np.diff(s[f"sensor_{k}"][1])) / 0.5) for k in ("left", "right")}
    real, over = margin(speed), 0
    period = speed["left"][0][-1] - speed["left"][0][0]
    for k in range(15):
        shift = 1 + int(md5(f"s:{k}".encode()).hexdigest()[:8], 16) / 2**32 * (period - 2)
        moved = {}
        for k, (t, v) in speed.items():
            at = [t[0] + (x - t[0] + shift) % (t[-1] - t[0]) for x in t]
            o = np.argsort(at, kind="stable")
            moved[k] = np.array(at)[o], v[o]
        over += abs(margin(moved)) >= abs(real)
    got = G.permutation_test(spark.createDataFrame(rows, SERIES), "g", 15, grid_step=0.25, reach=0.5, lag_step=0.25).first()
    assert abs(got["margin"] - real) < 1e-9 and got["p"] == (1 + over) / 16
    for at_once in (1, 4, 100):
        assert G.permutation_test(spark.createDataFrame(rows, SERIES), "g", 15, grid_step=0.25, reach=0.5, lag_step=0.25, at_once=at_once).first()["p"] == got["p"]


def plain_best_lag(ta, va, tb, vb, step, reach, lag_step):
    """One interpolation for each lag."""
    lo, hi = max(ta[0], tb[0]), min(ta[-1], tb[-1])
    if min(len(ta), len(tb)) < 5 or hi <= lo:
        return 0.0, 0.0
    grid, found = np.arange(lo, hi, step), []
    a = np.interp(grid, ta, va)
    for lag in np.arange(-reach, reach + lag_step, lag_step):
        b = np.interp(grid - lag, tb, vb)
        flat = a.std() < 1e-9 or b.std() < 1e-9
        found.append((lag, 0.0 if flat else float(((a - a.mean()) * (b - b.mean())).mean() / (a.std() * b.std()))))
    k = int(np.round(np.abs([r for _, r in found]), 9).argmax())
    return found[k] if found[k][1] else (0.0, 0.0)


def test_lags_in_blocks(spark):
    """Blocks of any size, series with gaps over several blocks, constant ones, short ones, and lags that are no steps of the grid."""
    rng = np.random.default_rng(6)
    made = {}
    for g, (n, m) in {"long": (900, 700), "gaps": (60, 300), "short": (3, 40), "flat": (200, 200), "apart": (50, 50)}.items():
        ta, tb = np.sort(rng.uniform(0, 60, n)), np.sort(rng.uniform(0, 60, m)) + (100 if g == "apart" else 0)
        if g == "gaps":
            ta, tb = np.append(ta[ta < 10], ta[ta > 45]), np.append(tb[tb < 20], tb[tb > 55])
        f = lambda t: np.sin(t) + np.sin(2.3 * t) + 5
        made[g] = ta, np.full(ta.size, 3e5) if g == "flat" else f(ta), tb, 40 * f(tb - 0.7) + rng.normal(size=tb.size)
    rows = [(g, n, float(t), float(v)) for g, (ta, va, tb, vb) in made.items() for n, x, y in (("a", ta, va), ("b", tb, vb)) for t, v in zip(x, y, strict=True)] + [("empty", "c", 1.0, 1.0), (None, "a", 1.0, 1.0), ("long", "a", None, 1.0), ("long", "b", 1.0, None)]
    df = spark.createDataFrame(rows, SERIES)
    for step, lag_step in ((0.1, 0.1), (0.1, 0.2), (0.1, 0.07)):
        want = {g: plain_best_lag(*x, step, 1.4, lag_step) for g, x in made.items()} | {"empty": (0.0, 0.0)}
        for block in (20, 150, 10**6):
            got = {r["g"]: (r["lag"], r["r"]) for r in G.best_lag(df, "g", "a", "b", step, 1.4, lag_step, block=block).collect()}
            assert set(got) == set(want) and all(np.allclose(got[g], want[g], rtol=0, atol=1e-9) for g in want), (step, lag_step, block, got, want)
    assert abs(want["long"][0] + 0.7) < 0.1


def shifted_products(x, y, reach):
    """Sums of x[i + k] * y[i]."""
    n = x.size
    return [sum(x[i + k] * y[i] for i in range(max(0, -k), min(n, n - k))) for k in range(-reach, reach + 1)]


def test_flow_and_trajectories_in_blocks(spark):
    """Against plain loops, over blocks of any size."""
    rng = np.random.default_rng(11)
    wave = lambda t: np.sin(t / 300) + np.sin(t / 170)
    made = {"good": (9000, 300, 200, 500.0), "short": (1500, 40, 40, 0.0), "flat": (9000, 60, 60, 0.0), "gaps": (9000, 200, 30, -90.0)}
    series, want = [], {}
    for g, (span, n, m, shift) in made.items():
        ta, tb = np.sort(rng.uniform(0, span, n)), np.sort(rng.uniform(0, span, m))
        if g == "gaps":
            ta = np.append(ta[ta < 2000], ta[ta > 7000])
        va, vb = wave(ta) + 7, np.full(m, 2.5) if g == "flat" else 3 * wave(tb - shift) + 0.1 * rng.normal(size=m)
        series += [(g, "left", n_, float(t), float(v)) for n_, x, y in (("gripper", ta, va), ("flow", tb, vb)) for t, v in zip(x, y, strict=True)]
        lo, hi = max(ta[0], tb[0]), min(ta[-1], tb[-1])
        if hi - lo < 2000:
            want[g] = (None, None, "overlap")
        elif g == "flat":
            want[g] = (None, None, "flat")
        else:
            grid = np.arange(lo, hi, 33.33)
            a, b = np.interp(grid, ta, va), np.interp(grid, tb, vb)
            r = np.array(shifted_products((b - b.mean()) / (b.std() + 1e-8), (a - a.mean()) / (a.std() * a.size + 1e-8), 45))
            k = int(np.abs(r).argmax())
            k = 45 if abs(r[45]) >= 0.8 * abs(r[k]) else k
            want[g] = (round(float(r[k]), 4), round((k - 45) * 33.33, 1), None)
    df = spark.createDataFrame([*series, ("half", "left", "flow", 1.0, 1.0), ("good", "right", "gripper", 1.0, 1.0)], "g string, side string, series string, t double, v double")
    for block in (50, 10**6):
        got = {r["g"]: (r["correlation"], r["lag_ms"], r["note"]) for r in G.gripper_flow_sides(df, "g", block=block).collect()}
        assert got == want and want["good"][1] != 0

    poses, want = [], {}
    for g, shift in (("near", 0.0), ("late", 200.0), ("few", 0.0)):
        t, u = np.sort(rng.uniform(0, 6000, 3 if g == "few" else 150)), np.sort(rng.uniform(500, 6500, 120))
        head, stereo = [np.stack([wave(x - s), 2 * wave(x + 50 - s), 5 + wave(2 * x - s)], 1) * 100 for x, s in ((t, 0.0), (u, shift))]
        stereo = stereo + rng.normal(size=stereo.shape)
        poses += [(g, n, float(x), *map(float, p)) for n, at, v in (("head", t, head), ("stereo", u, stereo)) for x, p in zip(at, v, strict=True)]
        if g == "few":
            want[g] = (0, 0.0, 0.0, 0.0, None, None, None, 0.0, False)
            continue
        grid = np.arange(max(t[0], u[0]), min(t[-1], u[-1]), 50.0)
        pairs = [(np.interp(grid, u, stereo[:, k]), np.interp(grid, t, head[:, k])) for k in range(3)]
        rs = [np.corrcoef(a, b)[0, 1] for a, b in pairs]
        x, y = ((v - v.mean()) / (v.std() + 1e-8) for v in pairs[0])
        k = int(np.abs(shifted_products(x, y, 30)).argmax()) - 30
        want[g] = (grid.size, *[round(float(r), 4) for r in rs], *[round(float(np.sqrt(((a - b) ** 2).mean())), 2) for a, b in pairs], k * 50.0, bool(np.mean(np.abs(rs)) >= 0.7))
    df = spark.createDataFrame(poses, "g string, source string, t_ms double, x double, y double, z double")
    for block in (40, 10**6):
        got = {r["g"]: tuple(r)[1:] for r in G.trajectory_correlation(df, "g", 50.0, block=block).collect()}
        assert got == want and want["late"][7] != 0


def test_products_by_fft_are_the_direct_ones():
    rng = np.random.default_rng(2)
    t = np.sort(rng.uniform(0, 500, 6000))
    v, grid, lags = rng.normal(size=6000), np.arange(3.0, 480.0, 0.05), G.lags_of(2.0, 0.05)
    a = rng.normal(size=grid.size)
    got = G._lag_sums(a, None, grid, t, v, 0.05, lags)
    b = np.interp(grid[None, :] - lags[:, None], t, v)
    assert grid.size * lags.size > 200_000
    for x, y in zip(got, (b @ a, b.sum(1), (b * b).sum(1), b.min(1), b.max(1)), strict=True):
        assert np.allclose(x, y, rtol=0, atol=1e-8)


def test_pairing_verdicts_find_one_swap_among_many(spark):
    """300 draws can't give p below 1/301, which Benjamini-Hochberg rejects over 40 sessions; sensors too short to be shifted have p = 1."""
    rng = np.random.default_rng(1)
    rows = paired("swapped", rng, swap=True)
    for k in range(39):
        rows += paired(f"short{k}", rng, span=1.75, step=0.25)
    df = spark.createDataFrame(rows, SERIES)
    how = {"grid_step": 0.5, "reach": 0.5, "lag_step": 0.5}
    got = {r["g"]: r for r in G.pairing_verdicts(df, "g", **how).collect()}
    assert len(got) == 40 and [g for g, r in got.items() if r["robust"]] == ["swapped"]
    assert got["swapped"]["vote"] == "swap" and got["swapped"]["p"] < 1 / 301 and got["short0"]["p"] == 1.0
    assert not any(r["robust"] for r in G.pairing_verdicts(df, "g", refine=0, **how).collect())


def test_groups_come_whole_and_in_order(spark):
    rng = np.random.default_rng(3)
    rows = [(None if k % 17 == 0 else int(g), int(k)) for k, g in enumerate(rng.integers(0, 40, 3000))]
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        got = G.each_group(spark.createDataFrame(rows, "g long, k long"), "g", ["k"], lambda key, t: [(key, t.column("k").to_pylist())], "g long, ks array<long>").collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    want = {}
    for g, k in rows:
        if g is not None:
            want.setdefault(g, []).append(k)
    assert len(got) == len(want) and {r["g"]: r["ks"] for r in got} == want


def test_first_fit_is_a_plain_loop(spark):
    rng = np.random.default_rng(2)
    items = [(k, int(rng.integers(0, 50)), None if k % 9 == 0 else int(rng.integers(1, 40))) for k in range(60)]
    disks = [("a", 100.0), ("b", 60.0), ("c", 45.0)]
    free, want = dict(disks), {}
    for k, _, size in sorted(items, key=lambda x: (x[1], x[0])):
        want[k] = next((d for d in free if free[d] - (size or 0) >= 5), None)
        if want[k]:
            free[want[k]] -= size or 0
    df = spark.createDataFrame(items, "k long, at long, size long")
    for chunk in (1000, 7):
        assert {r["k"]: r["target"] for r in G.first_fit(df, disks, ["at", "k"], "k", "size", 5, chunk).collect()} == want
    assert {r["target"] for r in G.first_fit(df, [], ["at", "k"], "k", "size", 5).collect()} == {None}


def test_json_renames(spark):
    df = spark.createDataFrame([('{"left": "left", "k": ["right", {"x": "left"}]}',), ("bad",), (None,)], "j string")
    assert [r[0] for r in G.replace_json_values(df, "j", {"left": "right", "right": "left"}).collect()] == ['{"left": "right", "k": ["left", {"x": "right"}]}', "bad", None]
    df = spark.createDataFrame([('["left", "right"]',)], "j string")
    assert G.replace_quoted(df, "j", {"left": "right", "right": "left"}).first()[0] == '["right", "left"]'


def test_ledger_states(spark):
    b = spark.createDataFrame([("1", "pending_validation"), ("2", "sent"), ("3", "approved")], "id string, status string")
    e = spark.createDataFrame([("1", "approved"), ("2", "sending")], "id string, to_status string")
    assert [(r["id"], r["status"], r["refused"]) for r in L.advance(b, e, "id").orderBy("id").collect()] == [("1", "approved", False), ("2", "sent", True), ("3", "approved", False)]
    led = spark.createDataFrame([("a",)], "name string")
    assert [r[0] for r in L.append_once(led, spark.createDataFrame([("a",), ("b",), ("b",)], "name string"), ["name"]).collect()] == ["b"]
    names = spark.createDataFrame([("f1",), ("id2",), ("id",), ("zz",)], "n string")
    s = spark.createDataFrame([("f1", "id1"), ("f2", "id2")], "folder string, id string")
    assert {r["n"]: r["id"] for r in L.resolve_ids(names, s, "n", "folder", "id").collect()} == {"f1": "id1", "id2": "id2", "id": "id1", "zz": None}


def test_full_score_without_vision_tops_at_60(spark):
    row = [("s", 0.0, None, 0.0, 0, 0.0, 0.0, 0, 1.0, 1.0, 1.0, False, 1.0, 5, 5, 1.0, True)]
    names = "session string, max_drift double, fps_spread double, worst_drop_pct double, severe_drops int, max_local_std double, gap_pct double, queue_drops int, any_rate double, left_rate double, right_rate double, vision boolean, imu_ratio double, checks_ok int, checks_total int, overlap double, duration_ok boolean"
    got = P.full_score(spark.createDataFrame(row, names)).first()
    assert got["score"] == 60.0 and got["grade"] == "C"
    assert P.full_score(spark.createDataFrame([(*row[0][:11], True, *row[0][12:])], names)).first()["score"] == 100.0


def test_camera_sync_thresholds(spark):
    grid = spark.createDataFrame([("s", "left", k, 100.0 * k, "x/cameras/left/1.jpg") for k in range(50)], "session string, camera string, idx long, ts_ms double, file string")
    frames = spark.createDataFrame([("s", "left", k, 100.0 * k + (2.5 if k == 0 else 2.0)) for k in range(50)], "session string, camera string, frame_id long, ts_ms double")
    got = P.camera_sync(grid, frames).first()
    assert (got["bad"], got["ok"]) == (1, True)


def test_verdict_and_pairing(spark):
    checks = spark.createDataFrame([("a", "x", True, True, "fine"), ("a", "y", False, False, "odd"), ("b", "x", False, True, "bad")], "session string, check string, ok boolean, critical boolean, detail string")
    got = {r["session"]: r for r in P.verdict(checks).collect()}
    assert got["a"]["verdict"] == "warning" and got["a"]["warnings"] == ["y: odd"] and got["b"]["verdict"] == "failed"
    rows = spark.createDataFrame([(0.95, 0.9, 0.1, 0.2), (0.1, 0.2, 0.95, 0.9), (0.5, 0.5, 0.1, 0.1), (0.9, 0.9, 0.7, 0.7)], "a double, b double, c double, d double")
    assert [r[0] for r in rows.select(P.pairing_verdict(*map(F.col, "abcd"))).collect()] == ["same", "swap", "inconclusive", "same"]
    rows = spark.createDataFrame([(0.95, 0.6, 0.6, 0.6, True), (0.95, 0.6, 0.6, 0.6, False), (0.9, 0.9, 0.8, 0.8, True)], "a double, b double, c double, d double, e boolean")
    assert [r[0] for r in rows.select(P.pairing_verdict(*map(F.col, "abcd"), enough=F.col("e"))).collect()] == ["same", "inconclusive", "inconclusive"]


def test_stability_gate_in_two_runs(spark, tmp_path):
    schema = "name string, size long, mtime double, observed_at double"
    steps = [[("a", 1, 0.0, 0.0), ("b", 1, 0.0, 0.0)], [("a", 1, 0.0, 59.0), ("b", 2, 0.0, 60.0)], [("a", 1, 0.0, 60.0), ("b", 2, 0.0, 119.0)], [("a", 1, 0.0, 300.0), ("b", None, None, 121.0)]]
    out = []
    for k, rows in enumerate(steps):
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(str(tmp_path / "in" / f"{k}"))
        stream = spark.readStream.schema(schema).parquet(str(tmp_path / "in" / "*"))
        watch.drain(watch.stability_gate(stream, 60.0), lambda b, _: out.extend(b.collect()), str(tmp_path / "state"))
    assert [(r["name"], r["emitted_at"]) for r in out] == [("a", 60.0)]


def test_ledger_sink_is_idempotent(spark, tmp_path):
    sink = watch.ledger_sink(str(tmp_path / "ledger"), ["name"])
    batch = spark.createDataFrame([("a", 1), ("b", 2)], "name string, size long")
    sink(batch, 0)
    sink(batch, 0)
    assert spark.read.parquet(str(tmp_path / "ledger")).count() == 2


def test_full_score_without_measures(spark):
    names = "session string, max_drift double, fps_spread double, worst_drop_pct double, severe_drops int, max_local_std double, gap_pct double, queue_drops int, any_rate double, poses int, left_rate double, right_rate double, imu_ratio double, vision boolean, checks_ok int, checks_total int, overlap double, duration_ok boolean"
    none = ("s", *[None] * 17)
    got = P.full_score(spark.createDataFrame([none, ("p", *[None] * 8, 3, *[None] * 3, True, *[None] * 4), ("z", *[None] * 7, 0.0, 3, *[None] * 3, True, *[None] * 4)], names)).collect()
    assert [(r["sync"], r["stability"], r["detectability"], r["temporal"], r["duration"]) for r in got] == [(50.0, 50.0, 0.0, 50.0, 50.0), (50.0, 50.0, 20.0, 50.0, 50.0), (50.0, 50.0, 0.0, 50.0, 50.0)]


def test_batches_by_size_or_time(spark, tmp_path):
    schema = "q string, item long, at double"
    runs, out = [[("a", 1, 0.0), ("a", 2, 1.0), ("a", 3, 2.0), ("b", 9, 0.0)], [("a", 4, 3.0), ("a", 5, 30.0), ("b", 8, 19.0), ("b", 7, 20.0)]], []
    for k, rows in enumerate(runs):
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(str(tmp_path / "in" / str(k)))
        watch.drain(watch.batched(spark.readStream.schema(schema).parquet(str(tmp_path / "in" / "*")), "q", "item", "at", most=2, seconds=20.0), lambda b, _: out.extend(b.collect()), str(tmp_path / "state"))
    assert {(r["q"], r["item"]): r["batch"] for r in out} == {("a", 1): 0, ("a", 2): 0, ("a", 3): 1, ("a", 4): 1, ("a", 5): 2, ("b", 9): 0, ("b", 8): 0, ("b", 7): 1}


def test_throttle_snapshot_and_stages(spark, tmp_path):
    now, done = [0.0], []
    sink = watch.throttled(lambda s: done.append(now[0]), 60.0, lambda: now[0])
    rows, none = spark.range(1), spark.range(0)
    for t, batch in ((0.0, none), (1.0, rows), (30.0, rows), (61.0, none), (62.0, none), (200.0, none), (201.0, rows)):
        now[0] = t
        sink(batch, 0)
    assert done == [1.0, 61.0, 201.0]

    loads = iter([spark.range(1), ValueError(), spark.range(3)])

    def load():
        x = next(loads)
        if isinstance(x, Exception):
            raise x
        return x

    held, now[0], sizes = watch.Snapshot(load, 120.0, lambda: now[0]), 0.0, []
    for t in (0.0, 119.0, 120.0, 239.0, 240.0):
        now[0] = t
        sizes.append(held.get().count())
    assert sizes == [1, 1, 1, 1, 3]

    spark.range(4).write.parquet(str(tmp_path / "in"))
    seen = []
    keep = lambda name: lambda b, k: seen.append((name, sorted(r[0] for r in b.collect())))
    stream = watch.snapshots(spark, str(tmp_path / "in"), spark.range(1).schema, 100)
    watch.staged(stream, [lambda b: b.where("id > 0"), lambda b: b.where("id > 1")], [keep("one"), keep("two")], str(tmp_path / "state"))
    assert seen == [("one", [1, 2, 3]), ("two", [2, 3])]


def test_reports_are_written(spark, tmp_path):
    from sessionloom.plans import reports as R

    rows = spark.createDataFrame([("b", 2.0, None), ("a", 1.0, "x")], "session string, score double, note string")
    R.write_lines(rows, str(tmp_path / "lines"))
    assert sorted(r[0] for r in spark.read.text(str(tmp_path / "lines")).collect()) == ['{"session":"a","score":1.0,"note":"x"}', '{"session":"b","score":2.0,"note":null}']
    R.write_manifest(rows, str(tmp_path / "names"))
    assert [r[0] for r in spark.read.text(str(tmp_path / "names")).orderBy("value").collect()] == ["a", "b"]
    poses = spark.createDataFrame([(2.0, "left", "head", 1.0), (1.0, "right", "head", 2.0), (1.0, "left", "stereo", 3.0)], "ts_ms double, side string, source string, x_mm double")
    R.write_trajectory(poses, str(tmp_path / "csv"))
    got = [r["x_mm"] for f in sorted((tmp_path / "csv").glob("*.csv")) for r in spark.read.option("header", True).csv(str(f)).collect()]
    assert got == ["3.0", "2.0", "1.0"]
