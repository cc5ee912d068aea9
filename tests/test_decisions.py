"""Decisions over sessions, against plain Python: what goes where, and what no task or driver may hold whole."""

import numpy as np
from pyspark.sql import functions as F

from sessionloom.plans import checks as C
from sessionloom.plans import sessions as P


def test_completeness_sends_no_files_to_the_driver(spark):
    """Many files of few rows look small to the planner; they are dealt out all the same."""
    rng = np.random.default_rng(4)
    names = ["a.mp4", "b.mp4", "c.jsonl", "d.jsonl"]
    wanted = [(int(s), str(rng.choice(names))) for s in rng.integers(0, 40, 90)]
    files = [(int(s), str(rng.choice([*names, "notes"])), int(rng.integers(0, 2))) for s in rng.integers(0, 45, 160)]
    sessions = spark.range(40).select(F.col("id").alias("session"), F.lit(True).alias("result_present"), F.lit("success").alias("result"), F.lit(True).alias("config_present"), F.lit(True).alias("config_ok"), F.when(F.col("id") % 5 == 0, 900).otherwise(0).alias("mtime"))
    out = C.completeness(sessions, spark.createDataFrame([*wanted, (None, "a.mp4"), (3, None)], "session long, path string"), spark.createDataFrame([*files, (None, "a.mp4", 1), (7, None, 1), (8, "b.mp4", None)], "session long, path string, size long"), F.lit(1000))
    have = {(s, p) for s, p, size in files if size}
    missing = {s: min(p for t, p in wanted if t == s and (s, p) not in have) for s in {s for s, p in wanted if (s, p) not in have}}
    want = {s: f"{missing[s]} missing or empty" if s in missing else "changed lately" if s % 5 == 0 else "" for s in range(40)}
    got = out.collect()
    assert len(got) == 40 and {r["session"]: r["reason"] for r in got} == want and all(r["complete"] == (r["reason"] == "") for r in got)
    assert len(set(want.values())) > 4 and "" in want.values()
    assert "Broadcast" not in out._jdf.queryExecution().executedPlan().toString()


def test_daily_batch_of_equal_names(spark):
    """Whatever order the rows come in, the same sessions of equal names go into the batch, also where the cap falls between them."""
    name = "session_20240215_{:02d}0000".format
    rows = [(name(h), "RIG-2", None, operator, True, size) for h, operator, size in ((9, "b", 30), (9, "a", 30), (8, "a", 50), (8, "a", 10), (8, "b", 20), (10, "a", 1))]
    schema = "name string, rig_code string, rig_id string, operator string, valid boolean, size_bytes long"
    for seed in range(6):
        order = np.random.default_rng(seed).permutation(len(rows)) if seed > 1 else range(len(rows))[:: 1 - 2 * seed]
        got = P.daily_batch(spark.createDataFrame([rows[k] for k in order], schema).coalesce(1), "2024-02-15", 2, cap_bytes=110).collect()
        assert sorted((r["name"], r["operator"], r["size_bytes"]) for r in got) == [(name(8), "a", 10), (name(8), "a", 50), (name(8), "b", 20), (name(9), "a", 30)]
        tight = P.daily_batch(spark.createDataFrame([rows[k] for k in order], schema).coalesce(1), "2024-02-15", 2, cap_bytes=40).collect()
        assert sorted(r["size_bytes"] for r in tight) == [10, 20]


def test_quick_pairing_counts_samples_without_distance(spark):
    """A side whose samples all lack a distance correlates as 0 with none found; a side without samples as null. Openings without a distance count for nothing."""
    rng = np.random.default_rng(8)
    sides = {(s, side): n for s, ends in {"both": (9, 8), "left_blind": (0, 7), "blind": (0, 0), "right_only": (None, 6), "few": (3, 9)}.items() for side, n in zip(("left", "right"), ends, strict=True) if n is not None}
    samples, want = [], {}
    for (s, side), n in sides.items():
        d, o = rng.normal(size=n).tolist(), rng.normal(size=n).tolist()
        samples += [(s, side, k, float(k), x, y) for k, (x, y) in enumerate(zip(d, o, strict=True))] + [(s, side, 90 + k, 90.0 + k, None, 1e6 * k) for k in range(3)]
        line = np.array([float(k) for k in range(n)])
        want[s, side] = (n, *(0.0 if n < 4 else float(np.corrcoef(d, v)[0, 1]) for v in (o, line)))
    sensors = [(s, side, t, t) for s in {s for s, _ in sides} for side in ("left", "right") for t in (0.0, 100.0)]
    out = P.quick_pairing(spark.createDataFrame(samples, "session string, side string, sample_id long, t double, distance double, opening double"), spark.createDataFrame(sensors, "session string, side string, t double, opening double"))
    got = {r["session"]: r for r in out.collect()}
    assert set(got) == {s for s, _ in sides}
    for s, r in got.items():
        for side, own, cross in (("left", "r_ll", "r_lr"), ("right", "r_rr", "r_rl")):
            n, *rs = want.get((s, side), (0, None, None))
            assert r[f"found_{side}"] == n
            assert [r[own], r[cross]] == [None, None] if rs[0] is None else np.allclose([r[own], r[cross]], rs)
    assert {s for s, r in got.items() if r["verdict"] == "inconclusive"} >= {"left_blind", "blind", "right_only", "few"}
